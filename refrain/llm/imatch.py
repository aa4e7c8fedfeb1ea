"""I-Match fingerprints: distinct terms of a middle document-frequency band under randomised lexicons.

The band leaves out the frequent and the rare terms of the corpus. A lexicon is a fixed random
subset of the band: ``FAMILIES`` digests give each term a level (level k or more with probability
2^-k), and the lexicon of a family and level holds the terms of that level and above. A text's part
under a lexicon is one hash of its terms there, in sorted order; the fingerprint lists the parts of all
lexicons. Two texts are compared under the sparsest level at which lexicons still meet their terms,
where parts agree about as often as the texts share their terms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refrain.llm.counters import BLOCKS, add_up, bucket_of, counting, distinct_texts, tally
from refrain.llm.encoding import mapped
from refrain.session import remove_path
from refrain.sources.tables import read_table

FAMILIES = 20
LEVELS = 11  # a lexicon holds 1, 1/2, ... 1/1024 of the band
BAND = (5e-4, 0.20)  # shares of all distinct texts; terms of one text only are below it anyway


def term_hashes(text: str) -> np.ndarray:
    """Sorted digests of the distinct terms of a text: ASCII-lower-cased words without end marks."""
    terms = {w.strip(b".,;:!?\"'()[]") for w in text.encode().lower().split()}
    terms.discard(b"")
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))
    hashes.sort()
    return hashes


class Lexicons:
    """The terms of the band as sorted digests, and the digests that deal them to the lexicons.

    A text without a term in the band is fingerprinted by the rarer half of its terms (by counters).
    """

    def __init__(self, terms: np.ndarray, counts: np.ndarray, families: int = FAMILIES, levels: int = LEVELS) -> None:
        self.terms, self.counts, self.families, self.levels = terms, counts, families, levels
        rng = np.random.default_rng(20)
        self.seeds = rng.integers(1, 1 << 62, families, dtype=np.uint64) | np.uint64(1)
        # leading zeros of every value of so many bits
        self.zeros = np.array([levels - 1 - i.bit_length() for i in range(1 << levels - 1)], np.int8)

    def in_band(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(terms), bool)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return self.terms[at] == terms

    def levels_of(self, terms: np.ndarray) -> np.ndarray:
        """The highest level of each term in each family, by the term's digest alone."""
        mixed = terms[None, :] * self.seeds[:, None]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed >>= np.uint64(64 - (self.levels - 1))
        return self.zeros[mixed.astype(np.int64)]

    def fingerprint(self, text: str) -> str:
        """Parts joined by ``.``, the lexicons of level 0 first; empty parts where a text has no term."""
        terms = term_hashes(text)
        if not len(terms):
            return "." * (self.families * self.levels - 1)
        inside = self.in_band(terms)
        if not inside.any():
            seen = self.counts[bucket_of(terms)]
            inside = seen <= np.sort(seen)[(len(seen) - 1) // 2]  # with all that are as frequent as the last one
        terms = terms[inside]
        levels = self.levels_of(terms)
        # sorted by level and, as they are, by digest: the terms of a lexicon come first
        data = terms[np.argsort(-levels, axis=1, kind="stable")].tobytes()
        at = levels.astype(np.int64) + self.levels * np.arange(self.families)[:, None]
        here = np.bincount(at.ravel(), minlength=self.families * self.levels).reshape(self.families, self.levels)
        held = np.cumsum(here[:, ::-1], axis=1)[:, ::-1].tolist()  # terms of this level and above
        parts = [""] * (self.families * self.levels)
        for family in range(self.families):
            start, last, mark = 8 * len(terms) * family, 0, ""
            for k in range(self.levels - 1, -1, -1):
                if (n := held[family][k]) != last:
                    last, mark = n, xxhash.xxh3_64_hexdigest(data[start : start + 8 * n])[:4]
                parts[k * self.families + family] = mark
        return ".".join(parts)


def likeness(a: str, b: str, families: int = FAMILIES) -> float:
    """Share of equal parts at the sparsest level where half of the lexicons hold a term of either text."""
    left, right = a.split("."), b.split(".")
    for start in range(len(left) - families, -1, -families):
        pairs = [(x, y) for x, y in zip(left[start : start + families], right[start : start + families], strict=True) if x or y]
        if 2 * len(pairs) >= families:
            return sum(x == y for x, y in pairs) / len(pairs)
    return float(a == b)


def lexicons_of(docs: DataFrame, text: str = "text", band: tuple[float, float] = BAND) -> Lexicons:
    """Lexicons over the distinct texts of a table, so that copies do not lift their terms out of the band.

    Counters of a fixed size tell which terms may be frequent enough; those are counted exactly. As
    a text has few terms compared with the reciprocal of the band's lower end, so has the band: at most the
    mean number of terms of a text over ``band[0]``, whatever the size of the table.
    """
    texts, path = distinct_texts(docs, text)
    counts, documents = add_up(texts.mapInArrow(counting(term_hashes), BLOCKS))
    lowest, highest = max(1.0, band[0] * documents), max(2.0, band[1] * documents)
    chosen = tally(texts, term_hashes, counts, lowest).filter((F.col("n") > lowest) & (F.col("n") <= highest))
    rows = chosen.select("item").toArrow()
    remove_path(docs.sparkSession, path)
    return Lexicons(np.sort(rows.column("item").to_numpy().view(np.uint64)), counts)


def fingerprints(docs: DataFrame, lexicons: Lexicons, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of a text column; null counts as empty, an empty text has empty parts."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)

    def marks(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([shared.value.fingerprint(t or "") for t in batch.column(text).to_pylist()], pa.string())]

    return mapped(docs, {out: "string"}, marks)


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(bucket, extra, id, text) in ranges of doc_id, each followed by the document after it.

    The last document of a range needs the first one of the next range (the last of all needs the
    first of all). Which documents those are is found from the ids alone, one row for each range;
    they are sent to both ranges, marked ``extra`` in the earlier one. So texts are shuffled once.
    A null doc_id comes first; rows that share one are ordered by a digest of their texts.
    """
    count = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(2**63))).alias("id"))
    shares = [i / count for i in range(1, count)]
    cuts = rows.agg(F.percentile_approx("id", shares, 10_000)).first()[0] if shares else None
    place = F.size(F.filter(F.lit(sorted(set(cuts))), lambda c: c <= F.col("id"))) if cuts else F.lit(0)
    ranged = rows.withColumn("bucket", place.cast("int"))
    firsts = ranged.groupBy("bucket").agg(F.min("id").alias("__first"))
    along = Window.partitionBy(F.lit(0))  # one row for each range
    earlier = F.coalesce(F.lag("bucket").over(along.orderBy("bucket")), F.max("bucket").over(along))
    firsts = firsts.select("__first", earlier.alias("__earlier"))
    both = ranged.join(F.broadcast(firsts), ranged["id"] == firsts["__first"], "left")
    own = F.struct(F.col("bucket"), F.lit(0).alias("extra"))
    also = F.struct(F.col("__earlier").alias("bucket"), F.lit(1).alias("extra"))
    both = both.withColumn("__to", F.explode(F.when(F.col("__earlier").isNull(), F.array(own)).otherwise(F.array(own, also))))
    sent = both.select("__to.bucket", "__to.extra", "id", "doc_id", "text")
    return sent.repartitionById(count, F.col("bucket")).sortWithinPartitions("bucket", "extra", "id", F.xxhash64("text"))


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of a text's code points replaced by as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_neighbours(docs: DataFrame, lexicons: Lexicons) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and the next."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)
    names = [part.split()[0] for part in RESULT.split(", ")]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        last: tuple[int, int | None, str, str] | None = None  # bucket, doc_id, text, fingerprint
        done = None  # the bucket whose follower has come
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256).to_pydict()
                out: dict[str, list] = {n: [] for n in names}
                for bucket, extra, doc_id, body in zip(part["bucket"], part["extra"], part["doc_id"], part["text"], strict=True):
                    if extra and done == bucket:
                        continue  # rows that share the follower's doc_id
                    body = body or ""
                    mark = marks.fingerprint(body)
                    if last is not None and last[0] == bucket:
                        text = edited(last[2], body)
                        other = marks.fingerprint(text)
                        values = (last[1], len(last[2]), hashlib.sha256(text.encode()).hexdigest(), last[3], other, likeness(last[3], other), likeness(last[3], mark))
                        for n, v in zip(names, values, strict=True):
                            out[n].append(v)
                    last, done = (None, bucket) if extra else ((bucket, doc_id, body, mark), done)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(out["doc_id"], pa.int64()), "n_chars": pa.array(out["n_chars"], pa.int64()), **{n: pa.array(out[n], pa.string()) for n in names[2:5]}, **{n: pa.array(out[n], pa.float64()) for n in names[5:]}})

    return with_next(docs).mapInArrow(compared, RESULT)


def fingerprint_report(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    return compare_neighbours(docs, lexicons_of(docs))


QUERIES = {"op4_imatch": fingerprint_report}
ORACLES: dict[str, str] = {}
