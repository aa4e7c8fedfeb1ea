"""Lines that many documents repeat are left in one of them only.

``LineRuns`` holds what is known of the line keys as levelled sorted runs: tables of (key, docs,
last), bucketed and sorted by the key's digest, so that joining them with a new batch moves the batch only.
A batch is folded, anti-joined with the runs (keys that have reached the wanted number of documents
there and whose last document is not older are settled and need not be written again), and added as
a run of its own on the lowest level. Two runs of a level are merged, bucket by bucket, into one of the level
above, so an entry is written again once per level and the levels grow with the logarithm of the batches.

A table is taken in batches from its largest ids down; then each document loses the lines whose
settled entry names a later document. Texts are scanned for keys, for the settled ones, and to be cut;
they are shuffled once, by a digest. Keys with more than 1/1000 of all entries are known to every
task and are not shuffled at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.encoding import ROWS, texts_of
from refrain.session import cut_lineage, remove_path, scratch_path
from refrain.sources.tables import read_table

SHORTEST = 40  # code points of a key
LEAST = 5  # documents that hold it
BATCHES = 4
_HEAVY = 1000
_HELD = 1 << 16  # keys that a task folds before it writes them
_BLANKS = b" \t\n\x0b\x0c\r"
ENTRY = "key binary, docs bigint, last bigint"


def line_key(line: bytes, shortest: int = SHORTEST) -> bytes | None:
    """Digest of a line without its outer blanks, A-Z lower-cased; None if that is too short."""
    body = line.strip(_BLANKS).lower()
    if len(body) < shortest or (not body.isascii() and len(body.decode()) < shortest):
        return None
    return xxhash.xxh3_128_digest(body)


def keys_of(text: str | None, shortest: int) -> set[bytes]:
    found = {line_key(line, shortest) for line in (text or "").encode().split(b"\n")}
    found.discard(None)
    return found


class LineRuns:
    """Levelled sorted runs of line keys, as bucketed tables in the shared folder."""

    def __init__(self, spark: SparkSession, least: int = LEAST) -> None:
        self.spark, self.least = spark, least
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = [[]]  # (table, folder) of each run

    def _write(self, entries: DataFrame, level: int) -> None:
        name, path = f"refrain_lines_{uuid.uuid4().hex}", scratch_path(self.spark, "lines")
        entries.write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def new_keys(self, entries: DataFrame) -> DataFrame:
        """The folded entries that no run has settled: with ``least`` 1, keys never seen before."""
        fresh = entries.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
        first = F.lit(-(1 << 63))
        for name, _ in [run for level in self.levels for run in level]:
            known = self.spark.table(name).filter(F.col("docs") >= self.least).select(F.col("key").alias("__k"), F.col("last").alias("__l"))
            fresh = fresh.join(known, (F.col("key") == F.col("__k")) & (F.coalesce("__l", first) >= F.coalesce("last", first)), "left_anti")
        return fresh

    def _merge(self, older: tuple[str, str], newer: tuple[str, str], level: int) -> None:
        """Two sorted runs become one, bucket by bucket; the old tables go."""
        other = self.spark.table(newer[0]).toDF("__k", "__d", "__l")
        both = self.spark.table(older[0]).join(other, F.col("key") == F.col("__k"), "full_outer")
        none = F.lit(0).cast("bigint")
        merged = both.select(F.coalesce("key", "__k").alias("key"), (F.coalesce("docs", none) + F.coalesce("__d", none)).alias("docs"), F.greatest("last", "__l").alias("last"))
        self._write(merged, level)
        self._drop([older, newer])

    def add(self, entries: DataFrame) -> None:
        """Add a batch of (key, docs, last)."""
        self._write(self.new_keys(entries), 0)
        level = 0
        while len(self.levels[level]) == 2:
            full, self.levels[level] = self.levels[level], []
            self._merge(*full, level + 1)
            level += 1

    def settled(self) -> DataFrame:
        """(key, docs, last) of the keys that enough documents hold, once all runs are one.

        ``docs`` counts those until the key was settled. The result reads that run; see ``close``.
        """
        while (runs := [run for level in self.levels for run in level])[1:]:
            self.levels = [[], *([run] for run in runs[2:]), []]
            self._merge(*runs[:2], len(self.levels) - 1)
        if not runs:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.table(runs[0][0]).filter(F.col("docs") >= self.least)

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove_path(self.spark, path)

    def close(self) -> None:
        for level in self.levels:
            self._drop(level)
        self.levels = [[]]


def _entries(docs: DataFrame, text: str, shortest: int) -> DataFrame:
    """(batch, key, docs, last) of (batch, doc_id, text); equal keys of a task are folded."""
    names, kinds = ["batch", "key", "docs", "last"], [pa.int32(), pa.binary(), pa.int64(), pa.int64()]

    def rows(held: dict[tuple[int, bytes], list]) -> pa.RecordBatch:
        columns = [[b for b, _ in held], [k for _, k in held], [v[0] for v in held.values()], [v[1] for v in held.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], list] = {}
        for batch in batches:
            for number, doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)), strict=True):
                for key in keys_of(body, shortest):
                    entry = held.setdefault((number, key), [0, None])
                    entry[0] += 1
                    if doc_id is not None and (entry[1] is None or doc_id > entry[1]):
                        entry[1] = doc_id
                if len(held) >= _HELD:
                    yield rows(held)
                    held = {}
        yield rows(held)

    return docs.select("batch", "doc_id", text).mapInArrow(run, f"batch int, {ENTRY}")


def _light_lines(docs: DataFrame, text: str, shortest: int, heavy: frozenset[bytes]) -> DataFrame:
    """(doc_id, mark, key): the different keys of each row but the heavy ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = [keys_of(body, shortest) - heavy for body in texts_of(part.column(2))]
                at = pa.array([i for i, keys in enumerate(found) for _ in keys], pa.int32())
                keys = pa.array([k for keys in found for k in keys], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), keys], names=["doc_id", "mark", "key"])

    return docs.select("doc_id", "mark", text).mapInArrow(run, "doc_id bigint, mark bigint, key binary")


def cut_text(text: str | None, dropped: set[bytes], shortest: int = SHORTEST) -> tuple[int, int, str]:
    """(lines before, lines dropped, text that stays)."""
    lines = (text or "").encode().split(b"\n")
    kept = [x for x in lines if (key := line_key(x, shortest)) is None or key not in dropped] if dropped else lines
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


def drop_lines(docs: DataFrame, text: str = "text", *, least: int = LEAST, shortest: int = SHORTEST, batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and the text without the lines found elsewhere.

    A line whose key is in at least ``least`` rows stays only in those with the largest doc_id that
    holds it, there as often as it occurs. Rows count, so rows that share a doc_id count each, and
    all of the largest id keep the line. A null doc_id is smaller than any other; if only such rows hold a line,
    all keep it. Null and empty texts are one empty line and become empty texts. Other columns stay
    as they are; columns named n_lines and n_dropped are replaced.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"), F.col(text).alias("body"))
    low, high = narrow.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = (high or 0) - (low or 0) + 1
    batch = F.coalesce(F.floor((F.lit(high) - F.col("doc_id")).cast("double") * batches / width).cast("int"), F.lit(batches - 1))
    path = scratch_path(spark, "line-entries")
    _entries(narrow.withColumn("batch", F.least(batch, F.lit(batches - 1))), "body", shortest).write.partitionBy("batch").parquet(path)
    stored = spark.read.schema(f"{ENTRY}, batch int").parquet(path)
    runs = LineRuns(spark, least)
    for number in range(batches):  # from the largest ids down
        runs.add(stored.filter(F.col("batch") == number).drop("batch"))
    settled = cut_lineage(runs.settled().filter("last is not null"))
    runs.close()
    remove_path(spark, path)
    total = settled.agg(F.sum("docs")).first()[0] or 0
    # fewer than _HEAVY rows, as each has more than that part of the total
    heavy = {bytes(r["key"]): r["last"] for r in settled.filter(F.col("docs") * _HEAVY > total).collect()}
    rare = settled.filter(F.col("docs") * _HEAVY <= total).select("key", "last")
    lines = _light_lines(narrow, "body", shortest, frozenset(heavy))
    listed = lines.join(rare, "key").filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last")))
    lists = listed.groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__text")).agg(F.collect_set("key").alias("__keys"))  # of one text
    marked = docs.select(*own).withColumns({"__mark": F.xxhash64(F.coalesce(F.col(text), F.lit(""))), "__doc": F.col("doc_id").cast("bigint")})
    joined = marked.join(lists, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__text")), "left").drop("__mark", "__id", "__text")
    schema = docs.select(*own).withColumns({"n_lines": F.lit(None).cast("bigint"), "n_dropped": F.lit(None).cast("bigint")}).schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for start in range(0, whole.num_rows, ROWS):
                part = whole.slice(start, ROWS)
                made = []
                for doc_id, keys, body in zip(part.column("__doc").to_pylist(), part.column("__keys").to_pylist(), part.column(text).to_pylist(), strict=True):
                    gone = set(keys or ())
                    gone.update(k for k, last in heavy.items() if doc_id is None or doc_id < last)
                    made.append(cut_text(body, gone, shortest))
                columns = {c: part.column(c) for c in own} | {text: pa.array([m[2] for m in made], pa.string())}
                counts = [pa.array([m[k] for m in made], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns.values(), *counts], names=[*own, "n_lines", "n_dropped"])

    return joined.mapInArrow(run, schema)


def line_digests(spark: SparkSession, root: str) -> DataFrame:
    kept = drop_lines(read_table(spark, root, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op13_lines": line_digests}
_SQL = f"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place from documents
), k as (
  select *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l
), often as (
  select key, max(doc_id) as last from k where length(key) >= {SHORTEST} group by key having count(distinct doc_id) >= {LEAST}
), m as (
  select k.*, last is not null and k.doc_id < last as dropped from k left join often using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '')) as kept_sha256
from m group by doc_id"""

ORACLES: dict[str, str] = {"op13_lines": _SQL}
