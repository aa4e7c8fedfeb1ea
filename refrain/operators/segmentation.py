"""Word segmentation for scripts without spaces: a lexicon learned from the texts, and best paths.

A string of characters is a word when it holds together (its count is well above what any division
into two parts would give by chance) and stands free (many different characters precede and follow
it). Both come from counts of strings of up to ``LONGEST`` + 1 characters, which fold inside the
tasks. A run of text is then cut along the path of the highest product of word shares; that is a
walk over its characters with at most ``LONGEST`` steps for each, so it is linear in the text.

Texts are never shuffled. The lexicon used for cutting is bounded by ``MOST`` words, so it may go
to every task; characters that it lacks stand alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.operators.tokens import IDEOGRAPH, NOT_A_WORD
from refrain.session import cut_lineage

LONGEST = 5  # characters of a word
LEAST_COUNT = 5
LEAST_COHESION = 1.5  # natural logarithm
LEAST_FREEDOM = 1.0  # entropy of the neighbours on the narrower side
MOST = 1 << 18
TOGETHER = 1 << 21  # characters whose strings a task counts at once
SIDE_BY_SIDE = 1 << 14  # phrases
ALONE = 16
_START, _END = "\x02", "\x03"
_BESIDE = "[^\\p{L}\\p{N}\\s]+"  # what ends a phrase


def ideograph_runs(text: Column) -> Column:
    """Stretches of ideographs of a text, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{IDEOGRAPH}+"), F.lit(0))


def phrases(text: Column) -> Column:
    """Lower-cased stretches between marks, words still apart by single spaces."""
    tidy = F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), _BESIDE), lambda p: F.trim(F.regexp_replace(p, "\\s+", " ")))
    return F.filter(tidy, lambda p: p != "")


def joined_runs(text: Column) -> Column:
    """The phrases of a text without their spaces, as if its script had none."""
    return F.transform(phrases(text), lambda p: F.replace(p, F.lit(" "), F.lit("")))


def windows(runs: Mapping[str, int], longest: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """For each length the different strings of the runs, and how often they occur, a run as often as it is given.

    Strings are numbered: one of a length is that of the length before and a character more.
    """
    joined = "".join(f"{_START}{r}{_END}" for r in runs)
    sizes = np.array([len(r) + 2 for r in runs], np.int64)
    times = np.repeat(np.array(list(runs.values()), np.int64), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(joined))  # characters up to the end of the run
    alphabet, code = np.unique(np.frombuffer(joined.encode("utf-32-le"), np.uint32), return_inverse=True)
    at, number = np.arange(len(joined)), np.zeros(len(joined), np.int64)
    for length in range(1, longest + 1):
        going = left[at] >= length
        at, number = at[going], number[going]
        number, n = _numbered(number * len(alphabet) + code[at + length - 1])
        where = np.zeros(n, np.int64)
        where[number] = at  # any place of the string
        yield [joined[i : i + length] for i in where.tolist()], np.bincount(number, times[at], n).astype(np.int64)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 0 of the different keys, and how many there are; sorted only if the keys lie far apart."""
    span = int(keys.max(initial=-1)) + 1
    if span > 8 * len(keys):
        found, number = np.unique(keys, return_inverse=True)
        return number, len(found)
    seen = np.zeros(span, bool)
    seen[keys] = True
    numbers = np.cumsum(seen) - 1
    return numbers[keys], int(numbers[-1]) + 1 if span else 0


def string_counts(runs: DataFrame, longest: int) -> DataFrame:
    """(string, length, n): how often each string of up to ``longest`` characters occurs in ``run``.

    A run is framed by two marks that count as characters, so that its ends are neighbours like any
    other. Strings are counted where the runs lie, ``TOGETHER`` characters at a time; only counts are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for strings, n in windows(held, longest):
                yield pa.RecordBatch.from_arrays([pa.array(strings, pa.string()), pa.array(n)], names=["string", "n"])

        for batch in batches:
            for r in batch.column(0).to_pylist():
                if r not in held:
                    size += len(r) + 2
                held[r] = held.get(r, 0) + 1
                if size >= TOGETHER:
                    yield from counted()
                    held.clear()
                    size = 0
        if held:
            yield from counted()

    counts = runs.select("run").filter("run <> ''").mapInArrow(run, "string string, n bigint").groupBy("string").agg(F.sum("n").alias("n"))
    return counts.withColumn("length", F.char_length("string"))


def learn(
    runs: DataFrame,
    *,
    longest: int = LONGEST,
    least_count: int = LEAST_COUNT,
    least_cohesion: float = LEAST_COHESION,
    least_freedom: float = LEAST_FREEDOM,
) -> DataFrame:
    """(word, n, cohesion, freedom) of the words of ``run``, with its single characters (both null)."""
    counts = cut_lineage(string_counts(runs, longest + 1))
    framed = F.col("string").contains(_START) | F.col("string").contains(_END)
    inner = counts.filter(~framed)
    total = inner.filter("length = 1").agg(F.sum("n")).scalar()
    known = inner.select("string", "n")
    candidates = inner.filter((F.col("length") > 1) & (F.col("length") <= longest) & (F.col("n") >= least_count))
    # cohesion: the division that chance explains best
    splits = candidates.select("string", "n", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    halves = splits.select("string", "n", F.substring("string", F.lit(1), F.col("k")).alias("a"), F.substring("string", F.col("k") + 1, F.lit(longest)).alias("b"))
    both = halves.join(known.toDF("a", "na"), "a").join(known.toDF("b", "nb"), "b")
    bound = F.ln(F.col("n") / F.col("na")) - F.ln(F.col("nb") / F.col("__total"))
    cohesion = both.withColumn("__total", total).groupBy("string").agg(F.round(F.min(bound), 6).alias("cohesion"))

    def entropy(name: str, key: Column) -> DataFrame:
        around = counts.filter((F.col("length") > 2)).select(key.alias("string"), "n").filter(~framed)
        spread = F.ln(F.sum("n")) - F.sum(F.col("n") * F.ln("n")) / F.sum("n")
        return around.groupBy("string").agg(F.round(spread, 6).alias(name))

    after = entropy("after", F.substring("string", F.lit(1), F.col("length") - 1))
    before = entropy("before", F.substring("string", F.lit(2), F.col("length") - 1))
    scored = candidates.join(cohesion, "string").join(after, "string").join(before, "string")
    free = scored.select("string", "n", "cohesion", F.least("before", "after").alias("freedom"))
    words = free.filter((F.col("cohesion") >= least_cohesion) & (F.col("freedom") >= least_freedom))
    alone = inner.filter("length = 1").select("string", "n", F.lit(None).cast("double").alias("cohesion"), F.lit(None).cast("double").alias("freedom"))
    return cut_lineage(words.unionByName(alone).withColumnRenamed("string", "word"))


def weights(lexicon: DataFrame, most: int = MOST) -> dict[str, float]:
    """Logarithm of the share of each of the ``most`` most frequent words, for ``cut_words``."""
    rows = lexicon.orderBy(F.desc("n"), "word").limit(most).select("word", "n").collect()
    total = sum(r["n"] for r in rows)
    return {r["word"]: math.log(r["n"] / total) for r in rows}


def weight_of_unknown(shares: Mapping[str, float]) -> float:
    """The weight of a character that is no word: less than that of any word."""
    return 2 * min(shares.values(), default=-1.0) - 1


def best_path(run: str, shares: Mapping[str, float], longest: int = LONGEST, unknown: float | None = None) -> list[str]:
    """The words of the division with the highest sum of weights; of equal ones that with the longer last word.

    ``unknown`` is ``weight_of_unknown``, given by those who cut many runs: finding it reads all shares.
    """
    if unknown is None:
        unknown = weight_of_unknown(shares)
    best, step = [0.0], [0]
    for end in range(1, len(run) + 1):
        top, size = best[end - 1] + shares.get(run[end - 1], unknown), 1
        for k in range(2, min(longest, end) + 1):
            weight = shares.get(run[end - k : end])
            if weight is not None and best[end - k] + weight >= top:
                top, size = best[end - k] + weight, k
        best.append(top)
        step.append(size)
    words, end = [], len(run)
    while end:
        words.append(run[end - step[end] : end])
        end -= step[end]
    return words[::-1]


def cut_words(runs: Column, shares: Mapping[str, float], longest: int = LONGEST) -> Column:
    """The words of a list of runs, in order."""
    unknown = weight_of_unknown(shares)

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for start in range(0, len(batch), 256):
                rows = batch.slice(start, 256).to_pylist()
                parts.append(pa.array([None if r is None else [w for x in r for w in best_path(x, shares, longest, unknown)] for r in rows], pa.list_(pa.string())))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return run(runs)


def document_words(documents: DataFrame, shares: Mapping[str, float], text: str = "text") -> DataFrame:
    """``documents`` with ``words``: lower-cased words, and ideographs cut along the best path.

    Texts without ideographs never leave the JVM. Words of other scripts beside ideographs keep
    their order among themselves and come first.
    """
    body = F.lower(F.coalesce(F.col(text), F.lit("")))
    plain = F.array_remove(F.split(F.regexp_replace(body, f"{IDEOGRAPH}+", " "), NOT_A_WORD), "")
    if not shares:
        return documents.withColumn("words", plain)
    has = body.rlike(IDEOGRAPH)
    spaced = documents.filter(~has | F.col(text).isNull()).withColumn("words", plain)
    mixed = documents.filter(has).withColumn("words", F.concat(plain, cut_words(ideograph_runs(body), shares)))
    return spaced.unionByName(mixed)


class _Trie:
    """The words as a trie in arrays: edges (node, character) in a table with open addresses, weights by node."""

    def __init__(self, shares: Mapping[str, float], longest: int) -> None:
        words = [w for w in shares if 0 < len(w) <= longest]
        chars = [np.frombuffer(w.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for w in words]
        lengths, weight = np.array([len(c) for c in chars], np.int64), np.array([shares[w] for w in words], np.float64)
        table = np.full((len(words), longest), -1, np.int64)
        for k, c in enumerate(chars):
            table[k, : len(c)] = c
        node, nodes, edges, weights = np.zeros(len(words), np.int64), 1, [], [np.full(1, -np.inf)]
        for depth in range(longest):
            going = lengths > depth
            found, number = np.unique(node[going] << 21 | table[going, depth], return_inverse=True)
            edges.append(found)
            node[going] = nodes + number
            own = np.full(len(found), -np.inf)
            here = lengths == depth + 1
            own[node[here] - nodes] = weight[here]
            weights.append(own)
            nodes += len(found)
        keys = np.concatenate(edges)
        self.weights = np.concatenate(weights)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.children = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        left = np.arange(len(keys))
        at = self._home(keys)
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]  # of several the last one stays
            done = self.keys[at] == keys[left]
            self.children[at[done]] = left[done] + 1
            left, at = left[~done], (at[~done] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def child(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The nodes that the characters lead to; 0 where there is none."""
        keys = node << 21 | char
        out, left, at = np.zeros(len(keys), np.int64), np.arange(len(keys)), self._home(keys)
        while len(left):
            there = self.keys[at]
            same = there == keys[left]
            out[left[same]] = self.children[at[same]]
            on = ~same & (there != -1)
            left, at = left[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out

    def ending(self, codes: np.ndarray, left: np.ndarray, longest: int, unknown: float) -> list[np.ndarray]:
        """For each length the weights of the words that end at each character; ``left`` counts characters up to a run's end."""
        out = [np.full(len(codes), unknown), *(np.full(len(codes), -np.inf) for _ in range(longest - 1))]
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for k in range(longest):
            going = left[at] > k
            at, node = at[going], node[going]
            node = self.child(node, codes[at + k])
            at, node = at[node > 0], node[node > 0]
            weight = self.weights[node]
            word = weight > -np.inf
            out[k][at[word] + k] = weight[word]
        return out


def path_ends(codes: np.ndarray, sizes: np.ndarray, trie: _Trie, longest: int, unknown: float) -> np.ndarray:
    """Which characters of the runs end a word on the path that ``best_path`` finds, for all runs side by side.

    ``codes`` are the characters of all runs, ``sizes`` their lengths. The work of a step is that of
    the runs that are as long, so a few much longer ones than the others are better cut alone.
    """
    stops = np.cumsum(sizes)
    weights = trie.ending(codes, np.repeat(stops, sizes) - np.arange(len(codes)), longest, unknown)
    order = np.argsort(-sizes, kind="stable")
    start, size = (stops - sizes)[order], sizes[order]
    steps = np.ones(len(codes), np.int8)
    best = [np.zeros(len(sizes))]  # of the last ends, the latest first
    for end in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -end, side="left"))  # runs with a character at this place
        at = start[:n] + end
        top, step = best[0][:n] + weights[0][at], np.ones(n, np.int8)
        for k in range(1, min(longest, end + 1)):
            other = best[k][:n] + weights[k][at]
            better = (other >= top) & (other > -np.inf)
            top = np.where(better, other, top)
            step[better] = k + 1
        steps[at] = step
        best = [top, *best[: longest - 1]]
    ends = np.zeros(len(codes), bool)
    last, first = (stops - 1)[sizes > 0], (stops - sizes)[sizes > 0]
    while len(last):
        ends[last] = True
        last = last - steps[last]
        last, first = last[last >= first], first[last >= first]
    return ends


def boundary_scores(documents: DataFrame, shares: Mapping[str, float], longest: int = LONGEST) -> DataFrame:
    """Per document, how well its joined phrases are cut: words that the spaces give, words found, and ends in common.

    Phrases of a few documents are cut side by side, but for the ``ALONE`` longest ones.
    """
    names = ["n_true", "n_found", "n_common"]
    shared = documents.sparkSession.sparkContext.broadcast(dict(shares))

    def counted(rows: pa.ListArray, trie: _Trie, unknown: float) -> list[np.ndarray]:
        said = rows.flatten()
        owner = np.repeat(np.arange(len(rows)), pc.fill_null(pc.list_value_length(rows), 0).to_numpy())
        full = np.frombuffer("".join(said.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = pc.utf8_length(said).to_numpy().astype(np.int64)
        space = full == ord(" ")
        true = np.append(space, True)[1:]
        true[np.cumsum(sizes)[sizes > 0] - 1] = True
        phrase = np.repeat(np.arange(len(sizes)), sizes)[~space]
        codes, true = full[~space], true[~space]
        sizes = np.bincount(phrase, minlength=len(sizes))
        alone = np.zeros(len(sizes), bool)
        alone[np.argsort(-sizes, kind="stable")[:ALONE]] = True
        found = np.zeros(len(codes), bool)
        beside = ~alone[phrase]
        found[beside] = path_ends(codes[beside], sizes[~alone], trie, longest, unknown)
        for k in np.flatnonzero(alone).tolist():
            here = slice(*np.searchsorted(phrase, [k, k + 1]))
            words = best_path(codes[here].astype(np.uint32).tobytes().decode("utf-32-le"), shared.value, longest, unknown)
            found[here.start + np.cumsum([len(w) for w in words], dtype=np.int64) - 1] = True
        of = owner[phrase]
        return [np.bincount(of[x], minlength=len(rows)) for x in (true, found, true & found)]

    @F.arrow_udf("n_true bigint, n_found bigint, n_common bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie, unknown = _Trie(shared.value, longest), weight_of_unknown(shared.value)
        for batch in batches:
            made, start = [], 0
            size = np.cumsum(pc.fill_null(pc.list_value_length(batch), 0).to_numpy())
            while start < len(batch):
                # as many documents as have SIDE_BY_SIDE phrases together, one at least
                stop = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + SIDE_BY_SIDE, side="right")))
                made.append(counted(batch.slice(start, stop - start), trie, unknown))
                start = stop
            columns = [np.concatenate([m[i] for m in made]) if made else np.zeros(0, np.int64) for i in range(3)]
            yield pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    return documents.select("doc_id", run(phrases(F.col("text"))).alias("s")).select("doc_id", "s.*")
