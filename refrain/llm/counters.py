"""Document counts of hashed items in a fixed number of counters.

Counting every shingle or term of a corpus exactly would shuffle all of them. Here each task adds
up its documents in ``BUCKETS`` counters and sends them as a few slices, which are added in Spark.
The result is one number for each counter, 8 MB in all whatever the corpus holds, so it may go to
every task. A counter is an upper bound of its items' document counts; operators use it to order or
to select items, alike for all documents, never to decide on a pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.encoding import texts_of
from refrain.session import cut_lineage, scratch_path

BUCKETS = 1 << 20
SLICES = 64
_WIDTH = BUCKETS // SLICES
_ROWS = -1  # the slice that holds the number of rows
BLOCKS = "slice int, block binary"
MARKS = 1 << 20
_SEEN = 1 << 16  # digests of texts that a task remembers
_HELD = 1 << 21  # items that a task holds before it folds them
_REPEATED = 1 << 27  # marks of items that occur again
_RANGES = 256  # in which items are searched for others like them


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


class Counts:
    """The counters of one task."""

    def __init__(self) -> None:
        self.counts, self.rows = np.zeros(BUCKETS, np.int64), 0

    def add(self, hashes: np.ndarray) -> None:
        """Count one document's distinct items."""
        np.add.at(self.counts, bucket_of(hashes), 1)
        self.rows += 1

    def blocks(self) -> tuple[pa.Array, pa.Array]:
        """Columns slice and block, for all slices with any count."""
        parts = {k: self.counts[k * _WIDTH : (k + 1) * _WIDTH] for k in range(SLICES)}
        parts = {k: part for k, part in parts.items() if part.any()} | {_ROWS: np.array([self.rows], np.int64)}
        return pa.array(list(parts), pa.int32()), pa.array([p.tobytes() for p in parts.values()], pa.binary())


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(block.as_buffer(), np.int64)
            sums[k] = sums[k] + part if k in sums else part.copy()
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["slice", "block"])


def add_up(blocks: DataFrame) -> tuple[np.ndarray, int]:
    """All counters and the number of rows, from (slice, block) of any number of tasks."""
    counts, rows = np.zeros(BUCKETS, np.int64), 0
    for k, block in blocks.repartition(SLICES, "slice").mapInArrow(_add_slices, BLOCKS).collect():
        part = np.frombuffer(block, np.int64)
        if k == _ROWS:
            rows = int(part[0])
        else:
            counts[k * _WIDTH : (k + 1) * _WIDTH] = part
    return counts, rows


def count_documents(docs: DataFrame, text: str, items: Callable[[str], np.ndarray]) -> tuple[np.ndarray, int]:
    """Counters of the distinct items of all texts (null: none), and the number of rows."""
    return add_up(docs.select(text).mapInArrow(counting(items), BLOCKS))


def counting(items: Callable[[str], np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for batch in batches:
            for body in texts_of(batch.column(0)):
                counts.add(items(body or ""))
        yield pa.RecordBatch.from_arrays([*counts.blocks()], names=["slice", "block"])

    return count


def repeated(rows: DataFrame, items: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> np.ndarray:
    """Marks of the items (digests) that occur more than once in all, for ``is_marked``; 16 MB whatever there is.

    Tasks send the upper 32 bits of their items, each at most twice at a time. Items that share them,
    or a mark, pass as repeated as well; an item that does occur again is never left out.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def folded() -> pa.RecordBatch:
            found = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint32)
            found = found[np.append(np.ones(min(2, len(found)), bool), found[2:] != found[:-2])]
            cuts = np.searchsorted(found, np.arange(_RANGES + 1, dtype=np.uint64) << np.uint64(24))
            blocks = [found[cuts[k] : cuts[k + 1]].tobytes() for k in range(_RANGES)]
            return pa.RecordBatch.from_arrays([pa.array(range(_RANGES), pa.int32()), pa.array(blocks, pa.binary())], names=["slice", "block"])

        for keys in items(batches):
            held.append((keys.view(np.uint64) >> np.uint64(32)).astype(np.uint32))
            size += len(keys)
            if size >= _HELD:
                yield folded()
                held, size = [], 0
        yield folded()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def marked() -> pa.RecordBatch:
            found = np.sort(np.concatenate(held))
            marks = np.zeros(_REPEATED // _RANGES, bool)
            marks[_mark(found[1:][found[1:] == found[:-1]]) % len(marks)] = True
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())], names=["slice", "block"])

        for batch in batches:
            for k, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if k != now and held:
                    yield marked()
                    held = []
                now = k
                held.append(np.frombuffer(block.as_py(), np.uint32))
        if held:
            yield marked()

    marks = np.zeros(_REPEATED // 8, np.uint8)
    width = len(marks) // _RANGES
    ranges = rows.mapInArrow(send, BLOCKS).repartition(SLICES, "slice").sortWithinPartitions("slice")
    for k, block in ranges.mapInArrow(search, BLOCKS).collect():
        marks[k * width : (k + 1) * width] = np.frombuffer(block, np.uint8)
    return marks


def _mark(upper: np.ndarray) -> np.ndarray:
    return upper >> np.uint32(32 - (_REPEATED.bit_length() - 1))


def is_marked(marks: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Which of the items ``repeated`` has marked."""
    mark = _mark((items.view(np.uint64) >> np.uint64(32)).astype(np.uint32))
    return (marks[mark >> np.uint32(3)] >> (mark & np.uint32(7)).astype(np.uint8)) & np.uint8(1) == 1


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose digests the task does not remember; it forgets all of them when they are many."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        keep = []
        for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keep.append(key not in seen)
            if len(seen) >= _SEEN:
                seen.clear()
            seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _first_of_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (a, b, body) the first body of each (a, b)."""
    last = None
    for batch in batches:
        keep = []
        for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keep.append(key != last)
            last = key
        yield batch.select([2]).filter(pa.array(keep, pa.bool_()))


def distinct_texts(docs: DataFrame, text: str) -> tuple[DataFrame, str]:
    """(body) of every different text, and the folder of those that occur again, for the caller to remove.

    Digests alone are grouped to find the texts that occur again. Only rows that share one of
    ``MARKS`` marks with such a text are sent to where their copies meet, at most a few for each
    task and text; all others stay where they are read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.xxhash64(body).alias("a"), F.xxhash64(F.lit("text"), body).alias("b"), body.alias("body"))
    rows = rows.withColumn("mark", F.pmod("a", F.lit(MARKS)).cast("int"))
    again = rows.groupBy("a", "b", "mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    marks = F.broadcast(cut_lineage(again.select("mark").distinct()))  # at most MARKS rows
    alone = rows.join(marks, "mark", "left_anti").select("body")
    copied = rows.join(marks, "mark", "left_semi").select("a", "b", "body").mapInArrow(_first_seen, "a bigint, b bigint, body string")
    path = scratch_path(docs.sparkSession, "texts")
    copied.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(_first_of_equal, "body string").write.parquet(path)
    return alone.unionByName(docs.sparkSession.read.schema("body string").parquet(path)), path


def tally(texts: DataFrame, items: Callable[[str], np.ndarray], counts: np.ndarray, least: float) -> DataFrame:
    """(item, n): in how many of the texts each item occurs, exactly, if its counter is above ``least``.

    Other items cannot occur more often than that. Tasks fold what they count.
    """
    shared = texts.sparkSession.sparkContext.broadcast(counts > least)

    def folded(held: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["item", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, held, size = shared.value, [], 0
        for batch in batches:
            for body in texts_of(batch.column(0)):
                found = items(body or "")
                held.append(found[often[bucket_of(found)]])
                size += len(held[-1])
                if size >= _HELD:
                    yield folded(held)
                    held, size = [], 0
        yield folded(held)

    return texts.mapInArrow(run, "item bigint, n bigint").groupBy("item").agg(F.sum("n").alias("n"))
