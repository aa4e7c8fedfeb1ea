"""BPE encoding and decoding as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.bpe import Decoder, MergeTable, TextEncoder
from refrain.sources.tables import read_table

ROWS = 256
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def _table(path: str) -> MergeTable:
    return MergeTable(path)


@lru_cache(maxsize=2)
def _encoder(path: str) -> TextEncoder:
    """One per worker process, so that its bounded dictionary of words serves all its tasks."""
    return TextEncoder(_table(path))


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """The strings of an Arrow column, made a few hundred rows at a time."""
    for start in range(0, len(column), 256):
        yield from column.slice(start, 256).to_pylist()


def lists_of(parts: list) -> pa.Array:
    """A list column of numpy integer arrays."""
    sizes = np.fromiter(map(len, parts), np.int32, len(parts))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))


def rows_of(column: pa.ListArray) -> Iterator[np.ndarray | None]:
    """The rows of a list column as views of its values."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for i, valid in enumerate(column.is_valid().to_pylist()):
        yield values[ends[i] : ends[i + 1]] if valid else None


def mapped(df: DataFrame, outs: dict[str, str], fn: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``df`` with columns computed by ``fn`` from slices of its Arrow batches.

    Columns of the same names are replaced. Slices of ``ROWS`` rows keep what a task holds small,
    however large the batches are that Spark hands over.
    """
    kept = [c for c in df.columns if c not in outs]
    schema = df.select(*kept, *[F.lit(None).cast(kind).alias(name) for name, kind in outs.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                made = fn(part)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], names=[*kept, *outs])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, text: str = "text", out: str = "ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """Add the token ids (array<int>) of a text column; a null text counts as empty.

    ``tokenizer`` names a byte-level BPE file that every executor can read. Any text gives a
    result: an empty one no ids, a very long one is encoded in pieces of about half a million
    characters, and words beyond 64 characters pass the bounded-lookahead transducer.
    """

    def ids(batch: pa.RecordBatch) -> list[pa.Array]:
        return [lists_of(list(_encoder(tokenizer).encode(t or "" for t in batch.column(text).to_pylist())))]

    return mapped(df, {out: "array<int>"}, ids)


def decode(df: DataFrame, ids: str = "ids", out: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """Add the text of a column of token ids; null ids give null."""

    def texts(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([_decoded(row, tokenizer) for row in rows_of(batch.column(ids))], pa.string())]

    return mapped(df, {out: "string"}, texts)


def round_trip(df: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded", tokenizer: str = TOKENIZER) -> DataFrame:
    """Add the ids of a text and the text decoded from them, in one pass over the rows."""

    def both(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = list(_encoder(tokenizer).encode(t or "" for t in batch.column(text).to_pylist()))
        return [lists_of(rows), pa.array([_decoded(row, tokenizer) for row in rows], pa.string())]

    return mapped(df, {ids: "array<int>", decoded: "string"}, both)


def _decoded(ids: np.ndarray | None, tokenizer: str) -> str | None:
    if ids is None:
        return None
    machine = Decoder(_table(tokenizer))
    parts = [machine.push(ids[i : i + 65536].tolist()) for i in range(0, len(ids), 65536)]
    return "".join([*parts, machine.finish()])


def encoded_digests(spark: SparkSession, root: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the text decoded from them."""
    return round_trip(read_table(spark, root, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op1_bpe": encoded_digests}
ORACLES: dict[str, str] = {}
