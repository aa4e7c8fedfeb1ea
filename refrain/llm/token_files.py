"""Token files: Parquet lists of ids in document order, readable by column, row range and document.

Layout of a folder written by ``write_tokens``: one file per range of documents, in ascending
order, with the columns

``doc_id, part, row``  the document, its file and its place in the file (delta encoded),
``n_tokens``           number of ids, so that offsets need no ids to be read (delta encoded),
``ids``                the ids; as there are few different ones, dictionary encoded.

Row groups and pages are bounded, pages carry an index (min and max of doc_id for each page), and
rows are sorted by document: a reader that wants a few documents skips row groups and pages, and a
reader that wants lengths never touches the ids.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refrain.llm.bpe import TextEncoder, byte_symbols
from refrain.llm.encoding import TOKENIZER, _table, lists_of, mapped, rows_of
from refrain.session import scratch_path
from refrain.sources.tables import read_table

END_ID = 2
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",  # delta encodings where there is no dictionary
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "500",
}


@lru_cache(maxsize=2)
def _library_encoder(path: str) -> TextEncoder:
    """The tokenizers library's model on the different words of a block; one per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path).model
    symbols = {b: s for b, s in enumerate(byte_symbols())}

    def encode_words(words: list[str]) -> list[list[int]]:
        return [[t.id for t in model.tokenize(w.encode().decode("latin-1").translate(symbols))] for w in words]

    return TextEncoder(_table(path), encode_words)


def with_ids(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, end_id: int | None = END_ID) -> DataFrame:
    """Replace the text by ``ids``, each document closed by ``end_id``; a null text counts as empty."""
    end = np.array([] if end_id is None else [end_id], np.int32)

    def ids(batch: pa.RecordBatch) -> list[pa.Array]:
        encoded = _library_encoder(tokenizer).encode(t or "" for t in batch.column(text).to_pylist())
        return [lists_of([np.concatenate([row, end]) for row in encoded])]

    return mapped(df, {"ids": "array<int>"}, ids).drop(text)


def write_tokens(docs: DataFrame, path: str, *, text: str = "text", tokenizer: str = TOKENIZER, end_id: int | None = END_ID, files: int | None = None) -> None:
    """Write ``doc_id`` and the ids of ``text`` below ``path``, in ascending order of doc_id, nulls first.

    The texts are ranged over ``files`` files (by default the shuffle partitions), so no order of
    the input is needed; rows that share a doc_id go to one file, in any order. Other columns of
    ``docs`` are not written. An empty table gives a folder without rows.
    """
    count = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", text).repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id")
    rows = with_ids(ordered, text, tokenizer, end_id)
    position = F.monotonically_increasing_id()
    rows = rows.select(
        "doc_id", F.shiftright(position, 33).cast("int").alias("part"), position.bitwiseAND(F.lit((1 << 33) - 1)).alias("row"), F.size("ids").alias("n_tokens"), "ids"
    )
    rows.write.options(**FORMAT).parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the files; only those that are used are read."""
    return spark.read.schema("doc_id bigint, part int, row bigint, n_tokens int, ids array<int>").parquet(path)


def token_starts(files: DataFrame) -> DataFrame:
    """(doc_id, part, row, n_tokens, start): ids before each document, from the lengths alone."""
    lengths = files.select("doc_id", "part", "row", F.col("n_tokens").cast("long").alias("n_tokens"))
    totals = lengths.groupBy("part").agg(F.sum("n_tokens").alias("__total"))
    # one row per file
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = lengths.withColumn("__inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    joined = placed.join(F.broadcast(bases), "part")
    return joined.select("doc_id", "part", "row", "n_tokens", (F.col("__base") + F.col("__inside")).alias("start"))


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The ids of a few documents; row groups and pages without them are skipped."""
    return read_files(spark, path).filter(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "ids")


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if row is None else zlib.crc32(row.astype("<u4", copy=False).tobytes()) for row in rows_of(batch)], pa.int64())

    return run(ids)


def token_file_report(spark: SparkSession, root: str) -> DataFrame:
    """Write the table's tokens in the shared folder, then report from the files."""
    path = scratch_path(spark, "tokens")
    write_tokens(read_table(spark, root, "documents"), path)
    files = read_files(spark, path)
    sums = files.select(F.col("part").alias("p"), F.col("row").alias("r"), ids_crc32(F.col("ids")).alias("ids_crc32"))
    starts = token_starts(files)
    joined = starts.join(sums, (starts["part"] == sums["p"]) & (starts["row"] == sums["r"]))
    return joined.select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op7_token_files": token_file_report}
ORACLES: dict[str, str] = {}
