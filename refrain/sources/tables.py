"""Physical tables: declared schemas, file and database readers."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Declared rather than inferred: no footer is read to plan a query, and a drifted file fails early.
SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


SMALL_BYTES = 128 << 20


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read one parquet table below ``root`` with its declared schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_on: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """Read a table of a live database over JDBC, in parallel ranges of ``split_on``.

    Without ``split_on`` a JDBC read is a single task, so large tables need it with its bounds.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=fetch_size, **options)
    if split_on is not None:
        if lower is None or upper is None:
            raise ValueError("a split column needs its lower and upper bound")
        reader = reader.options(
            partitionColumn=split_on, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def bound_query(
    spark: SparkSession, text: str, args: Mapping[str, Any], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Run one SQL text with named parameters over the given frames; values are never spliced in.

    The text names a frame as ``{name}``. The frames belong to this call alone, so queries that run
    side by side cannot replace each other's tables.
    """
    return spark.sql(text, args=dict(args), **tables)


def spread(frame: DataFrame) -> DataFrame:
    """Give a scan of a single file split one partition per core before work that is heavy per row.

    ``frame`` is a scan with projections and filters only. Only inputs below ``SMALL_BYTES`` are
    spread; larger ones are cut by the reader (``spark.sql.files.maxPartitionBytes`` and
    ``minPartitionNum``), so texts are never shuffled at scale, however many cores there are.
    """
    session = frame.sparkSession
    size = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return frame.repartition(session.sparkContext.defaultParallelism) if size < SMALL_BYTES else frame
