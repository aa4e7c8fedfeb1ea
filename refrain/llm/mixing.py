"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refrain.functions.ordering import number_rows
from refrain.llm.words import WORD, word_count
from refrain.session import cut_lineage
from refrain.sources.tables import read_table

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # the mix takes three halves of all sizes
MOST = 2  # times its size that a source, and a document, may be taken
SEED = "mix"
_WIDE = "decimal(38,0)"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight, num, den): each source's target is ``num / den``, exactly.

    ``sizes`` has source and size. Sources in code point order, null last, take the weights in
    turn. They share ``SHARE`` of all sizes by weight; where that exceeds ``MOST`` times a source's
    size, the source stops there and the rest is shared anew. Only sums of the sources' table
    reach the driver, once for each round of sharing.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = number_rows(per_source, [F.col("source").isNull(), "source"], index="__turn")
    turn = ((F.col("__turn") - 1) % len(weights) + 1).cast("int")
    sources = cut_lineage(numbered.withColumn("weight", F.element_at(F.lit(list(weights)), turn).cast("long")).drop("__turn"))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    whole = SHARE[0] * total
    # the level that a unit of weight gets is left / (SHARE[1] * free)
    left, free = whole, None
    while True:
        if free is None:
            open_weight, stopped = sources.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.lit(0)).first()
        else:
            above = _above(left, free)
            open_weight, stopped = sources.agg(
                F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)), F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0))
            ).first()
        now = (whole - SHARE[1] * MOST * stopped, open_weight)
        if open_weight == 0 or (free is not None and now == (left, free)):
            break
        left, free = now
    free = free or 1
    stopped_here = _above(left, free)
    return sources.select(
        "source",
        "source_size",
        "weight",
        F.when(stopped_here, MOST * F.col("source_size")).otherwise(F.col("weight") * F.lit(left).cast(_WIDE)).cast(_WIDE).alias("num"),
        F.when(stopped_here, F.lit(1)).otherwise(F.lit(SHARE[1] * free)).cast(_WIDE).alias("den"),
    )


def _above(left: int, free: int) -> Column:
    """Whether a source's share reaches its limit: weight * left / (SHARE[1] * free) >= MOST * size."""
    return F.col("weight").cast(_WIDE) * F.lit(left).cast("decimal(20,0)") >= F.col("source_size").cast(_WIDE) * F.lit(MOST * SHARE[1] * free).cast("decimal(12,0)")


def plan_copies(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every row of ``sizes``.

    A document of a source is expected ``target / source_size`` times. These expectations are
    summed up along the source in the order of size (so that every part of the order, and with it
    the words taken, comes near its expectation), one random offset of the source is added, and a
    document is emitted once for each whole number it crosses. The sum up to the k-th document is
    k times a fraction, so it is computed exactly, and a hot source is cut into ranges by
    ``number_rows``; no source is gathered in one task. Equal rows each have a place in the order.
    """
    narrow = cut_lineage(sizes.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size")))
    targets = source_targets(narrow, weights).toDF("__source", "source_size", "weight", "num", "den")
    placed = number_rows(narrow, ["size", F.col("doc_id").isNull(), "doc_id"], ["source"], index="__k")
    joined = placed.join(targets, placed["source"].eqNullSafe(targets["__source"])).drop("__source", "weight")
    divisor = F.greatest(F.col("den").cast("decimal(14,0)") * F.col("source_size").cast("decimal(18,0)"), F.lit(1)).cast("decimal(30,0)")
    # 28 bits of a digest are the offset as a fraction of 2^28
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit("")))), 1, 7), 16, 10).cast("decimal(10,0)")
    joined = joined.withColumns({"__divisor": divisor, "__digest": digest})
    # whole numbers reached before and after a document, over the divisor
    joined = joined.withColumn("__offset", F.expr(f"(__divisor * __digest) div {1 << 28}").cast("decimal(20,0)")).withColumns(
        {name: F.col("num").cast("decimal(24,0)") * k.cast("decimal(13,0)") + F.col("__offset") for name, k in (("__before", F.col("__k") - 1), ("__after", F.col("__k")))}
    )
    copies = F.expr("__after div __divisor - __before div __divisor")
    return joined.select(
        "doc_id", "source", "size", "source_size", (F.col("num").cast("double") / F.col("den").cast("double")).alias("target"), F.when(F.col("source_size") > 0, copies).otherwise(F.lit(0)).cast("long").alias("copies")
    )


def mix(docs: DataFrame, text: str = "text", weights: Sequence[int] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; nulls in any column are kept.

    Needs ``doc_id`` and ``source``. Documents that share a doc_id are told apart by source and
    size; rows equal in all three are told apart by their number within the group.
    """
    own = docs.columns
    sized = docs.withColumn("__size", word_count(F.col(text)))
    plan = plan_copies(sized.select("doc_id", "source", F.col("__size").alias("size")), weights, seed)
    plan = plan.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    plan = plan.filter("__copies > 0").toDF("__doc", "__src", "__sz", "__copies", "__rows")
    same = sized["doc_id"].eqNullSafe(plan["__doc"]) & sized["source"].eqNullSafe(plan["__src"]) & (sized["__size"] == plan["__sz"])
    joined = sized.join(plan, same)
    single = joined.filter("__rows = 1").withColumn("__times", F.col("__copies"))
    turn = F.row_number().over(Window.partitionBy("__doc", "__src", "__sz").orderBy(F.lit(0)))
    several = joined.filter("__rows > 1").withColumn("__turn", turn)
    several = several.withColumn("__times", F.expr("__copies div __rows + if(__turn <= __copies % __rows, 1, 0)")).drop("__turn")
    chosen = single.unionByName(several)
    return chosen.filter("__times > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*own)


def mixture(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents")
    plan = plan_copies(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


QUERIES = {"op3_mix": mixture}
# Sources by their limit per unit of weight: those before a source in this order stop when it does.
_SQL = f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size from documents
), s as (
  select source, sum(size)::hugeint as source_size from d group by source
), w as (
  select *, {list(WEIGHTS)}[((row_number() over (order by source is null, source) - 1) % {len(WEIGHTS)} + 1)::int]::hugeint as weight from s
), t as (
  select *, {SHARE[0]} * sum(source_size) over () as whole,
    coalesce(sum(source_size) over (o rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (o rows between current row and unbounded following) as open_weight
  from w window o as (order by source_size::double / weight, source is null, source)
), c as (
  select *, weight * (whole - {SHARE[1] * MOST} * before) >= {MOST * SHARE[1]} * source_size * open_weight as stops from t
), l as (
  select *, whole - {SHARE[1] * MOST} * coalesce(sum(source_size) filter (stops) over (), 0) as rest, coalesce(sum(weight) filter (not stops) over (), 1) as free from c
), n as (
  select source, source_size, (case when stops then {MOST} * source_size else weight * rest end)::hugeint as num, (case when stops then 1 else {SHARE[1]} * free end)::hugeint as den from l
), k as (
  select d.*, source_size, num, den, greatest(den * source_size, 1)::hugeint as divisor, ('0x' || substr(md5('{SEED}:' || coalesce(d.source, '')), 1, 7))::hugeint as digest,
    row_number() over (partition by d.source order by size, doc_id nulls last) as k
  from d join n on d.source is not distinct from n.source
), p as (
  select *, (divisor * digest) // {1 << 28} as off from k
), q as (
  select *, case when source_size > 0 then (num * k + off) // divisor - (num * (k - 1) + off) // divisor else 0 end as copies from p
)
select doc_id, size::bigint as size, source_size::bigint as source_size, num::double / den::double as target, (copies * size)::bigint as taken, copies::bigint as copies from q"""

ORACLES: dict[str, str] = {"op3_mix": _SQL}
