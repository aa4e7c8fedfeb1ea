"""Personal data: known forms, and identifiers found by bootstrapped contextual extraction.

Values of the known forms are the seeds. The words before them are lexical patterns. A pattern's
score is the share of its occurrences that precede identifiers, where a seed counts whole, a string
that nothing speaks for yet counts half, and other words nothing. Identifiers behind trusted
patterns are seeds of the next generation and vouch for the other patterns they occur with. The two are
computed in turn on the graph of patterns and instances until no new pattern is trusted.
Identifier-like strings behind trusted patterns are reported as ``context``. Everything is DataFrame
and SQL functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refrain.session import cut_lineage, remove_path, scratch_path
from refrain.sources.tables import read_table

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
LEAST_SCORE = 0.6  # of a pattern
LEAST_SEEDS = 3  # different known or believed values that a pattern must have been seen with
UNKNOWN = 0.5  # belief in an identifier-like string that nothing speaks for
_BLOCK = 256
_TAIL = 64  # characters before a value in which its pattern is looked for

# Possessive, and anchored where a match must begin, so that long runs cost linear time. A match
# begins at the start of a run or where the match before it ended (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Words of contexts end at blanks and at the marks between a label and its value. An identifier-like
# word has a digit in it and ends in a letter or digit.
_WORD = r"[^\x20\x09-\x0D:=]++"
_TOKEN = r"(?<![^\x20\x09-\x0D:=])[^\x20\x09-\x0D:=0-9]*+[0-9](?:[^\x20\x09-\x0D:=]*[\p{L}\p{N}])?"
_SPAN = "array<struct<start:int,stop:int,value:string,left:string>>"


def _bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once, though ``fn`` uses it more than once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return _total(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), worth)) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _plausible(kind: str, value: Column) -> Column:
    """The conditions that a match must meet; what fails is dropped, not tried again."""
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return _bound(_digits(value), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def located(text: Column, pattern: str, plausible: Callable[[Column], Column]) -> Column:
    """array of (start, stop, value, left) of a pattern's plausible matches, in code points.

    The pieces between matches give the places, and ``left``, the end of what precedes a match:
    lengths are added up in blocks, so that a text with very many matches does not cost their square.
    """
    empty = F.array().cast(_SPAN)

    def placed(found: Column) -> Column:
        return _bound(F.split(text, pattern, -1), lambda pieces: _bound(F.transform(pieces, lambda p: F.length(p)), lambda gaps: _placed(found, pieces, gaps)))

    def _placed(found: Column, pieces: Column, gaps: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.get(gaps, i) + F.length(m))
        return _bound(steps, lambda s: _bound(_block_sums(s), lambda b: _spans(found, pieces, gaps, s, b)))

    def _block_sums(steps: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")), lambda k: _total(F.slice(steps, k * _BLOCK + 1, F.lit(_BLOCK))))
        return _bound(sums, lambda s: F.transform(s, lambda _, k: _total(F.slice(s, F.lit(1), k))))

    def _spans(found: Column, pieces: Column, gaps: Column, steps: Column, before: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            k = F.floor(i / _BLOCK).cast("int")
            start = F.get(before, k) + _total(F.slice(steps, k * _BLOCK + 1, i % _BLOCK)) + F.get(gaps, i)
            near = F.right(F.get(pieces, i), F.lit(_TAIL))
            left = F.when(F.length(near) < _TAIL, F.right(F.concat(F.right(F.coalesce(F.get(found, i - 1), F.lit("")), F.lit(_TAIL)), near), F.lit(_TAIL))).otherwise(near)
            return F.struct(start.cast("int").alias("start"), (start + F.length(m)).cast("int").alias("stop"), m.alias("value"), left.alias("left"))

        return F.filter(F.transform(found, span), lambda x: plausible(x["value"]))

    return _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.exists(found, plausible), placed(found)).otherwise(empty))


def base_columns(text: Column) -> dict[str, Column]:
    """One array of (start, stop, value, left) for each known form; a null text counts as empty."""
    body = F.coalesce(text, F.lit(""))
    needs = {"email": F.contains(body, F.lit("@")), "phone": F.contains(body, F.lit("+"))}
    out = {}
    for kind in KINDS:
        found = located(body, PATTERNS[kind], _check(kind))
        out[kind] = F.when(needs[kind], found).otherwise(F.array().cast(_SPAN)) if kind in needs else found
    return out


def _check(kind: str) -> Callable[[Column], Column]:
    return lambda value: _plausible(kind, value)


def _identifier_like(value: Column) -> Column:
    """At least six characters, four of them digits."""
    return (F.length(value) >= 6) & (F.length(_digits(value)) >= 4)


def left_word(left: Column) -> Column:
    """The word that ends the text before a value, in lower case; empty at the start of a text."""
    return F.lower(F.regexp_extract(left, rf"({_WORD})[\x20\x09-\x0D:=]*+$", 1))


def occurrences(rows: DataFrame) -> DataFrame:
    """(__row, pattern, instance, start, stop, seed) of the known forms and of the identifier-like
    words that overlap none of them.

    ``rows`` has __row, ``__known`` and ``__words``. The spans of a text meet in the order of their starts, so
    that a word is compared with the known ones before and behind it only.
    """
    spans = rows.select("__row", F.inline("__known")).withColumn("seed", F.lit(True)).unionByName(rows.select("__row", F.inline("__words")).withColumn("seed", F.lit(False)))
    order = Window.partitionBy("__row").orderBy("start")
    reached = F.max(F.when(F.col("seed"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.min(F.when(F.col("seed"), F.col("start"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    placed = spans.withColumns({"__reached": F.coalesce(reached, F.lit(-1)), "__following": F.coalesce(following, F.lit((1 << 31) - 1))})
    free = placed.filter(F.col("seed") | ((F.col("__reached") <= F.col("start")) & (F.col("__following") >= F.col("stop"))))
    return free.select("__row", left_word(F.col("left")).alias("pattern"), F.col("value").alias("instance"), "start", "stop", "seed")


def pattern_totals(docs: DataFrame, patterns: DataFrame, text: str = "text") -> DataFrame:
    """(pattern, total): how often each pattern's word occurs in all texts; words fold before they meet the patterns."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(_WORD), F.lit(0))).alias("pattern"))
    return words.groupBy("pattern").agg(F.count(F.lit(1)).alias("total")).join(patterns, "pattern")


def trusted_patterns(edges: DataFrame, totals: DataFrame, least: float = LEAST_SCORE, seeds: int = LEAST_SEEDS) -> DataFrame:
    """(pattern, score) of the patterns of high score, by as many generations as find new ones.

    ``edges`` has (pattern, instance, n, seed), one row for each pair; ``totals`` the occurrences of
    every pattern's word. Patterns that could not reach ``least`` even if all they precede were
    identifiers are left out first; common words go with them, so no pattern's rows are many
    compared with its occurrences in the corpus. Beliefs only grow, so a trusted pattern stays so.
    """
    reach = edges.groupBy("pattern").agg(F.sum("n").alias("all"))
    possible = reach.join(totals, "pattern").filter((F.col("all") >= least * F.col("total")) & (F.col("pattern") != ""))
    graph = cut_lineage(edges.join(possible.select("pattern", "total"), "pattern"))
    believed = graph.withColumn("belief", F.when(F.col("seed"), 1.0).otherwise(UNKNOWN))
    known = 0
    while True:
        score = F.round(F.sum(F.col("n") * F.col("belief")) / F.max("total"), 9)
        scores = believed.groupBy("pattern").agg(score.alias("score"), F.count_if(F.col("belief") > UNKNOWN).alias("vouching"))
        trusted = cut_lineage(scores.filter((F.col("vouching") >= seeds) & (F.col("score") >= least)).select("pattern", "score"))
        count = trusted.count()
        if count == known:
            return trusted
        known = count
        # what stands behind a trusted pattern counts as a seed from now on
        heard = graph.join(trusted.select("pattern"), "pattern").select("instance").distinct().withColumn("__heard", F.lit(True))
        belief = F.when(F.col("seed") | F.col("__heard"), 1.0).otherwise(UNKNOWN)
        believed = cut_lineage(graph.join(heard, "instance", "left").withColumn("belief", belief).drop("__heard"))


def extract(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add the columns ``email, ip, card, phone, context``: arrays of (start, stop, value) in code points.

    Null and empty texts have empty arrays. Columns of the same names are replaced. The rows with
    their spans are written once to the shared folder and numbered there, so repeated rows and
    null or repeated ids do not matter. ``carry`` names the columns that the result keeps (all).
    """
    own = [c for c in carry or docs.columns if c not in (*KINDS, CONTEXT)]
    spark, path, seen_path = docs.sparkSession, scratch_path(docs.sparkSession, "pii"), scratch_path(docs.sparkSession, "pii-seen")
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumns({f"__{k}": c for k, c in base_columns(F.col(text)).items()}).withColumn("__words", located(body, _TOKEN, _identifier_like))
    stored = found.select(*own, *[f"__{k}" for k in KINDS], "__words").withColumn("__row", F.monotonically_increasing_id())
    stored.write.parquet(path)
    rows = spark.read.schema(stored.schema).parquet(path)
    spans = occurrences(rows.select("__row", F.concat(*[F.col(f"__{k}") for k in KINDS]).alias("__known"), "__words"))
    spans.write.parquet(seen_path)
    seen = spark.read.schema(spans.schema).parquet(seen_path)
    edges = cut_lineage(seen.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")))
    trusted = trusted_patterns(edges, pattern_totals(docs, edges.select("pattern").distinct(), text))
    hits = seen.filter("not seed").join(trusted.select("pattern"), "pattern")
    per_row = cut_lineage(hits.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("start", "stop", F.col("instance").alias("value")))).alias(CONTEXT)))
    remove_path(spark, seen_path)
    joined = rows.join(per_row, "__row", "left")
    empty = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    plain = [F.transform(f"__{k}", lambda s: F.struct(s["start"], s["stop"], s["value"])).alias(k) for k in KINDS]
    return joined.select(*own, *plain, F.coalesce(CONTEXT, empty).alias(CONTEXT))


def personal_data(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    found = extract(docs, carry=["doc_id"])

    def joined(kinds: tuple[str, ...]) -> Column:
        return F.array_join(F.concat(*[F.transform(k, _named(k)) for k in kinds]), ",")

    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(joined(KINDS), 256).alias("base_sha256"), joined((*KINDS, CONTEXT)).alias("spans"))


def _named(kind: str) -> Callable[[Column], Column]:
    return lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["stop"])


QUERIES = {"op9_pii": personal_data}
ORACLES: dict[str, str] = {}
