"""URL filters: host and path rules, and logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.sources.tables import read_table

Rule = tuple[str, str]  # (allow or block, host/path)
RULES: tuple[Rule, ...] = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# The small labelled table: hosts named for what they do, in every domain, language and with every
# usual prefix alike, so that only the names decide.
BLOCKED_NAMES = (
    "ads-track", "adserver", "banner-ads", "click-tracker", "popup-ads", "casino-bonus", "free-casino", "cheap-pills", "xxx-tube", "spam-links", "spam-mail", "link-farm",
    "win-prizes", "poker-bets", "adult-club", "adult-video", "porn-clips", "viagra-shop", "malware-kit", "phishing-page",
)
ALLOWED_NAMES = (
    "news", "docs", "wiki", "library", "school", "science", "forum", "recipes", "city", "museum", "garden", "travel", "history", "weather", "music", "theatre",
    "station", "mountain", "render", "thereon", "nation", "lament", "einheit", "rechnung", "vielleicht", "puente", "cantos", "cielo", "enter", "within", "others", "blended",
)
# Hosts of either label whose path holds the names.
NEUTRAL_HOSTS = ("place", "pages", "server", "example", "host", "portal")
BUCKETS = 1 << 18  # far more than the grams of the table, so that strange grams seldom meet a weight
GRAM_SIZES = (3, 4)
DIRECTORIES = 2  # of a longer path that are judged together


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """struct(rule, action) of the longest rule that fits, else null; equally long ones in the order given."""
    found: Column | None = None
    for action, rule in sorted(rules, key=lambda r: -len(r[1])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,action:string>")


def _bucket_at(text: Column, size: int, place: str, buckets: int) -> Callable[[Column], Column]:
    def bucket(start: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(place), F.substring(text, start, F.lit(size))), F.lit(buckets)).cast("int")

    return bucket


def gram_buckets(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Distinct buckets of the character n-grams of ``^host`` and ``path$``; the two never mix."""
    parts = []
    for place, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(F.lit("^"), path, F.lit("$")))):
        for size in GRAM_SIZES:
            starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
            grams = F.transform(starts, _bucket_at(text, size, place, buckets))
            parts.append(grams)
    return F.array_distinct(F.concat(*parts))


def _numbers(values: Sequence[float], kind: str) -> Column:
    """A literal array, folded by the optimizer from one string instead of an expression for each number."""
    return F.split(F.lit(",".join("0" if v == 0 else repr(v) for v in values)), ",").cast(f"array<{kind}>")


class UrlModel:
    """Logistic regression over hashed n-grams; ``probability`` is one SQL expression.

    The weights are a literal array of fixed length, so scoring is a projection next to the scan.
    Buckets that no labelled url fills have weight zero and are left out of the training.
    """

    def __init__(self, weights: list[float], intercept: float) -> None:
        self.weights, self.intercept = weights, intercept

    @classmethod
    def fit(cls, labelled: DataFrame, buckets: int = BUCKETS) -> UrlModel:
        """Train on (url, blocked 0/1), a small table. With one label only, that label always wins."""
        host, path = split_url(F.col("url"))
        rows = labelled.select(F.col("blocked").cast("double").alias("label"), host.alias("host"), path.alias("path"))
        filled = rows.select(F.explode(gram_buckets(F.col("host"), F.col("path"), buckets)).alias("bucket")).distinct()
        used = sorted(r[0] for r in filled.collect())
        # the buckets are bound to a lambda variable, so they are computed once for each row
        dense = F.transform(
            F.array(gram_buckets(F.col("host"), F.col("path"), buckets)),
            lambda on: F.transform(_numbers(used, "int"), lambda i: F.array_contains(on, i).cast("double")),
        )
        rows = rows.select("label", array_to_vector(F.get(dense, F.lit(0))).alias("features"))
        low, high = rows.agg(F.min("label"), F.max("label")).first()
        if low is None or low == high:
            return cls([0.0] * buckets, 20.0 if low else -20.0)
        model = LogisticRegression(maxIter=60, regParam=0.01).fit(rows)
        weights = [0.0] * buckets
        for bucket, x in zip(used, model.coefficients, strict=True):
            weights[bucket] = float(x)
        return cls(weights, float(model.intercept))

    def probability(self, host: Column, path: Column) -> Column:
        """Probability that the url is to be blocked.

        A path of more than ``DIRECTORIES`` directories is judged in
        overlapping pieces of as many, by the most suspicious
        one, so that neither chance grams add up nor a name is drowned by what stands beside it.
        """
        weights = _numbers(self.weights, "double")

        def score(part: Column) -> Column:
            return F.aggregate(gram_buckets(host, part, len(self.weights)), F.lit(self.intercept), lambda a, b: a + F.get(weights, b))

        def pieces(parts: Column) -> Column:
            step = DIRECTORIES // 2
            starts = F.sequence(F.lit(0), F.greatest(F.size(parts) - 1 - step, F.lit(0)), F.lit(step))
            return F.transform(starts, lambda i: F.array_join(F.slice(parts, i + 1, F.lit(DIRECTORIES + 1)), "/"))

        long = F.size(F.split(path, "/")) > DIRECTORIES + 1
        scores = F.transform(F.get(F.transform(F.array(F.split(path, "/")), pieces), F.lit(0)), score)
        return 1 / (1 + F.exp(-F.when(long, F.array_max(scores)).otherwise(score(path))))


def labelled_urls() -> list[tuple[str, int]]:
    """(url, blocked) of the small labelled table."""
    rows = []
    for names, blocked in ((BLOCKED_NAMES, 1), (ALLOWED_NAMES, 0)):
        for i, (name, prefix, domain) in enumerate(product(names, ("", "www.", "m.", "blog."), ("com", "net", "org"))):
            language, end = ("en", "de", "fr", "es")[i // 3 % 4], ("", "/", "?page=2", "#top", ".html")[i % 5]
            rows.append((f"http{'s' * (i % 2)}://{prefix}{name}.example.{domain}/{language}/{37 * i % 9973}{end}", blocked))
        # the same names in paths, alone and among innocent directories
        for i, (name, shape) in enumerate(product(names, ("/{n}", "/{n}/{k}", "/{l}/{n}.html", "/{l}/{k}/{n}/", "/{a}/{n}/{b}/{k}", "/{a}/{b}/{l}/{n}"))):
            a, b = ALLOWED_NAMES[i % len(ALLOWED_NAMES)], ALLOWED_NAMES[7 * i % len(ALLOWED_NAMES)]
            path = shape.format(n=name, k=37 * i % 9973, l=("en", "de", "fr", "es")[i // 3 % 4], a=a, b=b)
            host = NEUTRAL_HOSTS[i // 2 % len(NEUTRAL_HOSTS)]
            rows.append((f"http{'s' * (i % 2)}://{host}.example.{('com', 'net', 'org')[i % 3]}{path}", blocked))
    return rows


def judge_urls(pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = RULES, url: str = "url") -> DataFrame:
    """Add host, path, rule, verdict and block_probability to every row.

    A null url, an empty one or one without ``://`` has empty host and path and is judged by the
    model like any other. Columns of the same names in ``pages`` are replaced.
    """
    host, path = split_url(F.col(url))
    step = pages.withColumns({"host": host, "path": path})
    step = step.withColumn("__rule", matching_rule(F.col("host"), F.col("path"), rules))
    step = step.withColumn("block_probability", model.probability(F.col("host"), F.col("path")))
    learned = F.when(F.col("block_probability") > 0.5, "block").otherwise("allow")
    return step.withColumns({"rule": F.col("__rule.rule"), "verdict": F.coalesce(F.col("__rule.action"), learned)}).drop("__rule")


def page_verdicts(spark: SparkSession, root: str) -> DataFrame:
    pages = read_table(spark, root, "pages").select("page_id", "url")
    labelled = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(b).alias("blocked")) for u, b in labelled_urls()])
    model = UrlModel.fit(spark.range(1, numPartitions=1).select(F.inline(labelled)))
    return judge_urls(pages, model).select("page_id", "host", "path", "rule", "verdict", F.round("block_probability", 6).alias("block_probability"))


QUERIES = {"op6_url_filter": page_verdicts}
ORACLES: dict[str, str] = {}
