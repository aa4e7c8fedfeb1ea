"""Quality rules: a table of thresholds compiled into Spark projections, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.words import BLANK, WORD, words_of
from refrain.sources.tables import read_table

STOP_WORDS = tuple(
    "the of and to a in is that for it on with as was be are by at this from "
    "der die das und ist zu den von mit im sich des auf für ein eine dem nicht als auch "
    "le la les de et en un une des du que est pour dans qui par sur pas plus au "
    "el los las y del se por con para su al lo como más o una es no".split()
)

# Letters of the languages of STOP_WORDS, and function words of other languages in Latin script.
# STOP_WORDS says nothing about a text of another language: see ``covered`` in ``measures``.
LETTERS = "A-Za-zäöüßéèêëàâîïôùûçœæÿñáíóúÄÖÜẞÉÈÊËÀÂÎÏÔÙÛÇŒÆŸÑÁÍÓÚ"
OTHER_WORDS = tuple(
    "het een van niet zijn maar ook naar wordt deze "  # Dutch
    "di che il della dei gli sono nel con alla "  # Italian
    "os um uma não em ao dos das foi mais "  # Portuguese
    "och att som är för inte till med har det jag "  # Swedish
    "og er til ikke på med av af har jeg "  # Danish, Norwegian
    "ja ei että se oli hän mutta kun ovat myös "  # Finnish
    "i w na z się nie jest do że to "  # Polish
    "je se v že si jsem byl nebo jako ale "  # Czech, Slovak, Croatian, Slovene
    "și nu să pe cu din care mai este sau "  # Romanian
    "az és hogy nem egy ez volt meg is csak "  # Hungarian
    "ve bir bu da ne için ile çok gibi ama "  # Turkish
    "yang dan itu dengan untuk tidak dari dalam adalah ini "  # Indonesian, Malay
    "ang ng sa mga ay na ko hindi at siya "  # Tagalog
    "na ya wa kwa ni katika za hii kuwa lakini "  # Swahili
    "và là của có không những được trong cho người "  # Vietnamese
    "et non cum sed ad quod ut qui autem enim "  # Latin
    "eta da ez bat dute zen izan baina dira ere "  # Basque
    "i els amb però són aquest també dels al va "  # Catalan
    "die nie en wat het is vir sy hulle ook".split()  # Afrikaans
)
OTHER_LETTERS_PERCENT = 2
OTHER_WORDS_PERCENT = 5

# (name, expression over the measures, lowest, highest value allowed; None leaves a side open)
Rule = tuple[str, str, float | None, float | None]
RULES: tuple[Rule, ...] = (
    ("mean_word_chars", "word_chars / n_words", 2.0, 20.0),
    ("symbols_per_word", "n_symbols / n_words", None, 0.30),
    ("stop_word_share", "n_stop_words / n_words", 0.01, None),
    ("dup_line_share", "n_dup_lines / n_lines", None, 0.50),
    ("ellipsis_line_share", "n_ellipsis_lines / n_lines", None, 0.50),
)
STOP_RULES = ("stop_word_share",)  # only for texts that STOP_WORDS covers
MINIMUM_WORDS = 50
REPEAT_PERCENT = 50


def measures(df: DataFrame, text: str = "text", prefix: str = "__q_") -> DataFrame:
    """Add the counts that rules may use, as columns named ``prefix`` + name.

    ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_ellipsis_lines, n_stop_words`` and
    ``n_repeat_words``; ``covered`` is false for a text of another language than those of
    ``STOP_WORDS``: less than one in a hundred words is among them, and many letters are of other alphabets
    or many words function words of other languages. A null text counts as empty, an empty one has zeros. Everything is computed
    inside the row; repeated windows are found by sorting their digests with their places, only
    for texts that have any.
    """

    def c(name: str) -> Column:
        return F.col(prefix + name)

    def named(**columns: Column) -> dict[str, Column]:
        return {prefix + k: v for k, v in columns.items()}

    empty = F.array().cast("array<bigint>")
    body = F.coalesce(F.col(text), F.lit(""))
    step = df.withColumns(named(words=words_of(F.col(text)), lines=F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))))
    step = step.withColumns(
        named(
            n_words=F.size(c("words")).cast("long"),
            word_chars=F.length(F.regexp_replace(body, BLANK + "+", "")).cast("long"),
            n_symbols=F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long"),
            n_lines=F.size(c("lines")).cast("long"),
            n_dup_lines=(F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
            n_ellipsis_lines=F.size(F.filter(c("lines"), lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long"),
            n_stop_words=F.size(F.filter(c("words"), lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long"),
            digests=F.transform(c("words"), lambda w: F.xxhash64(w)),
        )
    ).drop(prefix + "lines")
    others = tuple(w for w in OTHER_WORDS if w not in STOP_WORDS)
    letters = F.length(F.regexp_replace(body, r"\P{L}+", ""))
    foreign = F.length(F.regexp_replace(body, rf"[\P{{L}}{LETTERS}]+", ""))
    spoken = F.size(F.filter(c("words"), lambda w: F.lower(w).isin(*others)))
    step = step.withColumns(
        named(
            covered=F.when(100 * c("n_stop_words") >= c("n_words"), True)
            .when(100 * foreign > OTHER_LETTERS_PERCENT * letters, False)
            .otherwise(100 * spoken < OTHER_WORDS_PERCENT * c("n_words")),
            windows=F.when(
                c("n_words") >= 3,
                F.transform(F.sequence(F.lit(0), c("n_words").cast("int") - 3), lambda i: F.xxhash64(F.get(c("digests"), i), F.get(c("digests"), i + 1), F.get(c("digests"), i + 2))),
            ).otherwise(empty),
        )
    ).drop(prefix + "digests", prefix + "words")
    placed = F.sort_array(F.transform(c("windows"), lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    none = F.array().cast("array<struct<g:bigint,i:int>>")
    step = step.withColumns(named(placed=F.when(F.size(F.array_distinct(c("windows"))) < F.size(c("windows")), placed).otherwise(none))).drop(prefix + "windows")
    twice = F.filter(
        c("placed"),
        lambda x, k: x["g"].eqNullSafe(F.get(c("placed"), k - 1)["g"]) | x["g"].eqNullSafe(F.get(c("placed"), k + 1)["g"]),
    )
    step = step.withColumns(named(spots=F.sort_array(F.transform(twice, lambda x: x["i"])))).drop(prefix + "placed")
    covered = F.transform(c("spots"), lambda p, k: F.least(F.coalesce(F.get(c("spots"), k + 1) - p, F.lit(3)), F.lit(3)).cast("long"))
    return step.withColumns(named(n_repeat_words=F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b))).drop(prefix + "spots")


def verdict(rules: Sequence[Rule] = RULES, prefix: str = "__q_") -> Column:
    """One boolean column from the table of thresholds; a ratio over zero lines or words passes."""
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_ellipsis_lines", "n_stop_words", "n_repeat_words")

    def inside(rule: Rule) -> Column:
        rule_name, expression, low, high = rule
        for name in names:
            expression = " ".join(prefix + name if part == name else part for part in expression.split(" "))
        numerator, _, divisor = expression.partition(" / ")
        value = F.expr(f"({numerator}) / nullif({divisor}, 0)") if divisor else F.expr(numerator)
        within = F.lit(True)
        if low is not None:
            within &= value >= low
        if high is not None:
            within &= value <= high
        if rule_name in STOP_RULES:
            within |= ~F.col(prefix + "covered")
        return F.coalesce(within, F.lit(True))

    return reduce(lambda a, b: a & b, map(inside, rules), F.lit(True))


def base_failed(prefix: str = "__q_") -> Column:
    """Too few words, or more than half of them in three-word windows that occur twice."""
    words = F.col(prefix + "n_words")
    return (words < MINIMUM_WORDS) | (100 * F.col(prefix + "n_repeat_words") > REPEAT_PERCENT * words)


def judge(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``base_failed`` and ``kept`` (and the measures under their prefix) to every row."""
    measured = measures(df, text)
    return measured.withColumn("__q_failed", base_failed()).withColumn("__q_kept", ~F.col("__q_failed") & verdict(rules))


def keep_good(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that pass, with their own columns only.

    The row number in the condition keeps the optimizer from moving the filter below the
    projections, where the steps of the measures would be written out in one another and repeated.
    """
    judged = judge(df, text, rules).withColumn("__q_row", F.monotonically_increasing_id())
    return judged.filter("__q_kept and __q_row >= 0").select(*df.columns)


def quality_report(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = judge(docs)
    return judged.select("doc_id", *[F.col("__q_" + n).alias(n) for n in shown], F.col("__q_failed").alias("base_failed"), F.col("__q_kept").alias("kept"))


def counts_sql(docs: str = "documents") -> str:
    """DuckDB CTEs ending in ``judged``: the measures, base_failed and kept of every document."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    blank = "[\\x20\\x09-\\x0D]"
    checks = []
    for _, expression, low, high in RULES:
        top, _, under = expression.partition(" / ")
        value = f"({top})::double / nullif({under}, 0)"
        checks += [f"coalesce({value} >= {low}, true)"] * (low is not None) + [f"coalesce({value} <= {high}, true)"] * (high is not None)
    return f"""
    q_words as (
      select doc_id, coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from {docs}
    ), q_lines as (
      select *, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l,
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) as g
      from q_words
    ), q_grams as (
      select doc_id, unnest(g) as gram, unnest(range(len(g))) as i from q_lines
    ), q_twice as (
      select doc_id, i, count(*) over (partition by doc_id, gram) as n from q_grams
    ), q_spots as (
      select doc_id, least(coalesce(lead(i) over (partition by doc_id order by i) - i, 3), 3) as covered from q_twice where n > 1
    ), q_repeat as (
      select doc_id, sum(covered)::bigint as n_repeat_words from q_spots group by doc_id
    ), measured as (
      select q.doc_id, len(w)::bigint as n_words, length(regexp_replace(body, '{blank}+', '', 'g'))::bigint as word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, len(l)::bigint as n_lines,
        (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
        len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…){blank}*$')))::bigint as n_ellipsis_lines,
        len(list_filter(w, lambda x: lower(x) in ({stop})))::bigint as n_stop_words,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words
      from q_lines q left join q_repeat r on q.doc_id = r.doc_id
    ), failed as (
      select *, n_words < {MINIMUM_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words as base_failed from measured
    ), judged as (
      select *, not base_failed and {" and ".join(checks)} as kept from failed
    )"""


QUERIES = {"op10_quality": quality_report}
ORACLES = {"op10_quality": f"with {counts_sql()} select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from judged"}
