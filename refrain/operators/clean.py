"""Rules for invalid comments, exact copies, and the report of what each step removed.

Every rule is a boolean of the row itself: the whole filter is one narrow stage without shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions.joins import join_heavy
from refrain.functions.numbers import percent
from refrain.operators.tokens import IDEOGRAPH, words
from refrain.session import cut_lineage

# Terms that mark advertising or leaked credentials.
BLACKLIST = ["加微信", "刷单", "代刷", "兼职", "casino", "viagra", "token", "password"]

MINIMUM_LENGTH = 2  # a word of two ideographs is a comment
LINK = "(?i)(https?://|www\\.|[a-z0-9._%+-]@[a-z0-9.-]+\\.[a-z]{2,})"  # of what stands before an @ the last character tells
FIVE_EQUAL = "(.)\\1{4,}"
LETTER = "\\p{L}"
SPACES = "[ \\t\\r\\n\\f]+"
SOLID = "[^ \\t\\r\\n\\f]"


def spam_rules(text: Column, minimum_length: int = MINIMUM_LENGTH) -> dict[str, Column]:
    """Named rules in the order in which they are applied.

    Blanks matter for the length only: neither links nor letters hold any. A text with as many other
    characters as the length asks for is found at its start; only the rest is tidied and measured.
    Only texts that hold a part of every link are searched for links.
    """
    whole = F.coalesce(text, F.lit(""))
    lower, body = F.lower(whole), F.trim(F.regexp_replace(whole, SPACES, " "))
    return {
        "empty": ~whole.rlike(SOLID),
        "too_short": ~whole.rlike(f"^(?:{SPACES[:-1]}*{SOLID}){{{minimum_length}}}") & (F.char_length(body) < minimum_length),
        "link": (whole.contains("@") | lower.contains("http") | lower.contains("www.")) & whole.rlike(LINK),
        "repeated": whole.rlike(FIVE_EQUAL),
        "no_letters": ~whole.rlike(LETTER),
    }


def has_term(text: Column, terms: Sequence[str]) -> Column:
    """Any term as a whole word; terms in scripts without spaces match anywhere."""
    spaced = [t.lower() for t in terms if not _ideographic(t)]
    hits = [F.coalesce(text.contains(t), F.lit(False)) for t in terms if _ideographic(t)]
    if spaced:
        listed = F.array(*[F.lit(t) for t in spaced])
        lower, inside = F.lower(text), F.lit(False)
        for t in spaced:
            inside = inside | lower.contains(t)  # only then the text is cut into words
        hits.append(F.coalesce(inside & F.arrays_overlap(words(text), listed), F.lit(False)))
    found = F.lit(False)
    for hit in hits:
        found = found | hit
    return found


def _ideographic(term: str) -> bool:
    return any("一" <= c <= "鿿" for c in term)


def drop_listed(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """Blacklist as a table of any size: anti join against the documents that contain a term.

    Every document contributes each of its words once, and each stretch of its text that is as
    long as some ideographic term and holds an ideograph; which lengths occur is found from the
    table. So the result is that of ``has_term``. ``terms`` has the column word.
    """
    listed = terms.select("word").filter("word is not null").distinct()
    joined = F.col("word").rlike(IDEOGRAPH)
    lengths = listed.filter(joined).agg(F.collect_set(F.char_length("word"))).scalar()  # one number per length
    text = F.coalesce(F.col("text"), F.lit(""))

    def stretches(characters: Column) -> Column:
        """Strings of the listed lengths, each cut from the list of characters."""

        def of(length: Column) -> Column:
            last = F.size(characters) - length
            starts = F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.array_join(F.slice(characters, i, length), ""))

        return F.flatten(F.transform("__lengths", of))

    # different strings are found by hashing, different structs by comparing all of them
    whole = F.transform(F.array_distinct(words(text)), lambda w: F.struct(w.alias("word"), F.lit(False).alias("joined")))
    cut = F.transform(F.array(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))), stretches)[0]
    parts = F.when(text.rlike(IDEOGRAPH), F.filter(F.array_distinct(cut), lambda s: s.rlike(IDEOGRAPH))).otherwise(F.array().cast("array<string>"))
    inside = F.transform(parts, lambda s: F.struct(s.alias("word"), F.lit(True).alias("joined")))
    found = documents.withColumn("__lengths", lengths).select("doc_id", F.explode(F.concat(whole, inside)).alias("f")).select("doc_id", "f.*")
    # words are compared in lower case, as they are cut; stretches as they stand
    wanted = listed.select(F.when(joined, F.col("word")).otherwise(F.lower("word")).alias("word"), joined.alias("joined")).distinct()
    hit = found.join(wanted, ["word", "joined"], "left_semi").select("doc_id").distinct()
    return documents.join(hit, "doc_id", "left_anti")


def first_failure(text: Column, terms: Sequence[str] = BLACKLIST) -> Column:
    """Name of the first rule that a text fails, or NULL."""
    rules = {**spam_rules(text), "blacklist": has_term(text, terms)}
    return F.coalesce(*[F.when(failed, name) for name, failed in rules.items()])


def rule_names() -> list[str]:
    return [*spam_rules(F.lit("")), "blacklist"]


def normal_form(text: Column) -> Column:
    """Lower case, single spaces, no margins."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SPACES, " "))


def digests(documents: DataFrame) -> DataFrame:
    """(doc_id, digest) of the normal form; equal texts have equal digests."""
    return documents.select("doc_id", digest(F.col("text")).alias("digest"))


def digest(text: Column) -> Column:
    return F.md5(normal_form(text).cast("binary"))


def exact_groups(keyed: DataFrame) -> DataFrame:
    """Groups of equal texts from (doc_id, digest): the earliest id and the number of copies.

    Folded on the map side, so a text copied into a third of all rows costs one row per task.
    """
    return keyed.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")
    )


def later_copies(documents: DataFrame) -> DataFrame:
    """Ids of all documents that repeat an earlier one.

    The texts are read once, for their digests; a text with very many copies is a heavy key of
    the join.
    """
    keyed = cut_lineage(digests(documents))
    repeated = cut_lineage(exact_groups(keyed).filter(F.col("copies") > 1))
    first = repeated.select("digest", F.col("doc_id").alias("first_id"), "copies")
    found = join_heavy(keyed, first, "digest", "copies")
    return found.filter(F.col("doc_id") != F.col("first_id")).select("doc_id")


def keep_first(documents: DataFrame) -> DataFrame:
    """The earliest document of every group of equal texts.

    The anti join is against the copies only, usually far fewer than the documents that stay,
    so the texts themselves need not be shuffled while the copies fit a broadcast.
    """
    return documents.join(later_copies(documents), "doc_id", "left_anti")


def retention_report(steps: DataFrame) -> DataFrame:
    """Rows in, removed and out per step; ``steps`` has step_no, step, removed and total."""
    so_far = Window.partitionBy(F.lit(0)).orderBy("step_no")  # over the handful of steps
    gone = F.sum("removed").over(so_far)
    out = F.col("total") - F.col("gone")
    return steps.withColumn("gone", gone).select(
        "step_no",
        "step",
        (out + F.col("removed")).alias("rows_in"),
        "removed",
        out.alias("rows_out"),
        percent(out, F.col("total"), 2).alias("retention_pct"),
    )
