"""Words, shingles and literals that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The contracts' definition of a word, as Java, Python and DuckDB regular expressions read it.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"


def words_of(text: Column) -> Column:
    """The words of a text in order; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")
