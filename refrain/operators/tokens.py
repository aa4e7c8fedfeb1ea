"""Words of a text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no topic (English, French, German, Spanish function words).
STOP_WORDS = (
    "the of and to in is that it for on with as are this be by from or an at not "
    "le la les de des et un une en du au que qui "
    "der die das und ist von zu den mit ein eine "
    "el los las y se lo por con"
).split()

NOT_A_WORD = "[^\\p{L}\\p{N}]+"
IDEOGRAPH = "[\\x{4e00}-\\x{9fff}]"


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), NOT_A_WORD), "")


def _pairs(word: Column) -> Column:
    starts = F.sequence(F.lit(1), F.char_length(word) - 1)
    return F.transform(starts, lambda i: F.substring(word, i, F.lit(2)))


def segments(text: Column) -> Column:
    """Words, with runs of ideographs cut into overlapping pairs of characters.

    Scripts written without spaces have no word breaks to split on. Texts without ideographs
    take the plain path.
    """
    plain = words(text)
    cut = F.flatten(
        F.transform(
            plain,
            lambda word: F.when(
                word.rlike(IDEOGRAPH) & (F.char_length(word) > 1), _pairs(word)
            ).otherwise(F.array(word)),
        )
    )
    return F.when(text.rlike(IDEOGRAPH), cut).otherwise(plain)


def is_stop_word(word: Column) -> Column:
    return word.isin(*STOP_WORDS)
