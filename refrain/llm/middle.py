"""Fill-in-middle: documents whose middle is moved behind the rest, for training on infilling.

Each character gets a symbol, the pair of its own class and the next one's (line end, other blank,
visible, end of text), and the symbols of a text form a wavelet matrix: one bit vector per bit of
the symbol with counts at every 64th place. How many units end up to a place is a sum of the ranks
of the pairs at which a unit ends; a cut after k units is found by bisection on that sum. Besides
the text a task holds one byte and a few bits for each character of one document at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.encoding import mapped, texts_of
from refrain.sources.tables import read_table

SEED = 42
RATE = 50  # of 100 documents, those whose middle is moved
SUFFIX_FIRST = 80  # of 100 moved ones, those in the form spm
MARKERS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
PLAIN, PSM, SPM = "plain", "psm", "spm"

# classes of a character, and of what follows it
_LINE_END, _BLANK, _VISIBLE, _END = range(4)
_BITS = 4
_CLASSES = np.full(128, _VISIBLE, np.uint8)
_CLASSES[[0x20, *range(0x09, 0x0E)]] = _BLANK
_CLASSES[0x0A] = _LINE_END


def _pair(here: int, following: int) -> int:
    return 4 * here + following


# The pairs at which a unit ends. A token is blanks with the visible run behind them, or the blanks
# that end a text; a line takes its line end along.
_ANY = (_LINE_END, _BLANK, _VISIBLE, _END)
UNITS: dict[str, tuple[int, ...]] = {
    "token": (_pair(_VISIBLE, _LINE_END), _pair(_VISIBLE, _BLANK), *(_pair(c, _END) for c in _ANY[:3])),
    "line": (*(_pair(_LINE_END, c) for c in _ANY), _pair(_BLANK, _END), _pair(_VISIBLE, _END)),
    "character": tuple(_pair(c, n) for c in _ANY[:3] for n in _ANY),
}


def class_pairs(text: str) -> np.ndarray:
    """The symbol of every code point."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    classes = _CLASSES[np.minimum(points, 127)]
    return 4 * classes + np.append(classes[1:], np.uint8(_END))[: len(classes)]


class WaveletMatrix:
    """Ranks of the symbols of a sequence, in one step per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int = _BITS) -> None:
        self.size, self.bits = len(symbols), bits
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []  # ones before each word
        self.zeros: list[int] = []
        for level in range(bits - 1, -1, -1):
            ones = (symbols >> level & 1).astype(bool)
            packed = np.zeros(self.size // 64 + 1, np.uint64)
            packed.view(np.uint8)[: (self.size + 7) // 8] = np.packbits(ones, bitorder="little")
            counts = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=counts[1:])
            self.words.append(packed)
            self.before.append(counts)
            self.zeros.append(self.size - int(counts[-1]))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def _ones(self, level: int, place: int) -> int:
        word = place >> 6
        return int(self.before[level][word]) + (int(self.words[level][word]) & ((1 << (place & 63)) - 1)).bit_count()

    def rank(self, symbol: int, place: int) -> int:
        """How often the symbol occurs before ``place``."""
        start = 0
        for level in range(self.bits):
            first, last = self._ones(level, start), self._ones(level, place)
            if symbol >> (self.bits - 1 - level) & 1:
                start, place = self.zeros[level] + first, self.zeros[level] + last
            else:
                start, place = start - first, place - last
            if start == place:
                return 0
        return place - start


class Boundaries:
    """Where the units of a text end."""

    def __init__(self, text: str, unit: str = "token") -> None:
        self.matrix = WaveletMatrix(class_pairs(text))
        self.ends = [s for s in UNITS[unit] if self.matrix.rank(s, self.matrix.size)]
        self.units = self.until(self.matrix.size)

    def until(self, place: int) -> int:
        """Units that end in the first ``place`` characters."""
        return sum(self.matrix.rank(s, place) for s in self.ends)

    def cut(self, units: int) -> int:
        """The place behind so many units: the first one up to which they all have ended."""
        low, high = 0, self.matrix.size
        while low < high:
            place = (low + high) // 2
            if self.until(place) >= units:
                high = place
            else:
                low = place + 1
        return low


def _check(markers: Sequence[str]) -> None:
    """Markers must not overlap, or a text's own characters could make up another one."""
    if len(set(markers)) != 3 or not all(markers):
        raise ValueError("three different markers are needed")
    for a in markers:
        for b in markers:
            if any(a.endswith(b[:k]) for k in range(1, len(b) if a == b else len(b) + 1)) or (a != b and b in a):
                raise ValueError(f"markers {a} and {b} overlap")


def rearranged(doc_id: int | None, text: str | None, unit: str, rate: int, suffix_first: int, seed: int, markers: Sequence[str]) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix characters, middle characters, output) of one document."""
    text = text or ""
    bounds = Boundaries(text, unit)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, other, moved, order = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    if not text or moved % 100 >= rate or any(m in text for m in markers):
        return bounds.units, PLAIN, None, None, text
    first, second = sorted((one % (bounds.units + 1), other % (bounds.units + 1)))
    start, end = bounds.cut(first), bounds.cut(second)
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    p, s, m = markers
    if order % 100 < suffix_first:
        return bounds.units, SPM, start, end - start, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return bounds.units, PSM, start, end - start, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    *,
    unit: str = "token",
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    seed: int = SEED,
    markers: Sequence[str] = MARKERS,
) -> DataFrame:
    """Add ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    What becomes of a document depends on its key alone, so equal rows agree and reruns repeat. A
    null key counts as an empty one. Null and empty texts, and texts that hold a marker, stay plain
    (``output`` is the text, the character counts are null). Columns of those names are replaced.
    """
    _check(markers)
    kinds = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [rearranged(k, t, unit, rate, suffix_first, seed, markers) for k, t in zip(batch.column(key).to_pylist(), texts_of(batch.column(text)), strict=True)]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]

    return mapped(docs, kinds, run)


def restored(output: Column, form: Column, markers: Sequence[str] = MARKERS) -> Column:
    """The text from which an output was made; null for a null output."""
    _check(markers)
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in markers), -1)
    prefix_first = F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2))
    suffix_first = F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1))
    return F.when(form == PSM, prefix_first).when(form == SPM, suffix_first).otherwise(output)


def middle_digests(spark: SparkSession, root: str) -> DataFrame:
    """Per document: units, form, cuts, and digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(read_table(spark, root, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    )


QUERIES = {"op11_middle": middle_digests}
_P, _S, _M = MARKERS
_SQL = f"""
with d as (
  select doc_id, coalesce(text, '') as text, sha256('{SEED}:' || coalesce(doc_id::varchar, '')) as h from documents
), t as (
  select doc_id, text, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') as tokens,
    ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2, ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4 from d
), f as (
  select *, len(tokens) as n, case when text = '' or contains(text, '{_P}') or contains(text, '{_S}') or contains(text, '{_M}') or h3 % 100 >= {RATE} then 'plain'
    when h4 % 100 < {SUFFIX_FIRST} then 'spm' else 'psm' end as form from t
), k as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b from f
), p as (
  select *, coalesce(array_to_string(tokens[1:a], ''), '') as prefix, coalesce(array_to_string(tokens[a + 1:b], ''), '') as middle, coalesce(array_to_string(tokens[b + 1:n], ''), '') as suffix from k
)
select doc_id, n::bigint as n, form, (case when form <> 'plain' then length(prefix) end)::bigint as prefix_chars, (case when form <> 'plain' then length(middle) end)::bigint as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '{_P}' || prefix || '{_S}' || suffix || '{_M}' || middle else '{_S}' || suffix || '{_P}' || prefix || '{_M}' || middle end) as output_sha256,
  sha256(text) as restored_sha256 from p"""

ORACLES: dict[str, str] = {"op11_middle": _SQL}
