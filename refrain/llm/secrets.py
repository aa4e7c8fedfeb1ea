"""Secret scans: known forms, and sliding-window entropy per character class for the rest."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.encoding import texts_of
from refrain.sources.tables import read_table

KINDS = ("assign", "access", "hex", "entropy")
SPANS = "array<struct<kind:string,start:int,stop:int>>"

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run is maximal, so asking for its length at once finds the same ones
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

WINDOW = 20
# Character classes: pattern of the characters, lowest entropy in bits per character of a window.
CLASSES: tuple[tuple[str, re.Pattern[str], float], ...] = (
    ("hex", re.compile(r"[0-9a-fA-F]{20,}"), 2.9),
    ("base32", re.compile(r"[A-Z2-7]{20,}"), 3.4),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.6),
)
# Never reported by the entropy method: one kind of character only, words joined by signs, and
# places of a path. Compared with a whole candidate, or what is left of it, without signs at its ends.
ALLOWED: tuple[str, ...] = (
    r"[A-Za-z]+",
    r"[0-9]+",
    r"[a-z]+([-_/=+][A-Za-z]+)+[-_/=+]*",
    r"[-_=+/]+",
    r"(?i)(0123456789abcdef)+0?1?2?3?4?5?6?7?8?9?",
)
# Left out of a candidate, which is cut there: long repeats, and parts that say that they are examples.
_REPEAT = re.compile(r"(.)\1{9,}")
_EXAMPLE = re.compile(r"example|sample|placeholder|changeme|your[-_]?(?:key|token)", re.IGNORECASE)
_PART = re.compile(r"[^-_=+/]+")
_SIGNS = "-_=+/"

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def base_spans(text: str) -> list[Span]:
    """The known forms, leftmost and non-overlapping for each kind, in code points."""
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def entropy_windows(run: str, window: int, least: float) -> list[tuple[int, int]]:
    """Merged ranges of the windows whose Shannon entropy is at least ``least``.

    Counts change by one character in and one out, and so does the sum of c * log2(c).
    """
    costs = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    counts: dict[str, int] = {}
    total, ranges = 0.0, []
    for i, char in enumerate(run):
        c = counts.get(char, 0)
        total += costs[c + 1] - costs[c]
        counts[char] = c + 1
        if i >= window:
            old = run[i - window]
            c = counts[old]
            total += costs[c - 1] - costs[c]
            counts[old] = c - 1
        if i >= window - 1 and math.log2(window) - total / window >= least - 1e-9:
            begin = i - window + 1
            if ranges and begin <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], i + 1)
            else:
                ranges.append((begin, i + 1))
    return ranges


class Scanner:
    """Finds all spans of a text; its own parameters, no state between texts."""

    def __init__(self, window: int = WINDOW, allowed: Sequence[str] = ALLOWED) -> None:
        self.window = window
        self.allowed = [re.compile(p) for p in allowed]

    def _allows(self, string: str) -> bool:
        bare = string.strip(_SIGNS)
        return any(p.fullmatch(string) or p.fullmatch(bare) for p in self.allowed)

    def entropy_spans(self, text: str, base: Sequence[Span]) -> list[Span]:
        """Ranges of high entropy in candidate strings not on the allow-list, without the known forms.

        Of a range that meets known forms all the rest is reported, but for signs at its ends.
        """
        found = []
        forms = _merged([(s, e) for s, _, e in base])
        for candidate in _CANDIDATE.finditer(text):
            cuts = _left_out(candidate[0])
            ranges: list[tuple[int, int]] = []
            for begin, end in _outside(0, len(candidate[0]), cuts):
                string = candidate[0][begin:end]
                if len(string) < self.window or self._allows(string):
                    continue
                begin += candidate.start()
                for _, characters, least in CLASSES:
                    for run in characters.finditer(string):
                        if not self._allows(run[0]):
                            ranges += [(begin + run.start() + s, begin + run.start() + e) for s, e in entropy_windows(run[0], self.window, least)]
            for start, end in _merged(ranges):
                rest = _outside(start, end, forms)
                if rest == [(start, end)]:
                    found.append((start, 3, end))
                    continue
                for s, e in rest:
                    s += len(text[s:e]) - len(text[s:e].lstrip(_SIGNS))
                    e = s + len(text[s:e].rstrip(_SIGNS))
                    if s < e:
                        found.append((s, 3, e))
        return found

    def spans(self, text: str) -> list[Span]:
        """Base and added spans by start, then kind."""
        base = base_spans(text)
        return sorted([*base, *self.entropy_spans(text, base)])


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _left_out(string: str) -> list[tuple[int, int]]:
    """Long repeats, and the parts that hold the name of an example."""
    cuts = [m.span() for m in _REPEAT.finditer(string)]
    names = [m.span() for m in _EXAMPLE.finditer(string)]
    if names:
        parts = [m.span() for m in _PART.finditer(string)]
        starts = [s for s, _ in parts]
        cuts += [(parts[bisect_right(starts, s) - 1][0], parts[bisect_right(starts, e - 1) - 1][1]) for s, e in names]
    return _merged(cuts)


def _outside(start: int, end: int, spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of a range without the given spans, which are in order and apart."""
    out = []
    for i in range(max(bisect_right(spans, (start, start)) - 1, 0), len(spans)):
        s, e = spans[i]
        if s >= end:
            break
        if e > start:
            if s > start:
                out.append((start, s))
            start = e
    return [*out, (start, end)] if start < end else out


def secret_spans(text: Column, window: int = WINDOW, allowed: Sequence[str] = ALLOWED) -> Column:
    """array of (kind, start, stop) of a text column; null and empty texts give an empty array."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    @F.arrow_udf(SPANS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(window, allowed)
        for batch in batches:
            yield pa.array([[{"kind": KINDS[k], "start": s, "stop": e} for s, k, e in scanner.spans(t or "")] for t in texts_of(batch)], kind)

    return run(text)


def mask_text(text: str, spans: Sequence[tuple[int, int]], mask: str) -> str:
    """One walk over the sorted (start, stop); what a span shares with the one before is masked with that."""
    parts, at = [], 0
    for start, stop in sorted(spans):
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, stop)
    return "".join([*parts, text[at:]])


def masked(text: Column, mask: str = "[SECRET]", window: int = WINDOW, allowed: Sequence[str] = ALLOWED) -> Column:
    """The text with every secret replaced, found and masked in one pass; overlapping spans become
    one mask. Null where there is none, so that such texts need not be sent back."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(window, allowed)
        for batch in batches:
            rows = ((t, [(s, e) for s, _, e in scanner.spans(t or "")]) for t in texts_of(batch))
            yield pa.array([mask_text(t, found, mask) if found else None for t, found in rows], pa.string())

    return run(text)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with secrets masked; ``n_chars`` follows where there is one."""
    found = df.withColumn("__masked", masked(F.col(text)))
    if "n_chars" in df.columns:
        found = found.withColumn("n_chars", F.coalesce(F.length("__masked").cast("long"), F.col("n_chars")))
    return found.withColumn(text, F.coalesce("__masked", F.col(text))).select(*df.columns)


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def secret_report(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", secret_spans(F.col("text")).alias("found"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != "entropy")
    return docs.select(
        "doc_id", count("assign"), count("access"), count("hex"), count("entropy"),
        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("found")).alias("spans"),
    )


QUERIES = {"op8_secrets": secret_report}
ORACLES: dict[str, str] = {}
