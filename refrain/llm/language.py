"""Language identification by cross-parsing against suffix automata of labelled text.

Every language has a suffix automaton of some of its labelled text. A text is cut greedily into
the longest phrases that occur there; the language that needs the fewest phrases, each weighed by
the bits of a place in the language's text, wins. All texts of a batch are parsed side by side:
they are laid out in lanes of ``LANE`` characters, and one numpy step moves all lanes by a
character, so the work per character is a table look-up for each language.
"""

from __future__ import annotations

import math

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refrain.llm.encoding import mapped
from refrain.sources.tables import read_table

SAMPLE_DOCUMENTS = 120  # of each language, chosen by a digest of their ids
SAMPLE_CHARS = 500  # of each of them, from a place chosen by the digest
MOST_CHARS = 240_000  # of all languages together; many languages get shorter texts
ALPHABET = 62  # letters with a column of their own in the step tables; the steps of others are looked up
LANE = 256
NO_LANGUAGE = "und"
_NEW = 1 << 30


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of a text, from a table over code points; runs of non-letters count once."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    found = table[codes]
    return found[np.append(True, (found[1:] != 0) | (found[:-1] != 0))] if len(found) else found


def symbol_table(letters: list[str]) -> np.ndarray:
    """0 for what is no letter, 1 for letters that are not given, then the given letters in either case."""
    places = {letter: i + 2 for i, letter in enumerate(letters)}
    table = np.zeros(0x110000, np.uint8 if len(letters) < 254 else np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = places.get(char) or places.get(char.lower()[0], 1)
    for letter, place in places.items():
        for char in {letter.upper(), letter.title()}:
            if len(char) == 1 and char not in places:
                table[ord(char)] = place
    return table


def transitions(symbols: list[int]) -> list[dict[int, int]]:
    """Of each state of the automaton of all substrings, the next state by symbol."""
    follow, link, longest = [{}], [-1], [0]
    last = 0
    for s in symbols:
        here = len(follow)
        follow.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in follow[p]:
            follow[p][s] = here
            p = link[p]
        if p >= 0:
            q = follow[p][s]
            if longest[q] == longest[p] + 1:
                link[here] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(s) == q:
                    follow[p][s] = copy
                    p = link[p]
                link[q] = link[here] = copy
        last = here
    return follow


def step_table(follow: list[dict[int, int]], size: int) -> np.ndarray:
    """Transitions [state, symbol] for the symbols below ``size``; -1 where there is none."""
    table = np.full((len(follow), size), -1, np.int32)
    for state, steps in enumerate(follow):
        for s, to in steps.items():
            if s < size:
                table[state, s] = to
    return table


def suffix_automaton(symbols: list[int], size: int) -> np.ndarray:
    """Transitions [state, symbol] of the automaton of all substrings; -1 where there is none."""
    return step_table(transitions(symbols), size)


@dataclass
class RareSteps:
    """Transitions of the symbols without a column: sorted keys of state and symbol."""

    keys: np.ndarray
    to: np.ndarray
    again: np.ndarray  # by symbol: the step where a state has none

    @classmethod
    def of(cls, follow: list[dict[int, int]], size: int, symbols: int) -> RareSteps:
        pairs = sorted((state * symbols + s, to) for state, steps in enumerate(follow) for s, to in steps.items() if s >= size)
        again = np.full(symbols, len(follow) | _NEW, np.int32)
        for s, to in follow[0].items():
            again[s] = to | _NEW
        keys = np.array([k for k, _ in pairs] + [1 << 62], np.int64)
        return cls(keys, np.array([t for _, t in pairs] + [0], np.int32), again)

    def look_up(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        wanted = states.astype(np.int64) * len(self.again) + symbols
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.to[at], self.again[symbols])


@dataclass
class LanguageModel:
    """Automata as step tables, in the order of the languages' names."""

    languages: list[str]
    letters: list[str]
    steps: list[np.ndarray]
    bits: list[float]  # of a phrase: a place in the language's text, or a new symbol
    rare: list[RareSteps]

    @property
    def columns(self) -> int:
        return min(len(self.letters), ALPHABET) + 2

    @classmethod
    def fit(cls, samples: dict[str, str]) -> LanguageModel:
        """From one text for each language."""
        seen: dict[str, int] = {}
        for text in samples.values():
            for char in text:
                if char.isalpha():
                    low = char.lower()[0]
                    seen[low] = seen.get(low, 0) + 1
        letters = sorted(seen, key=lambda c: (-seen[c], c))
        table, size = symbol_table(letters), min(len(letters), ALPHABET) + 2
        steps, bits, rare = [], [], []
        for language in sorted(samples):
            symbols = symbols_of(samples[language], table).tolist()
            follow = transitions(symbols)
            moves = step_table(follow, size)
            # a missing step ends the phrase; the next one begins with the same symbol, which is a
            # phrase by itself where the language lacks it: from the added last state any step is new
            again = np.where(moves[0] < 0, len(moves), moves[0]) | _NEW
            steps.append(np.vstack([np.where(moves < 0, again[None, :], moves), again[None, :]]).astype(np.int32).ravel())
            bits.append(math.log2(max(2, len(symbols))))
            rare.append(RareSteps.of(follow, size, len(letters) + 2))
        return cls(sorted(samples), letters, steps, bits, rare)

    def costs(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol [text, language], and whether each text has any letter."""
        size = self.columns
        parts = [symbols_of(t, table) for t in texts]
        lengths = np.array([len(p) for p in parts])
        letters = np.array([bool(p.any()) for p in parts], bool)
        lanes = -(-lengths // LANE)
        owner = np.repeat(np.arange(len(texts)), lanes)
        grid = np.zeros((int(lanes.sum()), LANE), table.dtype)
        at = 0
        for p, n in zip(parts, lanes.tolist(), strict=True):
            grid[at : at + n].ravel()[: len(p)] = p  # a view, as the lanes of a text are adjacent
            at += n
        widths = np.full(len(grid), LANE)
        ends = np.cumsum(lanes)[lanes > 0] - 1
        widths[ends] = (lengths[lanes > 0] - 1) % LANE + 1
        order = np.argsort(-widths, kind="stable")  # lanes that end early come last
        grid, widths, owner = np.ascontiguousarray(grid[order].T), widths[order], owner[order]
        active = np.searchsorted(-widths, -np.arange(LANE), "left")  # lanes wider than each column
        far = [np.flatnonzero(row[:n] >= size) if len(self.letters) > ALPHABET else row[:0] for row, n in zip(grid, active, strict=True)]
        result = np.zeros((len(texts), len(self.languages)))
        for k, steps in enumerate(self.steps):
            state = np.full(grid.shape[1], len(steps) // size - 1, np.int32)
            phrases = np.zeros(grid.shape[1], np.int32)
            for i in range(LANE):
                n = active[i]
                if n == 0:
                    break
                if len(far[i]):
                    to = steps[state[:n] * size + np.minimum(grid[i, :n], size - 1)]
                    to[far[i]] = self.rare[k].look_up(state[far[i]], grid[i, far[i]])
                else:
                    to = steps[state[:n] * size + grid[i, :n]]
                phrases[:n] += to >> 30
                state[:n] = to & (_NEW - 1)
            result[:, k] = np.bincount(owner, phrases, len(texts)) * self.bits[k]
        return result / np.maximum(lengths, 1)[:, None], letters

    def predict(self, texts: list[str | None], table: np.ndarray) -> list[tuple[str, float]]:
        """Language and score of each text: the winner's lead as a share of the next one's bits."""
        bits, letters = self.costs([t or "" for t in texts], table)
        if not self.languages:
            return [(NO_LANGUAGE, 0.0)] * len(texts)
        out = []
        for row, known in zip(bits, letters, strict=True):
            if not known:
                out.append((NO_LANGUAGE, 0.0))
                continue
            best = int(row.argmin())  # of equal ones the first name
            weights = np.exp2(-20 * (row - row[best]))
            out.append((self.languages[best], float(1 / weights.sum())))
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample_texts(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """One bounded training text for each language of (doc_id, text, lang).

    Of each language the ``documents`` texts with the smallest digests of their ids give ``chars``
    characters each. The bound is for the model's training only.
    """
    usable = docs.filter("text is not null and lang is not null")
    digest = F.xxhash64(F.lit("language"), "doc_id")
    width = F.greatest(F.length("text") - chars, F.lit(0)) + 1
    piece = F.substring("text", (F.pmod(F.shiftright(digest, 8), width) + 1).cast("int"), F.lit(chars))
    ranked = usable.select("lang", digest.alias("__digest"), "doc_id", piece.alias("piece"))
    order = Window.partitionBy("lang").orderBy("__digest", "doc_id", "piece")
    chosen = ranked.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= documents)
    rows = chosen.select("lang", "__rank", "piece").collect()
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in rows:
        texts.setdefault(row[0], []).append((row[1], row[2]))
    most = MOST_CHARS // max(1, len(texts))
    return {lang: "\n".join(p for _, p in sorted(pieces))[:most] for lang, pieces in texts.items()}


_SYMBOLS: dict[tuple[str, ...], np.ndarray] = {}


def identify(df: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the predicted language and a score from 0 to 1; ``und`` for null and texts without a letter."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def predicted(batch: pa.RecordBatch) -> list[pa.Array]:
        letters = tuple(shared.value.letters)
        if letters not in _SYMBOLS:
            _SYMBOLS.clear()
            _SYMBOLS[letters] = symbol_table(list(letters))
        rows = shared.value.predict(batch.column(text).to_pylist(), _SYMBOLS[letters])
        return [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())]

    return mapped(df, {lang: "string", score: "double"}, predicted)


def language_report(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents")
    model = LanguageModel.fit(sample_texts(docs.filter(~held_out(F.col("doc_id")))))
    rows = identify(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op5_language": language_report}
ORACLES: dict[str, str] = {}
