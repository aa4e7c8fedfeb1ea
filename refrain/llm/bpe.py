"""Byte-level BPE as a streaming transducer with bounded lookahead, and its incremental decoder.

Three layers, all plain Python and numpy that run inside Spark tasks:

* ``MergeTable`` holds the merge list of a public tokenizer file and its *sufficient lookahead*:
  how many bytes behind a place must be known before the token boundaries up to it are final.
* ``Transducer`` takes the bytes of one word in pieces and emits tokens as soon as they are
  stable; it never holds more than twice the lookahead plus one piece.
* ``TextEncoder`` cuts texts into words (the file's pre-tokenizer), encodes every different word of
  a block once and lays the ids out by document. ``StreamEncoder`` does the same for a text that
  arrives in pieces.

Why the lookahead suffices. Merges run in rank order, leftmost first, so compare the run over a
prefix with the run over the whole word. The first rule that differs straddles the end of the
prefix and starts at most ``len(a) + len(b) - 1`` bytes before it. Later the place of the first
difference can only move left by a rule (a, b) of higher rank whose ``b`` starts at that place, so
that the left part of the earlier rule lies on the left spine of ``b``; it moves by ``len(a)``.
The longest such chain of rules with rising ranks bounds how far the end can be felt.
"""

from __future__ import annotations

import codecs
import heapq
import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain
from unicodedata import category

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

SPACE, LETTER, NUMBER, OTHER = 3, 1, 2, 0
BLOCK_CHARS = 1 << 19
LONG_WORD = 64
CACHED_WORDS = 150_000
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1
NO_RULE = 1 << 62


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    symbols = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in symbols)
    symbols.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return [symbols[b] for b in range(256)]


class MergeTable:
    """Merges, token bytes and special tokens of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is not a byte-level BPE file")
        symbols = byte_symbols()
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.first = [vocab[s] for s in symbols]
        self.bytes: list[bytes] = [b""] * self.size
        for token, number in vocab.items():
            self.bytes[number] = bytes(byte_of[s] for s in token)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, number in self.specials.items():
            self.bytes[number] = text.encode()
        self.rules: dict[int, int] = {}  # pair of ids -> rank and id of the whole, in rank order
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            whole = vocab[left + right]
            self.rules[vocab[left] * self.size + vocab[right]] = rank << ID_BITS | whole
            self.parts[whole] = (vocab[left], vocab[right])
        self.lookahead = self._sufficient_lookahead()

    def _sufficient_lookahead(self) -> int:
        """The longest chain of rules described in the module's docstring, in bytes."""
        reach: dict[int, int] = {}  # by left part, over the rules of lower rank
        longest = 0
        for key in self.rules:  # in rank order
            left, right = divmod(key, self.size)
            far = len(self.bytes[left]) + len(self.bytes[right]) - 1
            node: int | None = right
            while node is not None:
                far = max(far, reach.get(node, 0) + len(self.bytes[left]))
                node = self.parts[node][0] if node in self.parts else None
            reach[left] = max(reach.get(left, 0), far)
            longest = max(longest, far)
        return longest

    def merge(self, data: bytes) -> list[int]:
        """Tokens of one whole word."""
        tokens = [self.first[b] for b in data]
        return self._merge_short(tokens) if len(tokens) <= 24 else self._merge_long(tokens)

    def _merge_short(self, tokens: list[int]) -> list[int]:
        find, size = self.rules.get, self.size
        pairs = [find(a * size + b, NO_RULE) for a, b in zip(tokens, tokens[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best == NO_RULE:
                break
            i = pairs.index(best)
            whole = tokens[i] = best & ID_MASK
            del tokens[i + 1], pairs[i]
            if i:
                pairs[i - 1] = find(tokens[i - 1] * size + whole, NO_RULE)
            if i < len(pairs):
                pairs[i] = find(whole * size + tokens[i + 1], NO_RULE)
        return tokens

    def _merge_long(self, tokens: list[int]) -> list[int]:
        find, size, n = self.rules.get, self.size, len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rule = find(tokens[i] * size + tokens[i + 1])
            if rule is not None:
                heap.append((rule, i))
        heapq.heapify(heap)
        while heap:
            rule, i = heapq.heappop(heap)
            j = after[i]
            if tokens[i] < 0 or j >= n or find(tokens[i] * size + tokens[j]) != rule:
                continue
            tokens[i], tokens[j] = rule & ID_MASK, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    rule = find(tokens[k] * size + tokens[after[k]])
                    if rule is not None:
                        heapq.heappush(heap, (rule, k))
        return [t for t in tokens if t >= 0]


class Transducer:
    """Encodes one word whose bytes arrive in pieces; memory does not depend on its length."""

    def __init__(self, table: MergeTable) -> None:
        self.table = table
        self.pending = b""

    def push(self, data: bytes) -> list[int]:
        """Take bytes and return the tokens that no later byte can change."""
        out: list[int] = []
        ahead, lengths = self.table.lookahead, self.table.bytes
        step = 2 * ahead + 64
        for start in range(0, len(data), step):
            self.pending += data[start : start + step]
            if len(self.pending) < step:
                continue
            tokens, end = self.table.merge(self.pending), 0
            for token in tokens:
                if end + len(lengths[token]) > len(self.pending) - ahead:
                    break
                end += len(lengths[token])
                out.append(token)
            self.pending = self.pending[end:]
        return out

    def finish(self) -> list[int]:
        tokens, self.pending = self.table.merge(self.pending), b""
        return tokens


class Decoder:
    """Incremental byte-to-text state machine: feed ids, get the text that is complete so far.

    A character whose bytes are split over tokens waits in the state; bytes that can't become one
    are replaced as the whole text's decoding would replace them.
    """

    def __init__(self, table: MergeTable) -> None:
        self.bytes = table.bytes
        self.state = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def push(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


def _class_table() -> np.ndarray:
    """Letter, number, white space or other, by code point.

    Python's two Unicode tables are of different versions. Where they disagree (characters that
    were assigned in between), the tokenizer library itself is asked how it groups the character.
    """
    points = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    at = np.frombuffer(points.encode("utf-32-le"), np.uint32)
    older = np.array([{"L": LETTER, "N": NUMBER}.get(category(c)[0], OTHER) for c in points], np.uint8)
    newer = np.zeros(len(points), np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for run in regex.finditer(pattern, points):
            newer[run.start() : run.end()] = kind
    older[newer == SPACE] = SPACE
    cut = ByteLevel(add_prefix_space=False).pre_tokenize_str
    for i in np.flatnonzero(older != newer):
        alone = [kind for kind, mate in ((LETTER, "x"), (NUMBER, "1"), (OTHER, "!")) if len(cut(mate + points[i])) == 1]
        newer[i] = alone[0] if alone else SPACE
    kinds = np.zeros(0x110000, np.uint8)
    kinds[at] = newer
    return kinds


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character classes, and powers of an odd number and of its inverse up to ``n`` at least."""
    if "kinds" not in _TABLES:
        _TABLES["kinds"] = _class_table()
    if len(_TABLES.get("up", ())) < n + 1:
        base = 0x9E3779B97F4A7C15 | 1
        for name, number in (("up", base), ("down", pow(base, -1, 1 << 64))):
            powers = np.full(max(n, BLOCK_CHARS) + 1, number, np.uint64)
            powers[0] = 1
            _TABLES[name] = np.cumprod(powers, dtype=np.uint64)
    return _TABLES["kinds"], _TABLES["up"], _TABLES["down"]


def word_starts(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where words start in concatenated texts (code points, start of every non-empty text).

    Words are contractions, runs of letters, numbers or other characters with at most one blank
    before them, and white space; of white space before a word, the last character stands alone
    or is the word's blank.
    """
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = _tables(0)[0][codes]
    head = np.zeros(n + 3, bool)
    head[text_starts] = True
    start = np.zeros(n + 3, bool)
    start[0] = True
    start[1:n] = kind[1:] != kind[:-1]
    start |= head
    after_space = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~head[1:n]) + 1
    start[after_space - 1] = True
    start[after_space[codes[after_space - 1] == 32]] = False
    quote = np.flatnonzero((codes == 39) & start[:n])
    if len(quote):
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        here = ~head[quote + 1] & (quote + 1 < n)
        single = here & np.isin(one, [ord(c) for c in "stmd"])
        double = here & ~head[quote + 2] & (
            ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        )
        start[quote[single | double] + 1] = False
        start[quote[single] + 2] = True
        start[quote[double] + 3] = True
    return np.flatnonzero(start[:n])


def _safe_cut(text: str, end: int, kinds: np.ndarray, floor: int = 0) -> int:
    """The last place up to ``end`` between a visible character and white space, or ``floor``."""
    for i in range(min(end, len(text) - 1), floor, -1):
        if kinds[ord(text[i])] == SPACE and kinds[ord(text[i - 1])] != SPACE:
            return i
    return floor


class TextEncoder:
    """Encodes many texts; equal words of a block are encoded once.

    ``encode_words`` turns a list of words into lists of ids; by default it is the transducer. A
    dictionary of at most ``CACHED_WORDS`` words is kept between blocks, so memory is bounded.
    """

    def __init__(self, table: MergeTable, encode_words: Callable[[list[str]], list[list[int]]] | None = None) -> None:
        self.table = table
        self.known: dict[str, list[int]] = {}
        self.encode_words = encode_words or self._transduce

    def _transduce(self, words: list[str]) -> list[list[int]]:
        out = []
        for word in words:
            data = word.encode()
            if len(data) <= LONG_WORD:
                out.append(self.table.merge(data))
            else:
                machine = Transducer(self.table)
                out.append([*machine.push(data), *machine.finish()])
        return out

    def _ids_of(self, words: list[str]) -> list[list[int]]:
        known = self.known
        found = [known.get(w) for w in words]
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            for i, ids in zip(missing, self.encode_words([words[i] for i in missing]), strict=True):
                found[i] = ids
                if len(known) < CACHED_WORDS and len(words[i]) <= LONG_WORD:
                    known[words[i]] = ids
        return found  # type: ignore[return-value]

    def _block(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and the number of ids of each."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(texts)
        n = len(joined)
        if n == 0:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends_of_texts = np.cumsum(lengths)
        begins = (ends_of_texts - lengths)[lengths > 0]
        starts = word_starts(codes, begins)
        ends = np.append(starts[1:], n)
        _, up, down = _tables(n)
        hashed = codes + np.uint64(0x51ED270B)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(29)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashed * up[:n], out=total[1:])
        key = (total[ends] - total[starts]) * down[starts]
        key ^= (ends - starts).astype(np.uint64) << np.uint64(56)
        long = np.flatnonzero(ends - starts > LONG_WORD)
        key[long] = long.astype(np.uint64) | np.uint64(0xFF << 56)  # long words are never taken as equal
        _, sample, which = np.unique(key, return_index=True, return_inverse=True)
        ids = self._ids_of([joined[s:e] for s, e in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        offsets = np.cumsum(sizes) - sizes
        counts = sizes[which]
        placed = np.cumsum(counts)
        result = flat[np.repeat(offsets[which] - (placed - counts), counts) + np.arange(placed[-1])]
        until = np.append(0, placed)[np.searchsorted(starts, ends_of_texts, "left")]
        return result, np.diff(until, prepend=0)

    def _pieces(self, text: str) -> list[str | int]:
        """Parts of a text that are encoded by themselves, and ids of special tokens between them."""
        parts: list[str | int] = [text]
        for special, number in self.table.specials.items():
            if special in text:
                parts = [x for p in parts for x in (self._split(p, special, number) if isinstance(p, str) else [p])]
        out: list[str | int] = []
        for part in parts:
            while isinstance(part, str) and len(part) > BLOCK_CHARS:
                cut = _safe_cut(part, BLOCK_CHARS, _tables(0)[0])
                if cut == 0:
                    break
                out.append(part[:cut])
                part = part[cut:]
            out.append(part)
        return out

    @staticmethod
    def _split(text: str, special: str, number: int) -> list[str | int]:
        around = text.split(special)
        return [around[0], *(x for part in around[1:] for x in (number, part))]

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        waiting: list[list[str | int]] = []
        chars = 0
        for text in texts:
            waiting.append(self._pieces(text) if len(text) > BLOCK_CHARS or any(s in text for s in self.table.specials) else [text])
            chars += len(text)
            if chars >= BLOCK_CHARS:
                yield from self._flush(waiting)
                waiting, chars = [], 0
        yield from self._flush(waiting)

    def _flush(self, waiting: list[list[str | int]]) -> Iterator[np.ndarray]:
        if sum(len(p) for parts in waiting for p in parts if isinstance(p, str)) > 2 * BLOCK_CHARS:
            for parts in waiting:  # a very long text: one piece at a time
                yield np.concatenate([np.array([p], np.int32) if isinstance(p, int) else self._block([p])[0] for p in parts])
            return
        ids, counts = self._block([p for parts in waiting for p in parts if isinstance(p, str)])
        ends = np.cumsum(counts).tolist()
        at, begin = 0, 0
        for parts in waiting:
            pieces = []
            for p in parts:
                if isinstance(p, int):
                    pieces.append(np.array([p], np.int32))
                else:
                    pieces.append(ids[begin : ends[at]])
                    begin = ends[at]
                    at += 1
            yield pieces[0] if len(pieces) == 1 else np.concatenate(pieces)


class StreamEncoder:
    """Encodes one text that arrives in pieces of any size; special tokens are not looked for.

    Text up to the last place that surely divides words is encoded at once. A word that grows
    beyond ``window`` characters is handed to the transducer while it is still open.
    """

    def __init__(self, table: MergeTable, window: int = 4096) -> None:
        self.encoder = TextEncoder(table)
        self.table, self.window = table, window
        self.rest = ""
        self.machine: Transducer | None = None
        self.kind = OTHER

    def _whole(self, text: str) -> list[int]:
        return self.encoder._block([text])[0].tolist() if text else []

    def push(self, piece: str) -> list[int]:
        out: list[int] = []
        kinds = _tables(0)[0]
        self.rest += piece
        if self.machine is not None:
            out += self._continue(kinds)
        cut = _safe_cut(self.rest, len(self.rest), kinds) if self.machine is None else 0
        out += self._whole(self.rest[:cut])
        self.rest = self.rest[cut:]
        if self.machine is None and len(self.rest) > self.window:
            codes = np.frombuffer(self.rest.encode("utf-32-le"), np.uint32)
            starts = word_starts(codes, np.array([0]))
            last = int(starts[-1])
            if len(self.rest) - last > self.window // 2:
                out += self._whole(self.rest[:last])
                self.rest = self.rest[last:]
                self.machine, self.kind = Transducer(self.table), int(kinds[ord(self.rest[-1])])
                out += self.machine.push(self.rest[:-1].encode())
                self.rest = self.rest[-1:]
            elif len(starts) > 3:  # the last words may still change
                out += self._whole(self.rest[: int(starts[-3])])
                self.rest = self.rest[int(starts[-3]) :]
        return out

    def _continue(self, kinds: np.ndarray) -> list[int]:
        """Feed the open word; close it where its run of characters ends."""
        codes = np.frombuffer(self.rest.encode("utf-32-le"), np.uint32)
        other = np.flatnonzero(kinds[codes] != self.kind)
        assert self.machine is not None
        if not len(other):
            out = self.machine.push(self.rest[:-1].encode())
            self.rest = self.rest[-1:]
            return out
        end = int(other[0]) - (self.kind == SPACE)
        out = [*self.machine.push(self.rest[:end].encode()), *self.machine.finish()]
        self.rest, self.machine = self.rest[end:], None
        return out

    def finish(self) -> list[int]:
        if self.machine is None:
            out = self._whole(self.rest)
        else:
            out = [*self.machine.push(self.rest.encode()), *self.machine.finish()]
        self.rest, self.machine = "", None
        return out
