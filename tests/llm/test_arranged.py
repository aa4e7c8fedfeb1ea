"""Fill-in-middle, Merkle manifest and line dedup against plain Python, with their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from refrain.llm import lines, merkle, middle

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
PARTS = ["a", "bc ", " ", "\n", "\t\t", "é", "日本 ", "\U0001f600", "\x0b", "x\n\n", "<", "P>", "\x00", "\x85", "\xa0"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(80))) for _ in range(n)]


# Fill-in-middle -----------------------------------------------------------------------------


def plain_middle(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(tokens), "plain", None, None, text
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return len(tokens), "spm" if h4 % 100 < 80 else "psm", len(p), len(m), out


def test_wavelet_matrix_counts():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 12, size).astype(np.uint8)
        matrix = middle.WaveletMatrix(symbols)
        for place in {0, size, size // 2, size // 3, min(size, 64)}:
            assert [matrix.rank(s, place) for s in range(16)] == [int((symbols[:place] == s).sum()) for s in range(16)]


@pytest.mark.parametrize("unit, pieces", [("token", TOKEN.findall), ("line", lambda t: t.splitlines(keepends=True) if not set(t) & set("\x0b\x0c\x1c\x1d\x1e\x85\r") else re.findall(r"[^\n]*\n|[^\n]+$", t)), ("character", list)])
def test_cuts_are_where_units_end(unit, pieces):
    for text in random_texts(60):
        parts, bounds = pieces(text), middle.Boundaries(text, unit)
        assert bounds.units == len(parts)
        assert [bounds.cut(k) for k in range(len(parts) + 1)] == [len("".join(parts[:k])) for k in range(len(parts) + 1)]


def test_middle_rows(spark):
    texts = [None, "", " ", "one", "with <S> inside", "trailing \n\n", "a\x00b c", *random_texts(200), "word " * 50_000]
    rows = [(i if i % 9 else None, t, -1) for i, t in enumerate(texts)] + [(5, "same text here", 1)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    made = middle.fill_in_middle(df).withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert [tuple(r[c] for c in ("n", "form", "prefix_chars", "middle_chars", "output")) for r in made] == [plain_middle(i, t) for i, t, _ in rows]
    assert [r["back"] for r in made] == [t or "" for _, t, _ in rows]
    assert {r["form"] for r in made} == {"plain", "psm", "spm"} and middle.fill_in_middle(df.limit(0)).count() == 0


def test_markers_may_not_overlap(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    for markers in (("<P>", "<P>", "<M>"), ("aa", "b", "c"), ("ab", "bc", "d"), ("abc", "b", "d"), ("", "b", "c")):
        with pytest.raises(ValueError):
            middle.fill_in_middle(df, markers=markers)
    made = middle.fill_in_middle(df, markers=("[pre]", "[suf]", "[mid]"), rate=100, unit="character")
    assert made.select(middle.restored(F.col("output"), F.col("form"), ("[pre]", "[suf]", "[mid]"))).first()[0] == "x"


# Merkle manifest ----------------------------------------------------------------------------


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(levels, place):
    out = []
    for level in levels[:-1]:
        run = place - place % 3
        out.append(("".join(level[run:place]), "".join(level[place + 1 : run + 3])))
        place //= 3
    return out


def plain_manifest(leaves):
    """(doc_id, leaf, witness, subroot, root) of (doc_id, source, leaf)."""
    groups = {}
    for doc_id, source, leaf in leaves:
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(groups[s])]) for s in names}
    top = levels_of([trees[s][-1][0] for s in names])
    return [
        (x[3], x[2], siblings(trees[s], k) + siblings(top, t), trees[s][-1][0], top[-1][0])
        for t, s in enumerate(names)
        for k, x in enumerate(sorted(groups[s]))
    ]


def as_text(rows):
    return sorted(str(r) for r in rows)


@pytest.mark.parametrize("height", [1, 2, 5])
def test_manifest(spark, height):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(400)]), rng.choice(["hot", "hot", "b", None, "é", "\U0001f600", "one of one" if i == 7 else "b"]), sha(str(rng.randrange(500)))) for i in range(700)]
    rows += [(3, "lone", sha("x")), (11, "b", sha("same")), (11, "b", sha("same"))]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, leaf string").withColumns({"pos": F.lit("clash"), "tree": F.lit(1)})
    got = [(r["doc_id"], r["leaf"], [(w["before"].hex(), w["after"].hex()) for w in r["witness"]], r["subroot"], r["root"]) for r in merkle.manifest(df, height).collect()]
    assert as_text(got) == as_text(plain_manifest(rows))


def test_manifest_of_little(spark):
    one = spark.createDataFrame([(1, None, sha("a"))], "doc_id bigint, source string, leaf string")
    row = merkle.manifest(one).first()
    assert (row["root"], row["witness"], row["claimed"]) == (sha("a"), [], None)
    assert merkle.manifest(one.limit(0)).count() == 0


def test_witnesses_grow_with_siblings():
    tree = merkle.Witnesses()
    first = tree.append(b"a" * 32)
    tree.append(b"b" * 32)
    assert list(first.witness()) == []  # nothing is complete yet
    tree.append(b"c" * 32)
    assert list(first.witness()) == [(b"", b"b" * 32 + b"c" * 32)]
    for _ in range(6):
        tree.append(b"d" * 32)
    assert len(list(first.witness())) == 2 and sum(map(len, tree.open)) == 1


def test_leaves_and_tampering(spark):
    rows = [(1, None, "en", 3, "a\nb"), (2, "é", None, None, None), (None, "s", "", 0, ""), (4, "s", "x", 1, "no line end")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    plain = lambda r: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    leaves = df.withColumn("leaf", merkle.leaf_digest([F.col(c) for c in merkle.COLUMNS])).withColumn("claimed", F.when(F.col("doc_id") == 1, F.lit(sha("other"))).otherwise(F.col("leaf")))
    assert [r["leaf"] for r in leaves.collect()] == [plain(r) for r in rows]
    made = merkle.manifest(leaves).withColumn("same", merkle.folded(F.col("claimed"), F.col("witness")) == F.col("root"))
    assert {r["doc_id"]: r["same"] for r in made.collect()} == {1: False, 2: True, None: True, 4: True}
    assert zlib.crc32(b"1") % 2 == 1


# Line dedup ---------------------------------------------------------------------------------


def plain_lines(rows, least=5, shortest=40):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    holders = {}
    for i, (doc_id, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= shortest:
                holders.setdefault(k, []).append(-1 if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        parts = (text or "").split("\n")
        at = -1 if doc_id is None else doc_id
        kept = [x for x in parts if len(holders.get(key(x), [])) < least or at == max(holders[key(x)])]
        out.append((doc_id, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


LONG = [f"Line number {i} with é and more than forty characters in it" for i in range(12)]


def line_rows(seed=6, n=120):
    rng = random.Random(seed)

    def line():
        x = rng.choice([*LONG, LONG[0], "short", "", "é" * 39, "é" * 40, f"own {rng.random()} " * 4])
        return rng.choice(["", " ", "\t\r"]) + (x.upper() if rng.random() < 0.2 and "é" not in x else x) + rng.choice(["", "  "])

    return [(i, "\n".join(line() for _ in range(rng.randrange(8)))) for i in rng.sample(range(1000), n)]


def compared(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "kept", 0) for r in rows], "doc_id bigint, text string, key string, n_lines int")
    made = lines.drop_lines(df, **settings)
    assert made.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in made.collect()]
    assert as_text(got) == as_text(plain_lines(rows, settings.get("least", 5), settings.get("shortest", 40)))


def test_lines(spark):
    compared(spark, line_rows())


@pytest.mark.parametrize("batches, least, shortest", [(1, 2, 1), (3, 1, 10), (5, 7, 40)])
def test_lines_with_other_settings(spark, batches, least, shortest):
    compared(spark, line_rows(9, 60), batches=batches, least=least, shortest=shortest)


def test_lines_with_ties_nulls_and_copies(spark):
    rows = [(7, LONG[0]), (7, LONG[0]), (7, None), (2, ""), (3, f"{LONG[0]}\n{LONG[0]}\nend"), *[(None, LONG[0])] * 3, *[(None, LONG[1])] * 6, (9, "\n" * 5000 + LONG[2] * 2000)]
    compared(spark, rows)
    assert lines.drop_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_most_keys_are_light(spark, monkeypatch):
    monkeypatch.setattr(lines, "_HEAVY", 1)  # no key is known to all tasks, all go through the join
    compared(spark, line_rows(11, 80))


def test_runs_are_merged_by_level(spark):
    runs = lines.LineRuns(spark, least=1)
    seen = set()
    for k in range(5):
        batch = {bytes([i]) * 16 for i in range(k * 3, k * 3 + 6)}
        entries = spark.createDataFrame([(bytearray(x), 1, 100 - k) for x in batch], lines.ENTRY)
        assert {bytes(r["key"]) for r in runs.new_keys(entries).collect()} == batch - seen  # the merge anti-join
        runs.add(entries)
        seen |= batch
        assert [len(level) for level in runs.levels] == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]][k]
    assert {bytes(r["key"]): r["last"] for r in runs.settled().collect()} == {bytes([i]) * 16: 100 - max(0, i // 3 - 1) for i in range(18)}
    runs.close()
