"""Learned words and best paths against brute force."""

import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from refrain.operators import keywords, segmentation

WORDS = ["音乐", "好听", "旋律", "喜欢", "非常", "歌手", "的", "我", "了"]


def chinese(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(WORDS) for _ in range(rng.randrange(3, 12))) for _ in range(n)]


def plain_lexicon(runs, longest=5, least=5, cohesion=1.5, freedom=1.0):
    counts = {}
    for run in runs:
        framed = f"\x02{run}\x03"
        for k in range(1, longest + 2):
            for i in range(len(framed) - k + 1):
                counts[framed[i : i + k]] = counts.get(framed[i : i + k], 0) + 1
    inner = {s: n for s, n in counts.items() if not set(s) & {"\x02", "\x03"}}
    total = sum(n for s, n in inner.items() if len(s) == 1)

    def entropy(around):
        n = sum(around)
        return math.log(n) - sum(c * math.log(c) for c in around) / n

    out = {s: n for s, n in inner.items() if len(s) == 1}
    for s, n in inner.items():
        if 1 < len(s) <= longest and n >= least:
            tight = min(math.log(n * total / (inner[s[:k]] * inner[s[k:]])) for k in range(1, len(s)))
            free = min(entropy([c for t, c in counts.items() if len(t) == len(s) + 1 and t.startswith(s)]), entropy([c for t, c in counts.items() if len(t) == len(s) + 1 and t.endswith(s)]))
            if round(tight, 6) >= cohesion and round(free, 6) >= freedom:
                out[s] = n
    return out


def test_learned_words(spark):
    runs = chinese(150)
    frame = spark.createDataFrame([(r,) for r in [*runs, *runs[:9], ""]], "run string")
    learned = {r.word: r.n for r in segmentation.learn(frame).collect()}
    assert learned == plain_lexicon([*runs, *runs[:9]])
    assert {"音乐", "好听", "旋律"} <= set(learned) and "乐好" not in learned


def test_strings_are_counted_where_the_runs_lie(spark, monkeypatch):
    runs = ["ab", "aab", "a", "ab", "𝒳b𝒳", "", None, "的好的好"]
    frame = spark.createDataFrame([(r,) for r in runs], "run string")
    want = {}
    for r in filter(None, runs):
        framed = f"\x02{r}\x03"
        for k in range(1, 5):
            for i in range(len(framed) - k + 1):
                want[framed[i : i + k]] = want.get(framed[i : i + k], 0) + 1
    for together in (1, 6, 1 << 20):
        monkeypatch.setattr(segmentation, "TOGETHER", together)
        counts = segmentation.string_counts(frame, 4)
        assert {r.string: r.n for r in counts.collect()} == want
    text = counts._jdf.queryExecution().toString()
    assert text.count("Aggregate [") and "times" not in text  # runs themselves are not shuffled


def brute_path(run, shares, longest):
    """The best of all divisions."""
    unknown = 2 * min(shares.values()) - 1
    best = None
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        words, start = [], 0
        for i, cut in enumerate([*cuts, 1], 1):
            if cut:
                words.append(run[start:i])
                start = i
        if all(len(w) == 1 or (len(w) <= longest and w in shares) for w in words):
            weight = sum(shares.get(w, unknown) for w in words)
            if best is None or weight > best:
                best = weight
    return best


def test_best_path_is_the_best_of_all():
    rng = random.Random(4)
    for _ in range(200):
        shares = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))): -rng.random() * 9 for _ in range(12)}
        run = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 10)))
        words = segmentation.best_path(run, shares, 4)
        unknown = 2 * min(shares.values()) - 1
        assert "".join(words) == run and sum(shares.get(w, unknown) for w in words) == pytest.approx(brute_path(run, shares, 4))
    assert segmentation.best_path("", {"a": -1.0}) == [] and segmentation.best_path("xy", {}) == ["x", "y"]


def test_best_path_is_linear():
    shares = {"ab": -1.0, "abc": -2.0, "c": -1.5}

    def seconds(n):
        start = time.perf_counter()
        segmentation.best_path("abc" * n, shares)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(160_000) < 4 * seconds(80_000) + 0.2


def test_document_words(spark):
    rows = [(1, "Plain words, here"), (2, "我非常喜欢的音乐 and more"), (3, None), (4, ""), (5, "好听" * 4000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    runs = spark.createDataFrame([(r,) for r in chinese(150)], "run string")
    shares = segmentation.weights(segmentation.learn(runs))
    words = {r.doc_id: r.words for r in segmentation.document_words(documents, shares).collect()}
    assert words[1] == ["plain", "words", "here"] and words[3] == words[4] == []
    assert words[2] == ["and", "more", "我", "非常", "喜欢", "的", "音乐"] and words[5] == ["好听"] * 4000
    without = segmentation.document_words(documents, {})
    assert {r.doc_id: r.words for r in without.filter("doc_id < 2").collect()} == {1: words[1]}
    assert len(segmentation.weights(segmentation.learn(runs), most=3)) == 3


def test_words_are_counted_in_the_row(spark):
    frame = spark.createDataFrame([(1, ["b", "the", "a", "b"]), (2, []), (3, ["the"]), (4, None)], "doc_id long, words array<string>")
    counted = keywords.word_counts(frame)
    assert sorted(map(tuple, counted.collect())) == [(1, "a", 1), (1, "b", 2)]
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()


def test_boundaries_of_joined_phrases(spark):
    rng = random.Random(5)
    known = ["melody", "guitar", "chorus", "drum", "on", "a"]
    said = [" ".join(rng.choice(known) for _ in range(8)) + "." for _ in range(300)]
    documents = spark.createDataFrame([*enumerate(said), (900, None), (901, "...")], "doc_id long, text string")
    runs = documents.select(F.explode(segmentation.joined_runs(F.col("text"))).alias("run"))
    shares = segmentation.weights(segmentation.learn(runs, longest=6))
    made = {r.doc_id: r for r in segmentation.boundary_scores(documents, shares, longest=6).collect()}
    assert tuple(made[900])[1:] == tuple(made[901])[1:] == (0, 0, 0)
    common, true, found = (sum(r[c] for r in made.values()) for c in ("n_common", "n_true", "n_found"))
    assert common / true > 0.95 and common / found > 0.9


@pytest.mark.parametrize("longest", [1, 3, 5])
def test_paths_side_by_side_are_best_paths(longest):
    rng = random.Random(longest)
    text = lambda n: "".join(rng.choice("aabc𝒳的") for _ in range(n))
    shares = {text(rng.randrange(1, longest + 1)): -rng.randrange(1, 5) / 2 for _ in range(40)}
    runs = [text(rng.randrange(0, 40)) for _ in range(300)]
    codes = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32).astype(np.int64)
    unknown = segmentation.weight_of_unknown(shares)
    ends = segmentation.path_ends(codes, np.array([len(r) for r in runs]), segmentation._Trie(shares, longest), longest, unknown)
    want = np.concatenate([[w_end for w in segmentation.best_path(r, shares, longest) for w_end in [False] * (len(w) - 1) + [True]] for r in runs])
    assert np.array_equal(ends, want.astype(bool))
    none = segmentation.path_ends(np.array([97, 98]), np.array([0, 2]), segmentation._Trie({}, longest), longest, -3.0)
    assert none.tolist() == [True, True]


def test_shares_are_not_read_for_every_run(spark):
    class Read(dict):
        def values(self):
            raise AssertionError("all shares were read")

    assert segmentation.best_path("abab", Read({"ab": -1.0}), unknown=-3.0) == ["ab", "ab"]
    rows = [(k, " ".join(f"w{k}x{i}," for i in range(300))) for k in range(100)]
    shares = {f"{i:x}": -10.0 for i in range(1 << 18)}
    made = segmentation.boundary_scores(spark.createDataFrame(rows, "doc_id long, text string"), shares)
    start = time.perf_counter()
    assert {r.n_true for r in made.collect()} == {300}
    assert time.perf_counter() - start < 60  # 30000 phrases


def test_scores_are_those_of_phrases_cut_alone(spark, monkeypatch):
    rng = random.Random(12)
    known = ["one", "two", "on", "e", "three"]
    rows = [(k, ". ".join(" ".join(rng.choice(known) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(0, 6)))) for k in range(60)]
    shares = {w: -1.0 - i / 8 for i, w in enumerate(known)}
    documents, unknown, want = spark.createDataFrame([*rows, (99, None)], "doc_id long, text string"), segmentation.weight_of_unknown(shares), {99: (0, 0, 0)}
    for k, text in rows:
        true, found, at = set(), set(), 0
        for phrase in filter(None, text.split(". ")):
            for out, words in ((true, phrase.split(" ")), (found, segmentation.best_path(phrase.replace(" ", ""), shares, 5, unknown))):
                out |= {at + end for end in np.cumsum([len(w) for w in words]).tolist()}
            at += len(phrase.replace(" ", ""))
        want[k] = (len(true), len(found), len(true & found))
    for side, alone in ((1, 0), (7, 2), (1 << 14, 16)):
        monkeypatch.setattr(segmentation, "SIDE_BY_SIDE", side)
        monkeypatch.setattr(segmentation, "ALONE", alone)
        made = segmentation.boundary_scores(documents, shares).collect()
        assert {r.doc_id: tuple(r)[1:] for r in made} == want
