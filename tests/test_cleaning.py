"""Cleaning rules, exact copies, signatures, near copies and components on small frames."""

import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

from refrain.operators import components as components_module
from refrain.operators import clean, nearcopies, survivors
from refrain.operators.components import components
from refrain.operators.tokens import segments, words
from refrain.plans.catalog import REGISTRY


def failures(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    checked = frame.select("doc_id", clean.first_failure(F.col("text")).alias("f"))
    return [r.f for r in checked.orderBy("doc_id").collect()]


def test_rules(spark):
    texts = {
        "a perfectly fine comment": None,
        "": "empty",
        "  \n\t ": "empty",
        None: "empty",
        "short": None,
        "s": "too_short",
        "look at https://example.org now": "link",
        "write to someone@example.org please": "link",
        "so goooood to hear": "repeated",
        "so goood to hear it": None,
        "12345 67890 !?": "no_letters",
        "my password is here": "blacklist",
        "passwords are plural here": None,
        "这首歌很好听请加微信联系我": "blacklist",
    }
    assert failures(spark, list(texts)) == list(texts.values())


def test_five_line_breaks_are_no_repetition(spark):
    assert failures(spark, ["one line\n\n\n\n\n\nanother line"]) == [None]


def test_blacklist_table_equals_list(spark):
    texts = ["token here", "nothing here", "Password!", "tokens", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    terms = spark.createDataFrame([("token",), ("password",)], "word string")
    by_table = sorted(r.doc_id for r in clean.drop_listed(frame, terms).collect())
    by_list = sorted(
        r.doc_id for r in frame.filter(~clean.has_term(F.col("text"), ["token", "password"])).collect()
    )
    assert by_table == by_list == [1, 3, 4]


def test_blacklist_table_equals_list_for_ideographs(spark):
    texts = ["这首歌很好听请加微信联系我", "加微", "微信 加", "可以刷单x", "X加微信", "token加", "加V信", "好听", "", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    listed = ["加微信", "刷单", "加V信", "Token", "casino"]
    terms = spark.createDataFrame([(t,) for t in [*listed, None, "刷单"]], "word string")
    by_table = sorted(r.doc_id for r in clean.drop_listed(frame, terms).collect())
    by_list = sorted(r.doc_id for r in frame.filter(~clean.has_term(F.col("text"), listed)).collect())
    assert by_table == by_list == [1, 2, 5, 7, 8, 9]


def test_blacklist_table_is_linear_in_the_text(spark):
    terms = spark.createDataFrame([("加微信",), ("刷单",)], "word string")

    def seconds(n):
        frame = spark.createDataFrame([(1, "".join(chr(0x4E00 + (7 * i) % 9000) for i in range(n)) + "刷单")], "doc_id long, text string")
        start = time.perf_counter()
        assert clean.drop_listed(frame, terms).count() == 0
        return time.perf_counter() - start

    seconds(100)
    assert seconds(80_000) < 3 * seconds(40_000) + 2


def test_short_comments_survive(spark):
    assert failures(spark, ["好听", "太棒了吧", "nice!", "x"]) == [None, None, None, "too_short"]
    rules = clean.spam_rules(F.lit("nice!"), minimum_length=10)
    assert spark.range(1).select(rules["too_short"]).first()[0]


def test_exact_copies_ignore_case_and_spaces(spark):
    texts = ["One two", "one  two ", "ONE\nTWO", "one two three", ""]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    groups = sorted((r.doc_id, r.copies) for r in clean.exact_groups(clean.digests(frame)).collect())
    assert groups == [(0, 3), (3, 1), (4, 1)]
    assert sorted(r.doc_id for r in clean.later_copies(frame).collect()) == [1, 2]
    assert sorted(r.doc_id for r in clean.keep_first(frame).collect()) == [0, 3, 4]


def test_segments_cut_ideographs_into_pairs(spark):
    frame = spark.createDataFrame([("Good 好听的歌 4U", ), ("plain words", ), ("好", )], "t string")
    got = [r.s for r in frame.select(segments(F.col("t")).alias("s")).collect()]
    assert got == [["good", "好听", "听的", "的歌", "4u"], ["plain", "words"], ["好"]]


def signed(spark, values):
    return spark.createDataFrame([(v,) for v in values], "signature long")


def brute_pairs(values):
    unique = sorted(set(values))
    return sorted(
        (a, b)
        for i, a in enumerate(unique)
        for b in unique[i + 1 :]
        if (a ^ b).bit_count() <= nearcopies.DISTANCE
    )


def near_signatures(seed, n=400):
    """Random signatures with neighbours at one to five bits, and a crowd that shares 40 bits."""
    rng = random.Random(seed)
    values = []
    for _ in range(n // 8):
        base = rng.getrandbits(60)
        values.append(base)
        for bits in (1, 2, 3, 4, 5):
            flipped = base
            for p in rng.sample(range(60), bits):
                flipped ^= 1 << p
            values.append(flipped)
    prefix = rng.getrandbits(40) << 20
    values += [prefix | rng.getrandbits(20) for _ in range(n // 4)]
    values += [0, 1, 3, 7, (1 << 60) - 1, (1 << 60) - 2]
    return sorted(set(values))


def test_close_pairs_equal_brute_force(spark):
    values = near_signatures(1)
    got = sorted(map(tuple, nearcopies.close_pairs(signed(spark, values)).collect()))
    assert got == brute_pairs(values)


def test_crowded_buckets_lose_nothing(spark):
    values = near_signatures(2)
    got = sorted(map(tuple, nearcopies.close_pairs(signed(spark, values), crowded=2).collect()))
    assert got == brute_pairs(values)


def test_signature_is_the_majority_vote(spark):
    import hashlib

    text = "one two two three Three three"
    frame = spark.createDataFrame([(1, text), (2, "?!")], "doc_id long, text string")
    got = {r.doc_id: r.signature for r in nearcopies.signatures(frame).collect()}
    hashes = [int(hashlib.md5(w.encode()).hexdigest()[:15], 16) for w in text.lower().split()]
    want = sum(1 << i for i in range(60) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
    assert got == {1: want}


def test_votes_of_a_batch_stay_with_their_text(spark):
    lists = [["a", "b", "a"], [], None, ["b"], ["c"] * 5000 + ["a"]]
    got = nearcopies.majority(pa.array(lists, pa.list_(pa.string()))).to_pylist()
    alone = [nearcopies.majority(pa.array([w], pa.list_(pa.string())))[0].as_py() for w in lists]
    assert got == alone and got[1] is got[2] is None
    assert [got[0], got[3], got[4]] == [nearcopies.word_hash(w) for w in "abc"]


def test_pairs_do_not_go_back_to_the_texts(spark, tmp_path):
    texts = [" ".join(f"word{i}" for i in range(200)) + f" {end}" for end in ("x", "y", "z")]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    pairs = REGISTRY["dedup_simhash_pairs"](spark, str(tmp_path))
    assert pairs.inputFiles() == []
    values = [r.signature for r in nearcopies.signatures(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()]
    assert sorted((r.low, r.high) for r in pairs.collect()) == brute_pairs(values)


def test_near_groups_keep_the_earliest(spark):
    base = " ".join(f"word{i}" for i in range(300))
    texts = [base, "something else entirely here", base + " extra", base.upper(), "other " + base]
    frame = spark.createDataFrame([(i + 10, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.keep_id for r in nearcopies.near_groups(nearcopies.signatures(frame)).collect()}
    assert got[11] == 11
    assert got[10] == got[13] == 10
    signatures = {r.doc_id: r.signature for r in nearcopies.signatures(frame).collect()}
    for doc in (12, 14):
        close = (signatures[doc] ^ signatures[10]).bit_count() <= 3
        assert (got[doc] == 10) == close


def test_near_groups_of_the_report_come_from_the_profile(spark):
    base = " ".join(f"word{i}" for i in range(300))
    texts = [base, base + " https://x.org", "", base.upper(), base, "12", None, "another comment"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    profile = survivors.text_profile(frame)
    assert profile.columns == ["doc_id", "failed", "digest", "signature"]
    first = survivors.first_copies(profile)
    groups = {r.doc_id: r.keep_id for r in survivors.near_groups_of(profile, first).collect()}
    assert groups == {0: 0, 7: 7}
    assert sorted(r.doc_id for r in survivors.kept_documents(frame).collect()) == [0, 7]


def test_components_of_chain_star_and_ring(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(200, i) for i in range(201, 260)]
    ring = [(300 + i, 300 + (i + 1) % 9) for i in range(9)]
    edges = spark.createDataFrame(chain + star + ring, "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert {got[n] for n in range(100, 141)} == {100}
    assert {got[n] for n in range(200, 260)} == {200}
    assert {got[n] for n in range(300, 309)} == {300}


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges_are_found_once(spark, monkeypatch):
    """Components turn each edge in its row, so what finds the edges runs once."""
    cut = []
    monkeypatch.setattr(components_module, "cut_lineage", lambda df: cut.append(df) or df.localCheckpoint())
    edges = spark.createDataFrame([(1, 2), (3, 2), (7, 8)], "a long, b long").groupBy("a", "b").count()
    found = {r.node: r.root for r in components_module.components(edges).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7}
    assert cut[0]._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1 and cut[0].count() == 6


def test_rules_are_those_of_the_tidied_text(spark):
    texts = [None, "", " \n\t", "a", " a ", "a b", "\u00a0", "\u00a0b", "的", "好听", "x@y.de", "see a.b+c@d-e.org now", "@y.de", "a @y.de", "a@ y.de", "a@b", "a@b.c"]
    texts += ["WWW.x", "wwwx", "http:/x", "HTTPS://x", "http ://", "aaaaa", "a aaaa", "!!!!!", "12 34", "my Token, here", "tokens", "a to\u212aen", "PASSWORD", "pass word", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for least in (1, 2, 4):
        whole = F.coalesce("text", F.lit(""))
        body = F.trim(F.regexp_replace(whole, clean.SPACES, " "))
        link = "(?i)(https?://|www\\.|[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,})"
        plain = {"empty": body == "", "too_short": F.char_length(body) < least, "link": body.rlike(link), "repeated": whole.rlike("(.)\\1{4,}"), "no_letters": ~body.rlike("\\p{L}")}
        made = clean.spam_rules(F.col("text"), least)
        assert list(made) == list(plain)
        for name in plain:
            assert frame.filter(made[name] != plain[name]).collect() == [], (least, name)
    spaced = F.array(*[F.lit(t) for t in clean.BLACKLIST if t.isascii()])
    expected = F.coalesce(F.arrays_overlap(words(F.col("text")), spaced), F.lit(False))
    assert frame.filter(clean.has_term(F.col("text"), clean.BLACKLIST) != expected).collect() == []
    assert frame.filter(expected).count() == 3


def test_words_before_an_address_are_not_searched_from_each_letter(spark):
    frame = spark.createDataFrame([("a" * 9 + "b" * 200_000 + " x@y",), ("ab" * 100_000 + "@z.de",)], "text string").coalesce(1)
    start = time.perf_counter()
    assert [r[0] for r in frame.select(clean.spam_rules(F.col("text"))["link"]).collect()] == [False, True]
    assert time.perf_counter() - start < 30
