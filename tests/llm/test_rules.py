"""Quality rules, mixing and URL filters against plain Python, and the pipeline."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from refrain.llm import encoding, mixing, quality, urls
from refrain.session import scratch_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# ---- quality


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_plain_counts(spark):
    rng = random.Random(3)
    pieces = ["the", "a", "b", "é", "\U0001f600", " ", " ", "\n", "\t", "\x0b", "\x1f", "\x85", "　", "#", "|", "...", "\r\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(80))) for _ in range(500)] + [None, "", " \n ", "x " * 4000, "a b c a b c a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {r["doc_id"]: r for r in quality.measures(df).collect()}
    for i, text in enumerate(texts):
        assert tuple(out[i]["__q_" + n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == plain_measures(text), text


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and"]) if i % 5 == 0 else "".join(rng.choice("abcdefgh") for _ in range(6)) for i in range(n))


def test_rules_keep_prose_and_drop_junk(spark):
    rng = random.Random(4)
    good = [prose(rng, 60), prose(rng, 400) + "\n" + prose(rng, 30), "Der Hund und die Katze sind nicht im Haus, " + prose(rng, 80)]
    bad = [None, "", "too short", "buy now " * 100, " ".join(w + "%%%" for w in prose(rng, 90).split()), "\n".join(["the same line of words " + prose(rng, 3)] * 2 + ["x"] * 40), " ".join("".join(rng.choice("xyzw") for _ in range(40)) for _ in range(80))]
    df = spark.createDataFrame(list(enumerate(good + bad)), "doc_id bigint, text string").withColumn("words", F.lit("clash"))
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2]
    judged = {r["doc_id"]: (r["__q_failed"], r["__q_kept"]) for r in quality.judge(df).collect()}
    assert [judged[i][0] for i in range(3, 7)] == [True] * 4 and judged[7] == (False, False)
    assert quality.keep_good(df.limit(0)).count() == 0


CLEAN = {
    "ru": "когда они вернулись домой уже темнело и дети сидели у окна слушая как ветер шумит над старым садом",
    "el": "όταν γύρισαν στο σπίτι είχε ήδη νυχτώσει και τα παιδιά κάθονταν δίπλα στο παράθυρο ακούγοντας τον άνεμο",
    "ko": "그들이 집으로 돌아왔을 때는 이미 어두워졌고 아이들은 창가에 앉아 오래된 정원 위로 부는 바람 소리를 듣고 있었다",
    "ar": "عندما عادوا إلى البيت كان الظلام قد حل وكان الأطفال يجلسون قرب النافذة يستمعون إلى صوت الريح",
    "hi": "जब वे घर लौटे तब अंधेरा हो चुका था और बच्चे खिड़की के पास बैठे हवा की आवाज़ सुन रहे थे",
    "pl": "kiedy wrócili do domu było już ciemno, a dzieci siedziały przy oknie słuchając, jak wiatr szumi nad ogrodem",
    "tr": "eve döndüklerinde hava kararmıştı ve çocuklar pencerenin yanında oturup bahçede esen rüzgârı dinliyordu",
    "id": "ketika mereka pulang hari sudah gelap dan anak-anak duduk dekat jendela mendengarkan angin yang bertiup",
    "sw": "waliporudi nyumbani giza lilikuwa limeingia na watoto walikaa karibu ya dirisha wakisikiliza upepo wa bustani",
}


def test_clean_documents_of_other_languages_are_kept(spark):
    rng = random.Random(14)
    rows = [(name, " ".join(" ".join(rng.sample(text.split(), len(text.split()))) for _ in range(6))) for name, text in CLEAN.items()]
    junk = [("caps", " ".join("".join(rng.choice("ERTIWHNAOÉ") for _ in range(6)) + "!!" for _ in range(90))), ("list", " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(90)))]
    junk += [("symbols", " ".join(w + "%%%" for w in rows[0][1].split())), ("repeated", "когда они вернулись " * 40)]
    df = spark.createDataFrame(rows + junk, "lang string, text string")
    assert {r["lang"] for r in quality.keep_good(df).collect()} == set(CLEAN)


def test_thresholds_are_a_parameter(spark):
    df = spark.createDataFrame([(1, prose(random.Random(1), 70))], "doc_id bigint, text string")
    assert quality.keep_good(df, rules=()).count() == 1
    assert quality.keep_good(df, rules=(("long", "n_words", 100.0, None),)).count() == 0


# ---- mixing


def plain_targets(sizes):
    """By resharing the excess until none is above, in fractions."""
    from fractions import Fraction

    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, Fraction(0))
    left, free = Fraction(3, 2) * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level >= 2 * sizes[s]}
        if not above:
            target.update({s: weight[s] * level for s in free})
            break
        target.update({s: Fraction(2 * sizes[s]) for s in above})
        left -= sum(2 * sizes[s] for s in above)
        free -= above
    return {s: float(t) for s, t in target.items()}


def test_targets_and_copies(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "é", "Z", None, "empty"]), rng.randrange(1, 300)) for i in range(900)]
    rows = [(i, s, 0 if s == "empty" else n) for i, s, n in rows] + [(None, "a", 5), (7, "b", None), (8, "c", 40), (8, "c", 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    plan = mixing.plan_copies(df).collect()
    again = mixing.plan_copies(df.repartition(7)).collect()
    key = lambda r: (str(r["source"]), r["size"], str(r["doc_id"]), r["copies"])
    assert sorted(map(key, plan)) == sorted(map(key, again)) and len(plan) == len(rows)
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + (n or 0)
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in plan:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-12) and r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - want[s]) <= 600 for s in sizes)


def test_equal_sizes_are_taken_evenly(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("source"), F.lit(10).alias("size"))
    copies = {}
    for r in mixing.plan_copies(df).collect():
        copies[r["source"]] = copies.get(r["source"], 0) + 10 * r["copies"]
    want = plain_targets({"0": 3340, "1": 3330, "2": 3330})
    assert all(abs(copies[s] - want[s]) <= 10 for s in want)


def test_mix_repeats_whole_rows(spark):
    rows = [(i, "w " * (1 + i % 9), "en", ["a", "b", None][i % 3], None) for i in range(90)] + [(5, "same", None, "a", 1)] * 3 + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash"))
    out = mixing.mix(df)
    assert out.columns == df.columns
    sized = df.select("doc_id", "source", F.size(F.expr("filter(split(coalesce(text, ''), ' '), x -> x <> '')")).alias("size"))
    plan = {}
    for r in mixing.plan_copies(sized).collect():
        plan[(r["doc_id"], r["source"], r["size"])] = plan.get((r["doc_id"], r["source"], r["size"]), 0) + r["copies"]
    got = {}
    for r in out.collect():
        k = (r["doc_id"], r["source"], len((r["text"] or "").split()))
        got[k] = got.get(k, 0) + 1
    assert got == {k: n for k, n in plan.items() if n}
    assert mixing.mix(df.limit(0)).count() == 0


# ---- urls

PLAIN_RULES = [("www.example.com", "/en/", "allow"), ("example.com", "/en/", "block"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("com", "/", "allow")]


def plain_url(url):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    for domain, start, action in PLAIN_RULES:
        if (host == domain or host.endswith("." + domain)) and path.startswith(start):
            return host, path, domain + start, action
    return host, path, None, None


def test_hosts_paths_and_rules(spark):
    given = [
        None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://A.COM/x?y", "https://www.example.com/en/1", "https://WWW.Example.com/EN/1", "http://example.com/en/", "http://xexample.com/en/5",
        "http://a.b.example.com/en/#x", "http://net/es/9", "http://m.net/fr", "http://m.net/fr/", "http://É.org/é?q", "http://a?b/c", "ftp://a/b://c/d", "http://u@h.com:80/p#q", "http://adserver.example.org/en/4", "http://library.example.org/en/4", "x" * 5000, "http://" + "a." * 3000 + "net/es/",
    ]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id bigint, url string").withColumn("host", F.lit("clash"))
    model = urls.UrlModel.fit(spark.createDataFrame(urls.labelled_urls(), "url string, blocked int"))
    out = {r["page_id"]: r for r in urls.judge_urls(pages, model).collect()}
    for i, url in enumerate(given):
        host, path, rule, action = plain_url(url)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"]) == (host, path, rule), url
        assert out[i]["verdict"] == action if action else out[i]["verdict"] in ("allow", "block")
    assert out[19]["verdict"] == "block" and out[20]["verdict"] == "allow"
    assert urls.judge_urls(pages.limit(0), model).count() == 0


def test_unseen_names_are_judged_by_their_grams(spark):
    rows = spark.createDataFrame(urls.labelled_urls(), "url string, blocked int")
    half = [r for i, r in enumerate(urls.labelled_urls()) if i % 2]
    model = urls.UrlModel.fit(spark.createDataFrame(half, "url string, blocked int"))
    judged = urls.judge_urls(rows, model, rules=()).select("blocked", (F.col("verdict") == "block").cast("int").alias("v")).collect()
    assert sum(r["blocked"] == r["v"] for r in judged) > 0.97 * len(judged)
    one = urls.UrlModel.fit(rows.filter("blocked = 1"))
    assert urls.judge_urls(rows.limit(3), one, rules=()).filter("verdict = 'allow'").count() == 0


def test_paths_alone_decide_and_long_paths_do_not_drown_them(spark):
    model = urls.UrlModel.fit(spark.createDataFrame(urls.labelled_urls(), "url string, blocked int"))
    rng = random.Random(16)
    filler = lambda n: "/".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(6)) for _ in range(n))
    hosts = ("http://mill.org", "https://www.riverside.org", "http://a.place.example.org")
    bad = [f"{h}/{p}" for h in hosts for p in ("casino-bonus/", "en/cheap-pills/12", "poker-bets.html", "x/adult-video/7")]
    bad += [f"{h}/{'history/garden/' * 30}casino-bonus/{'travel/weather/' * 30}" for h in hosts]
    good = [f"{h}/{p}" for h in hosts for p in ("", "en/12", "recipes/4", "de/history/garden/", filler(60), filler(400))]
    rows = spark.createDataFrame([(u, 1) for u in bad] + [(u, 0) for u in good], "url string, blocked int")
    judged = urls.judge_urls(rows, model, rules=()).select("url", "blocked", "block_probability").collect()
    assert not [(r["url"][:60], r["block_probability"]) for r in judged if (r["block_probability"] > 0.5) != r["blocked"]]


# ---- pipeline


def test_pipeline_stages(spark):
    rng = random.Random(9)
    base = [prose(rng, 90) for _ in range(30)]
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, t + " more words", "en", None, None) for i, t in enumerate(base[:10])]  # near copies
    rows += [(200, "junk", "en", "a", 4), (201, None, None, None, None), (202, "", "", "", 0)]
    rows += [(300, prose(rng, 80) + " password=abcdef0123456789ab", "en", "b", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append((name, docs))
    ids = [sorted({r["doc_id"] for r in d.select("doc_id").collect()}) for _, d in seen]
    assert ids[0] == [*range(30), *range(100, 110), 300] and ids[1] == [*range(30), 300] == ids[2]
    assert all(d.columns == ["doc_id", "text", "lang", "source", "n_chars"] for _, d in seen[:4])
    masked = seen[2][1].filter("doc_id = 300").first()
    assert masked["text"].endswith(" [SECRET]") and masked["n_chars"] == len(masked["text"])
    assert ids[3] == ids[4] and set(ids[3]) <= set(ids[2]) and seen[3][1].count() == seen[4][1].count()
    texts = {(r["doc_id"], r["text"]) for r in seen[3][1].collect()}
    assert {(r["doc_id"], r["text"]) for r in encoding.decode(seen[4][1].select("doc_id", "ids")).collect()} == texts


def test_pipeline_on_no_documents(spark):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0, name
