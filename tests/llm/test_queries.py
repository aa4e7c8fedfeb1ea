"""The registered queries and the pipeline on the given tables, against plain Python."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from refrain.llm import encoding, quality, secrets
from tests.llm import test_jaccard, test_rules, test_texts

SF_DIR = os.environ.get("REFRAIN_SF_DIR", "/root/testdata/sf0.001")
os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text, lang, source from '{SF_DIR}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(encoding.TOKENIZER)


def rows_of(spark, name):
    rows = entry.queries()[name](spark, SF_DIR).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_all_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_op1(spark, docs, library):
    out = rows_of(spark, "op1_bpe")
    for doc_id, text, *_ in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
        assert tuple(out[doc_id][c] for c in ("n_tokens", "ids_sha256", "decoded_sha256")) == want


def test_op2(spark, docs):
    out = rows_of(spark, "op2_jaccard")
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.values()) == test_jaccard.brute([d[:2] for d in docs])


def test_op3(spark, docs):
    out = rows_of(spark, "op3_mix")
    sizes, total = {}, {}
    for doc_id, text, _, source in docs:
        sizes[doc_id] = len((text or "").encode().split())
        total[source] = total.get(source, 0) + sizes[doc_id]
    want, taken = test_rules.plain_targets(total), dict.fromkeys(total, 0)
    for doc_id, _, _, source in docs:
        r = out[doc_id]
        assert (r["size"], r["source_size"]) == (sizes[doc_id], total[source]) and r["target"] == pytest.approx(want[source])
        assert r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    longest = max(sizes.values())
    assert all(abs(taken[s] - want[s]) <= longest for s in total)


def test_op4(spark, docs):
    out = rows_of(spark, "op4_imatch")
    marks = {}
    for (doc_id, text, *_), (_, following, *_) in zip(docs, docs[1:] + docs[:1], strict=True):
        half = len(text) // 2
        r = out[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(text[: len(text) - half] + following[:half]))
        assert marks.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    mean = lambda c: np.mean([r[c] for r in out.values()])
    assert mean("near_edited") > 0.2 > 0.1 > mean("near_next")


def test_op5(spark, docs):
    out = rows_of(spark, "op5_language")
    held = [(d, lang) for d, _, lang, _ in docs if zlib.crc32(str(d).encode()) % 4 == 2]
    assert {d for d, r in out.items() if r["held_out"]} == {d for d, _ in held}
    assert np.mean([out[d]["lang_pred"] == lang for d, lang in held]) >= 0.97


def test_op6(spark):
    out = rows_of(spark, "op6_url_filter")
    for page_id, url in duckdb.sql(f"select page_id, url from '{SF_DIR}/pages.parquet'").fetchall():
        host, path, rule, action = test_rules.plain_url(url)
        r = out[page_id]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (r["verdict"] == action if action else r["verdict"] in ("allow", "block"))


def test_op7(spark, docs, library):
    out, start = rows_of(spark, "op7_token_files"), 0
    for doc_id, text, *_ in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert tuple(out[doc_id][c] for c in ("start", "n_tokens", "ids_crc32")) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op8(spark, docs):
    out = rows_of(spark, "op8_secrets")
    for doc_id, text, *_ in docs:
        found = test_texts.plain_secrets(text or "")
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in found)
        r = out[doc_id]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in found) for i in range(3)] and r["base_sha256"] == sha(joined)
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_op9(spark, docs):
    import re

    out = rows_of(spark, "op9_pii")
    for doc_id, text, *_ in docs:
        found = [(k, m.start(), m.end()) for k, (p, fits) in test_texts.PLAIN.items() for m in re.finditer(p, text or "") if fits(m[0])]
        r, joined = out[doc_id], ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        assert [r[f"n_{k}"] for k in test_texts.PLAIN] == [sum(x[0] == k for x in found) for k in test_texts.PLAIN]
        assert r["base_sha256"] == sha(joined) and r["spans"].startswith(joined)


def plain_mix(docs):
    """(doc_id, text) as often as systematic sampling takes it, in whole numbers."""
    size = {d: len(t.encode().split()) for d, t, _ in docs}
    by_source = {}
    for d, t, s in docs:
        by_source.setdefault(s, []).append(d)
    targets = test_rules.plain_targets({s: sum(size[d] for d in ids) for s, ids in by_source.items()})
    copies = {}
    for s, ids in by_source.items():
        whole = sum(size[d] for d in ids)
        rate = targets[s] / whole
        offset = int(hashlib.md5(f"mix:{s or ''}".encode()).hexdigest()[:7], 16) / 2**28
        for k, d in enumerate(sorted(ids, key=lambda d: (size[d], d)), 1):
            copies[d] = int(rate * k + offset + 1e-9) - int(rate * (k - 1) + offset + 1e-9)
    return copies


def test_pipeline(spark, docs, library):
    """Rejected documents, later members of groups, masks, copies and ids, each by plain Python."""
    def kept(text):
        words, chars, symbols, dup, repeated = test_rules.plain_measures(text)
        lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        stop = sum(w.lower() in quality.STOP_WORDS for w in text.encode().decode().split())
        end = sum(x.rstrip(" \t\n\r\x0b\x0c").endswith(("...", "…")) for x in lines)
        if words < 50 or 100 * repeated > 50 * words:
            return False
        return 2 <= chars / words <= 20 and symbols / words <= 0.3 and stop / words >= 0.01 and dup / len(lines) <= 0.5 and end / len(lines) <= 0.5

    good = [(d, t, s) for d, t, _, s in docs if t and kept(t)]
    firsts = {d for d, _, c in test_jaccard.brute([x[:2] for x in good]) if d == c}
    scanner, masked = secrets.Scanner(), []
    for d, text, s in good:
        if d in firsts:
            at, out = 0, ""
            for start, _, end in scanner.spans(text):
                if start >= at:
                    out += text[at:start] + "[SECRET]"
                at = max(at, end)
            masked.append((d, out + text[at:], s))
    copies = plain_mix(masked)
    want = sorted((d, sha(t), tuple(library.encode(t, add_special_tokens=False).ids)) for d, t, _ in masked for _ in range(copies[d]))
    got = sorted((r["doc_id"], r["decoded_sha256"], tuple(r["ids"])) for r in entry.queries()["pipeline"](spark, SF_DIR).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want] and got == want
