"""BPE and token files against the tokenizers library, round trips and edge cases."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from refrain.llm import encoding, token_files
from refrain.llm.bpe import Decoder, MergeTable, StreamEncoder, TextEncoder, Transducer, _tables, word_starts

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PARTS = ["a", "b", "'s", "'re", "'ll", "'", "  ", " ", "\n", "\t", "é", "日本", "1", "²", "!", "-", "<|endoftext|>", "　", "the", "\U0001f600", "'ve ", "ſ", "\x85", "\x1c"]
EDGES = ["", " ", "a" * 3000, "ab" * 5000, " " * 700 + "x", "\n" * 9000, "=" * 12345, "the" * 2000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y"]


@pytest.fixture(scope="module")
def table():
    return MergeTable(encoding.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(encoding.TOKENIZER)


def random_texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(n)]


def expected(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_character_classes_are_the_librarys(library):
    cut = library.pre_tokenizer.pre_tokenize_str
    _tables(0)
    for point in [*range(0x3000), *range(0x3000, 0x110000, 97)]:
        if not 0xD800 <= point < 0xE000:
            c = chr(point)
            text = f"x{c}1{c}!{c}"
            assert len(cut(text)) == len(word_starts(np.array([ord(x) for x in text], np.uint32), np.array([0]))), hex(point)


@pytest.mark.parametrize("make", [TextEncoder, lambda t: token_files._library_encoder(encoding.TOKENIZER)])
def test_blocks_equal_the_library(table, library, make):
    texts = random_texts(600) + EDGES
    assert [x.tolist() for x in make(table).encode(texts)] == expected(library, texts)


def test_streams_equal_the_library_at_any_cut(table, library):
    rng = random.Random(7)
    for text in [t for t in random_texts(150, 9) + EDGES if "<|" not in t]:
        stream, out, at = StreamEncoder(table, window=rng.choice([8, 64, 4096])), [], 0
        while at < len(text):
            step = rng.choice([1, 3, 50, 5000])
            out += stream.push(text[at : at + step])
            at += step
        assert out + stream.finish() == expected(library, [text])[0]


def test_transducer_emits_early_and_stays_small(table):
    machine, most, emitted = Transducer(table), 0, 0
    for _ in range(2000):
        emitted += len(machine.push(b"thereinaton"))
        most = max(most, len(machine.pending))
    assert emitted > 0 and most <= 2 * table.lookahead + 64 + 11
    assert b"".join(table.bytes[i] for i in machine.finish()).endswith(b"aton")


def test_decoder_waits_for_split_characters(table, library):
    ids = expected(library, ["日本\U0001f600é"])[0]
    machine = Decoder(table)
    assert "".join([machine.push([i]) for i in ids] + [machine.finish()]) == "日本\U0001f600é"
    broken = Decoder(table)
    assert broken.push(ids[:1]) + broken.finish() == library.decode(ids[:1], skip_special_tokens=False)


def test_columns_with_nulls_ties_and_clashing_names(spark, library):
    rows = [(1, None, 7), (2, "", 8), (3, "same text", 9), (3, "same text", 9), (None, "x" * 70, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = encoding.round_trip(df).collect()
    assert [r["ids"] for r in out] == expected(library, [r[1] or "" for r in rows])
    assert [r["decoded"] for r in out] == [r[1] or "" for r in rows]
    assert encoding.round_trip(df.limit(0)).count() == 0
    coded = encoding.encode(df.drop("ids"))
    assert [r["text"] for r in encoding.decode(coded, out="text").collect()] == [r[1] or "" for r in rows]


def test_token_files(spark, library, tmp_path):
    rows = [(5, None), (2, "two words"), (2, "other"), (None, "x"), (9, ""), (7, "last one " * 50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, files=3)
    starts = {(r["doc_id"], r["start"]): r["n_tokens"] for r in token_files.token_starts(token_files.read_files(spark, path)).collect()}
    lengths = [len(x) + 1 for x in expected(library, [t or "" for _, t in rows])]
    assert sum(starts.values()) == sum(lengths)
    ordered = sorted(starts, key=lambda k: k[1])
    assert [k[0] for k in ordered] == [None, 2, 2, 5, 7, 9]
    assert [k[1] for k in ordered] == np.cumsum([0, *[starts[k] for k in ordered][:-1]]).tolist()
    one = token_files.read_documents(spark, path, [7]).select("ids", token_files.ids_crc32(F.col("ids")).alias("c")).collect()
    ids = [*expected(library, ["last one " * 50])[0], 2]
    assert one[0]["ids"] == ids and one[0]["c"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    empty = str(tmp_path / "none")
    token_files.write_tokens(docs.limit(0), empty, files=2)
    assert token_files.token_starts(token_files.read_files(spark, empty)).count() == 0


def test_files_carry_indexes_and_encodings(spark, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "tokens"
    token_files.write_tokens(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text")), str(path), files=1)
    chunk = pq.ParquetFile(next(path.glob("*.parquet"))).metadata.row_group(0)
    columns = {chunk.column(i).path_in_schema: chunk.column(i) for i in range(chunk.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_offset_index
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
