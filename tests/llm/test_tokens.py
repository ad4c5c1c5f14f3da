"""Encoding and packing against the tokenizers library, and shards against their law."""

import hashlib
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martflow.llm import bpe, packing, shards
from martflow.llm.queries import QUERIES
from martflow.llm.tokens import ByteLevelEncoder

ODD = [
    "", " ", "  a  b\n\n c \n", "Σίσυφος ΟΔΟΣ İx", "<|endoftext|> hi<|startoftext|>there <|x|>", "a\x1cb \x1d c",
    "don't we'll I'M ’s 12½ Ⅷ ² é ́x 漢字 😀👍🏽", "x" * 3000, "ab cd  ef", "\x85q", " lead", "trail ", "a \n b",
]
TEXTS = st.text(st.sampled_from("ab cd\n\t '’sté́Σ12½<|>漢😀.,!\x1f "), max_size=40)


@pytest.fixture(scope="module")
def word():
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.WordEncoder(path), Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def byte():
    path = public_tokenizers.path("byte_bpe_50k.json")
    return ByteLevelEncoder(path), Tokenizer.from_file(path)


def check_word(pair, text):
    own, library = pair
    ids = library.encode(text, add_special_tokens=False).ids
    found, decoded = own.encode(text)
    assert np.frombuffer(found, "<u4").tolist() == ids
    assert decoded == own.decode(found) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(word, byte, text):
    check_word(word, text)
    assert np.frombuffer(byte[0].encode(text), "<u4").tolist() == byte[1].encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_any_text(word, byte, text):
    check_word(word, text)
    assert np.frombuffer(byte[0].encode(text), "<u4").tolist() == byte[1].encode(text, add_special_tokens=False).ids


LONG = ["x" * 200_000, "ab" * 100_000, "thequickbrownfox" * 12_500, "é" * 100_000, "the" * 40 + "Q" * 200 + "ing" * 500]


@pytest.mark.parametrize("text", LONG, ids=range(len(LONG)))
def test_long_words(word, text):
    began = time.time()
    word[0].encode(text)
    assert time.time() - began < 5
    check_word(word, text)


@settings(max_examples=200, deadline=None)
@given(st.text("abeinrst", min_size=1, max_size=80))
def test_both_ways_to_merge_agree(word, text):
    own = word[0]
    symbols = list(text)
    symbols[-1] += bpe.WORD_END
    assert own._merge((text, True)) == own._merge_long(symbols)


def test_the_query_equals_the_library_on_the_whole_table(spark, word):
    small = "/root/testdata/sf0.001"
    documents = dict(duckdb.sql(f"select doc_id, text from '{small}/documents.parquet'").fetchall())
    found = QUERIES["op10_forced_boundary_bpe"](spark, small).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(documents)
    for r in found:
        ids = word[1].encode(documents[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = word[1].decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_no_token_holds_a_forced_boundary(word):
    own = word[0]
    for token in list(own.ids)[:2000]:
        plain = token.removesuffix(bpe.WORD_END)
        assert token in own.special or all(plain[k : k + 2] in own.joinable for k in range(len(plain) - 1))
    assert len(own.joinable) < 256 * 256


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=120), st.integers(1, 40))
def test_plans_place_every_piece_once(lengths, times):
    counts = np.bincount(lengths * times, minlength=33) if lengths else np.zeros(33, int)
    steps = packing.plan(counts, 32)
    placed = np.zeros(33, int)
    for pattern, repeats in steps:
        assert sum(pattern) <= 32
        np.add.at(placed, list(pattern), repeats)
    assert (placed == counts).all()
    covered = {length: 0 for length in range(33)}
    for length, first, end, *_ in packing.places(steps, counts):
        covered[length] += end - first
    assert all(covered[k] == counts[k] for k in range(33))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=150), st.integers(1, 40))
def test_no_plan_is_worse_than_best_fit(lengths, times):
    counts = np.bincount(lengths * times, minlength=65) if lengths else np.zeros(65, int)
    taken = sum(n for _, n in packing.plan(counts, 64))
    assert taken <= sum(n for _, n in packing.best_fit(counts, 64))
    assert taken >= -(-int(counts @ np.arange(65)) // 64)


@pytest.mark.parametrize("scale, most", [("sf0.001", 193), ("sf0.01", 967), ("sf0.1", 9876)])
def test_given_tables_take_few_sequences(spark, byte, scale, most):
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet").withColumn("length", F.lit("x"))
    counts = np.zeros(packing.CAPACITY + 1, int)
    for row in packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")).groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    taken = sum(n for _, n in packing.plan(counts))
    assert taken <= min(most, sum(n for _, n in packing.best_fit(counts, packing.CAPACITY)))


def test_documents_are_packed(spark, byte):
    texts = ["", None, "one two three", "word " * 5000, "x", "x", " ".join(f"n{k}" for k in range(700))]
    rows = [(k, t, 0, "s") for k, t in enumerate(texts)] + [(4, "x", 1, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, offset string")
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack(cut, ["doc_id", "piece"])
    found = packed.collect()
    inside = {}
    for r in found:
        inside.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in inside.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    for key, text in enumerate(texts):
        own = sorted((r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in found if r["doc_id"] == key)
        own = own[:: 2 if key == 4 else 1]
        ids = np.array(byte[1].encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert b"".join(p[3] for p in own) == ids
        assert [p[0] for p in own] == list(range(len(own))) and all(p[2] == 1024 for p in own[1:])
    distinct = cut.dropDuplicates(["doc_id", "piece"])
    whole = packing.sequences(distinct, packing.pack(distinct, ["doc_id", "piece"])).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in distinct.collect())


def test_encoded_table(spark, word):
    rows = [(1, None), (2, ""), (3, "Hello World"), (3, "Hello World")]
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), path)
    found = {r["doc_id"]: (bytes(r["ids"]), r["decoded"]) for r in encoded.collect()}
    assert found[1] == found[2] == (b"", "") and found[3] == word[0].encode("Hello World")
    assert {r["decoded"] for r in bpe.decode(encoded, path).collect()} == {"", found[3][1]}


@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 2), (4, 1)])
def test_curve_visits_neighbours(spark, dimensions, bits):
    from pyspark.sql import functions as F

    cells = spark.range(1 << dimensions * bits)
    axes = [f"x{d}" for d in range(dimensions)]
    for d, axis in enumerate(axes):
        cells = cells.withColumn(axis, F.expr(f"cast(shiftright(id, {d * bits}) & {(1 << bits) - 1} as int)"))
    found = cells.withColumn("at", shards.curve_index([F.col(a) for a in axes], bits)).orderBy("at").collect()
    assert [r["at"] for r in found] == list(range(len(found)))
    for one, two in zip(found, found[1:]):
        assert sum(abs(one[a] - two[a]) for a in axes) == 1


def test_shards(spark):
    rows = [(k, f"text {k % 9}" if k % 11 else None, ["en", "de", None][k % 3], f"s{k % 4}", k) for k in range(203)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string, source string, shard int")
    placed = shards.shards(docs, 7)
    found = placed.collect()
    sizes = [sorted(r["slot"] for r in found if r["shard"] == s) for s in range(7)]
    assert sum(map(len, sizes)) == 206 and all(s == list(range(len(s))) for s in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    for r in found:
        text = (rows[r["doc_id"]][1] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 16, zlib.crc32(text), "rows")
    boxes = shards.manifest(placed)
    wanted = {r["shard"] for r in found if rows[r["doc_id"]][2] == "de"}
    assert wanted <= {r["shard"] for r in shards.shards_for(boxes, lang="de").collect()}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack(packing.pieces(empty, path), ["doc_id", "piece"]).count() == 0
    assert shards.shards(empty).count() == 0
    assert bpe.encode(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0
