"""Registered queries over whole tables, and the stages of the pipeline."""

import hashlib
import zlib
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from martflow.llm import pii
from martflow.llm.queries import QUERIES, SQL
from tests.llm.test_duplicates import roots, sets_of
from tests.llm.test_models import plain_spans

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_all_are_registered():
    assert {"pipeline", *QUERIES} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, connection, name):
    df = QUERIES[name](spark, SMALL)
    cursor = connection.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in df.collect()))) == sorted(map(str, cursor.fetchall()))


def test_personal_data_of_all_documents(spark, connection):
    texts = dict(connection.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    found = QUERIES["op3_crf_pii"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        base = plain_spans(texts[r["doc_id"]])
        for kind in pii.KINDS:
            assert r[f"n_{kind}"] == sum(s[2] == kind for s in base)
        listed = [f"{kind}:{start}:{end}" for start, end, kind in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(",")) | {""}


def test_stages_keep_what_they_should(spark, connection, path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = dict(connection.execute("SELECT doc_id, text FROM documents").fetchall())
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SMALL).write.parquet(path(name))
        kept.append(spark.read.parquet(path(name)))
    ids = [sorted(r["doc_id"] for r in frame.select("doc_id").collect()) for frame in kept[:-1]]
    assert ids[1] == sorted(k for k, text in texts.items() if any(map(str.isalpha, text or "")))
    latest = {}
    for key in ids[1]:
        latest[texts[key]] = max(key, latest.get(texts[key], key))
    assert ids[2] == sorted(latest.values())
    assert set(ids[3]) <= set(ids[2]) and ids[4] == ids[3]
    assert all(frame.columns == docs.columns for frame in kept[1:-1])
    for r in kept[4].collect():
        assert not plain_spans(r["text"]) and r["n_chars"] == len(r["text"])
    pieces = kept[5].collect()
    assert {r["doc_id"] for r in pieces} == set(ids[4]) and all(1 <= r["length"] <= 1024 for r in pieces)


def test_near_dedup_and_packing_stages_equal_brute_force(spark):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = sets_of(rows)
    linked = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    top = roots(sets, linked)
    kept = stages["near_dedup"](spark, docs, SMALL).collect()
    assert linked and sorted(r["doc_id"] for r in kept) == sorted(k for k in sets if top[k] == k)
    texts = dict(rows)
    assert all(r["text"] == texts[r["doc_id"]] for r in kept)

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    expected = {}
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for piece, end in enumerate(range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)):
            start = max(0, end - 1024)
            expected[key, piece] = (end - start, zlib.crc32(ids[start:end].tobytes()))
    packed = stages["packing"](spark, docs, SMALL).collect()
    assert {(r["doc_id"], r["piece"]): (r["length"], r["ids_crc32"]) for r in packed} == expected
    assert len(packed) == len(expected)
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        ends = [0, *(offset + length for offset, length in sorted(spans))]
        assert [offset for offset, _ in sorted(spans)] == ends[:-1] and ends[-1] <= 1024
