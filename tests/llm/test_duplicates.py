"""Exact and near duplicates, and the components beneath, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martflow.llm import exact, near
from martflow.llm.components import components
from martflow.llm.near import Shingler

SCHEMA = "doc_id long, text string, key string, n string, sha int, row int, component string"


def words(seed, count):
    pick = random.Random(seed)
    return [f"w{pick.randrange(5000)}" for _ in range(count)]


def edited(base, places, tag):
    out = list(base)
    for k in places:
        out[k] = f"{tag}{k}"
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    base, other = words(1, 300), words(2, 60)
    texts = {
        1: " ".join(base), 2: " ".join(base).upper(), 3: "  \t".join(base), 4: edited(base, [50], "x"),
        5: edited(base, [50, 120], "x"), 6: edited(base, range(0, 300, 9), "y"), 7: " ".join(base[:240]),
        8: None, 9: "", 10: " \n ", 11: "a b", 12: "A  b", 13: "a b c", 14: "É b c d e", 15: "é b c d e",
        16: " ".join(other), 17: " ".join(other[:52]), 18: " ".join(other[:40]), 19: "a b c d e f", 20: "",
        21: " ".join(words(3, 20_000)), 22: " ".join(words(3, 20_000)) + " end",
    }
    for k in range(30, 60):
        texts[k] = edited(base, [3 * k, (7 * k) % 300], f"v{k % 4}")
    listed = list(texts.items())
    return listed + [listed[0], listed[8]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(k, t, "k", "n", 1, 2, "c") for k, t in rows], SCHEMA)


def sets_of(rows):
    out = {}
    for key, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        if len(found) < 5:
            out[key] = {tuple(found)} if found else set()
        else:
            out[key] = {tuple(found[i : i + 5]) for i in range(len(found) - 4)}
    return out


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    return {n: top(n) for n in nodes}


def test_exact_duplicates(docs, rows):
    found = exact.exact_duplicates(docs).collect()
    groups = {}
    for key, text in rows:
        groups.setdefault(text or "", []).append(key)
    assert len(found) == len(rows)
    for r in found:
        own = next(g for g in groups.values() if r["key"] in g)
        text = dict(rows)[r["key"]] or ""
        assert (r["keep_key"], r["group_size"]) == (max(own), len(own))
        assert bytes(r["sha"]) == hashlib.sha256(text.encode()).digest()
        assert not r["kept"] or r["key"] == r["keep_key"]
    assert sum(r["kept"] for r in found) == len(groups)


def test_any_key_goes_before_a_missing_one(spark):
    df = spark.createDataFrame([(None, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    kept = {(r["key"], r["keep_key"]) for r in exact.exact_duplicates(df).where("kept").collect()}
    assert kept == {(1, 1), (None, None)}


def test_rows_that_stay_have_all_columns(docs, rows):
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({text or "" for _, text in rows})


def test_merge_tree_of_many_ranks(spark):
    df = spark.range(0, 3000, 1, 32).selectExpr("id as doc_id", "cast(id % 7 * (id % 3) as string) as text")
    found = exact.exact_duplicates(df, fan_in=2).where("kept").collect()
    assert {r["key"] for r in found} == {r["keep_key"] for r in found} and len(found) == 10


def test_near_duplicates_equal_brute_force(docs, rows):
    sets = sets_of(rows)
    linked = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    expected = roots(sets, linked)
    found = near.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        key = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[key]), expected[key], expected[key] == key)


def test_estimate_is_near_the_similarity():
    shingler, pick = Shingler(), random.Random(4)
    base = shingler.shingles(" ".join(words(5, 400)))
    for share in (0.95, 0.8, 0.6):
        other = shingler.shingles(" ".join(words(5, int(400 * share)) + [f"z{pick.random()}" for _ in range(20)]))
        common = len(set(base.tolist()) & set(other.tolist()))
        true = common / (len(base) + len(other) - common)
        one, two = (np.frombuffer(shingler.long_sketch(s), np.uint64) for s in (base, other))
        assert abs(near._estimates(one[None, :], two)[0] - true) < 0.07


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    edges = [e for e in edges if e[0] != e[1]]
    expected = roots({n for e in edges for n in e}, edges)
    assert {r["node"]: r["component"] for r in found} == expected


def test_a_long_path_is_one_component(spark):
    path = spark.range(300).selectExpr("(id * 77) % 301 as a", "((id + 1) * 77) % 301 as b")
    assert {r["component"] for r in components(path).collect()} == {0}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_duplicates(empty).count() == 0
    assert exact.drop_exact_duplicates(empty).count() == 0
    assert near.near_duplicates(empty).count() == 0


def test_rows_grow_with_a_group_just_below_the_threshold(spark, monkeypatch):
    """Texts of a mutual similarity of about 0.71, and among them pairs of 0.9: no step lists the group's pairs."""
    made = {}
    store = near.materialise

    def counted(df, label):
        out = store(df, label)
        made[label] = out.count()
        return out

    monkeypatch.setattr(near, "materialise", counted)
    base = words(9, 300)

    def rows_of(size):
        texts = []
        for k in range(size // 2):
            pick = random.Random(k)
            one = list(base)
            for place in pick.sample(range(5, 295, 6), 6):
                one[place] = f"own{k}x{place}"
            other = list(one)
            other[pick.randrange(300)] = f"pair{k}"
            texts += [" ".join(one), " ".join(other)]
        made.clear()
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = near.near_duplicates(docs).select("doc_id", "component_id").collect()
        sets = sets_of(enumerate(texts))
        places = {s: k for k, s in enumerate(sorted(set().union(*sets.values())))}
        holds = np.zeros((size, len(places)), np.float32)
        for k, own in sets.items():
            holds[k, [places[s] for s in own]] = 1
        common, n = holds @ holds.T, holds.sum(axis=1)
        linked = np.argwhere(100 * common >= 75 * (n[:, None] + n - common))
        assert {r["doc_id"]: r["component_id"] for r in found} == roots(sets, linked.tolist())
        return dict(made)

    small, large = rows_of(300), rows_of(600)
    # A member is a suspect once in each of its buckets at most.
    assert 0 < large["suspects"] <= large.pop("apart") <= 2.2 * small["apart"]
    large.pop("suspects")
    # Links that join two components: no more than there are texts.
    assert large.pop("more-links") < 600
    for label, count in large.items():
        assert count <= 2.2 * small[label] + 20, (label, small[label], count)
