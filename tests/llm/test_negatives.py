"""Hard negatives against brute force, and the tables and planes beneath."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as arrays

from martflow.llm import negatives


@settings(max_examples=60, deadline=None)
@given(
    arrays.arrays(np.int64, st.tuples(st.integers(1, 5), st.just(16)), elements=st.integers(-(2**27), 2**27)),
    arrays.arrays(np.int64, st.tuples(st.integers(1, 5), st.just(16)), elements=st.integers(-(2**27), 2**27)),
)
def test_scores_are_inner_products(anchors, candidates):
    found = negatives.scores(negatives.subset_sums(anchors), negatives.planes(candidates))
    assert (found == candidates @ anchors.T).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-3, 3), max_size=60), st.integers(1, 5))
def test_first_rows(found, count):
    ids = np.arange(len(found))[::-1] * 7 % 61
    kept = negatives.first(ids, np.array(found, np.int64), count)
    assert [(-found[k], ids[k]) for k in kept] == sorted((-f, i) for f, i in zip(found, ids))[:count]


def expected(rows):
    sound = {}
    for key, label, vector in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if key % 7 == 0 else label
        row = (label, [math.floor(256 * x) for x in vector])
        sound[key] = min(sound.get(key, row), row)
    out = []
    for anchor in (k for k in sound if k % 50 == 0):
        label, vector = sound[anchor]
        score = {k: sum(a * b for a, b in zip(vector, v)) for k, (_, v) in sound.items() if k != anchor}
        order = sorted(score, key=lambda k: (-score[k], k))
        for positive in [k for k in order if sound[k][0] == label][:5]:
            bound = score[positive]
            held = [k for k in order if sound[k][0] != label and 50 * bound <= 100 * score[k] <= 95 * bound]
            out += [(anchor, positive, n + 1, k, bound, score[k]) for n, k in enumerate(held[:3])]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int, v string, block int, score string, asks int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, label, "v", 1, "s", 2) for k, label, v in rows], SCHEMA)


@pytest.mark.parametrize("width", [3, 8, 20])
def test_equals_brute_force(spark, width):
    random = np.random.default_rng(width)
    rows = []
    for key in range(0, 260):
        vector = (random.integers(-8, 9, width) / 8).tolist() if key % 3 else [0.5] * width
        rows.append((key, int(random.integers(0, 4)), vector))
    rows += [(300, None, [1.0] * width), (301, 1, None), (350, 1, [None] * width), (400, 1, [float("nan")] * width)]
    rows += [(450, 1, [float("inf")] * width), (None, 1, [1.0] * width), rows[5], rows[50], (500, 2, []), (550, 2, [1.5])]
    rows += [(50, 3, [0.25] * width), (600, 2, [-1000.0] * width), (601, 3, [1000.25] * width)]
    found = negatives.hard_negatives(frame(spark, rows)).collect()
    assert sorted(map(tuple, found)) == expected(rows) and len(found) > 10


def test_many_equal_vectors_split_over_blocks(spark):
    rows = [(k, k % 2, [1.0, 0.5]) for k in range(1, 2000)] + [(2000, 1, [1.0, 0.6]), (2001, 0, [0.9, 0.5])]
    found = negatives.hard_negatives(frame(spark, rows)).collect()
    assert sorted(map(tuple, found)) == expected(rows)


def test_empty_and_too_large(spark):
    assert negatives.hard_negatives(frame(spark, [])).collect() == []
    assert negatives.hard_negatives(frame(spark, [(50, 1, [1.0])])).collect() == []
    with pytest.raises(Exception, match="fit a long"):
        negatives.hard_negatives(frame(spark, [(50, 1, [1e30])])).collect()
