"""Spelling variants against brute force, and the trees beneath."""

import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martflow.llm import spelling
from martflow.llm.spelling import Leaf, Tree, counts_of, letters_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def expected(rows):
    counts = {}
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            code = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if code % 199 == 0:
                at = code % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] = counts.get(word, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for word, n in counts.items():
        near = [w for w in counts if w != word and one_edit(w, word)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 5 * n else None
        out[word] = [form, word, n, len(near), counts[form] if form else None]
    for word, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: tuple(row) for w, row in out.items()}


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


WORDS = st.lists(st.text("abcéÉ", min_size=3, max_size=4), min_size=1, max_size=60, unique=True)


@settings(max_examples=100, deadline=None)
@given(WORDS, st.integers(1, 8))
def test_boxes_and_leaves_hold_all_near_words(words, size):
    for length in (3, 4):
        own = [w for w in words if len(w) == length]
        if not own:
            continue
        for asked, more, less in ((own, 1, 1), ([w for w in words if len(w) == length + 1], 0, 1)):
            if not asked:
                continue
            tree = Tree(counts_of(letters_of(own)), size)
            reached = {(int(k), int(m)) for leaf, rows in tree.reached(counts_of(letters_of(asked)), more, less) for k in rows for m in tree.members[leaf]}
            pairs = {(k, m) for k, a in enumerate(asked) for m, b in enumerate(own) if one_edit(a, b)}
            assert pairs <= reached
            leaf = Leaf(own, [1] * len(own))
            a, b = leaf.near(letters_of(asked), longer=not more)
            assert sorted(zip(a.tolist(), b.tolist())) == sorted(pairs)


def test_pruning_leaves_boxes_out():
    pick = random.Random(3)
    words = ["".join(pick.choice("abcdefghijkl") for _ in range(8)) for _ in range(4000)]
    counts = counts_of(letters_of(words))
    tree = Tree(counts, 64)
    met = sum(len(rows) * len(tree.members[leaf]) for leaf, rows in tree.reached(counts, 1, 1))
    assert met < 0.3 * len(words) ** 2


def sample_rows():
    pick = random.Random(7)
    stems = ["banana", "bananas", "orange", "Éclairs", "éclairs", "straße", "window", "widow", "minnow", "ananab"]
    rows = []
    for key in range(400):
        text = " ".join(pick.choice(stems) for _ in range(pick.randrange(12)))
        if key % 7 == 0:
            text += " bananna, Banan4banane winddow ORANGE×x windows."
        rows.append((key, text))
    long = "x" * 3000
    rows += [(1000, None), (1001, ""), (1002, f"{long} " * 6 + f"{long}y " * 5), (None, "banane " * 4), rows[5], rows[5]]
    rows += [(2000 + k, f"tiewordaa tiewordab {'tiewordaX ' * 1}") for k in range(6)] + [(3000, "tiewordac " * 40)]
    return rows


def frame(spark, rows):
    schema = "doc_id long, text string, word string, n int, run string, code string, place string, leaf int, doc string"
    return spark.createDataFrame([(k, t, "w", 1, "r", "c", "p", 2, "d") for k, t in rows], schema)


def test_equals_brute_force(spark):
    rows = sample_rows()
    result = spelling.variants(frame(spark, rows))
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    answers = expected(rows)
    assert found(result) == answers
    assert any(row[0] for row in answers.values())


def test_many_leaves_equal_brute_force(spark, monkeypatch):
    """Words spread over many leaves of the upper levels, and chains of forms."""
    monkeypatch.setattr(spelling, "LEAF_WORDS", 40)
    monkeypatch.setattr(spelling, "BOX_WORDS", 4)
    pick = random.Random(11)
    rows = []
    for key in range(700):
        word = "".join(pick.choice("abcd") for _ in range(pick.choice([6, 6, 7])))
        rows.append((key, f"{word} " * pick.choice([5, 6, 30, 200])))
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 130, "aaabbb": 700}
    rows += [(5000 + k, f"{w} " * n) for k, (w, n) in enumerate(words.items())]
    trees = spelling.layout(spelling.vocabulary(frame(spark, rows)))
    assert len(trees) >= 2 and max(sum(node[0] < 0 for node in tree.nodes) for tree, _ in trees.values()) > 4
    assert found(spelling.variants(frame(spark, rows))) == expected(rows)


def test_empty_table_and_no_words(spark):
    assert spelling.variants(frame(spark, [])).collect() == []
    assert spelling.variants(frame(spark, [(1, None), (2, "a b c")])).collect() == []


def test_layout_numbers_leaves_once(spark):
    words = spark.createDataFrame([("".join(w), 5) for w in np.random.default_rng(1).choice(list("abcdef"), (3000, 6))], "word string, n long")
    trees = spelling.layout(words.distinct())
    leaves = [first + node[1] for tree, first in trees.values() for node in tree.nodes if node[0] < 0]
    assert sorted(leaves) == list(range(len(leaves)))
