"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One inserted, deleted or replaced letter changes at most two letter counts, by one each. Words of one length are the points of
a k-d tree. Its upper levels, laid out from a bounded sample, deal the words to leaves, each of which is searched in a
task that builds the lower levels. A word asks the tree of its own length for words with one letter replaced, and the tree of the
next shorter length for words with one letter less. A box is passed over when no point in it can be that near. What
remains is compared letter by letter. Of a word's near words only their number and the best go on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import bounded_sample, map_columns
from martflow.workspace import materialise

# The letters, the rule that misspells, and the least words.
LETTERS = "A-Za-zÀ-ÿ"
MISSPELT_EVERY = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
# A form is at least so many times as frequent.
TIMES = 5

# Words of one leaf of the upper levels, about, and of the lower ones.
LEAF_WORDS = 4096
BOX_WORDS = 64
# Words whose letter counts lay out the upper levels, and the least for one leaf. The layout decides only who works on what.
SAMPLE_WORDS = 50_000
SAMPLED_PER_LEAF = 8
# Words that ask a leaf at once.
ASKED_AT_ONCE = 8192
ACCENTED = 0xC0
DIMENSIONS = 26 + 0x100 - ACCENTED

OWN, SAME, LONGER = 0, 1, 2


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of the words that are long and frequent enough."""
    run = F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    ascii_only = F.octet_length("run") == F.length("run")
    lowered = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", upper, lower))
    words = runs.select("doc", lowered.alias("run"))
    code = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    words = words.withColumn("code", code).withColumn("place", (F.col("code") % F.length("run")).cast("int"))
    without = F.expr("concat(substring(run, 1, place), substring(run, place + 2))")
    word = F.when(F.col("code") % MISSPELT_EVERY == 0, without).otherwise(F.col("run"))
    counted = words.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LENGTH))


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points, all of which are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each word."""
    place = np.where(letters >= ACCENTED, letters.astype(np.int64) - ACCENTED + 26, letters.astype(np.int64) - ord("a"))
    counts = np.zeros((len(letters), DIMENSIONS), np.int32)
    rows = np.arange(len(letters))
    for column in place.T:
        counts[rows, column] += 1
    return counts


class Tree:
    """A k-d tree: each node sends counts of one letter up to a bound to the left, others to the right."""

    def __init__(self, counts: np.ndarray, leaf_size: float):
        self.nodes: list[tuple[int, int, int, int]] = []  # letter, bound, left, right; a leaf has letter -1 and its number
        self.members: list[np.ndarray] = []
        self._grow(counts, np.arange(len(counts)), leaf_size)

    def _grow(self, counts: np.ndarray, rows: np.ndarray, leaf_size: float) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, 0, 0, 0))
        split = self._split(counts[rows]) if len(rows) > leaf_size else None
        if split is None:
            self.nodes[at] = (-1, len(self.members), 0, 0)
            self.members.append(rows)
        else:
            letter, bound = split
            left = counts[rows, letter] <= bound
            lower = self._grow(counts, rows[left], leaf_size)
            upper = self._grow(counts, rows[~left], leaf_size)
            self.nodes[at] = (letter, bound, lower, upper)
        return at

    @staticmethod
    def _split(counts: np.ndarray) -> tuple[int, int] | None:
        """The letter and bound that part the rows most evenly; none if all are alike."""
        best, found = 0, None
        # The median, or the bound before it, is the most even of a letter.
        middle = np.median(counts, axis=0).astype(np.int64)
        for shift in (0, -1):
            lower = (counts <= middle + shift).sum(axis=0)
            even = np.minimum(lower, len(counts) - lower)
            letter = int(even.argmax())
            if even[letter] > best:
                best, found = int(even[letter]), (letter, int(middle[letter] + shift))
        return found

    def without_members(self) -> Tree:
        light = object.__new__(Tree)
        light.nodes, light.members = self.nodes, []
        return light

    def reached(self, counts: np.ndarray, more: int, less: int):
        """(leaf, rows) of the leaves that may hold a point with up to ``more`` letters more and ``less`` letters less."""
        full = np.full(len(counts), more, np.int32), np.full(len(counts), less, np.int32)
        waiting = [(0, np.arange(len(counts)), *full)]
        while waiting:
            at, rows, more_left, less_left = waiting.pop()
            if not len(rows):
                continue
            letter, bound, lower, upper = self.nodes[at]
            if letter < 0:
                yield bound, rows
                continue
            own = counts[rows, letter]
            # Towards the left a point has at most the bound, towards the right more than it.
            left = less_left - np.maximum(own - bound, 0)
            right = more_left - np.maximum(bound + 1 - own, 0)
            for node, budget, other, is_left in ((lower, left, more_left, True), (upper, right, less_left, False)):
                goes = budget >= 0
                waiting.append((node, rows[goes], *((other[goes], budget[goes]) if is_left else (budget[goes], other[goes]))))


def layout(words: DataFrame) -> dict[int, tuple[Tree, int]]:
    """For each length the upper levels of its tree and the number of its first leaf.

    A length has about as many leaves as its words fill, but no more than its part of the sample can lay out.
    """
    sizes = {r["length"]: r["rows"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("rows")).collect()}
    by_length: dict[int, list[str]] = {length: [] for length in sizes}
    for row in bounded_sample(words.select("word"), "word", SAMPLE_WORDS).collect():
        by_length[len(row["word"])].append(row["word"])
    trees, first = {}, 0
    for length, sample in sorted(by_length.items()):
        sample = sample or ["a" * length]
        leaf = max(SAMPLED_PER_LEAF, LEAF_WORDS * len(sample) / max(1, sizes[length]))
        tree = Tree(counts_of(letters_of(sample)), leaf)
        trees[length] = (tree.without_members(), first)
        first += len(tree.members)
    return trees


def _dealt(words: DataFrame, trees: dict[int, tuple[Tree, int]]) -> DataFrame:
    """leaf, role, word, n: every word in its own leaf, and in the leaves that it asks."""

    def start():
        def apply(columns):
            out: dict[str, list] = {"leaf": [], "role": [], "word": [], "n": []}
            by_length: dict[int, list[int]] = {}
            for k, word in enumerate(columns["word"]):
                by_length.setdefault(len(word), []).append(k)
            for length, rows in by_length.items():
                counts = counts_of(letters_of([columns["word"][k] for k in rows]))
                asked = [(length, OWN, 0, 0), (length, SAME, 1, 1)]
                if length - 1 in trees:
                    asked.append((length - 1, LONGER, 0, 1))
                own = np.full(len(rows), -1)
                for of_length, role, more, less in asked:
                    tree, first = trees[of_length]
                    for leaf, reached in tree.reached(counts, more, less):
                        if role == OWN:
                            own[reached] = leaf
                        elif role == SAME:
                            reached = reached[own[reached] != leaf]
                        for k in reached:
                            out["leaf"].append(first + leaf)
                            out["role"].append(role)
                            out["word"].append(columns["word"][rows[k]])
                            out["n"].append(columns["n"][rows[k]])
            return out

        return apply

    return map_columns(words.select("word", "n"), "leaf int, role int, word string, n long", start)


class Leaf:
    """The words of one leaf of the upper levels, and the lower levels over them."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n = np.array(words, object), np.array(n, np.int64)
        self.letters = letters_of(words)
        self.counts = counts_of(self.letters)
        self.tree = Tree(self.counts, BOX_WORDS)

    def near(self, letters: np.ndarray, longer: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of an asking word and a word of the leaf that are one edit apart."""
        counts = counts_of(letters)
        asking, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for leaf, rows in self.tree.reached(counts, 0 if longer else 1, 1):
            members = self.tree.members[leaf]
            own, other = counts[rows].astype(np.float64), self.counts[members].astype(np.float64)
            # One count less by one, and for a replaced letter another more by one.
            apart = (own**2).sum(axis=1)[:, None] + (other**2).sum(axis=1) - 2 * own @ other.T
            a, b = np.nonzero(apart == (1 if longer else 2))
            a, b = rows[a], members[b]
            held = (_one_less if longer else _one_replaced)(letters[a], self.letters[b])
            asking.append(a[held])
            found.append(b[held])
        return np.concatenate(asking), np.concatenate(found)


def _one_replaced(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (one != other).sum(axis=1) == 1


def _one_less(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether the letters before the first difference, and those after it less one, make up the shorter word."""
    ahead = np.cumprod(longer[:, :-1] == shorter, axis=1, dtype=np.int64).sum(axis=1)
    behind = np.cumprod((longer[:, 1:] == shorter)[:, ::-1], axis=1, dtype=np.int64).sum(axis=1)
    return ahead + behind >= shorter.shape[1]


def _summed(words: np.ndarray, by: np.ndarray, others: np.ndarray, of: np.ndarray, n: np.ndarray):
    """For the words that have pairs: word, number of pairs, n and word of the best partner."""
    ranks = np.argsort(np.argsort(others, kind="stable"))
    order = np.lexsort((ranks[of], -n[of], by))
    by, of = by[order], of[order]
    firsts = np.flatnonzero(np.diff(by, prepend=-1))
    sizes = np.diff(np.append(firsts, len(by)))
    best = of[firsts]
    return words[by[firsts]].tolist(), sizes.tolist(), n[best].tolist(), others[best].tolist()


def _answered(leaf: Leaf, role: int, words: list[str], n: list[int]):
    """Rows of word, n_near, best_n, best for the words that ask, and for those of the leaf where they are shorter."""
    import pyarrow as pa

    asking, found = leaf.near(letters_of(words), role == LONGER)
    if not len(asking):
        return
    names, counts = np.array(words, object), np.array(n, np.int64)
    told = [_summed(names, asking, leaf.words, found, leaf.n)]
    if role == LONGER:
        told.append(_summed(leaf.words, found, names, asking, counts))
    for columns in told:
        yield pa.RecordBatch.from_pydict(dict(zip(("word", "n_near", "best_n", "best"), columns)))


def _searched(dealt: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: what each leaf can tell of a word."""
    spark = dealt.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = dealt.repartition(parts, "leaf").sortWithinPartitions("leaf", "role")

    def run(batches):
        current, leaf = None, None
        words: list[str] = []
        n: list[int] = []

        def flush(role):
            nonlocal leaf, words, n
            if words:
                if role == OWN:
                    leaf = Leaf(words, n)
                if leaf is not None:
                    for at in range(0, len(words), ASKED_AT_ONCE):
                        some = slice(at, at + ASKED_AT_ONCE)
                        yield from _answered(leaf, role, words[some], n[some])
            words, n = [], []

        for batch in batches:
            numbers, roles = batch["leaf"].to_numpy(), batch["role"].to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(roles) != 0)) + 1
            bounds = [0, *cuts.tolist(), batch.num_rows]
            for start, end in zip(bounds, bounds[1:]):
                key = (numbers[start], roles[start])
                if key != current:
                    if current is not None:
                        yield from flush(current[1])
                        if key[0] != current[0]:
                            leaf = None
                    current = key
                words.extend(batch["word"].slice(start, end - start).to_pylist())
                n.extend(batch["n"].slice(start, end - start).to_pylist())
                if key[1] != OWN and len(words) >= ASKED_AT_ONCE:
                    yield from flush(key[1])
        if current is not None:
            yield from flush(current[1])

    return spread.mapInArrow(run, "word string, n_near long, best_n long, best string")


def _rooted(forms: DataFrame) -> DataFrame:
    """word, root: the last form that forms lead to. Each round doubles the steps; forms grow by ``TIMES``, so few are needed."""
    current = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = current.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        stepped = current.join(ahead, F.col("root") == F.col("_at"), "left")
        current = materialise(
            stepped.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots"
        )
        if current.where("moved").isEmpty():
            return current.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``.

    Words are runs of letters in lower case (A-Z alone), some with a letter left out by the fixed rule, of at least six letters
    and five occurrences. A null or empty text has none, and an empty table returns no rows. Rows that repeat count each; a
    null doc_id counts as an empty text in the rule. Texts and words of any length are taken whole. Ties of frequency go to the smallest word
    in code-point order. Only doc_id and text are read.
    """
    words = materialise(vocabulary(docs), "words")
    told = _searched(_dealt(words, layout(words)))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best")
    near = told.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    found = materialise(
        words.join(near, "word", "left").select(
            "word",
            F.when(is_form, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _rooted(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
