"""Quality of a text: histogram gradient-boosted trees over statistics of the document.

Trees are grown level by level on binned features and kept as flat arrays, a node's children at 2 i + 1 and 2 i + 2, so
that a batch of documents walks through all trees at once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import astuple, dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import bounded_sample, in_learning_part, map_columns
from martflow.workspace import materialise

# Labelled documents a model is fitted on, at most.
SAMPLE_ROWS = 20_000
BINS = 32
DEPTH = 4
TREES = 80
RATE = 0.15
SMOOTHING = 1.0
LEAST_WEIGHT = 2.0

STATISTICS = [
    "log_bytes", "upper", "lower", "digits", "spaces", "other_bytes", "hash_dollar_percent", "ampersand_star",
    "exclamation", "bar", "full_stop", "comma", "quotes_brackets", "entropy", "log_words", "word_bytes",
    "longest_word", "distinct_words", "top_word", "log_lines", "line_bytes", "repeated_lines", "ended_lines", "short_lines",
]


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of STATISTICS. A null text counts as empty."""
    content = (text or "").encode()
    counts = np.bincount(np.frombuffer(content, np.uint8), minlength=256)
    size = max(len(content), 1)

    def share(letters: bytes) -> float:
        return float(counts[list(letters)].sum()) / size

    seen = counts[counts > 0] / size
    words = content.split()
    n_words = max(len(words), 1)
    tally = Counter(words)
    lines = [line for line in content.split(b"\n") if line]
    n_lines = max(len(lines), 1)
    return [
        float(np.log1p(len(content))),
        float(counts[65:91].sum()) / size,
        float(counts[97:123].sum()) / size,
        float(counts[48:58].sum()) / size,
        share(b" \t\r\n"),
        float(counts[128:].sum()) / size,
        share(b"#$%"),
        share(b"&*"),
        share(b"!"),
        share(b"|"),
        share(b"."),
        share(b","),
        share(b"\"'()[]{}<>=/\\_"),
        float(-(seen * np.log2(seen)).sum()) if len(seen) else 0.0,
        float(np.log1p(len(words))),
        sum(map(len, words)) / n_words,
        float(max(map(len, words), default=0)),
        len(tally) / n_words,
        max(tally.values(), default=0) / n_words,
        float(np.log1p(len(lines))),
        sum(map(len, lines)) / n_lines,
        1 - len(set(lines)) / n_lines if lines else 0.0,
        sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines) / n_lines,
        sum(len(line) < 30 for line in lines) / n_lines,
    ]


@dataclass
class Forest:
    """Flat trees: ``feature`` and ``above`` of every inner node, ``leaves`` of the lowest level."""

    base: float
    feature: np.ndarray
    above: np.ndarray
    leaves: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        trees, inner = self.feature.shape
        if not len(rows) or not trees:
            return np.full(len(rows), 1 / (1 + np.exp(-self.base)))
        node = np.zeros((len(rows), trees), np.int64)
        tree, row = np.arange(trees)[None, :], np.arange(len(rows))[:, None]
        while node[0, 0] < inner:
            node = 2 * node + 1 + (rows[row, self.feature[tree, node]] > self.above[tree, node])
        return 1 / (1 + np.exp(-(self.base + self.leaves[tree, node - inner].sum(axis=1))))


def fit(rows: np.ndarray, labels: np.ndarray) -> Forest:
    """Boost trees on the log loss. Splits are sought between the bins of each feature's histogram."""
    inner, width = 2**DEPTH - 1, rows.shape[1]
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], rows[:, f], side="left") for f in range(width)], axis=1)
    mean = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(len(rows), base)
    feature = np.zeros((TREES, inner), np.int64)
    above = np.full((TREES, inner), np.inf)
    leaves = np.zeros((TREES, inner + 1))
    for tree in range(TREES):
        chance = 1 / (1 + np.exp(-margin))
        slope, weight = labels - chance, chance * (1 - chance)
        node = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            place = node - first
            gain, where = np.zeros(count), [None] * count
            for f in range(width):
                cell = place * BINS + binned[:, f]
                slopes = np.bincount(cell, slope, count * BINS).reshape(count, BINS).cumsum(axis=1)
                weights = np.bincount(cell, weight, count * BINS).reshape(count, BINS).cumsum(axis=1)
                right_s, right_w = slopes[:, -1:] - slopes, weights[:, -1:] - weights
                better = (
                    slopes**2 / (weights + SMOOTHING)
                    + right_s**2 / (right_w + SMOOTHING)
                    - slopes[:, -1:] ** 2 / (weights[:, -1:] + SMOOTHING)
                )
                better[(weights < LEAST_WEIGHT) | (right_w < LEAST_WEIGHT)] = 0
                better[:, len(edges[f]) :] = 0
                best = better.argmax(axis=1)
                for k in np.flatnonzero(better[np.arange(count), best] > gain + 1e-9):
                    gain[k], where[k] = better[k, best[k]], (f, best[k])
            for k, split in enumerate(where):
                if split:
                    feature[tree, first + k], above[tree, first + k] = split[0], edges[split[0]][split[1]]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[tree, node]] > above[tree, node])
        sums = np.bincount(node - inner, slope, inner + 1)
        leaves[tree] = RATE * sums / (np.bincount(node - inner, weight, inner + 1) + SMOOTHING)
        margin += leaves[tree][node - inner]
    return Forest(base, feature, above, leaves)


def described(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and the statistics of every row's whole text, as binary doubles."""

    def start():
        return lambda columns: {
            "key": columns["key"],
            "stats": [np.array(statistics(text)).tobytes() for text in columns["text"]],
        }

    return map_columns(docs.select(F.col(key).alias("key"), "text"), "key long, stats binary", start)


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id") -> Forest:
    """Fit on at most SAMPLE_ROWS labelled documents, none of them held out.

    Where a document has several labels the more frequent counts, 1 in a tie; null labels are left out. Without any
    label every score is one half.
    """
    usable = labels.where(in_learning_part(F.col(key)) & F.col(label).isNotNull())
    voted = usable.groupBy(F.col(key).alias("key")).agg((F.avg(F.col(label)) >= 0.5).cast("int").alias("label"))
    once = stats.join(voted, "key").dropDuplicates(["key"])
    found = bounded_sample(once, "key", SAMPLE_ROWS).collect()
    if not found:
        return Forest(0.0, np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 1)))
    found.sort(key=lambda r: r["key"])
    return fit(
        np.stack([np.frombuffer(bytes(r["stats"])) for r in found]), np.array([float(r["label"]) for r in found])
    )


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id") -> DataFrame:
    """key, score of every row of ``docs``: the probability of label 1, from statistics of its whole text."""
    stats = materialise(described(docs, key), "statistics")
    # Broadcast as plain values, as executors may lack the class.
    shared = docs.sparkSession.sparkContext.broadcast(astuple(train(stats, labels, label, key)))

    def start():
        forest = Forest(*shared.value)

        def apply(columns):
            rows = np.stack([np.frombuffer(s) for s in columns["stats"]])
            return {"key": columns["key"], "score": forest.score(rows).tolist()}

        return apply

    return map_columns(stats, "key long, score double", start)
