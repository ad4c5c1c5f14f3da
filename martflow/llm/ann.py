"""Nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts with few edges between them. A small classifier
learns in which parts the neighbours of a vector lie. It files every row under its most probable part, and sends
every query to its several most probable parts, where all rows are compared exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martflow.llm.common import bounded_sample, map_columns
from martflow.workspace import materialise

# Vectors that the partition is learned from, at most. Every row is indexed.
SAMPLE_ROWS = 8192
NEIGHBOURS = 10
PARTS = 32
# Parts a query is sent to at least, and the probability that its parts must hold together. Vectors in clusters reach it
# within a few parts, vectors without any structure only within most of them.
LEAST_PROBES = 4
COVERED = 0.975
HIDDEN = 64
EPOCHS = 30
# Rows and queries compared at once.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024


def usable(vector: list | None, width: int | None) -> bool:
    """Vectors that are null, zero, of another width, or that hold a null or non-finite number, take no part."""
    if not vector or None in vector or (width is not None and len(vector) != width):
        return False
    values = np.asarray(vector, np.float64)
    return bool(np.isfinite(values).all() and values.any())


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def neighbour_graph(unit: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of every row."""
    k = min(k, len(unit) - 1)
    out = np.zeros((len(unit), k), np.int64)
    for at in range(0, len(unit), 1024):
        near = unit[at : at + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else out[at : at + 1024]
    return out


def balanced_parts(unit: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Halve the rows again and again, first by the main direction, then by swaps that cut fewer edges."""
    label = np.zeros(len(unit), np.int64)
    ends = np.concatenate([np.stack([np.repeat(np.arange(len(graph)), graph.shape[1]), graph.ravel()], 1)])
    count = 1
    while count < parts:
        for part in range(count):
            rows = np.flatnonzero(label == part)
            centred = unit[rows] - unit[rows].mean(axis=0)
            direction = np.linalg.svd(centred, full_matrices=False)[2][0] if len(rows) > 1 else np.zeros(unit.shape[1])
            side = np.zeros(len(unit), bool)
            side[rows[np.argsort(centred @ direction, kind="stable")[len(rows) // 2 :]]] = True
            inside = np.zeros(len(unit), bool)
            inside[rows] = True
            edges = ends[inside[ends[:, 0]] & inside[ends[:, 1]]]
            for _ in range(30):
                crossing = side[edges[:, 0]] != side[edges[:, 1]]
                weight = np.where(crossing, 1, -1)
                gain = np.bincount(edges[:, 0], weight, len(unit)) + np.bincount(edges[:, 1], weight, len(unit))
                left, right = rows[~side[rows]], rows[side[rows]]
                left = left[np.argsort(-gain[left], kind="stable")][: max(1, len(rows) // 50)]
                right = right[np.argsort(-gain[right], kind="stable")][: max(1, len(rows) // 50)]
                pairs = min(len(left), len(right))
                swap = gain[left[:pairs]] + gain[right[:pairs]] > 0
                if not swap.any():
                    break
                side[left[:pairs][swap]], side[right[:pairs][swap]] = True, False
            label[rows] = part + count * side[rows]
        count *= 2
    return label


class Router:
    """Two layers that give the probability of every part."""

    def __init__(self, first: np.ndarray, shift: np.ndarray, second: np.ndarray, bias: np.ndarray):
        self.first, self.shift, self.second, self.bias = first, shift, second, bias

    def chances(self, unit: np.ndarray) -> np.ndarray:
        x = np.maximum(unit @ self.first + self.shift, 0) @ self.second + self.bias
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit(rows: np.ndarray) -> Router:
    """Learn parts from a sample of usable vectors."""
    unit = _unit(rows)
    parts = 1
    while parts < PARTS and parts * 64 < len(unit):
        parts *= 2
    graph = neighbour_graph(unit, NEIGHBOURS)
    label = balanced_parts(unit, graph, parts)
    # A vector's target is where it and its neighbours lie.
    target = np.zeros((len(unit), parts))
    np.add.at(target, (np.repeat(np.arange(len(unit)), graph.shape[1]), label[graph].ravel()), 1.0)
    target[np.arange(len(unit)), label] += max(1, graph.shape[1]) / 2
    target /= target.sum(axis=1, keepdims=True)
    random = np.random.default_rng(5)
    width = unit.shape[1]
    weights = [
        random.normal(0, 1.0, (width, HIDDEN)) * np.sqrt(2.0), np.zeros(HIDDEN),
        random.normal(0, 1.0, (HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts),
    ]
    mean = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(unit))
        for at in range(0, len(order), 128):
            batch = order[at : at + 128]
            hidden = np.maximum(unit[batch] @ weights[0] + weights[1], 0)
            error = (Router(*weights).chances(unit[batch]) - target[batch]) / len(batch)
            back = (error @ weights[2].T) * (hidden > 0)
            slopes = [unit[batch].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for k, slope in enumerate(slopes):
                mean[k] = 0.9 * mean[k] + 0.1 * slope
                square[k] = 0.999 * square[k] + 0.001 * slope**2
                corrected = mean[k] / (1 - 0.9**step)
                weights[k] -= 0.01 * corrected / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return Router(*weights)


def train(vectors: DataFrame, key: str, vector: str) -> tuple[Router | None, int]:
    """The router and the width of the vectors, from the usable vectors with the smallest hashes of their keys."""
    present = vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull())
    chosen = bounded_sample(present.select(F.col(key).alias("_key")).distinct(), "_key", SAMPLE_ROWS)
    found = present.join(F.broadcast(chosen), F.col(key) == F.col("_key"), "left_semi")
    sample = [r[1] for r in sorted(found.select(key, vector).limit(2 * SAMPLE_ROWS).collect(), key=lambda r: r[0])]
    sample = [v for v in sample if usable(v, None)]
    if not sample:
        return None, 0
    widths, counts = np.unique([len(v) for v in sample], return_counts=True)
    width = int(widths[counts.argmax()])
    return fit(np.array([v for v in sample if len(v) == width], np.float64)), width


def indexed(vectors: DataFrame, router: Router, width: int, key: str, vector: str, every: int) -> DataFrame:
    """key, part, values of every usable row; ``probes`` lists the parts to search for rows that are queries."""
    shared = vectors.sparkSession.sparkContext.broadcast((router.first, router.shift, router.second, router.bias))

    def start():
        fitted = Router(*shared.value)

        def apply(columns):
            kept = [(k, v) for k, v in zip(columns["key"], columns["vector"]) if k is not None and usable(v, width)]
            out = {"key": [k for k, _ in kept], "part": [], "probes": [], "values": []}
            if not kept:
                return out
            rows = np.array([v for _, v in kept], np.float64)
            chances = fitted.chances(_unit(rows))
            order = np.argsort(-chances, axis=1, kind="stable")
            covered = np.cumsum(np.take_along_axis(chances, order, axis=1), axis=1)
            needed = np.maximum((covered < COVERED).sum(axis=1) + 1, LEAST_PROBES)
            out["part"] = order[:, 0].tolist()
            out["values"] = [row.tobytes() for row in rows]
            out["probes"] = [o[:n].tolist() if k % every == 0 else [] for (k, _), o, n in zip(kept, order, needed)]
            return out

        return apply

    return map_columns(
        vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector")),
        "key long, part int, probes array<int>, values binary",
        start,
    )


def _nearest(count: int):
    """The nearest rows of each query within one block of rows and queries."""

    def compare(frame):
        import pandas as pd

        queries, rows = frame[frame["asks"]], frame[~frame["asks"]]
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        ids = rows["key"].to_numpy(np.int64)
        values = np.frombuffer(b"".join(rows["values"])).reshape(len(ids), -1)
        norms = np.sqrt((values * values).sum(axis=1))
        unit = _unit(values)
        out = []
        for query, raw in zip(queries["key"].to_numpy(np.int64), queries["values"]):
            asked = np.frombuffer(raw)
            quick = unit @ _unit(asked[None, :])[0]
            quick[ids == query] = -np.inf
            left = int(np.isfinite(quick).sum())
            if not left:
                continue
            bound = np.partition(quick, -min(count, left))[-min(count, left)] - 1e-9
            close = np.flatnonzero(quick >= bound)
            # The score of a pair does not depend on the block it is met in.
            score = (values[close] * asked).sum(axis=1) / (norms[close] * np.sqrt((asked * asked).sum()))
            best = np.lexsort((ids[close], -score))[:count]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[close][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    return compare


def nearest(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, count: int = 5
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``count`` nearest rows by cosine found for every row with a key divisible by ``every``.

    Ties go to the smaller key; a row is no neighbour of its own key, and rows that repeat a key and a vector count once.
    Rows without a key and vectors that are not usable take no part; without any the result is empty.
    """
    spark = vectors.sparkSession
    router, width = train(vectors, key, vector)
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    stored = materialise(indexed(vectors, router, width, key, vector, every), "vectors")
    # A few numbers for each part: rows, and queries that search it. Large parts are split into blocks.
    asks = stored.where(F.size("probes") > 0).select("key", "values", F.explode("probes").alias("part"))
    held = stored.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("row_blocks"))
    asked = asks.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("query_blocks"))
    sizes = F.broadcast(held.join(asked, "part"))
    rows = stored.join(sizes, "part").select(
        "part",
        F.pmod(F.xxhash64("key"), "row_blocks").alias("row_block"),
        F.explode(F.expr("sequence(0L, query_blocks - 1L)")).alias("query_block"),
        "key", "values", F.lit(False).alias("asks"),
    )
    questions = asks.join(sizes, "part").select(
        "part",
        F.explode(F.expr("sequence(0L, row_blocks - 1L)")).alias("row_block"),
        F.pmod(F.xxhash64("key"), "query_blocks").alias("query_block"),
        "key", "values", F.lit(True).alias("asks"),
    )
    found = (
        rows.unionByName(questions)
        .groupBy("part", "row_block", "query_block")
        .applyInPandas(_nearest(count), "query_id long, vec_id long, score double")
    )
    ranks = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        found.dropDuplicates(["query_id", "vec_id", "score"])
        .withColumn("rank", ranks)
        .where(F.col("rank") <= count)
        .select("query_id", "rank", "vec_id", "score")
    )
