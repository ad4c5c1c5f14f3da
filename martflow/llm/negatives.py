"""Hard negatives by exact integer scores, computed with the Method of Four Russians.

A vector's components become integers, and the integers of eight neighbouring dimensions one byte for each bit plane. For
every anchor and group of eight dimensions a table holds the sums of all 256 subsets of its components. A score is then a sum
of table entries that a candidate's bytes point to, shifted by their planes, the sign plane counted negative.

Candidates are dealt into blocks of bounded size, and every block meets all anchors, a batch at a time. The first pass
finds each anchor's positives, the second its negatives in the range that each positive sets. A block passes on the first
few for each anchor, never pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.workspace import materialise

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
# A negative's score in hundredths of the positive's score.
LEAST, MOST = 50, 95
GROUP = 8
# Candidates of one block at most; blocks are smaller where there are few rows for many tasks.
BLOCK_ROWS = 32_768
# Candidates scored at once with a batch of anchors.
AT_ONCE = 2048
# Above this component size, 64 dimensions could give a score beyond a long.
LARGEST = 2**28


def prepared(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, label, v (integers) of the rows that take part, one for each vec_id."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & finite

    def scaled(x):
        value = F.floor(F.lit(float(SCALE)) * x.cast("double"))
        told = F.lit(f"a component is beyond {LARGEST // SCALE}; scores would not fit a long")
        return F.when(F.abs(x) < LARGEST // SCALE, value).otherwise(F.raise_error(told).cast("long")).cast("int")

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    rows = embeddings.where(sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.transform(vector, scaled).alias("v")
    )
    least = F.min(F.struct("label", "v")).alias("_row")
    return rows.groupBy("vec_id").agg(least).select("vec_id", "_row.label", "_row.v")


def padded(vectors, width: int) -> np.ndarray:
    """Integer vectors of an Arrow list column as rows of ``width``; what is missing counts as 0."""
    column = vectors.combine_chunks() if hasattr(vectors, "combine_chunks") else vectors
    bounds = column.offsets.to_numpy()
    values = column.values.to_numpy()
    lengths = np.diff(bounds)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values[bounds[0] : bounds[-1]]
    return out


def planes(vectors: np.ndarray) -> np.ndarray:
    """Bytes by plane, group and row, in two's complement with as few planes as the values need."""
    size = int(max(vectors.max(initial=0), -(vectors.min(initial=0) + 1)))
    grouped = vectors.reshape(len(vectors), -1, GROUP)
    place = np.arange(GROUP)
    packed = [(((grouped >> k) & 1) << place).sum(axis=2).astype(np.uint8).T for k in range(size.bit_length() + 1)]
    return np.ascontiguousarray(packed)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """By group and byte, the sum of the components that the byte's bits name, for every anchor."""
    grouped = anchors.reshape(len(anchors), -1, GROUP)
    sums = np.zeros((grouped.shape[1], 1 << GROUP, len(anchors)), np.int64)
    for bit in range(GROUP):
        # The table of the first bits, and again with the next component added.
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + grouped[:, :, bit].T[:, None, :]
    return sums


def scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Exact inner products of candidates (rows) with anchors (columns)."""
    total = np.zeros((packed.shape[2], tables.shape[2]), np.int64)
    sign = len(packed) - 1
    for k, plane in enumerate(packed):
        looked_up = tables[0][plane[0]]
        for table, index in zip(tables[1:], plane[1:]):
            looked_up += table[index]
        looked_up <<= k
        if k < sign:
            total += looked_up
        else:
            total -= looked_up
    return total


class Block:
    """The candidates of one block, by vec_id, in bit planes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.packed = planes(vectors[order])

    def scored(self, tables: np.ndarray):
        """Places of some candidates and their scores, until all have been scored."""
        for at in range(0, len(self.ids), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            yield some, scores(tables, self.packed[:, :, some])

    def of_label(self, label: int) -> Block:
        part = object.__new__(Block)
        held = self.labels == label
        part.ids, part.labels, part.packed = self.ids[held], self.labels[held], self.packed[:, :, held]
        return part


def first(ids: np.ndarray, found: np.ndarray, count: int) -> np.ndarray:
    """Places of the first rows: higher scores first, ties by smaller id."""
    if len(found) > 8 * count:
        bound = np.partition(found, len(found) - count)[len(found) - count]
        few = np.flatnonzero(found >= bound)
        return few[np.lexsort((ids[few], -found[few]))[:count]]
    return np.lexsort((ids, -found))[:count]


def _best(parts: list[tuple[np.ndarray, np.ndarray]], count: int) -> tuple[np.ndarray, np.ndarray]:
    ids, found = (np.concatenate(c) for c in zip(*parts))
    kept = first(ids, found, count)
    return ids[kept], found[kept]


def _positives_of(block: Block, batch, width: int):
    """anchor_id, positive_id, score: the first rows of the anchor's label in the block."""
    ids, labels = batch["vec_id"].to_numpy(), batch["label"].to_numpy()
    vectors = padded(batch["v"], width)
    out: tuple[list, list, list] = ([], [], [])
    for label in np.unique(labels):
        own = np.flatnonzero(labels == label)
        held = block.of_label(label)
        parts: dict[int, list] = {k: [] for k in own}
        for some, found in held.scored(subset_sums(vectors[own])):
            for column, k in enumerate(own):
                others = held.ids[some] != ids[k]
                parts[k].append(_best([(held.ids[some][others], found[others, column])], POSITIVES))
        for k, some in parts.items():
            if some:
                near, found = _best(some, POSITIVES)
                out[0].extend([ids[k]] * len(near))
                out[1].extend(near)
                out[2].extend(found)
    return out


def _negatives_of(block: Block, batch, width: int):
    """anchor_id, positive_id, positive_score, negative_id, score: the first rows of the block for each positive."""
    ids, labels = batch["vec_id"].to_numpy(), batch["label"].to_numpy()
    positives = batch["positives"].to_pylist()
    tables = subset_sums(padded(batch["v"], width))
    parts: dict[tuple[int, int], list] = {(k, p): [] for k, own in enumerate(positives) for p in range(len(own))}
    for some, found in block.scored(tables):
        near_ids, near_labels = block.ids[some], block.labels[some]
        for k, own in enumerate(positives):
            score = found[:, k]
            bounds = [p["score"] for p in own]
            likely = (100 * score >= LEAST * min(bounds)) & (100 * score <= MOST * max(bounds)) & (near_labels != labels[k])
            likely = np.flatnonzero(likely)
            if len(likely):
                score, near = score[likely], near_ids[likely]
                for p, bound in enumerate(bounds):
                    held = (LEAST * bound <= 100 * score) & (100 * score <= MOST * bound)
                    if held.any():
                        parts[k, p].append(_best([(near[held], score[held])], NEGATIVES))
    out: tuple[list, ...] = ([], [], [], [], [])
    for (k, p), some in parts.items():
        if some:
            near, found = _best(some, NEGATIVES)
            for column, value in zip(out, (ids[k], positives[k][p]["vec_id"], positives[k][p]["score"])):
                column.extend([value] * len(near))
            out[3].extend(near)
            out[4].extend(found)
    return out


def _meeting(rows: DataFrame, anchors: DataFrame, blocks: int, width: int, of_block, schema: str) -> DataFrame:
    """Every block of candidates with every batch of anchors. Blocks come whole, before the anchors they meet."""
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")
    candidates = rows.select(block, F.lit(0).alias("asks"), "vec_id", "label", "v")
    # The anchors are the smaller side by far, so they are repeated, not the candidates.
    copies = anchors.withColumns({"block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "asks": F.lit(1)})
    both = candidates.unionByName(copies, allowMissingColumns=True)
    spread = both.repartitionById(blocks, "block").sortWithinPartitions("block", "asks")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        import pyarrow as pa

        held: list[pa.RecordBatch] = []
        current, whole = None, None
        for batch in batches:
            numbers, asks = batch["block"].to_numpy(), batch["asks"].to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(asks) != 0)) + 1
            bounds = [0, *cuts.tolist(), batch.num_rows]
            for start, end in zip(bounds, bounds[1:]):
                if numbers[start] != current:
                    current, held, whole = numbers[start], [], None
                part = batch.slice(start, end - start)
                if not asks[start]:
                    held.append(part)
                    continue
                if whole is None and held:
                    table = pa.Table.from_batches(held)
                    whole = Block(table["vec_id"].to_numpy(), table["label"].to_numpy(), padded(table["v"], width))
                    held = []
                if whole is not None:
                    found = of_block(whole, part, width)
                    if found[0]:
                        columns = [pa.array(np.asarray(c, np.int64)) for c in found]
                        yield pa.RecordBatch.from_arrays(columns, names)

    return spread.mapInArrow(run, schema)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Rows that repeat a
    vec_id count as one, the least by label and vector. Shorter vectors are filled up with zeros. An anchor without positives, and a
    positive without rows in its range, as with a score below zero, return nothing; an empty table returns no rows. Ties go
    to the smaller vec_id. Only vec_id, label and embedding are read. A component of 2**20 or more fails the job,
    as its scores would not fit a long.
    """
    spark = embeddings.sparkSession
    rows = materialise(prepared(embeddings), "integers")
    count, widest = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(GROUP, -(-(widest or 0) // GROUP) * GROUP)
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // BLOCK_ROWS))
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    found = _meeting(rows, anchors, blocks, width, _positives_of, "anchor_id long, vec_id long, score long")
    place = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    positives = found.withColumn("place", F.row_number().over(place)).where(F.col("place") <= POSITIVES)
    asked = materialise(
        positives.groupBy(F.col("anchor_id").alias("vec_id"))
        .agg(F.collect_list(F.struct(F.col("vec_id"), F.col("score"))).alias("positives"))
        .join(anchors, "vec_id"),
        "asked",
    )
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _meeting(rows, asked, blocks, width, _negatives_of, schema)
    place = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= NEGATIVES)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
