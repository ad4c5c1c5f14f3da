"""Near-duplicates by b-bit MinHash: banding for candidates, packed low bits for estimates, full sets for the proof.

Documents with equal shingle sets form a class, and one of each class goes on. Classes that share a band are candidates.
The low bits of all minima, packed into a few numbers, give an estimate of the similarity, corrected for
chance agreement. Only pairs whose estimate comes near the threshold are compared on their full sets.

No bucket is expanded into all its pairs. First every class is compared with the smallest of one of its buckets, the one
of the best estimate. Then what shares a bucket and is not yet connected is compared in blocks, in memory, by a
longer sketch and by a bound: a shingle that no other candidate has can't be common to two. Where a block has likely
partners, their full sets are sent there once, and only links that join two components of the block leave it, so
no step makes more rows than the blocks have members. Of a large component, which may hold a third of all rows, no
member is compared with another.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import map_columns
from martflow.llm.components import components
from martflow.llm.tokens import Cache
from martflow.workspace import materialise

WORDS = 5
# Linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS = 32
ROWS = 4
MINIMA = BANDS * ROWS
# Bits retained of each minimum. Two unequal minima agree in them by a chance of 1 in 2**BITS.
BITS = 4
PER_LONG = 64 // BITS
# Pairs whose estimate lies further below the threshold are not compared. Five standard deviations.
MARGIN = 0.2
# The longer sketch of the second round, and its margin of four and a half standard deviations.
LONG_MINIMA = 1024
LONG_MARGIN = 0.065
# Classes of one bucket compared at once with as many others, and shingles they may have together.
MEMBERS = 2000
BLOCK_SHINGLES = 2_000_000
# Shingles looked up at once.
COMPARED_AT_ONCE = 1_000_000
# A document of more shingles is worked through in blocks of so many.
BLOCK = 4096


class Shingler:
    """Sets of word shingles as sorted 64-bit numbers, and their sketches."""

    def __init__(self, words: int = WORDS):
        import xxhash

        random = np.random.default_rng(20260)
        self.words = words
        self.digest = xxhash.xxh3_128_digest
        self.whole = xxhash.xxh3_64_intdigest
        self.weights = random.integers(0, 2**64, words, np.uint64) | np.uint64(1)
        self.factors = random.integers(0, 2**32, MINIMA, np.uint32) | np.uint32(1)
        self.long_factors = random.integers(0, 2**32, LONG_MINIMA, np.uint32) | np.uint32(1)
        self.mixers = random.integers(0, 2**64, ROWS, np.uint64) | np.uint64(1)
        self.numbers = Cache(xxhash.xxh64_intdigest)

    def shingles(self, text: str | None) -> np.ndarray:
        """Distinct shingles of the whole text. bytes know only the white space and the case of ASCII."""
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.words:
            return np.array([self.whole(b" ".join(words), seed=len(words))], np.uint64)
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.uint64, len(words))
        count = len(words) - self.words + 1
        sums = np.zeros(count, np.uint64)
        for k, weight in enumerate(self.weights):
            sums += numbers[k : k + count] * weight
        sums ^= sums >> np.uint64(31)
        sums *= np.uint64(0x9E3779B97F4A7C15)
        sums ^= sums >> np.uint64(29)
        return np.unique(sums)

    def _minima(self, shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        minima = np.full(len(factors), 2**32 - 1, np.uint32)
        for at in range(0, len(short), BLOCK):
            products = short[at : at + BLOCK, None] * factors
            np.minimum(minima, products.min(axis=0), out=minima)
        return minima

    def _packed(self, minima: np.ndarray) -> np.ndarray:
        """The low bits of the minima."""
        low = (minima & np.uint32(2**BITS - 1)).astype(np.uint64).reshape(-1, PER_LONG)
        return (low << np.arange(0, 64, BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def sketch(self, shingles: np.ndarray) -> tuple[list[int], list[int]]:
        """Band keys, and the packed low bits of the minima."""
        minima = self._minima(shingles, self.factors)
        mixed = minima.reshape(BANDS, ROWS).astype(np.uint64) * self.mixers
        keys = np.bitwise_xor.reduce(mixed ^ (mixed >> np.uint64(29)), axis=1)
        keys = (keys + np.arange(BANDS, dtype=np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        return keys.view(np.int64).tolist(), self._packed(minima).view(np.int64).tolist()

    def long_sketch(self, shingles: np.ndarray) -> bytes:
        return self._packed(self._minima(shingles, self.long_factors)).tobytes()


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n, digest, bands, bits of every document; those without words have n = 0."""

    def start():
        shingler = Shingler()

        def apply(columns):
            out = {name: [] for name in ("doc_id", "n", "digest", "bands", "bits")}
            for doc, text in zip(columns["doc_id"], columns["text"]):
                found = shingler.shingles(text)
                bands, bits = shingler.sketch(found) if len(found) else ([], [])
                row = (doc, len(found), shingler.digest(found.tobytes()), bands, bits)
                for name, value in zip(out, row):
                    out[name].append(value)
            return out

        return apply

    schema = "doc_id long, n long, digest binary, bands array<long>, bits array<long>"
    return map_columns(docs.select("doc_id", "text"), schema, start)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed bits: the share of minima that agree, corrected for agreement by chance."""
    ones = F.lit(sum(1 << k for k in range(0, 64, BITS)))

    def differing(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        folded = bits
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(bits, k))
        return F.bit_count(folded.bitwiseAND(ones))

    differ = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda total, x: total + x)
    chance = 2.0**-BITS
    return ((1 - differ / F.lit(float(MINIMA))) - chance) / (1 - chance)


def _near_enough(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b, estimate of pairs whose sizes and estimates allow a link."""
    sides = classes.select("id", "n", "bits")
    left = sides.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    right = sides.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    both = pairs.join(left, "a").join(right, "b")
    sizes = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    return (
        both.where(sizes)
        .select("a", "b", estimate(F.col("bits_a"), F.col("bits_b")).alias("estimate"))
        .where(F.col("estimate") >= PERCENT / 100 - MARGIN)
    )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b of the pairs whose full sets reach the threshold."""

    def start():
        shingler = Shingler()
        # A class that is in many pairs comes up again and again.
        sets = Cache(shingler.shingles, 64)

        def apply(columns):
            out = {"a": [], "b": []}
            for a, b, one, two in zip(columns["a"], columns["b"], columns["text_a"], columns["text_b"]):
                one, two = sets[one], sets[two]
                common = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * common >= PERCENT * (len(one) + len(two) - common):
                    out["a"].append(a)
                    out["b"].append(b)
            return out

        return apply

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return map_columns(both, "a long, b long", start)


def link(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches, classes and verified links.

    Sketches: doc_id, n, digest of every row. Classes: digest, id (smallest doc_id), n. Links: a, b between ids.
    """
    stored = materialise(sketches(docs), "sketches")
    classes = materialise(
        stored.where("n > 0 and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits")),
        "classes",
    )
    held = classes.select("id", "n", F.explode("bands").alias("bucket"))
    shared = held.groupBy("bucket").agg(F.min("id").alias("b"), F.count("*").alias("size")).where("size > 1")
    members = materialise(held.join(shared.select("bucket", "b"), "bucket"), "members")
    star = members.where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    star = materialise(_near_enough(star, classes), "star")
    wanted = members.select("id").distinct()
    texts = materialise(
        docs.select(F.col("doc_id").alias("id"), "text").join(wanted, "id").dropDuplicates(["id"]), "texts"
    )
    # First each class with the likeliest of its candidates.
    best = star.groupBy("a").agg(F.max_by("b", F.struct("estimate", -F.col("b"))).alias("b"))
    links = materialise(_verified(best, texts), "links")
    labels = materialise(components(links), "labels")
    more = materialise(_apart(members, classes, labels, texts), "more-links")
    return stored, classes, links.unionByName(more)


def _apart(members: DataFrame, classes: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b of linked classes that share a bucket and were not connected yet, enough of them to connect all such."""
    labelled = members.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "id", "n", F.coalesce("component", "id").alias("component")
    )
    counts = labelled.groupBy("bucket", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    split = (
        counts.groupBy("bucket")
        .agg(
            F.count("*").alias("kinds"),
            F.max_by("component", "rows").alias("main"),
            F.max(F.struct("rows", "n")).alias("in_main"),
            F.sum("rows").alias("rows"),
            F.sum("n").alias("all_n"),
        )
        .where("kinds > 1")
    )
    apart = materialise(labelled.drop("n").join(split, "bucket"), "apart")
    wide = materialise(_wide(apart.select("id").distinct(), texts), "wide")
    details = materialise(_details(classes, wide), "details")
    in_main, n_main = F.col("in_main.rows"), F.col("in_main.n")
    # Blocks 0 to main_blocks - 1 hold the largest component of the bucket, the others follow.
    blocks = (
        apart.join(details, "id")
        .withColumn("main_blocks", _blocks(in_main, n_main))
        .withColumn("other_blocks", _blocks(F.col("rows") - in_main, F.col("all_n") - n_main))
        .withColumn("is_main", F.col("component") == F.col("main"))
        .withColumn(
            "own",
            F.when(F.col("is_main"), F.pmod(F.xxhash64("id"), F.col("main_blocks")))
            .otherwise(F.col("main_blocks") + F.pmod(F.xxhash64("id"), F.col("other_blocks")))
            .cast("int"),
        )
    )
    last = F.col("main_blocks") + F.col("other_blocks") - 1
    met = F.when(F.col("is_main"), F.sequence(F.col("main_blocks"), last)).otherwise(F.sequence(F.lit(0), last))
    paired = (
        blocks.withColumn("met", F.explode(met))
        .withColumn("low", F.least("own", "met"))
        .withColumn("high", F.greatest("own", "met"))
        .select("bucket", "low", "high", "own", "id", "component", "n", "shared", "bits", "bands")
    )
    # Full sets go only to the blocks where a member has a likely partner, once each.
    suspects = materialise(_by_block(paired, _suspects, paired.schema), "suspects")
    with_sets = suspects.join(wide.select("id", "shingles"), "id").select(*paired.columns, "shingles")
    return _by_block(with_sets, _links_of, "a long, b long")


def _blocks(rows: Column, shingles: Column) -> Column:
    """Blocks for so many rows with so many shingles."""
    return F.greatest(F.ceil(rows / MEMBERS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")


def _wide(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """id, bits (the longer sketch), shingles."""

    def start():
        shingler = Shingler()

        def apply(columns):
            sets = [shingler.shingles(text) for text in columns["text"]]
            return {
                "id": columns["id"],
                "bits": [shingler.long_sketch(s) for s in sets],
                "shingles": [s.view(np.int64) for s in sets],
            }

        return apply

    return map_columns(texts.join(ids, "id"), "id long, bits binary, shingles array<long>", start)


def _details(classes: DataFrame, wide: DataFrame) -> DataFrame:
    """id, n, shared (shingles that another of ``wide`` has as well), bits (the longer sketch), bands."""
    alone = (
        wide.select("id", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("rows"), F.min("id").alias("id"))
        .where("rows = 1")
        .groupBy("id")
        .agg(F.count("*").alias("alone"))
    )
    return (
        classes.select("id", "n", "bands").join(wide.select("id", "bits"), "id").join(alone, "id", "left")
        .select("id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"), "bits", "bands")
    )


def _by_block(paired: DataFrame, of_block, schema) -> DataFrame:
    """Apply a function of a table to the rows of every pair of blocks, which come together in one task."""
    keys = ["bucket", "low", "high"]
    spark = paired.sparkSession
    spread = paired.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)

    def run(batches):
        import pyarrow as pa

        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            key_columns = [np.asarray(batch.column(k)) for k in range(3)]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in key_columns], axis=0)) + 1
            bounds = [0, *changes.tolist(), batch.num_rows]
            for start, end in zip(bounds, bounds[1:]):
                key = tuple(c[start] for c in key_columns) if end > start else current
                if key != current and held:
                    yield from of_block(pa.Table.from_batches(held))
                    held = []
                current = key
                held.append(batch.slice(start, end - start))
        if held:
            yield from of_block(pa.Table.from_batches(held))

    return spread.mapInArrow(run, schema)


def _likely(table, label: np.ndarray):
    """For each row of the first block its likely partners that have another label just then, as row numbers."""
    own, high, low = (table[c].to_numpy() for c in ("own", "high", "low"))
    n, shared = (table[c].to_numpy() for c in ("n", "shared"))
    bits = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint64).reshape(len(n), -1)
    bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(n), -1)
    bucket = table["bucket"][0].as_py()
    within = low[0] == high[0]
    first, second = (np.arange(len(n)),) * 2 if within else (np.flatnonzero(own == low[0]), np.flatnonzero(own == high[0]))
    for i in first:
        j = second[second > i] if within else second
        j = j[label[j] != label[i]]
        j = j[100 * np.minimum(n[j], n[i]) >= PERCENT * np.maximum(n[j], n[i])]
        # 100 * common >= PERCENT * (n_i + n_j - common), and no more can be common than is shared with any.
        j = j[(100 + PERCENT) * np.minimum(shared[j], shared[i]) >= PERCENT * (n[j] + n[i])]
        for width, margin in ((MINIMA // PER_LONG, MARGIN), (LONG_MINIMA // PER_LONG, LONG_MARGIN)):
            if len(j):
                j = j[_estimates(bits[j, :width], bits[i, :width]) >= PERCENT / 100 - margin]
        # A pair that shares several buckets is compared in the first.
        same = bands[j] == bands[i]
        j = j[bands[i][same.argmax(axis=1)] == bucket]
        if len(j):
            yield i, j


def _suspects(table):
    """The rows that have a likely partner in the block."""
    found = np.zeros(table.num_rows, bool)
    for i, j in _likely(table, table["component"].to_numpy()):
        found[i] = True
        found[j] = True
    if found.any():
        yield from table.take(np.flatnonzero(found)).combine_chunks().to_batches()


def _links_of(table):
    """Links proved on full sets, each of which joins two components of the block: fewer than it has rows."""
    import pyarrow as pa

    ids, n, label = table["id"].to_numpy(), table["n"].to_numpy(), table["component"].to_numpy().copy()
    shingles = table["shingles"].combine_chunks()
    bounds, values = shingles.offsets.to_numpy(), shingles.values.to_numpy().view(np.uint64)
    sets = [values[a:b] for a, b in zip(bounds, bounds[1:])]
    links = []
    for i, partners in _likely(table, label):
        mine = sets[i]
        for some in np.split(partners, np.flatnonzero(np.diff(np.cumsum(n[partners]) // COMPARED_AT_ONCE)) + 1):
            some = some[label[some] != label[i]]
            if not len(some):
                continue
            theirs = np.concatenate([sets[j] for j in some])
            place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            starts = np.concatenate([[0], np.cumsum(n[some])[:-1]])
            common = np.add.reduceat((mine[place] == theirs).astype(np.int64), starts)
            for j in some[100 * common >= PERCENT * (n[i] + n[some] - common)]:
                if label[j] != label[i]:
                    links.append((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
                    label[label == label[j]] = label[i]
    if links:
        a, b = zip(*links)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _estimates(many: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Corrected similarity of packed bits, as ``estimate``, for one sketch and many others."""
    bits = many ^ one
    folded = bits.copy()
    for k in range(1, BITS):
        folded |= bits >> np.uint64(k)
    ones = np.uint64(sum(1 << k for k in range(0, 64, BITS)))
    differ = np.bitwise_count(folded & ones).sum(axis=1)
    chance = 2.0**-BITS
    return (1 - differ / (many.shape[1] * PER_LONG) - chance) / (1 - chance)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``.

    ASCII letters are taken in lower case; words stand between ASCII white space. A document's set holds its
    distinct shingles of five words, or all its words as one if they are fewer; a null text, or one without words, has none
    and is linked with nothing. Documents are linked at a similarity of 0.75, and ``component_id`` is the
    smallest doc_id that links lead to. Rows that repeat a doc_id share one decision; a row without one takes no part.
    An empty table gives an empty result. Only doc_id and text are read.
    """
    stored, classes, links = link(docs)
    labels = components(links)
    named = classes.select("digest", "id").join(labels.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("digest", F.coalesce("component", "id").alias("component"))
    # One row per digest on the right; a class of very many documents is split by the adaptive skew join.
    joined = stored.select("doc_id", "n", "digest").join(named, "digest", "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
