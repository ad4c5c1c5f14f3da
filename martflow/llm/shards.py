"""Shards along a Hilbert curve over several metadata dimensions. DataFrame functions only.

Each dimension is quantised to 32 cells; the cells' place on the curve orders the rows, and equal runs of that order
become the shards. Neighbours on the curve are neighbours in every dimension, so a shard covers a small box, and
the manifest of the boxes tells which shards a filter on any of the dimensions can skip.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import numbered
from martflow.workspace import materialise

BITS = 5
CELLS = 1 << BITS
SHARDS = 40


@lru_cache
def curve_steps(dimensions: int) -> list[int]:
    """The curve as a state machine: entry ``state * 2**dimensions + corner`` holds next state and digit.

    A state is the corner where the curve enters a cube and the axis it leaves along.
    """
    n, corners = dimensions, 1 << dimensions

    def turn(value: int, by: int) -> int:
        by %= n
        return ((value << by) | (value >> (n - by))) & (corners - 1)

    gray = [w ^ (w >> 1) for w in range(corners)]
    place = {g: w for w, g in enumerate(gray)}
    trailing_ones = [next(k for k in range(n + 1) if not w >> k & 1) for w in range(corners)]
    entry = [0 if w == 0 else gray[2 * ((w - 1) // 2)] for w in range(corners)]
    axis = [0 if w == 0 else trailing_ones[w - 1 if w % 2 == 0 else w] % n for w in range(corners)]
    steps = []
    for state in range(corners * n):
        enters, along = divmod(state, n)
        for corner in range(corners):
            digit = place[turn(corner ^ enters, n - (along + 1))]
            next_enters = enters ^ turn(entry[digit], along + 1)
            next_along = (along + axis[digit] + 1) % n
            steps.append((next_enters * n + next_along) * corners + digit)
    return steps


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a point with ``bits`` bits in each dimension."""
    n, corners = len(cells), 1 << len(cells)
    table = F.lit(curve_steps(n))
    state, index = F.lit(0), F.lit(0).cast("long")
    for level in reversed(range(bits)):
        corner = F.lit(0)
        for d, cell in enumerate(cells):
            corner = corner + F.shiftright(cell, level).bitwiseAND(F.lit(1)) * (1 << d)
        step = F.element_at(table, (state * corners + corner + 1).cast("int"))
        index = index * corners + step % corners
        state = F.floor(step / corners)
    return index


def name_cell(column: Column) -> Column:
    """Cell of a name: equal names share one. A missing name counts as empty."""
    return (F.crc32(F.coalesce(column, F.lit("")).cast("binary")) % CELLS).cast("int")


def size_cell(size: Column) -> Column:
    """Cell of a size in bytes: one for each doubling."""
    return (F.length(F.bin(size)) - 1).cast("int")


def shards(docs: DataFrame, count: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, and the cells and curve index.

    The law is ``rows``: the counts of two shards differ by one at most. Rows with equal cells follow one
    another by doc_id (null first) and checksum; repeated rows keep one slot each. A null text counts as empty,
    null lang and source as the empty name. An empty table gives an empty result, and only the columns named
    here are read. Equal texts share a shard only where the order puts them together, as the law asks for counts.
    """
    content = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id"),
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        name_cell(F.col("lang")).alias("lang_cell"),
        name_cell(F.col("source")).alias("source_cell"),
    ).withColumn("size_cell", size_cell(F.col("size")))
    placed = narrow.withColumn("curve", curve_index([F.col("lang_cell"), F.col("source_cell"), F.col("size_cell")]))
    stored = materialise(placed, "curve")
    rows = max(1, stored.count())
    ranked = numbered(stored, ["curve", "doc_id", "text_crc32"], "_rank", "curve-order")
    shard = F.expr(f"(_rank * {count}) div {rows}")
    first = F.expr(f"(shard * {rows} + {count - 1}) div {count}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_rank") - first)
        .withColumn("law", F.lit("rows"))
        .drop("_rank")
    )


def manifest(placed: DataFrame) -> DataFrame:
    """Rows, bytes and the box of each shard, for skipping files."""
    boxes = [f(F.col(c)).alias(f"{f.__name__}_{c}") for c in ("lang_cell", "source_cell", "size_cell") for f in (F.min, F.max)]
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *boxes)


def shards_for(boxes: DataFrame, lang: str | None = None, source: str | None = None) -> DataFrame:
    """The shards of a manifest that may hold rows of a language, a source, or both."""
    for name, value in (("lang_cell", lang), ("source_cell", source)):
        if value is not None:
            boxes = boxes.where(name_cell(F.lit(value)).between(F.col(f"min_{name}"), F.col(f"max_{name}")))
    return boxes
