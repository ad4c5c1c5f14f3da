"""Packing of token sequences by patterns fitted with non-negative least squares.

Only the histogram of piece lengths reaches the driver: at most one number for each length up to the capacity. The
driver enumerates patterns of few lengths that fill a sequence, fits how often each repeats, rounds down, and packs
what is left by best fit, all on counts. Fits of several sizes are tried, the empty one included, and the one of
the fewest sequences is taken, so that no fit is worse than best fit alone. The result is a short table that says which ranks of a length go where;
Spark numbers the pieces of each length and looks their places up.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import map_columns, numbered
from martflow.llm.tokens import ByteLevelEncoder
from martflow.workspace import materialise

CAPACITY = 1024
# Patterns that a fit may use, most first; every pattern costs a few rows of the lookup table.
PATTERNS = (64, 32, 16, 8, 4, 0)
SEPARATOR = 2


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids of every document: its ids and the separator, cut only if too long.

    All pieces of a cut document are full but the first, which may be shorter. ``ids`` are little-endian
    unsigned 32-bit integers. A null or empty text is one piece that holds just the separator.
    """

    def start():
        encoder = ByteLevelEncoder(tokenizer)
        end = SEPARATOR.to_bytes(4, "little")

        def cut(columns):
            out = {name: [] for name in ("doc_id", "piece", "start", "length", "ids")}
            for doc, text in zip(columns["doc_id"], columns["text"]):
                ids = encoder.encode(text or "") + end
                total = len(ids) // 4
                at = 0
                for number in range(-(-total // capacity)):
                    to = min(total, capacity) if total <= capacity else (total - 1) % capacity + 1 + number * capacity
                    for name, value in zip(out, (doc, number, at, to - at, ids[4 * at : 4 * to])):
                        out[name].append(value)
                    at = to
            return out

        return cut

    return map_columns(
        docs.select("doc_id", "text"), "doc_id long, piece int, start long, length long, ids binary", start
    )


def candidate_patterns(lengths: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of one to three of the given lengths that fill a sequence to the end, longest length first.

    Long pieces are the hard ones to place, so where some pattern holds one of over half the capacity, all do.
    """
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    found = []
    for a in lengths:
        rest = int(capacity - a)
        if rest == 0:
            found.append((int(a),))
        elif rest <= a and there[rest]:
            found.append((int(a), rest))
        seconds = lengths[(lengths <= a) & (lengths < rest)]
        thirds = rest - seconds
        use = there[thirds] & (thirds <= seconds)
        found += [(int(a), int(b), int(c)) for b, c in zip(seconds[use], thirds[use])]
    return [p for p in found if p[0] > capacity // 2] or found


def fit_repeats(patterns: np.ndarray, wanted: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative least squares by active sets: indices of at most ``most`` patterns, and how often each repeats.

    ``patterns`` holds the lengths of each pattern, padded with 0; ``wanted`` how many pieces each length has.
    Misses count by the square of the length, as short pieces find a place anywhere.
    """
    weight = (np.arange(len(wanted)) / (len(wanted) - 1)) ** 2
    target = wanted * weight
    residual = target.copy()
    chosen: list[int] = []
    repeats = np.zeros(0)
    columns = np.zeros((len(target), 0))
    barred: set[int] = set()
    norm = np.sqrt((weight[patterns] ** 2).sum(axis=1))
    while len(chosen) < min(most, len(patterns)):
        gain = (weight * residual)[patterns].sum(axis=1) / norm
        gain[list(barred | set(chosen))] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 0.5:
            break
        chosen.append(best)
        column = np.bincount(patterns[best], minlength=len(target)) * weight
        columns = np.column_stack([columns, column])
        repeats = np.append(repeats, 0.0)
        while chosen:
            solved = np.linalg.lstsq(columns, target, rcond=None)[0]
            if solved.min() > 0:
                repeats = solved
                break
            # Step towards the solution until the first pattern reaches zero, and leave that one out.
            low = solved <= 0
            step = np.min(repeats[low] / np.maximum(repeats[low] - solved[low], 1e-12))
            repeats = repeats + step * (solved - repeats)
            keep = repeats > 1e-9
            if keep.all():
                keep[np.argmin(np.where(low, repeats, np.inf))] = False
            barred |= {c for c, k in zip(chosen, keep) if not k}
            chosen = [c for c, k in zip(chosen, keep) if k]
            columns, repeats = columns[:, keep], repeats[keep]
        residual = target - columns @ repeats
    return np.array(chosen, int), repeats


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack counts of lengths: the longest first, filled up with what leaves the least room. Patterns and repeats.

    Every step repeats until one of its lengths is used up, so there are no more steps than lengths.
    """
    left = counts.copy()
    steps = []
    lengths = np.flatnonzero(left)
    while len(lengths):
        pattern = [int(lengths[-1])]
        left[pattern[0]] -= 1
        room = capacity - pattern[0]
        while room:
            usable = np.flatnonzero(left[: room + 1])
            if not len(usable):
                break
            single = int(usable[-1])
            # Two lengths that together leave less room than the longest single one.
            partners = usable[np.searchsorted(usable, room - usable, side="right") - 1]
            sums = np.where(partners <= room - usable, usable + partners, 0)
            sums[(usable == partners) & (left[usable] < 2)] = 0
            pair = int(np.argmax(sums))
            take = [int(usable[pair]), int(partners[pair])] if sums[pair] > single else [single]
            for length in take:
                left[length] -= 1
            pattern += take
            room -= sum(take)
        used, needed = np.unique(pattern, return_counts=True)
        extra = int(np.min(left[used] // needed))
        left[used] -= extra * needed
        steps.append((tuple(sorted(pattern, reverse=True)), extra + 1))
        lengths = np.flatnonzero(left)
    return steps


def plan(counts: np.ndarray, capacity: int = CAPACITY, sizes: tuple[int, ...] = PATTERNS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and repeats that pack all pieces, of the first of the fits that takes the fewest sequences.

    ``counts[l]`` pieces have length ``l``. A fit of size 0 is best fit alone.
    """
    listed = candidate_patterns(np.flatnonzero(counts[:capacity]), capacity)
    plans = [_fitted(counts, capacity, listed, most) for most in sizes]
    return min(plans, key=lambda steps: sum(times for _, times in steps))


def _fitted(
    counts: np.ndarray, capacity: int, listed: list[tuple[int, ...]], most: int
) -> list[tuple[tuple[int, ...], int]]:
    """The plan of a fit of at most ``most`` patterns, with the residuals packed by best fit."""
    left = counts.copy()
    steps = []
    if left[capacity]:
        steps.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    if listed and most:
        padded = np.zeros((len(listed), 3), int)
        for row, pattern in zip(padded, listed):
            row[: len(pattern)] = pattern
        chosen, repeats = fit_repeats(padded, left, most)
        for index in np.argsort(-repeats, kind="stable"):
            pattern = listed[chosen[index]]
            used, needed = np.unique(pattern, return_counts=True)
            times = int(min(np.floor(repeats[index] + 1e-6), np.min(left[used] // needed)))
            if times > 0:
                left[used] -= times * needed
                steps.append((pattern, times))
    return steps + best_fit(left, capacity)


def places(steps: list[tuple[tuple[int, ...], int]], counts: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, repeats, first sequence, offset): where the ranks of a length go.

    Ranks count all pieces in order of length. Of a range, rank ``first + j * repeats + i`` goes to the i-th
    sequence, at ``offset + j * length``.
    """
    rank = np.concatenate([[0], np.cumsum(counts)[:-1]])
    rows, sequence = [], 0
    for pattern, times in steps:
        offset = 0
        for length, copies in zip(*np.unique(pattern, return_counts=True)):
            length, copies = int(length), int(copies)
            first = int(rank[length])
            rows.append((length, first, first + copies * times, times, sequence, offset))
            rank[length] += copies * times
            offset += copies * length
        sequence += times
    return rows


def pack(cut: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces that have a ``length`` of 1 to ``capacity``.

    ``order`` names columns that settle which of several pieces of one length comes first. Pieces may repeat;
    each gets a place. An empty table gives an empty result.
    """
    spark = cut.sparkSession
    stored = materialise(cut, "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in stored.groupBy("length").count().collect():  # one row for each length up to the capacity
        counts[row["length"]] = row["count"]
    rows = places(plan(counts, capacity), counts)
    schema = "_length long, _first long, _end long, _times long, _sequence long, _offset long"
    table = F.broadcast(spark.createDataFrame(rows, schema))
    ranked = numbered(stored, ["length", *order], "_rank", "pieces-in-order")
    here = F.col("_rank") - F.col("_first")
    found = ranked.join(
        table,
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")),
    )
    return (
        found.withColumn("sequence_id", F.col("_sequence") + here % F.col("_times"))
        .withColumn("offset", F.col("_offset") + F.floor(here / F.col("_times")) * F.col("length"))
        .select(*cut.columns, "sequence_id", "offset")
    )


def sequences(cut: DataFrame, packed: DataFrame) -> DataFrame:
    """The packed token sequences: sequence_id, ids, from pieces with their ids and their places.

    A sequence holds no more than the capacity, so a group is small. Pieces must be told apart by doc_id and piece.
    """
    placed = cut.join(packed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
