"""Packing of documents into sequences of fixed capacity, planned on a histogram.

Lengths are whole numbers up to the capacity, so the packing of any number of
documents is planned from the counts of documents per length: a table of at most
``capacity`` rows, whatever the input.  A plan is a list of patterns, each a
bin's lengths and how many bins are filled so.  Documents then find their places
by their rank among those of their length, without passing through one task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

Plan = list[tuple[tuple[int, ...], int]]


class SegmentTree:
    """Least capacity, at or above a wanted one, with an open bin."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, has_bins: bool) -> None:
        node = self.leaves + capacity
        self.open[node] = has_bins
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def least(self, wanted: int) -> int | None:
        node = self.leaves + wanted
        while not self.open[node]:
            while node & 1:  # a right child: nothing further right below this parent
                node //= 2
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit-decreasing over counts: whole groups of equal bins move at once.

    A document goes to the open bin with the least capacity that holds it.  That
    bin keeps being the best one for documents of this length until it is full
    for them, so ``capacity // length`` of them go there before the next bin.
    """
    tree = SegmentTree(capacity)
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(left: int, pattern: tuple[int, ...], number: int) -> None:
        if number:
            bins.setdefault(left, []).append((pattern, number))
            tree.set(left, True)

    for length in sorted(counts, reverse=True):
        rest = counts[length]
        while rest:
            left = tree.least(length)
            if left is None:
                left, pattern, number = capacity, (), rest
            else:
                pattern, number = bins[left].pop()
                if not bins[left]:
                    tree.set(left, False)
            fit = left // length
            full = min(number, rest // fit)
            rest -= full * fit
            put(left - fit * length, pattern + (length,) * fit, full)
            number -= full
            if rest and number:  # fewer than ``fit`` remain, or bins are used up
                if rest < fit:
                    put(left - rest * length, pattern + (length,) * rest, 1)
                    number, rest = number - 1, 0
            if pattern or left < capacity:
                put(left, pattern, number)
    return [group for groups in bins.values() for group in groups]


def best_two_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-two-fit over counts.

    A bin is filled greedily with the longest document that fits.  Then its
    smallest document is taken out, if two unpacked ones fit the gap so widened
    more tightly.  The same bin is made again while its documents last.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, number in counts.items():
        left[length] = number
    plan: Plan = []
    lengths = np.flatnonzero(left)
    while len(lengths):
        gap, greedy = capacity, Counter()
        at = len(lengths) - 1
        while gap > 0 and at >= 0:
            at = int(np.searchsorted(lengths[: at + 1], gap, side="right")) - 1
            if at < 0:
                break
            length = int(lengths[at])
            n = min(int(left[length]), gap // length)
            greedy[length] = n
            gap -= n * length
            at -= 1
        final = greedy
        if gap and sum(greedy.values()) > 1:
            smallest = min(greedy)
            pair = _best_pair(left, lengths, greedy, gap + smallest)
            if pair and sum(pair) > smallest:
                final = greedy - Counter([smallest]) + Counter(pair)
        # How often: every copy needs the greedy documents and the pair at hand.
        times = min(
            (int(left[x]) - max(n, greedy[x])) // n + 1 for x, n in final.items()
        )
        for x, n in final.items():
            left[x] -= n * times
        plan.append((tuple(sorted(final.elements(), reverse=True)), times))
        lengths = lengths[left[lengths] > 0]
    return plan


def _best_pair(left: np.ndarray, lengths: np.ndarray, used: Counter, room: int) -> tuple[int, int] | None:
    """Two unpacked documents whose lengths come closest to ``room`` from below."""
    spare = left[lengths].copy()
    for x, n in used.items():
        spare[np.searchsorted(lengths, x)] -= n
    some = spare > 0
    free, spare = lengths[some], spare[some]
    first = free[free < room]
    if not len(first):
        return None
    at = np.searchsorted(free, np.minimum(first, room - first), side="right") - 1
    same = (at >= 0) & (free[at] == first) & (spare[at] < 2)
    at = at - same
    ok = at >= 0
    if not ok.any():
        return None
    sums = np.where(ok, first + free[at], 0)
    best = int(np.argmax(sums))
    return int(first[best]), int(free[at[best]])


class Places:
    """Bin and offset of the r-th document of each length, under a plan."""

    def __init__(self, plan: Plan):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        bins = 0
        for pattern, number in plan:
            at = 0
            for length, each in sorted(Counter(pattern).items(), reverse=True):
                rows.setdefault(length, []).append((number * each, each, bins, at))
                at += length * each
            bins += number
        self.bins = bins
        self.by_length = {}
        for length, found in rows.items():
            table = np.array(found, np.int64)
            self.by_length[length] = (np.cumsum(table[:, 0]) - table[:, 0], table)

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bins and offsets for lengths and ranks counted from 0."""
        bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order])) + 1
        for part in np.split(order, edges):
            if len(part):
                length = int(lengths[part[0]])
                starts, table = self.by_length[length]
                row = np.searchsorted(starts, ranks[part], side="right") - 1
                slot = ranks[part] - starts[row]
                bins[part] = table[row, 2] + slot // table[row, 1]
                offsets[part] = table[row, 3] + slot % table[row, 1] * length
        return bins, offsets


def place(pieces: DataFrame, order: list[str], counts: dict[int, int], plan: Plan) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id`` and ``offset``.

    The rank of a piece among those of its length is its rank in one of about
    sqrt(n) hash groups plus the sizes of the groups before, so neither a length
    that most pieces have nor the number of groups gathers in one task.
    """
    spark = pieces.sparkSession
    groups = max(1, math.isqrt(sum(counts.values())))
    cast = pieces.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(groups)).cast("int"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cast.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("length", "_group").orderBy(*order)
    ranked = (
        cast.withColumn("_rank", F.row_number().over(within) - 1)
        .join(starts, ["length", "_group"])
        .withColumn("_rank", (F.col("_rank") + F.col("_start")).cast("long"))
    )
    names = [c for c in pieces.columns]
    places = spark.sparkContext.broadcast(Places(plan))
    schema = ranked.select(*names, F.col("_rank").alias("sequence_id"), F.col("_rank").alias("offset")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            bins, offsets = places.value.find(lengths, batch.column("_rank").to_numpy(zero_copy_only=False))
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(bins), pa.array(offsets)], names=[*names, "sequence_id", "offset"]
            )

    return ranked.select(*names, "_rank").mapInArrow(run, schema)


def length_counts(pieces: DataFrame) -> dict[int, int]:
    """Pieces per length: at most one row per length up to the capacity."""
    return {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
