"""Exact quantiles of many columns at once, by radix selection.

A double becomes a 64-bit key in the same order.  Each pass reads the table once
and counts, for all columns and all ranks still open, the next 16 bits of the keys
that begin with a rank's bits; the digit that holds the rank is added to them.
Four passes find every value exactly, whatever the values, the number of columns
or of ranks, and no task holds more than the digit tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .columns import quoted

DIGIT = 16
PASSES = 64 // DIGIT
TOP = np.uint64(1 << 63)


def ordered_keys(values: np.ndarray) -> np.ndarray:
    """Unsigned keys in the order of the doubles; both zeros have one key."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & TOP, ~bits, bits | TOP)


def value_of(key: int) -> float:
    """The double of a key."""
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.uint64(bits).view(np.float64))


def _digit_counts(df: DataFrame, columns: Sequence[str], open_: dict[int, list[int]], step: int) -> DataFrame:
    """Counts of the next digit by column and the digits before it (``prefix``, as a signed number)."""
    shift = np.uint64(64 - DIGIT * (step + 1))
    wanted = {c: np.array(sorted(p), np.uint64) for c, p in open_.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {c: np.zeros((len(p), 1 << DIGIT), np.int64) for c, p in wanted.items()}
        for batch in batches:
            for c, prefixes in wanted.items():
                values = batch.column(c).drop_null().to_numpy(zero_copy_only=False)
                keys = ordered_keys(values[~np.isnan(values)])
                digits = keys >> shift
                before = digits >> np.uint64(DIGIT) if step else np.zeros(len(keys), np.uint64)
                at = np.minimum(np.searchsorted(prefixes, before), len(prefixes) - 1)
                own = prefixes[at] == before
                digit = (digits[own] & np.uint64((1 << DIGIT) - 1)).astype(np.int64)
                tables[c] += np.bincount(at[own] * (1 << DIGIT) + digit, minlength=tables[c].size).reshape(tables[c].shape)
        for c, table in tables.items():
            row, digit = np.nonzero(table)
            columns = [
                pa.array(np.full(len(row), c, np.int32)), pa.array(wanted[c][row].view(np.int64)),
                pa.array(digit.astype(np.int32)), pa.array(table[row, digit]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["column", "prefix", "digit", "n"])

    cells = df.select(*[F.col(quoted(c)).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    counted = cells.mapInArrow(run, "column int, prefix long, digit int, n long")
    return counted.groupBy("column", "prefix", "digit").agg(F.sum("n").alias("n"))


def values_at_ranks(df: DataFrame, columns: Sequence[str], ranks: Mapping[int, Sequence[int]] | None = None, of_count=None):
    """Count of each column's numbers, and the values of the wanted ranks (from zero).

    ``of_count`` gives the ranks of a column from its number and count; nulls and
    NaN are no numbers.  Returns ``[(count, {rank: value}), ...]``.
    """
    open_ = {i: [0] for i in range(len(columns))}
    counts: list[int] = [0] * len(columns)
    # For every column: rank -> (prefix, rank among those with that prefix).
    places: list[dict[int, tuple[int, int]]] = [{} for _ in columns]
    for step in range(PASSES):
        if not open_:
            break
        table = _digit_counts(df, columns, open_, step)
        order = Window.partitionBy("column", "prefix").orderBy("digit")  # at most 2^16 rows
        ends = table.withColumn("end", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        if step == 0:
            totals = table.groupBy("column").agg(F.sum("n").alias("n")).collect()  # one row per column
            for r in totals:
                counts[r["column"]] = r["n"]
            for i, n in enumerate(counts):
                places[i] = {r: (0, r) for r in (of_count(i, n) if n else [])}
        signed = lambda p: p - (1 << 64) if p >> 63 else p
        asked = [(i, signed(p), r) for i, own in enumerate(places) for p, r in set(own.values())]
        if not asked:
            break
        wanted = df.sparkSession.createDataFrame(asked, "column int, prefix long, rank long")
        hit = (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))
        found = ends.join(F.broadcast(wanted), ["column", "prefix"]).filter(hit)  # one row per rank
        digit = {(r["column"], r["prefix"], r["rank"]): (r["digit"], r["rank"] - r["end"] + r["n"]) for r in found.collect()}
        for i, own in enumerate(places):
            for rank, (prefix, within) in own.items():
                d, left = digit[i, signed(prefix), within]
                own[rank] = ((prefix << DIGIT) | d, left)
        open_ = {i: sorted({p for p, _ in own.values()}) for i, own in enumerate(places) if own}
    return [(n, {r: value_of(p) for r, (p, _) in own.items()}) for n, own in zip(counts, places, strict=True)]


def quantiles_of(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles of numeric columns; null and NaN are skipped."""
    columns = list(wanted)

    def ranks(i: int, n: int) -> list[int]:
        places = [p * (n - 1) for p in wanted[columns[i]]]
        return sorted({math.floor(at) for at in places} | {math.ceil(at) for at in places})

    out: dict[str, list[float | None]] = {}
    for column, (n, found) in zip(columns, values_at_ranks(df, columns, of_count=ranks), strict=True):
        places = [p * (n - 1) for p in wanted[column]]
        out[column] = [
            found[math.floor(at)] + (found[math.ceil(at)] - found[math.floor(at)]) * (at - math.floor(at)) if n else None
            for at in places
        ]
    return out
