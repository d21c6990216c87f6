"""Cells that hold several ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .columns import quoted


def names_for_ids(
    df: DataFrame, keys: Sequence[str], ids: str, people: DataFrame, person_id: str, person: str, name: str, sep: str = "; "
) -> DataFrame:
    """Replace ids joined in a cell by names joined in the same order.

    A cell with an unknown id becomes null.  ``keys`` identify a row, so a
    group regathered here is one cell.
    """
    parts = df.select(
        *[quoted(k) for k in keys], F.posexplode(F.split(F.col(quoted(ids)), sep)).alias("_pos", "_id")
    )
    known = people.select(F.col(person_id).cast("string").alias("_person"), F.col(person).alias("_name"))
    named = parts.join(known, F.col("_id") == F.col("_person"), "left")
    cells = named.groupBy(*[quoted(k) for k in keys]).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_name"))).alias("_cells")
    )
    text = F.array_join(F.transform("_cells", lambda c: c["_name"]), sep)
    complete = F.forall("_cells", lambda c: c["_name"].isNotNull())
    return cells.select(*[quoted(k) for k in keys], F.when(complete, text).alias(name))
