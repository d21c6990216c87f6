"""Linked tools of an equipment sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import parse_date
from ..operators.columns import quoted
from ..operators.reshape import unpivot

ID_COLUMNS = ["T1 Supplier Name", "Entity", "SSEID", "T1 Site", "Tool Quantity"]


def linked_tools(sheet: DataFrame) -> DataFrame:
    """One row per linked tool with its exit forecast and tender date.

    Two unpivots meet in a full outer join whose keys match null to null, as
    in pandas.  Rows stay where the tool's number fits the quantity (one if
    blank) or either date is given.
    """

    def long(prefix: str, value: str) -> DataFrame:
        columns = [c for c in sheet.columns if prefix in c]
        rows = unpivot(sheet, ID_COLUMNS, columns, "LinkedTool", value)
        return rows.withColumn("LinkedTool", F.split("LinkedTool", "_")[1])

    keys = [*ID_COLUMNS, "LinkedTool"]
    left, right = long("T2ExFD_Tool", "T2ExFD"), long("T2TD_Tool", "T2TD")
    right = right.withColumnsRenamed({k: f"_r {k}" for k in keys})
    same = None
    for k in keys:
        term = F.col(quoted(k)).eqNullSafe(F.col(quoted(f"_r {k}")))
        same = term if same is None else same & term
    both = left.join(right, same, "outer").select(
        *[F.coalesce(quoted(k), quoted(f"_r {k}")).alias(k) for k in keys], "T2ExFD", "T2TD"
    )
    number = F.right("LinkedTool", F.lit(1)).try_cast("int")
    fits = F.coalesce(F.col("`Tool Quantity`"), F.lit(1)) >= number
    kept = both.filter(fits | F.col("T2ExFD").isNotNull() | F.col("T2TD").isNotNull())
    day = {c: parse_date(c, ["MM/dd/yyyy"], min_year=2000) for c in ("T2ExFD", "T2TD")}
    return kept.drop("Tool Quantity").withColumns(day)
