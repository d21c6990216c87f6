"""Market sheets: sectioned forecasts, process mixes and price tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_
import re

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import quarter_label
from ..functions.numbers import density_gigabytes, to_number
from ..functions.text import memory_name_parts
from ..operators.columns import drop_null_columns, quoted
from ..operators.reshape import unpivot
from ..operators.rows import drop_footer, forward_fill, section_rows

QUARTER_COLUMN = r"^Q\d-\d+$"
YEAR_COLUMN = r"^20\d\d$"
STOP = "Total"


def section_measures(
    sheet: DataFrame,
    label: str,
    start: str,
    measure: str,
    upload_date: date,
    active_first: bool,
    columns: str = QUARTER_COLUMN,
    scale: float = 1_000_000.0,
    section_names: Mapping[int, str] | None = None,
    position: str = "row_pos",
    by: Sequence[str] = (),
) -> DataFrame:
    """Long form of a sheet whose sections run from ``start`` to ``Total``.

    ``by`` names the file of a row, for several sheets in one frame.

    Period columns are found by name; cells that are no number become null.
    With ``section_names`` the running number of a section becomes its name.
    """
    periods = [c for c in sheet.columns if re.search(columns, c)]
    cells = sheet.select(position, *[quoted(c) for c in [*by, label, *periods]])
    body = section_rows(cells, label, start, STOP, active_first, position, by=by)
    long = unpivot(body, [*by, "section", label], periods, "period", measure)
    period = quarter_label("period") if columns == QUARTER_COLUMN else F.col("period")
    out = long.select(
        *[quoted(c) for c in by],
        "section",
        F.col(quoted(label)).alias("row_item"),
        period.alias("period"),
        (to_number(measure) * F.lit(scale)).alias(measure),
        F.lit(upload_date).alias("upload_dt"),
    )
    if section_names is None:
        return out.drop("section")
    names = F.create_map(*[x for k, v in section_names.items() for x in (F.lit(k).cast("long"), F.lit(v))])
    return out.withColumn("type", F.try_element_at(names, F.col("section"))).drop("section")


def process_mix(
    sheet: DataFrame,
    label: str,
    first: str,
    second: str,
    ignored: str,
    upload_date: date,
    position: str = "row_pos",
    by: Sequence[str] = (),
) -> DataFrame:
    """Two blocks of a sheet side by side, matched on row item and quarter.

    Rows up to the ``second`` marker are shares of wafers, rows after it shares
    of bits; the ``ignored`` row belongs to neither.
    """
    periods = [c for c in sheet.columns if re.search(QUARTER_COLUMN, c)]
    text = F.col(quoted(label))
    blocks = sheet.filter(text.isNotNull() & (text != ignored)).withColumn(
        "block", F.when(text == first, "wafer").when(text == second, "bit")
    )
    body = forward_fill(blocks, ["block"], position, by).filter(~text.isin(first, second))
    long = unpivot(body, [*by, "block", label], periods, "quarter", "share")
    share = to_number("share")
    return (
        long.groupBy(*[F.col(quoted(c)) for c in by], F.col(quoted(label)).alias("process"), quarter_label("quarter").alias("quarter"))
        .agg(
            F.max(F.when(F.coalesce("block", F.lit("wafer")) == "wafer", share)).alias("pct_wafer"),
            F.max(F.when(F.col("block") == "bit", share)).alias("pct_bit"),
        )
        .withColumn("upload_dt", F.lit(upload_date))
    )


def price_table(
    sheet: DataFrame,
    year: str,
    month: str,
    source: str,
    upload_date: date,
    footer_rows: int = 3,
    position: str = "row_pos",
    by: Sequence[str] = (),
) -> DataFrame:
    """Prices from a sheet with ``product|measure`` columns and one row per month.

    Blank columns and the footer go, the year is carried down, rows whose month
    is no three-letter name drop, and product names are taken apart.  With ``by``
    each file has its own footer, years and blank columns.
    """
    full = drop_null_columns(sheet)
    body = drop_footer(full, footer_rows, position, by)
    body = forward_fill(body, [year], position, by).filter(F.length(quoted(month)) == 3)
    when = F.to_date(F.try_to_timestamp(F.concat_ws(" ", quoted(month), quoted(year)), F.lit("MMM yyyy")))
    prices = [c for c in body.columns if "|" in c]
    long = unpivot(body.withColumn("forecast_dt", when), [*by, "forecast_dt"], prices, "_column", "_price")
    if by:
        cells = full.groupBy(*[quoted(c) for c in by]).agg(*[F.count(quoted(c)).alias(c) for c in prices])
        filled = unpivot(cells, by, prices, "_filled", "_n").filter("_n > 0")
        filled = filled.select(*[F.col(quoted(c)).alias(f"_key_{i}") for i, c in enumerate(by)], "_filled")
        same = reduce(and_, [F.col(quoted(c)).eqNullSafe(F.col(f"_key_{i}")) for i, c in enumerate(by)])
        long = long.join(filled, same & (F.col("_column") == F.col("_filled")), "left_semi")
    product, parts = F.split("_column", r"\|"), F.col("_parts")
    return (
        long.withColumn("_parts", memory_name_parts(product[0]))
        .select(
            *[quoted(c) for c in by],
            F.lit(source).alias("source"),
            F.lit(upload_date).alias("upload_dt"),
            F.replace(F.replace(product[0], F.lit("SO/DIMM"), F.lit("SODIMM")), F.lit("LR/RDIMM"), F.lit("LRDIMM")).alias("memory_full"),
            parts["tech"].alias("memory_tech"),
            parts["tech2"].alias("memory_tech2"),
            density_gigabytes(F.split(product[0], " ")[0]).alias("density_gb"),
            parts["width"].alias("width"),
            product[1].alias("price_type"),
            "forecast_dt",
            to_number("_price").alias("price"),
        )
        .filter(F.col("forecast_dt").isNotNull())
    )
