"""Delimited text: plain CSV, sheets with preambles, two-row headers."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.text import na_to_null
from ..session import known_size
from .records_in_text import quoted_records


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
    null_value: str | None = None,
    modified_after: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a declared schema, so no pass is spent on inference.

    ``modified_after`` skips files not touched since the last load.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("quote", quote).option("header", header)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.option("multiLine", multi_line).csv(path)


def numbered_lines(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """Lines with their file and their number in it, from zero.

    Files carry no line numbers.  Lines of one file block sit together in one
    task, so a count per block (one small row each) and the blocks before it
    give the number without sorting any lines.
    """
    reader = spark.read if modified_after is None else spark.read.option("modifiedAfter", modified_after)
    lines = reader.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    blocks = lines.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "_block", "_first", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    starts = known_size(starts)
    # The files are read twice: a number outside its block shows that they changed in between.
    within = F.col("_id") - F.col("_first")
    changed = F.raise_error(F.concat(F.col("file"), F.lit(" changed while it was read")))
    number = F.when((within >= 0) & (within < F.col("_n")), F.col("_before") + within).otherwise(changed)
    return lines.join(starts, ["file", "_block"], "left").select("file", number.cast("long").alias("row_pos"), "line")


def _header_cells(line: str, sep: str, quote: str) -> list[str]:
    cells = next(csv.reader([line], delimiter=sep, quotechar=quote), [])
    return [" ".join(cell.split()) for cell in cells]


def header_names(lines: Sequence[str], sep: str = ",", quote: str = '"') -> list[str]:
    """Column names from one header row, or two joined as ``group|measure``; a repeated name gets a number."""
    parts = [_header_cells(line, sep, quote) for line in lines]
    if len(parts) == 1:
        names = [name or f"Unnamed: {i}" for i, name in enumerate(parts[0])]
    else:
        groups, last = [], ""
        for cell in parts[0]:
            last = cell or last
            groups.append(last)
        groups += [last] * (len(parts[1]) - len(groups))
        names = [f"{g}|{m}" if g else m for g, m in zip(groups, parts[1])]
    seen: dict[str, int] = {}
    out = []
    for name in names:
        out.append(f"{name}.{seen[name]}" if name in seen else name)
        seen[name] = seen.get(name, 0) + 1
    return out


def sheet_layouts(
    records: DataFrame, header_row: int | Sequence[int], sep: str = ",", quote: str = '"'
) -> tuple[list[list[str]], DataFrame]:
    """The different headers of a folder's files, and the number of its header (``layout``) for each file.

    One row per layout reaches the driver, not one per file.
    """
    wanted = [header_row] if isinstance(header_row, int) else list(header_row)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("row_pos", "line"))), lambda r: r["line"])
    heads = known_size(records.filter(F.col("row_pos").isin(wanted)).groupBy("file").agg(lines.alias("lines")))
    found = heads.filter(F.size("lines") == len(wanted)).groupBy("lines").agg(F.min("file").alias("first")).orderBy("first").collect()
    numbered = heads.sparkSession.createDataFrame([(r["lines"], i) for i, r in enumerate(found)], "lines array<string>, layout int")
    return [header_names(r["lines"], sep, quote) for r in found], heads.join(numbered, "lines").select("file", "layout")


def read_sheet(
    spark: SparkSession,
    path: str,
    header_row: int | Sequence[int] | None = 0,
    names: Sequence[str] | None = None,
    na_values: Sequence[str] = (),
    keep_default_na: bool = True,
    sep: str = ",",
    modified_after: str | None = None,
    quote: str = '"',
) -> DataFrame:
    """A sheet landed as delimited text: text columns plus ``file`` and ``row_pos``.

    ``row_pos`` counts a file's data rows from zero.  Missing-value tokens become
    null.  Rows above the header drop.  Quoted cells may span lines.  Every file of
    a folder has its own header: columns are matched by name, in the order of the
    first file, and those a file lacks are null.
    """
    records = quoted_records(spark, path, sep, quote, modified_after)
    if header_row is None:
        first = 0
        if names is None:
            raise ValueError("a sheet without header needs names")
    else:
        first = (header_row if isinstance(header_row, int) else max(header_row)) + 1
    rows = records.filter(F.col("row_pos") >= first)
    if names is not None:
        layouts, rows = [list(names)], rows.withColumn("layout", F.lit(0))
    else:
        layouts, by_file = sheet_layouts(records, header_row, sep, quote)
        rows = rows.join(known_size(by_file), "file") if len(layouts) > 1 else rows.withColumn("layout", F.lit(0))
    columns = list(dict.fromkeys(n for layout in layouts for n in layout))
    options = {"sep": sep, "quote": quote, "escape": quote}
    parsed = [
        F.when(F.col("layout") == k, F.from_csv("line", ", ".join(f"c{i} string" for i in range(len(layout))), options)).alias(f"r{k}")
        for k, layout in enumerate(layouts)
    ]
    rows = rows.select("file", (F.col("row_pos") - first).alias("row_pos"), *parsed)
    cells = [F.coalesce(*[F.col(f"r{k}.c{layout.index(n)}") for k, layout in enumerate(layouts) if n in layout]) for n in columns]
    return rows.select("file", "row_pos", *[na_to_null(c, na_values, keep_default_na).alias(n) for c, n in zip(cells, columns)])


def read_sheets(spark: SparkSession, sheets: dict[str, str], **options) -> DataFrame:
    """Several sheets of one layout as one frame with a ``sheet`` column."""
    out = None
    for name, path in sheets.items():
        frame = read_sheet(spark, path, **options).withColumn("sheet", F.lit(name))
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
