"""Column selection, naming and dropping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


class MissingColumns(ValueError):
    """A required column is not in the data."""


def quoted(name: str) -> str:
    """Column name safe for ``F.col`` whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {missing}")
    return df.select([quoted(n) for n in names])


def align_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """These columns in this order; a missing one is added as null."""
    return df.select([F.col(quoted(n)) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names])


def combine_aligned(frames: Sequence[DataFrame], names: Sequence[str] | None = None) -> DataFrame:
    """Append frames whose columns differ; absent cells are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out if names is None else align_columns(out, names)


def drop_columns(df: DataFrame, names: Sequence[str], must_exist: bool = False) -> DataFrame:
    if must_exist:
        missing = [n for n in names if n not in df.columns]
        if missing:
            raise MissingColumns(f"missing columns: {missing}")
    return df.drop(*names)


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop columns whose name matches the pattern anywhere."""
    return df.drop(*[n for n in df.columns if re.search(pattern, n)])


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Keep columns whose name matches the pattern anywhere."""
    return df.select([quoted(n) for n in df.columns if re.search(pattern, n)])


def columns_starting(df: DataFrame, prefix: str) -> list[str]:
    return [n for n in df.columns if n.startswith(prefix)]


def null_columns(df: DataFrame) -> list[str]:
    """Names of columns without any value: one pass, one row to the driver."""
    counts = df.agg(*[F.count(F.col(quoted(n))).alias(str(i)) for i, n in enumerate(df.columns)]).first()
    return [n for i, n in enumerate(df.columns) if counts[i] == 0]


def drop_null_columns(df: DataFrame) -> DataFrame:
    return df.drop(*null_columns(df))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def take_positions(df: DataFrame, positions: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Columns by position under new names."""
    chosen = [df.columns[p] for p in positions]
    return df.select([F.col(quoted(c)).alias(n) for c, n in zip(chosen, names, strict=True)])


def decoded_name(name: str) -> str:
    """Plain form of an escaped list column name.

    ``_x0020_`` stands for the character of that code; a cut-off escape at the
    end of the name is removed.
    """
    plain = re.sub(r"_x00([0-9a-fA-F]{2})_", lambda m: chr(int(m.group(1), 16)), name)
    at = plain.find("_x")
    return plain[:at] if at > -1 and at >= len(plain) - 6 else plain


def decode_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[decoded_name(n) for n in df.columns])


def flatten_field(df: DataFrame, path: str, name: str) -> DataFrame:
    """Replace a nested record by one of its fields."""
    return df.withColumn(name, F.col(path)).drop(path.split(".")[0])


def stamp_load(df: DataFrame, load_time: Column | str, load_by: str, load_source: str | None = None) -> DataFrame:
    """Add ``LoadDtm``, ``LoadBy`` and, where given, ``LoadSource``."""
    when = F.to_timestamp(F.lit(load_time)) if isinstance(load_time, str) else load_time
    cols = {"LoadDtm": when, "LoadBy": F.lit(load_by)}
    if load_source is not None:
        cols["LoadSource"] = F.lit(load_source)
    return df.withColumns(cols)
