"""Files newer than the last load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

STAMP_PATTERN = r"(\d{4}\.\d{2}\.\d)"


def file_stamp(path: Column) -> Column:
    """Last load stamp ``YYYY.WW.D`` in a path; null where it has none."""
    return F.nullif(F.regexp_extract(path, ".*" + STAMP_PATTERN, 1), F.lit(""))


def newer_than_stamp(df: DataFrame, path: str, last_stamp: str) -> DataFrame:
    """Rows from files whose name is stamped after ``last_stamp``."""
    return df.withColumn("stamp", file_stamp(F.col(path))).filter(F.col("stamp") > last_stamp)


def modified_since(df: DataFrame, last_load: Column) -> DataFrame:
    """Rows from files changed after the last load; Spark skips the other files."""
    return df.filter(F.col("_metadata.file_modification_time") > last_load)
