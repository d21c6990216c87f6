"""JSON records and landed pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.picks import first_per_key


def explode_records(df: DataFrame, body: str, item_ddl: str, path: str = "elements") -> DataFrame:
    """One row per entry of the JSON array at ``path``, fields as columns."""
    parsed = F.from_json(body, f"`{path}` array<struct<{item_ddl}>>")
    rest = [c for c in df.columns if c != body]
    return df.select(*rest, F.inline(parsed[path]))


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def merge_pages(pages: DataFrame, key: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """All landed pages as one table; a key seen twice keeps its newest row."""
    return first_per_key(pages, key, newest)
