"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under a name."""

    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, tuple(covers.split()), build, sql)
        return build

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A test table, cut to the named columns so the scan reads no others."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def day_text(c: Column | str) -> Column:
    """A date or time as ISO day text."""
    return F.date_format(c, "yyyy-MM-dd")
