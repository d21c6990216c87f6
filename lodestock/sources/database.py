"""Database extracts: queries over JDBC or over registered views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

FETCH_ROWS = 10_000


def query_options(url: str, statement: str, fetch_rows: int = FETCH_ROWS, **extra: str) -> dict[str, str]:
    """Reader options for a statement run by the database."""
    return {"url": url, "dbtable": f"({statement.rstrip().rstrip(';')}) q", "fetchsize": str(fetch_rows), **extra}


def read_query(spark: SparkSession, url: str, statement: str, **options: str) -> DataFrame:
    """One statement as one partition; for large results use ``read_by_year``."""
    return spark.read.format("jdbc").options(**query_options(url, statement, **options)).load()


def year_predicates(column: str, first: int, last: int) -> list[str]:
    """One half-open range per year: each becomes a partition of the read."""
    return [
        f"{column} >= DATE '{date(y, 1, 1)}' AND {column} < DATE '{date(y + 1, 1, 1)}'" for y in range(first, last + 1)
    ]


def read_by_year(
    spark: SparkSession, url: str, statement: str, column: str, first: int, last: int, properties: Mapping[str, str]
) -> DataFrame:
    """The statement split by year, one query per partition, all at once."""
    options = query_options(url, statement)
    return spark.read.jdbc(
        url,
        options["dbtable"],
        predicates=year_predicates(column, first, last),
        properties={"fetchsize": options["fetchsize"], **properties},
    )


def read_views(spark: SparkSession, statement: str, views: Mapping[str, DataFrame]) -> DataFrame:
    """A statement over named frames; the names live only in the statement."""
    return spark.sql(statement, **views)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, batch_rows: int = FETCH_ROWS, **properties: str) -> None:
    """Parallel batched inserts; ``overwrite`` empties the table and keeps its columns."""
    writer = df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_rows), **properties)
    writer.option("truncate", mode == "overwrite").mode(mode).save()


def land_by_year(df: DataFrame, path: str, year_column: str, files_per_year: int = 8) -> None:
    """Land an extract partitioned by year, so later reads touch only their years.

    Rows are dealt by year and a row hash: a year is a few files, not one of every task.
    """
    spread = df.repartition(F.col(year_column), F.pmod(F.xxhash64(*df.columns), F.lit(files_per_year)))
    spread.write.mode("overwrite").partitionBy(year_column).parquet(path)


def read_years(spark: SparkSession, path: str, year_column: str, years: Sequence[int]) -> DataFrame:
    return spark.read.parquet(path).filter(F.col(year_column).isin(list(years)))
