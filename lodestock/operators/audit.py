"""Audit trail of loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

AUDIT_SCHEMA = (
    "log_type string, scope string, log_source string, data_area string, "
    "rec_count bigint, log_comment string, entry_date timestamp"
)


def audit_row(
    spark: SparkSession,
    log_type: str,
    scope: str,
    log_source: str,
    data_area: str,
    rec_count: int = 0,
    comment: str | None = None,
    entry_date=None,
) -> DataFrame:
    """One audit row: ``I`` loaded, ``W`` warning, ``E`` error."""
    if log_type not in ("I", "W", "E"):
        raise ValueError(f"unknown log type {log_type!r}")
    if not log_source.startswith(("Python: ", "SQL: ")):
        log_source = "Python: " + log_source
    row = [(log_type, scope, log_source, data_area, rec_count, comment, entry_date)]
    df = spark.createDataFrame(row, AUDIT_SCHEMA)
    return df if entry_date is not None else df.withColumn("entry_date", F.current_timestamp())


def success_row(spark, scope, log_source, data_area, rec_count, entry_date=None) -> DataFrame:
    return audit_row(spark, "I", scope, log_source, data_area, rec_count, None, entry_date)


def error_row(spark, scope, log_source, data_area, error, entry_date=None) -> DataFrame:
    return audit_row(spark, "E", scope, log_source, data_area, 0, f"Load failed: {error}", entry_date)


def warning_row(spark, scope, log_source, data_area, folder=None, kind="missing", entry_date=None) -> DataFrame:
    """Warning for a missing file or one that has not changed."""
    comments = {
        "missing": f"Nothing to read in {folder}.",
        "not modified": f"{data_area} is unchanged since its latest load; nothing was read.",
    }
    return audit_row(spark, "W", scope, log_source, data_area, 0, comments.get(kind.lower()), entry_date)


def append_audit(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("append").parquet(path)


def last_refresh(log: DataFrame, scope: str | None = None, data_area: str | None = None) -> DataFrame:
    """Latest successful load per source and data area."""
    done = log.filter(F.col("log_type") == "I")
    if scope is not None:
        done = done.filter(F.col("scope") == scope)
    if data_area is not None:
        done = done.filter(F.col("data_area") == data_area)
    # Entries of one time: the larger count, then the later texts, so that one row always wins.
    ties = [F.desc(c) for c in sorted(log.columns) if c not in ("log_source", "data_area", "entry_date")]
    w = Window.partitionBy("log_source", "data_area").orderBy(F.desc("entry_date"), *ties)
    return done.withColumn("latest", F.row_number().over(w)).filter("latest = 1").drop("latest")
