"""One scheduled refresh: changed sheet to loaded table, with its audit row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import audit
from ..operators.load import load_table
from ..sources.delimited import read_sheet

ISO = "%Y-%m-%dT%H:%M:%S"


def last_load_time(spark: SparkSession, audit_path: str, scope: str, data_area: str) -> datetime | None:
    """Time of the latest successful load, or none; a single row is fetched."""
    log = spark.read.schema(audit.AUDIT_SCHEMA).option("ignoreMissingFiles", True).parquet(audit_path)
    return audit.last_refresh(log, scope, data_area).agg(F.max("entry_date")).first()[0]


def refresh_from_sheet(
    spark: SparkSession,
    source: str,
    transform: Callable[[DataFrame], DataFrame],
    target: T.StructType,
    path: str,
    audit_path: str,
    scope: str,
    log_source: str,
    data_area: str,
    last_load: datetime | None,
    columns: Sequence[str] | None = None,
    truncate: bool = True,
    entry_date: datetime | None = None,
    **sheet_options,
) -> str:
    """Read files changed since the last load, transform, load and audit.

    Returns ``loaded``, ``skipped`` (nothing changed, a warning row) or
    ``failed`` (contract error, an error row).
    """
    changed = last_load.strftime(ISO) if last_load is not None else None
    lines = spark.read.text(source) if changed is None else spark.read.option("modifiedAfter", changed).text(source)
    if lines.isEmpty():
        audit.append_audit(
            audit.warning_row(spark, scope, log_source, data_area, source, "not modified", entry_date), audit_path
        )
        return "skipped"
    sheet = read_sheet(spark, source, modified_after=changed, **sheet_options)
    done = load_table(
        transform(sheet), path, target, audit_path, scope, log_source, data_area,
        columns=columns, truncate=truncate, entry_date=entry_date,
    )
    return "loaded" if done else "failed"
