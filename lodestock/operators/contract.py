"""Conforming data to a target schema, with errors raised before any job runs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.numbers import id_text, nan_to_null
from ..functions.text import blank_to_null
from .columns import quoted


class ContractError(ValueError):
    """The data does not fit the target table."""


class DuplicateColumn(ContractError):
    pass


class WrongColumnCount(ContractError):
    pass


class UnknownColumn(ContractError):
    pass


class MissingSourceColumn(ContractError):
    pass


class ExtraSourceColumn(ContractError):
    pass


class UnknownTable(ContractError):
    pass


class TruncatedText(ContractError):
    pass


class BadValue(ContractError):
    pass


def text_field(name: str, max_length: int | None = None, nullable: bool = True) -> T.StructField:
    """A string field that remembers its longest allowed text."""
    return T.StructField(name, T.StringType(), nullable, {"max_length": max_length} if max_length else {})


def target_schema(spark, table: str) -> T.StructType:
    """Schema of a catalogued table."""
    if not spark.catalog.tableExists(table):
        raise UnknownTable(f"table {table} not found")
    return spark.table(table).schema


def matched_fields(
    source: Sequence[str], target: T.StructType, columns: Sequence[str] | None = None
) -> list[T.StructField]:
    """Target field of each source column, or the contract error.

    Without ``columns`` the match is by position and counts must agree; with
    ``columns`` it is by name, ignoring case.
    """
    repeated = [n for n, k in Counter(source).items() if k > 1]
    if repeated:
        raise DuplicateColumn(f"duplicate column in the data: {repeated}")
    if columns is None:
        if len(source) < len(target):
            raise MissingSourceColumn("the table has more columns than the data")
        if len(source) > len(target):
            raise ExtraSourceColumn("the data has more columns than the table")
        return list(target)
    if len(columns) != len(source):
        raise WrongColumnCount(f"{len(columns)} columns named, the data has {len(source)}")
    by_name = {f.name.lower(): f for f in target}
    plain = [c.strip("[]").lower() for c in columns]
    unknown = [c for c, p in zip(columns, plain) if p not in by_name]
    if len(unknown) == len(columns):
        raise UnknownTable("none of the named columns is in the table")
    if unknown:
        raise UnknownColumn(f"not in the table: {unknown}")
    return [by_name[p] for p in plain]


def conform(
    df: DataFrame,
    target: T.StructType,
    columns: Sequence[str] | None = None,
    categorical: Sequence[str] = (),
) -> DataFrame:
    """The data under the target's names and types.

    Blank text, NaN and the texts ``nan`` and ``NaT`` become null; numeric
    columns named in ``categorical`` become digit text.  A value that does not
    fit its target type raises ``BadValue``, which counts them per column.
    """
    fields = matched_fields(df.columns, target, columns)
    out, lost = [], []
    for source, field in zip(df.schema, fields):
        c = F.col(quoted(source.name))
        if source.name in categorical and isinstance(source.dataType, T.NumericType):
            c = id_text(nan_to_null(c)) if isinstance(source.dataType, (T.DoubleType, T.FloatType)) else id_text(c)
        elif isinstance(source.dataType, T.StringType):
            c = F.nullif(F.nullif(blank_to_null(c), F.lit("nan")), F.lit("NaT"))
        elif isinstance(source.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        cast = c.try_cast(field.dataType)
        out.append(cast.alias(field.name, metadata=field.metadata))
        if source.dataType != field.dataType:
            lost.append(F.count_if(c.isNotNull() & cast.isNull()).alias(field.name))
    bad = df.agg(*lost).first().asDict() if lost else {}  # one row, one pass
    if any(bad.values()):
        raise BadValue("; ".join(f"{name}: {n} values do not fit" for name, n in bad.items() if n))
    return df.select(out)


def text_excess(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns whose longest text exceeds the allowed length, in one pass."""
    limited = [f for f in target if f.metadata.get("max_length") and f.name in df.columns]
    if not limited:
        return df.sparkSession.createDataFrame([], "column_name string, max_length bigint, allowed bigint")
    cells = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.max(F.length(quoted(f.name))).cast("long").alias("max_length"),
            F.lit(f.metadata["max_length"]).cast("long").alias("allowed"),
        )
        for f in limited
    ]
    report = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return report.filter(F.col("max_length") > F.col("allowed"))


def assert_fits(df: DataFrame, target: T.StructType) -> DataFrame:
    """Raise naming every too-narrow target column, else return the data."""
    bad = text_excess(df, target).collect()  # at most one row per column
    if bad:
        raise TruncatedText("; ".join(f"{r.column_name}: {r.max_length} > {r.allowed}" for r in bad))
    return df
