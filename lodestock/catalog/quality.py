"""Schema contract and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..operators import contract, profiling
from ..operators.quantiles import quantiles_of
from .registry import query, table

LINE_TARGET = T.StructType(
    [
        T.StructField("L_ORDERKEY", T.LongType()),
        contract.text_field("L_PARTKEY", 20),
        T.StructField("L_Quantity", T.DecimalType(18, 6)),
        contract.text_field("L_ReturnFlag", 1),
    ]
)


@query(
    "conformed_lines",
    "O-50",
    """
    SELECT l_orderkey AS "L_ORDERKEY", CAST(l_partkey AS VARCHAR) AS "L_PARTKEY", l_quantity AS "L_Quantity",
           CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS "L_ReturnFlag" FROM lineitem
    """,
)
def conformed_lines(spark, sf):
    df = table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    df = df.withColumn("l_returnflag", F.when(F.col("l_returnflag") == "N", "  ").otherwise(F.col("l_returnflag")))
    out = contract.conform(
        df, LINE_TARGET, columns=["l_orderkey", "[L_partkey]", "l_QUANTITY", "l_returnflag"], categorical=["l_partkey"]
    )
    return out.withColumn("L_Quantity", F.col("L_Quantity").cast("double"))


@query(
    "document_profile",
    "O-52",
    """
    SELECT 'doc_id' AS column_name, 'bigint' AS data_type, count(*) AS row_count, count(*) - count(doc_id) AS null_count, CAST(max(length(CAST(doc_id AS VARCHAR))) AS BIGINT) AS max_length FROM documents
    UNION ALL SELECT 'text', 'string', count(*), count(*) - count(text), CAST(max(length(text)) AS BIGINT) FROM documents
    UNION ALL SELECT 'lang', 'string', count(*), count(*) - count(lang), CAST(max(length(lang)) AS BIGINT) FROM documents
    UNION ALL SELECT 'source', 'string', count(*), count(*) - count(source), CAST(max(length(source)) AS BIGINT) FROM documents
    UNION ALL SELECT 'n_chars', 'bigint', count(*), count(*) - count(n_chars), CAST(max(length(CAST(n_chars AS VARCHAR))) AS BIGINT) FROM documents
    """,
)
def document_profile(spark, sf):
    return profiling.column_profile(table(spark, sf, "documents"))


@query("language_counts", "O-52", "SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def language_counts(spark, sf):
    return profiling.value_counts(table(spark, sf, "documents", "lang"), "lang")


@query(
    "too_long_texts",
    "O-53",
    """
    SELECT 'text' AS column_name, CAST(max(length(text)) AS BIGINT) AS max_length, CAST(3999 AS BIGINT) AS allowed
    FROM documents HAVING max(length(text)) > 3999
    UNION ALL SELECT 'source', CAST(max(length(source)) AS BIGINT), 4 FROM documents HAVING max(length(source)) > 4
    """,
)
def too_long_texts(spark, sf):
    target = T.StructType(
        [contract.text_field("text", 3999), contract.text_field("lang", 2), contract.text_field("source", 4)]
    )
    return contract.text_excess(table(spark, sf, "documents", "text", "lang", "source"), target)


@query(
    "line_statistics",
    "O-54",
    """
    SELECT 'l_quantity' AS column_name, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem
    UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), 6), round(stddev_samp(l_extendedprice), 6), min(l_extendedprice), max(l_extendedprice) FROM lineitem
    UNION ALL SELECT 'l_tax', count(l_tax), round(avg(l_tax), 6), round(stddev_samp(l_tax), 6), min(l_tax) + 0.0, max(l_tax) FROM lineitem
    """,
)
def line_statistics(spark, sf):
    stats = profiling.summary_statistics(
        table(spark, sf, "lineitem", "l_quantity", "l_extendedprice", "l_tax"), ["l_quantity", "l_extendedprice", "l_tax"]
    )
    return stats.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6), "min": F.col("min") + 0.0})


@query(
    "line_quantiles",
    "O-54",
    """
    SELECT unnest([0.25, 0.5, 0.75, 0.99])::DOUBLE AS p, round(unnest(quantile_cont(l_extendedprice, [0.25, 0.5, 0.75, 0.99])), 4) AS value FROM lineitem
    """,
)
def line_quantiles(spark, sf):
    df = table(spark, sf, "lineitem", "l_extendedprice")
    shares = (0.25, 0.5, 0.75, 0.99)
    found = profiling.exact_quantiles(df, "l_extendedprice", shares)
    return spark.createDataFrame([(p, round(v, 4)) for p, v in zip(shares, found)], "p double, value double")


@query(
    "line_correlations",
    "O-54",
    """
    SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, round(corr(l_quantity, l_extendedprice), 9) AS r FROM lineitem
    UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 9) FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 9) FROM lineitem
    """,
)
def line_correlations(spark, sf):
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    return profiling.correlations(table(spark, sf, "lineitem", *names), names).withColumn("r", F.round("r", 9))


QUANTILE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "quantiles_of_all_columns",
    "O-54 O-36",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, unnest([0.0, 0.1, 0.5, 0.9, 1.0])::DOUBLE AS p, round(unnest(quantile_cont({c}, [0.0, 0.1, 0.5, 0.9, 1.0])), 6)::DOUBLE AS value FROM lineitem"
        for c in QUANTILE_COLUMNS
    ),
)
def quantiles_of_all_columns(spark, sf):
    """All ranks of all columns in the same four readings of the table."""
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = quantiles_of(table(spark, sf, "lineitem", *QUANTILE_COLUMNS), {c: shares for c in QUANTILE_COLUMNS})
    rows = [(c, p, round(v, 6)) for c, values in found.items() for p, v in zip(shares, values, strict=True)]
    return spark.createDataFrame(rows, "column_name string, p double, value double")
