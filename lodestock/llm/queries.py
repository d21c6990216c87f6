"""Registered queries of the operators, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    decontaminate,
    exact_dedup,
    jaccard_join,
    line_dedup,
    oracles,
    pseudonyms,
    quality,
    sequences,
    spelling,
    suffix_dedup,
    token_counts,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
# A sample: anyone who knows the key can turn numbers and dates back.
SAMPLE_KEY = "sample-key-of-the-registered-query"


def query(sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its name."""

    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql.strip()
        return build

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


@query(oracles.DECONTAMINATION)
def op1_benchmark_decontamination(spark, folder):
    """Hit words and items of every document, against all benchmark items."""
    found = decontaminate.find_contamination(
        table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


@query()
def op3_token_counts(spark, folder):
    """Bytes and pieces of every document."""
    counted = token_counts.count_tokens(table(spark, folder, "documents", "doc_id", "text"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query()
def op6_token_id_output(spark, folder):
    """Packed id matrices of all documents."""
    return sequences.packed_matrices(table(spark, folder, "documents", "doc_id", "text"))


@query()
def op7_best_fit_packing(spark, folder):
    """Every piece of all documents with its sequence and place."""
    packed = sequences.pack_best_two_fit(table(spark, folder, "documents", "doc_id", "text"))
    return packed.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )


@query(oracles.QUALITY)
def op8_quality_rules(spark, folder):
    """Measures and verdict of every document."""
    judged = quality.judge(table(spark, folder, "documents", "doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op2_substring_dedup(spark, folder):
    """Every document without lines that come earlier in the corpus; offsets of those cut."""
    cut = line_dedup.remove_repeats(table(spark, folder, "documents", "doc_id", "text"))
    return cut.select("doc_id", "text", "removed", "n_units", "n_removed")


@query()
def op5_pii_pseudonyms(spark, folder):
    """Every document with pseudonyms for its validated numbers and dates."""
    return pseudonyms.pseudonymise(table(spark, folder, "documents", "doc_id", "text"), SAMPLE_KEY)


@query(oracles.JACCARD)
def op10_ngram_jaccard_join(spark, folder):
    """Component of every document under links of 85 % of shared four-word shingles."""
    return jaccard_join.components(table(spark, folder, "documents", "doc_id", "text"), size=4, percent=85)


@query()
def op4_toxicity(spark, folder):
    """Toxicity score of every document, from labels outside the held-out third."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels", "doc_id", "toxic")))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query(oracles.SUFFIXES)
def op9_suffix_array_dedup(spark, folder):
    """Bytes removed from every document as repeats of earlier 100-byte strings."""
    cut = suffix_dedup.remove_repeats(table(spark, folder, "documents", "doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(oracles.SPELLING)
def op11_spelling_variants(spark, folder):
    """Every word of at least five letters and three occurrences, with its form and root."""
    return spelling.variants(table(spark, folder, "documents", "doc_id", "text"))


@query(
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) = 1 AS kept, text_sha256
    FROM (
        SELECT doc_id,
               sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents
    )
    WINDOW same AS (PARTITION BY text_sha256)
    """
)
def op12_exact_dedup(spark, folder):
    """Every document with the document that stays of its equal texts."""
    return exact_dedup.mark_copies(table(spark, folder, "documents", "doc_id", "text"))


@query()
def op13_embedding_whitening(spark, folder):
    """Every vector along the first eight components of all."""
    return whitening.whiten(table(spark, folder, "embeddings", "vec_id", "embedding"))
