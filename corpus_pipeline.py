"""The training-data pipeline: toxicity, near duplicates, contamination, personal data, packing.

Each stage reads all that its predecessor kept and returns the columns of
documents, the last one packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestock.llm import decontaminate, jaccard_join, pseudonyms, sequences, toxicity
from lodestock.llm.batches import in_own_columns
from lodestock.llm.queries import SAMPLE_KEY
from lodestock.session import scratch_path

# No SQL for the whole: tested against brute force.
ORACLE_SQL = None
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold stay."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, of repeated rows one."""
    return jaccard_join.drop_near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is a benchmark's stay."""
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Validated numbers and dates become pseudonyms; every document stays.

    The key is the session's ``lodestock.pseudonym.key``; without it a sample key
    is used, which anyone who has this code can turn back.
    """
    key = spark.conf.get("lodestock.pseudonym.key", SAMPLE_KEY)
    return in_own_columns(docs, pseudonyms.COMPUTED, lambda own: pseudonyms.pseudonymise(own, key))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed sequences."""
    return sequences.pack_best_two_fit(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", pseudonymise),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
