"""Text features."""

from __future__ import annotations


from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, StopWordsRemover
from pyspark.sql import Column, DataFrame, functions as F

# Single-character tokens that carry nothing.
PUNCTUATION = list("\"'()*`{|}~/")


def tokens(text: Column | str) -> Column:
    """Words and single marks, digits masked as ``_``."""
    masked = F.regexp_replace(text, r"\d", "_")
    found = F.regexp_extract_all(masked, F.lit(r"[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]"), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(PUNCTUATION))


def stop_words(columns_in: str, column_out: str, words: list[str] | None = None) -> Transformer:
    words = words or StopWordsRemover.loadDefaultStopWords("english")
    return StopWordsRemover(inputCol=columns_in, outputCol=column_out, stopWords=words, caseSensitive=True)


def count_stages(column: str, vocabulary: int, min_documents: float) -> list[Estimator]:
    """Counts over a vocabulary, then inverse document weights.

    The vocabulary is kept on the driver, so the caller states how many tokens it
    may have and in how many documents a token must be; ``hashed_stages`` and
    ``document_frequencies`` have no such bounds.
    """
    counts = CountVectorizer(inputCol=column, outputCol="term_counts", vocabSize=vocabulary, minDF=min_documents)
    return [counts, IDF(inputCol="term_counts", outputCol="features")]


def hashed_stages(column: str, features: int = 1 << 14) -> list[Transformer | Estimator]:
    """The same without a vocabulary: nothing about the texts is kept on the driver."""
    return [
        HashingTF(inputCol=column, outputCol="term_counts", numFeatures=features),
        IDF(inputCol="term_counts", outputCol="features"),
    ]


def document_frequencies(df: DataFrame, key: str, tokens_column: str) -> DataFrame:
    """Documents holding each token and its weight ``ln((1 + n) / (1 + documents)) + 1``.

    One row per token, wherever the vocabulary ends: nothing of it is gathered.
    """
    held = df.select(key, F.explode(F.array_distinct(tokens_column)).alias("token"))
    n = df.agg(F.count(F.lit(1))).scalar()
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("documents"))
    return counts.withColumn("weight", F.log((1 + n) / (1 + F.col("documents"))) + 1)
