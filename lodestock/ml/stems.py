"""English word stems by stripping suffixes, after Porter's published algorithm.

The stem of a token depends on the token alone, so a task remembers the stems
of the tokens it met last.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

BATCH_ROWS = 1 << 16

# The suffixes of each step and what replaces them, the longest that fits first.
PLURALS = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
DERIVED = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
    ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
REDUCED = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
REMOVED = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "sion", "tion", "ou", "ism", "ate", "iti", "ous",
    "ive", "ize",
]


def _kinds(word: str) -> str:
    """``v`` or ``c`` per letter; a y after a consonant is a vowel."""
    out = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    """How often a vowel is followed by a consonant."""
    return _kinds(stem).count("vc")


def _short_end(stem: str) -> bool:
    """Whether it ends consonant, vowel, consonant other than w, x, y."""
    return _kinds(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _kinds(word)[-1] == "c"


def _replaced(word: str, rules: list[tuple[str, str]], least: int) -> str:
    """By the longest suffix that the word has; it stays if the rest has too small a measure."""
    for suffix, new in sorted(rules, key=lambda r: -len(r[0])):
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            return rest + new if _measure(rest) > least else word
    return word


def _without_tense(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        rest = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _kinds(rest):
            if rest.endswith(("at", "bl", "iz")):
                return rest + "e"
            if _double_end(rest) and rest[-1] not in "lsz":
                return rest[:-1]
            return rest + "e" if _measure(rest) == 1 and _short_end(rest) else rest
    return word


def _without_ending(word: str) -> str:
    for suffix in sorted(REMOVED, key=lambda s: -len(s)):
        if word.endswith(suffix):
            # Of -sion and -tion only -ion goes.
            rest = word[: -len(suffix)] + (suffix[0] if suffix in ("sion", "tion") else "")
            return rest if _measure(rest) > 1 else word
    return word


@lru_cache(maxsize=1 << 16)
def stem(token: str) -> str:
    """Stem of a lower-cased token; tokens of one or two letters and those with other signs than a-z stay."""
    word = token.lower()
    if len(word) < 3 or not (word.isascii() and word.isalpha()):
        return word
    word = _replaced(word, PLURALS, -1)
    word = _without_tense(word)
    if word.endswith("y") and "v" in _kinds(word[:-1]):
        word = word[:-1] + "i"
    word = _replaced(word, DERIVED, 0)
    word = _replaced(word, REDUCED, 0)
    word = _without_ending(word)
    if word.endswith("e"):
        rest = word[:-1]
        if _measure(rest) > 1 or (_measure(rest) == 1 and not _short_end(rest)):
            word = rest
    return word[:-1] if word.endswith("ll") and _measure(word) > 1 else word


def stem_counts(df: DataFrame, key: str, tokens_column: str) -> DataFrame:
    """``key``, ``stem`` and how often it occurs (``n``) in the row's tokens.

    Tokens become stems and are counted where the row is, so texts are cut into
    tokens once and only the distinct stems of a row are moved, once.
    """
    row = df.select(F.col(key), F.col(tokens_column).alias("tokens"))
    schema = T.StructType([row.schema[0], T.StructField("stem", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = batch.column(0), batch.column(1)
            of, found, counts = [], [], []

            def out() -> pa.RecordBatch:
                columns = [keys.take(pa.array(of, pa.int64())), pa.array(found, pa.string()), pa.array(counts, pa.int64())]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            for i, tokens in enumerate(rows):
                each = Counter(stem(t) for t in tokens.as_py() or () if t is not None)
                of += [i] * len(each)
                found += each.keys()
                counts += each.values()
                if len(of) >= BATCH_ROWS:
                    yield out()
                    of, found, counts = [], [], []
            if of:
                yield out()

    return row.mapInArrow(run, schema).groupBy(schema.names[0], "stem").agg(F.sum("n").alias("n"))


def stem_frequencies(df: DataFrame, key: str, tokens_column: str) -> DataFrame:
    """Rows that have each stem, its occurrences, and its weight ``ln((1 + rows) / (1 + documents)) + 1``."""
    n = df.agg(F.count(F.lit(1))).scalar()
    per = stem_counts(df, key, tokens_column).groupBy("stem").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("n"))
    return per.withColumn("weight", F.log((1 + n) / (1 + F.col("documents"))) + 1)
