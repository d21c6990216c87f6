"""Rule-based quality verdicts: a table of thresholds compiled into one projection.

Every measure is a column expression over one row, so a table of any size is
judged in its scan, without a shuffle and without user functions.

Defined results: a null, empty or blank text has no words, zero for every
measure, and fails; extra input columns stay, unless named like a measure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .batches import without

SPACES = " \t\n\x0b\f\r"
SPLIT = "[ \\t-\\r]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of the corpus' four languages.
STOP_WORDS = (
    "the of and to in is that for it was on are as with be by this from or at an "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un une que qui pour dans par sur du au avec est pas "
    "el los las y del se por con para su al lo como más una"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= measure <= high``; None leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# Verdict rules on top of the base rules; thresholds are on whole documents.
RULES = (
    Rule("few_words", "n_words", low=20),
    Rule("repeated_windows", "repeat_ratio", high=0.30),
    Rule("word_length", "mean_word_chars", low=2.0, high=20.0),
    Rule("symbols", "symbol_ratio", high=0.10),
    Rule("repeated_lines", "dup_line_ratio", high=0.50),
    Rule("stop_words", "stop_word_ratio", low=0.02),
    Rule("stop_word_hits", "n_stop_words", low=2),
)


def _text(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _words(text: Column) -> Column:
    """Words between white space; the first and last piece may be empty."""
    parts = F.split(text, SPLIT)
    return F.filter(parts, lambda w: w != "")


def _repeated(words: Column, n: Column) -> Column:
    """Words inside windows that the text has twice or more.

    Equal neighbours among the sorted (window, place) pairs are the repeated
    windows; in order of place, each adds the words that the one before has not.
    """
    last = F.greatest(n - (WINDOW - 1), F.lit(1))
    windows = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeats(sorted_pairs: Column) -> Column:
        size = F.size(sorted_pairs)

        def twin(p: Column, k: Column) -> Column:
            before = F.get(sorted_pairs, k - 1)["h"]
            after = F.get(sorted_pairs, k + 1)["h"]
            return ((k > 0) & (before == p["h"])) | ((k < size - 1) & (after == p["h"]))

        return F.array_sort(F.transform(F.filter(sorted_pairs, twin), lambda p: p["i"]))

    def covered(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        )

    many = (n >= WINDOW + 1) & (F.size(F.array_distinct(windows)) < F.size(windows))
    return F.when(many, covered(_bind(pairs, repeats))).otherwise(F.lit(0).cast("long"))


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once: the one item of an array."""
    return F.get(F.transform(F.array(value), use), 0)


def measures(docs: DataFrame, text: str = "text", stop_words: list[str] | None = None) -> DataFrame:
    """``docs`` with counts and ratios of each whole text."""
    names = (
        "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_stop_words "
        "mean_word_chars symbol_ratio dup_line_ratio repeat_ratio stop_word_ratio"
    ).split()
    listed = sorted(set(stop_words if stop_words is not None else STOP_WORDS))
    body, words, lines = _text(text), F.col("_words"), F.col("_lines")
    n = F.size(words)
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    kept = without(docs, [*names, "_words", "_lines"])
    return (
        kept.withColumn("_words", _words(body))
        .withColumn("_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \\t-\\r]")))
        .withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", F.length(F.translate(body, SPACES, "")).cast("long"))
        .withColumn("n_symbols", (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"))
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
        .withColumn("n_repeat_words", _repeated(words, n))
        .withColumn("n_stop_words", F.size(F.filter(words, lambda w: F.lower(w).isin(listed))).cast("long"))
        .withColumn("mean_word_chars", share("word_chars", "n_words"))
        .withColumn("symbol_ratio", share("n_symbols", "word_chars"))
        .withColumn("dup_line_ratio", share("n_dup_lines", "n_lines"))
        .withColumn("repeat_ratio", share("n_repeat_words", "n_words"))
        .withColumn("stop_word_ratio", share("n_stop_words", "n_words"))
        .drop("_words", "_lines")
    )


def passes(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules as one condition."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out = out & (F.col(r.measure) >= r.low)
        if r.high is not None:
            out = out & (F.col(r.measure) <= r.high)
    return out


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a document fails, in the table's order."""
    flags = []
    for r in rules:
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (F.col(r.measure) < r.low)
        if r.high is not None:
            bad = bad | (F.col(r.measure) > r.high)
        flags.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*flags))


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", stop_words: list[str] | None = None
) -> DataFrame:
    """``docs`` with measures, ``base_failed``, ``failed_rules`` and ``kept``."""
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = measures(without(docs, ["base_failed", "failed_rules", "kept"]), text, stop_words)
    return (
        out.withColumn("base_failed", base_failed)
        .withColumn("failed_rules", failed_rules(rules))
        .withColumn("kept", ~F.col("base_failed") & passes(rules))
    )
