"""Term and phrase counts per document."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.columns import quoted

# Letters, marks and digits of any script, and the underscore.
WORD = r"[\p{L}\p{M}\p{N}_]"


def whole_word(phrase: str) -> str:
    """Pattern of a phrase not touching another word character.

    The literal comes first and both checks after it: the matcher then searches
    for plain text and looks around only where it occurs.
    """
    literal = re.escape(phrase.lower())
    return f"{literal}(?!{WORD})(?<!{WORD}{literal})"


def _is_word(sign: str) -> bool:
    return sign == "_" or unicodedata.category(sign)[0] in "LMN"


def phrase_automaton(phrases: Sequence[str]) -> ahocorasick.Automaton:
    """One automaton for all phrases in lower case; each ends with its length and its columns."""
    automaton = ahocorasick.Automaton()
    for i, phrase in enumerate(phrases):
        low = phrase.lower()
        if not low:
            raise ValueError("a phrase must have a sign")
        automaton.add_word(low, (len(low), [*(automaton.get(low, (0, []))[1]), i]))
    automaton.make_automaton()
    return automaton


def hits(automaton: ahocorasick.Automaton, low: str) -> dict[int, int]:
    """Whole-word occurrences of each phrase that a text in lower case has.

    Occurrences of one phrase do not overlap: the leftmost counts, then the next
    one after its end.
    """
    found: dict[int, int] = {}
    free: dict[int, int] = {}  # where a phrase may begin again
    for last, (length, numbers) in automaton.iter(low):
        start = last + 1 - length
        if (start and _is_word(low[start - 1])) or (last + 1 < len(low) and _is_word(low[last + 1])):
            continue
        if start < free.get(numbers[0], 0):
            continue
        free[numbers[0]] = last + 1
        for i in numbers:
            found[i] = found.get(i, 0) + 1
    return found


def phrase_counts(documents: DataFrame, key: str, text: str, phrases: Sequence[str], total: str = "total") -> DataFrame:
    """Whole-word counts of each phrase, lower case, for documents with any.

    Words and phrases are counted alike and independently, all in one reading of
    the text, whatever their number.
    """
    shared = documents.sparkSession.sparkContext.broadcast(phrase_automaton(phrases))
    field = documents.select(key).schema[0]
    schema = T.StructType([field, *[T.StructField(p, T.IntegerType()) for p in phrases], T.StructField(total, T.IntegerType())])
    width, names, key_type = len(phrases), schema.names, to_arrow_type(field.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            rows, cells = [], []
            for i, low in enumerate(batch.column(1).to_pylist()):
                found = hits(automaton, low) if low else None
                if found:
                    rows.append(i)
                    cells.append(found)
            counts = np.zeros((len(rows), width), np.int32)
            for i, found in enumerate(cells):
                counts[i, list(found)] = list(found.values())
            columns = [pa.array(c) for c in np.ascontiguousarray(counts.T)] + [pa.array(counts.sum(axis=1, dtype=np.int32))]
            keys = batch.column(0).take(pa.array(rows, pa.int64())).cast(key_type)
            yield pa.RecordBatch.from_arrays([keys, *columns], names=names)

    # Lower case comes from the same function as the patterns' texts.
    low = documents.select(F.col(quoted(key)).alias("_key"), F.lower(F.col(quoted(text)).cast("string")).alias("_low"))
    return low.mapInArrow(run, schema)


def phrase_hits(documents: DataFrame, key: str, text: str, phrases: Sequence[str]) -> DataFrame:
    """The same as rows (``key``, ``phrase``, ``n``), for lists too long for a column each."""
    shared = documents.sparkSession.sparkContext.broadcast((phrase_automaton(phrases), list(phrases)))
    field = documents.select(key).schema[0]
    schema = T.StructType([field, T.StructField("phrase", T.StringType()), T.StructField("n", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, names = shared.value
        for batch in batches:
            rows = [(i, names[p], n) for i, low in enumerate(batch.column(1).to_pylist()) if low for p, n in hits(automaton, low).items()]
            at, phrase, n = zip(*rows, strict=True) if rows else ((), (), ())
            keys = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(phrase, pa.string()), pa.array(n, pa.int32())], names=schema.names)

    low = documents.select(F.col(quoted(key)).alias("_key"), F.lower(F.col(quoted(text)).cast("string")).alias("_low"))
    return low.mapInArrow(run, schema)
