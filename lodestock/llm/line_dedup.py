"""Substring dedup by hashing lines, paragraphs, or parts of lines.

Units are normalised and digested; of equal digests the earliest ranked
occurrence stays.  Every run of later occurrences that follow each other with at
least ``min_chars`` characters is cut out of its text, with its character offsets
in the original text kept in the result.

Passages that several documents share seldom begin and end with a line.  So the
unit ``passage`` cuts lines into parts: a part ends with its line, or after a
word that a hash of its last letters picks, one in ``EACH_WORD``.  Two places
with the same words are cut alike whatever stands before them, so a shared
passage is found but for the parts at its two ends.  ``PASSAGE_CHARS`` is what makes
a repeat a passage: shorter repeats (a heading, a common phrase) stay.  ``line`` and
``paragraph`` take whole units and cut every one that repeats.

The rank is (document id, place in the document).  A block of documents emits
each digest once per document; heads are counted with a map-side combine.  The
occurrences meet the heads of repeated digests by digest; hot digests are dealt to
several tasks (see ``hot_keys``), so a line that a third of all documents share
is no hot key.

Defined results: a null text stays null and has no units; a blank unit is never
cut; rows of equal id are one document, whose equal units count as one
occurrence, so exact repeats of a row come out alike; null ids rank first, and
texts without an id are documents in the order of a hash of the text; extra
columns stay, unless named like a computed one; an empty table gives an empty
one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage
from .batches import add_columns, as_bytes, blocks, without
from .hot_keys import join_heads

SEPARATORS = {"line": re.compile(rb"\n"), "paragraph": re.compile(rb"\n[ \t\r]*\n")}
PASSAGE_CHARS = 200
EACH_WORD = 6
OFFSETS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
COMPUTED = ["removed", "n_units", "n_removed", "_later", "_doc", "_mark", "_body"]

_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True


def part_ends(body: bytes) -> list[int]:
    """Where the parts of a text's lines end, the blanks after them included."""
    data = np.frombuffer(body.lower() + bytes(8), np.uint8)
    blank = _BLANK[data[:-8]]
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1  # words with a blank after them
    if not len(ends):
        return [len(body)]
    starts = np.r_[np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, len(body)]
    following = starts[np.searchsorted(starts, ends)]
    # The last eight bytes of each word, or all of a shorter one.
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), 0, (1,))
    begins = np.r_[0, starts[:-1]] if not blank[0] else starts[:-1]
    length = np.minimum(ends - begins[: len(ends)], 8)
    letters = words[ends - length] & (np.uint64(2**64 - 1) >> (np.uint64(64) - 8 * length.astype(np.uint64)))
    picked = ((letters * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(EACH_WORD) == 0
    lines = np.cumsum(data[:-8] == 10)
    picked |= lines[following - 1] > lines[ends - 1]
    out = following[picked].tolist()
    return out if out and out[-1] == len(body) else [*out, len(body)]


def units_of(body: bytes, unit: str) -> list[tuple[int, int, int, bytes]]:
    """Start, end (with the separator after it), characters and normalised text of each unit.

    Lower case and single spaces make units equal.
    """
    if unit == "passage":
        stops = ends = part_ends(body)
    else:
        found = [m.span() for m in SEPARATORS[unit].finditer(body)]
        stops, ends = [a for a, _ in found] + [len(body)], [b for _, b in found] + [len(body)]
    out, start = [], 0
    for stop, end in zip(stops, ends, strict=True):
        plain = " ".join(body[start:stop].decode("utf-8", "replace").lower().split())
        out.append((start, end, len(plain), plain.encode()))
        start = end
    return out


def _digest(plain: bytes) -> tuple[int, int]:
    raw = blake2b(plain, digest_size=12).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with the id as a long integer, and the mark that tells texts without one apart."""
    mark = F.when(F.col(f"`{key}`").isNull(), F.xxhash64(F.col(f"`{text}`").cast("string")))
    return docs.withColumns({"_doc": F.col(f"`{key}`").cast("long"), "_mark": mark})


def _occurrences(docs: DataFrame, unit: str) -> DataFrame:
    """Each document's distinct unit digests."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_body"):
            columns = [[], [], [], []]
            docs_of, marks = block.column(0).to_pylist(), block.column(1).to_pylist()
            for doc, mark, body in zip(docs_of, marks, as_bytes(block.column(2)), strict=True):
                found = {_digest(u[3]) for u in units_of(body or b"", unit) if u[2]}
                columns[0] += [doc] * len(found)
                columns[1] += [mark] * len(found)
                columns[2] += [d[0] for d in found]
                columns[3] += [d[1] for d in found]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["_doc", "_mark", "_digest", "_rest"])

    return docs.select("_doc", "_mark", "_body").mapInArrow(run, "_doc long, _mark long, _digest long, _rest int")


def later_units(docs: DataFrame, unit: str) -> DataFrame:
    """Per document, the digests of units that an earlier document has."""
    digest = ["_digest", "_rest"]
    # Null ids rank first; the least of each kind of document is kept apart, so all are plain numbers.
    low = {name: F.min(name).alias(f"_low{name}") for name in ("_doc", "_mark")}
    counted = _occurrences(docs, unit).groupBy(*digest).agg(*low.values(), F.count(F.lit(1)).alias("_n"))
    heads = cut_lineage(counted.filter("_n > 1"))
    met = join_heads(_occurrences(docs, unit), heads, digest, "_n", ["_doc", "_mark"], "shuffle_hash")
    first = F.when(F.col("_low_mark").isNotNull(), F.col("_mark").eqNullSafe(F.col("_low_mark"))).otherwise(F.col("_doc") == F.col("_low_doc"))
    return met.filter(~first).groupBy("_doc", "_mark").agg(F.collect_list("_digest").alias("_later"))


def repeated_runs(units: list[tuple[int, int, int, bytes]], later: set[int], min_chars: int) -> list[list[int]]:
    """Runs of units that come earlier in the corpus or the text, as lists of unit numbers; blank units break none."""
    out, run, chars, own = [], [], 0, set()
    for i, (_, _, size, plain) in enumerate([*units, (0, 0, -1, b"")]):
        if not size:
            continue
        digest = _digest(plain)[0] if size > 0 else None
        if size > 0 and (digest in later or digest in own):
            run.append(i)
            chars += size + (len(run) > 1)
            continue
        if run and chars >= min_chars:
            out.append(run)
        run, chars = [], 0
        own.add(digest)
    return out


def remove_repeats(
    docs: DataFrame, unit: str = "passage", min_chars: int | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with repeated runs of units cut out of the text.

    ``removed`` has the cut parts' (start, end) in characters of the original
    text; ``n_units`` and ``n_removed`` count units.  A cut unit takes the
    separator after it along.  ``min_chars`` is ``PASSAGE_CHARS`` for passages and
    1 for whole lines and paragraphs unless given.
    """
    if unit != "passage" and unit not in SEPARATORS:
        raise ValueError(f"no unit {unit!r}")
    least = min_chars if min_chars is not None else PASSAGE_CHARS if unit == "passage" else 1
    kept = without(docs, [c for c in COMPUTED if c not in (key, text)])
    known = _identified(kept.withColumn("_body", F.col(f"`{text}`").cast("string")), key, text)
    later = later_units(known, unit)
    same = known["_doc"].eqNullSafe(later["_doc"]) & known["_mark"].eqNullSafe(later["_mark"])
    joined = known.join(later, same, "left").drop("_doc", "_mark")
    fields = [
        T.StructField("_cut", T.StringType()),
        T.StructField("removed", OFFSETS),
        T.StructField("n_units", T.LongType()),
        T.StructField("n_removed", T.LongType()),
    ]

    def make(block):
        out = []
        for body, known in zip(as_bytes(block.column("_body")), block.column("_later").to_pylist(), strict=True):
            units = units_of(body, unit) if body is not None else []
            gone = [i for run in repeated_runs(units, set(known or ()), least) for i in run]
            spans: list[list[int]] = []
            for i in gone:
                start, end = units[i][:2]
                if spans and spans[-1][1] == start:
                    spans[-1][1] = end
                else:
                    spans.append([start, end])
            pieces, offsets, at, chars = [], [], 0, 0
            for start, end in spans:
                pieces.append(body[at:start])
                begin = chars + len(pieces[-1].decode("utf-8", "replace"))
                chars = begin + len(body[start:end].decode("utf-8", "replace"))
                offsets.append({"start": begin, "end": chars})
                at = end
            left = None if body is None else b"".join([*pieces, body[at:]]).decode("utf-8", "replace")
            out.append((left, offsets, len(units), len(gone)))
        return list(zip(*out, strict=True)) if out else [[], [], [], []]

    done = add_columns(joined, "_body", fields, make)
    return done.select(
        *[F.col("_cut").alias(c) if c == text else F.col(f"`{c}`") for c in kept.columns], "removed", "n_units", "n_removed"
    )
