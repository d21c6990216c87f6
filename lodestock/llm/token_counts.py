"""Token counts of whole texts, from counts of distinct pre-tokens.

A pre-token of the piece vocabulary is a run of spaces with what follows up to
the next space: no piece of the vocabulary has a space after another character
(checked when it is loaded), so no merge crosses such a border.  Each block of
documents is turned into per-document pre-token frequencies; the pieces of each
distinct pre-token of the block are counted once, joined to the frequencies and
summed.  No ids are kept.  Frequencies stay in their task: moved to a global
table of pre-tokens they would be several times the input.

Defined results: a null or empty text has no bytes and no tokens.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache

import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from .batches import add_columns

SPACE = "▁"
PRE_TOKEN = re.compile(" *[^ ]*")
KEPT_PRE_TOKENS = 200_000
LIMIT = 4096


class PieceCounter:
    """Numbers of pieces of pre-tokens; counted ones stay in a bounded table."""

    def __init__(self, model: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=model)
        for i in range(self._model.get_piece_size()):
            if SPACE in self._model.id_to_piece(i).lstrip(SPACE):
                raise ValueError(f"{model}: a piece has a space after another character")
        self._pieces: dict[str, int] = {}

    def _count(self, pre_tokens: list[str]) -> None:
        """The library puts one space before a text, so each lacks its first."""
        ids = self._model.encode([p[1:] for p in pre_tokens], num_threads=1)
        self._pieces.update(zip(pre_tokens, map(len, ids), strict=True))
        self._pieces[" "] = 1 if " " not in self._pieces else self._pieces[" "] or 1

    @staticmethod
    def frequencies(text: str) -> Counter:
        """Pre-tokens of a text and how often each occurs."""
        if not text:
            return Counter()
        spaced = " " + text.replace(SPACE, " ")
        if "  " in spaced or spaced.endswith(" "):
            found = Counter(PRE_TOKEN.findall(spaced))
        else:
            found = Counter([" " + w for w in spaced[1:].split(" ")])
        found.pop("", None)
        return found

    def totals(self, texts: list[str]) -> list[int]:
        if len(self._pieces) > KEPT_PRE_TOKENS:
            self._pieces.clear()
        tables = [self.frequencies(t) for t in texts]
        new = set().union(*tables).difference(self._pieces)
        if new:
            self._count(list(new))
        pieces = self._pieces
        return [sum(pieces[p] * n for p, n in table.items()) for table in tables]


@cache
def piece_counter(model: str) -> PieceCounter:
    """One counter per worker process."""
    return PieceCounter(model)


def count_tokens(docs: DataFrame, text: str = "text", model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` of each whole text."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]

    def make(block):
        texts = [t or "" for t in block.column(text).to_pylist()]
        return [[len(t.encode()) for t in texts], piece_counter(path).totals(texts)]

    return add_columns(docs, text, fields, make).withColumn("over_limit", F.col("n_tokens") > limit)
