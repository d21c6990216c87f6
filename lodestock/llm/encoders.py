"""Token ids of whole texts for a byte-level vocabulary."""

from __future__ import annotations

import base64
from array import array
from functools import cache

import public_tokenizers
import tiktoken

END_OF_TEXT = "<|endoftext|>"


class ByteEncoder:
    """Packed ids of texts, equal to those of the vocabulary's own library.

    The end-of-text string inside a text is that special token, the library's
    default.  ``width`` is the bytes of an id, little-endian.
    """

    def __init__(self, ranks_path: str, pattern: str, width: int = 4):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding(
            "bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)}
        )
        self._code = {2: "H", 4: "I"}[width]

    def encode(self, text: str) -> bytes:
        if END_OF_TEXT in text:
            ids = self._encoding.encode(text, allowed_special="all")
        else:
            ids = self._encoding.encode_ordinary(text)
        return array(self._code, ids).tobytes()


@cache
def byte_encoder(ranks_path: str | None = None, width: int = 4) -> ByteEncoder:
    """One encoder per worker process."""
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return ByteEncoder(path, public_tokenizers.PATTERN, width)
