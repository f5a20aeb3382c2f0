"""Token ids of a public byte-level vocabulary, with words remembered between texts.

Byte-level BPE never merges across a pre-token, and a single space between two visible
characters always starts one. Plain texts are therefore cut at their spaces and each
piece is encoded once; every other text goes to the library whole.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k"
END_OF_TEXT = "<|endoftext|>"
#: Anything but ASCII and Latin letters, line feeds and usual marks; white space that
#: meets white space; the start of a special string.
NOT_PLAIN = re.compile(
    "[^\n\x20-\x7e¡-ɏ–—‘-”…€]|[\x20\n]{2}|<\\|"
)
#: Pieces a worker remembers before it starts anew.
MEMO_PIECES = 300_000


def vocabulary_file(suffix: str, name: str = VOCABULARY) -> str:
    return public_tokenizers.path(f"{name}.{suffix}")


@lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    """The vocabulary as byte strings."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class SpacedIds(dict):
    """Ids of a space and a plain word, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.encoding = tiktoken.Encoding(
            "public",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks(path),
            special_tokens={},
        )

    def ids(self, piece: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(piece)).tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO_PIECES:
            self.clear()
        value = self[word] = self.ids(" " + word)
        return value


@lru_cache(maxsize=2)
def spaced_ids(path: str) -> SpacedIds:
    return SpacedIds(path)


def encode(text: str) -> np.ndarray:
    """The library's ids of one text, without added special tokens."""
    if NOT_PLAIN.search(text):
        ids = library(vocabulary_file("json")).encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4")
    memo = spaced_ids(vocabulary_file("tiktoken"))
    first, *rest = text.split(" ")
    return np.frombuffer(memo.ids(first) + b"".join(map(memo.__getitem__, rest)), "<u4")
