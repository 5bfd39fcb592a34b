"""Packing by power-of-two decomposition.

A document's token ids, closed by an end id, are cut into pieces whose lengths
are the binary digits of its length, the longest first and none above the
sequence length.  Each piece is a sequence of its own, so no sequence crosses
documents; pieces of equal length share a bucket and need no padding.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsegrid.llm.common import with_scanned

SEQUENCE = 2048
END_ID = 1
# Words whose ids a worker keeps; when full, the words not met lately go.
KEPT_WORDS = 400_000
_LONGEST_KEPT = 64


def byte_letters() -> dict[int, str]:
    """The printable character by which a byte-level vocabulary writes each byte: itself if it prints, else the next free one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = [letter for _, letter in sorted(byte_letters().items())]
_LATIN_END, _DOTTED_I = "\u0250", "\u0130"


class WordIds(dict):
    """Ids (little-endian 32-bit) of each word between ASCII white space, as the tokenizer gives them.

    White space separates tokens in the vocabulary's pre-tokenizer, so the ids of a
    text are those of its words one after another.  A word of Latin letters is one
    unit there and goes to the merges directly; all others take the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.older: dict[bytes, bytes] = {}

    def _encode(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if word.isalpha():  # ASCII letters
            ids = [t.id for t in self.merges(text.lower())]
        elif text.isalpha() and max(text) < _LATIN_END and _DOTTED_I not in text:
            ids = [t.id for t in self.merges("".join([_LETTERS[b] for b in text.lower().encode()]))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word[-1] in b".," and word[-2:-1].isalpha():
                ids = self[word[:-1]] + self[word[-1:]]
            else:
                ids = self._encode(word)
        if len(word) <= _LONGEST_KEPT:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        # ASCII letters in lower case at once, unless that could make a special token of ordinary text.
        return b"".join([self[w] for w in (text if b"<|" in text else text.lower()).split()])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker process."""
    return WordIds(path)


def binary_pieces(n: int, most: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    out = [(i, most) for i in range(0, n - n % most, most)]
    start, rest = n - n % most, n % most
    for bit in range(most.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            out.append((start, 1 << bit))
            start += 1 << bit
    return out


def pack(
    docs: DataFrame, vocabulary: str, text: str = "text", keep: Sequence[str] = ("doc_id",), sequence: int = SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: the columns `keep`, start, length, doc_tokens, tokens (binary: little-endian 32-bit ids),
    bucket (binary logarithm of the length), sequence_id and offset.

    A null text counts as empty: its one id is the end id.  Every row is packed,
    repeated ones too.  `sequence` must be a power of two.  sequence_id is unique
    and rises with the position in the input's partitions.
    """
    if sequence & (sequence - 1) or sequence < 1:
        raise ValueError("the sequence length must be a power of two")
    end = np.array([end_id], "<u4").tobytes()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("tokens", pa.binary())]))

    def make():
        words = word_ids(vocabulary)

        def cut(raw: bytes | None) -> list[dict]:
            ids = words.of(raw or b"") + end
            n = len(ids) // 4
            return [
                {"start": s, "length": k, "doc_tokens": n, "tokens": ids[4 * s : 4 * (s + k)]} for s, k in binary_pieces(n, sequence)
            ]

        return lambda texts: [pa.array([cut(t) for t in texts], kind)]

    sql = "array<struct<start:long,length:long,doc_tokens:long,tokens:binary>>"
    cut = with_scanned(docs, text, [("_pieces", kind, sql)], make, list(keep), binary=True)
    made = ("start", "length", "doc_tokens", "tokens")
    kept = [c for c in keep if c not in (*made, "bucket", "sequence_id", "offset")]
    return cut.select(*[F.col(f"`{c}`") for c in kept], F.explode("_pieces").alias("_piece")).select(
        *[F.col(f"`{c}`") for c in kept],
        *[F.col(f"_piece.{m}").alias(m) for m in made],
        F.log2("_piece.length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences below `path`, one folder for each bucket."""
    packed.write.partitionBy("bucket").parquet(path)
