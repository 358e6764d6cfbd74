"""Packing of tokenised documents by power-of-two decomposition.

A document of L tokens (its ids and one end id) is cut into pieces whose
lengths are powers of two: as many of the longest length as fit, then the binary
digits of the rest, longest first. Every piece is a sequence of its own and pieces
of one length form a bucket, so no sequence crosses documents, every batch drawn
from a bucket is rectangular, and there is no padding at all.

The pass is narrow: no shuffle, one slice of texts in memory. The ids are those of
the byte-level BPE file of the ``tokenizers`` library, special tokens in a text
included; they are computed with ``tiktoken``'s merge loop over the same
vocabulary, which takes a fifth of the time (a test holds the two together). Its
pattern gives up on a million white-space characters in a row; such a text is encoded
by ``tokenizers`` itself.

Cases: a null or empty text is the end id alone, one piece of length 1. Repeated rows
are packed each. An empty table gives no rows. Columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from skyledger.llm.arrow import map_slices, texts

MAX_LENGTH = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return shown | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks by byte string and the special tokens of a ``tokenizers`` JSON file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    byte = _byte_alphabet()
    ranks = {
        bytes(byte[c] for c in piece): i
        for piece, i in spec["model"]["vocab"].items()
        if piece not in special
    }
    return ranks, special


_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(name: str, ranks: dict, special: dict, pattern: str) -> tiktoken.Encoding:
    """The encoder of a vocabulary, made once per Python worker."""
    if name not in _encodings:
        _encodings[name] = tiktoken.Encoding(
            name, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special
        )
    return _encodings[name]


class _Ids:
    """The ids of texts by one vocabulary file."""

    def __init__(self, path: str, ranks: dict, special: dict, pattern: str):
        self.path, self.encoder = path, encoding(path, ranks, special, pattern)
        self.slow: Tokenizer | None = None

    def of(self, text: str) -> np.ndarray:
        try:
            found = self.encoder.encode_to_numpy(
                text, allowed_special="all", disallowed_special=()
            )
        except ValueError:  # the pattern's stack is too small for this text
            if self.slow is None:
                self.slow = Tokenizer.from_file(self.path)
            found = np.array(self.slow.encode(text, add_special_tokens=False).ids)
        return found.astype("<u4", copy=False)


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Powers of two that add up to ``n``, longest first."""
    bits = [1 << b for b in range(longest.bit_length() - 2, -1, -1)]
    return [longest] * (n // longest) + [b for b in bits if n & b]


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
)


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    longest: int = MAX_LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece; ``ids`` holds little-endian unsigned 32-bit ids.

    ``bucket`` is the binary logarithm of the length. ``sequence_id`` is unique; a
    retried task gives its rows the same numbers, because they follow from the split
    and the place in it.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    ranks, special = read_vocabulary(path)
    pattern = public_tokenizers.PATTERN
    shared = docs.sparkSession.sparkContext.broadcast((ranks, special))
    arrow_schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
            ("doc_tokens", pa.int64()),
        ]
    )

    def make():
        ids_of = _Ids(path, *shared.value, pattern)
        end = np.array([end_id], dtype="<u4")

        def apply(part: pa.RecordBatch) -> pa.RecordBatch:
            doc, start, length, ids, total = [], [], [], [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts(part)):
                data = np.concatenate([ids_of.of(text), end]).tobytes()
                n, at = len(data) // 4, 0
                for size in piece_lengths(n, longest):
                    doc.append(doc_id)
                    start.append(at)
                    length.append(size)
                    ids.append(data[4 * at : 4 * (at + size)])
                    total.append(n)
                    at += size
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(v, f.type)
                    for v, f in zip((doc, start, length, ids, total), arrow_schema)
                ],
                schema=arrow_schema,
            )

        return apply

    pieces = map_slices(
        docs.select(F.col("doc_id").cast("long"), "text"), make, PIECES
    )
    return pieces.select(
        "*",
        F.log2("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the pieces with one folder per length, for batches without padding.

    The hint splits a large bucket over tasks.
    """
    pieces.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "bucket",
    )
