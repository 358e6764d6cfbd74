from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import packing

TEXTS = [
    "plain words and more words",
    "",
    None,
    "a<|endoftext|>b  \n\n\t c",
    "é à 中文 \U0001f600 ß",
    "word " * 5000,
    "x" * 3000,
    "same",
    "same",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def table(spark, texts):
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, bucket string")


def test_piece_lengths():
    assert packing.piece_lengths(2063) == [1024, 1024, 8, 4, 2, 1]
    for n in range(1, 3000):
        sizes = packing.piece_lengths(n)
        assert sum(sizes) == n and sizes == sorted(sizes, reverse=True)
        assert all(s & (s - 1) == 0 for s in sizes)


def test_pieces_hold_the_ids_of_the_tokenizer(spark, tokenizer):
    rows = packing.pack(table(spark, TEXTS)).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    for i, text in enumerate(TEXTS):
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces]).tolist()
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in pieces:
            assert (r.start, r.offset, r.doc_tokens) == (at, 0, len(ids))
            assert r.length == 2**r.bucket == len(r.ids) // 4
            at += r.length


def test_all_documents(spark, tokenizer):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = packing.piece_digests(packing.pack(docs)).collect()
    got = {(r.doc_id, r.start, r.length): r.ids_crc32 for r in rows}
    want = {}
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        at = 0
        for n in packing.piece_lengths(len(ids)):
            data = np.array(ids[at : at + n], "<u4").tobytes()
            want[r.doc_id, at, n] = zlib.crc32(data)
            at += n
    assert got == want


@pytest.mark.parametrize("white", [" ", "\n", "\t", " \n"])
def test_long_white_space(spark, tokenizer, white):
    """Two million white-space characters in a row, also inside a text."""
    long = white * (2_000_000 // len(white))
    for text in (long, f"before{long}after") if white == " " else (f"before{long}after",):
        rows = sorted(packing.pack(table(spark, [text, "next"])).collect(), key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows if r.doc_id == 0])
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert sum(r.doc_id == 1 for r in rows) == 1


def test_repeated_rows_and_no_rows(spark):
    docs = table(spark, ["twice"]).union(table(spark, ["twice"]))
    rows = packing.pack(docs).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert len({(r.start, bytes(r.ids)) for r in rows}) == len(rows) // 2
    assert packing.pack(docs.limit(0)).count() == 0


def test_buckets_on_disk(spark, tmp_path):
    path = f"{tmp_path}/buckets"
    packing.write_buckets(packing.pack(table(spark, TEXTS)), path)
    back = spark.read.parquet(path)
    assert back.where("length != shiftleft(1, bucket)").isEmpty()
    assert back.agg({"length": "sum"}).first()[0] == sum(
        r.doc_tokens for r in back.where("start = 0").collect()
    )


def test_longest_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(table(spark, []), longest=1000)
