from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from skyledger.llm import line_dedup, packing, quality
from tests.llm import test_line_dedup, test_near_dedup, test_secrets

D = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute(rows, model):
    """Pieces of all documents, each stage on lists in memory."""
    scores = model.scores(quality.Lines.of([t or "" for _, t, _ in rows]))
    rows = [r for r, s in zip(rows, scores) if s >= quality.THRESHOLD]
    lines = test_line_dedup.brute(
        [(i, s, t) for i, t, s in rows], line_dedup.RATIO, line_dedup.MIN_PAGES
    )
    rows = [(i, t) for i, _, t, _, _ in lines]
    kept = [k for _, _, _, k in test_near_dedup.brute(rows)]
    rows = [(i, test_secrets.redacted(t)) for (i, t), k in zip(rows, kept) if k]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for n in packing.piece_lengths(len(ids)):
            yield doc_id, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()), len(ids)
            at += n


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    labels = spark.read.parquet(f"{D}/labels.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = sorted(brute(rows, quality.train(docs, labels)))
    got = entry.queries()["pipeline"](spark, D).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    assert (
        sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    )
    assert 0 < len({w[0] for w in want}) < len(rows)


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, D)
        assert docs.columns == COLUMNS
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] == sizes[4]


def test_odd_tables(spark, tmp_path):
    """Nulls everywhere, empty and repeated texts, clashing columns, no rows."""
    label = "doc_id long, quality int, toxic int"
    spark.createDataFrame([(1, None, 0), (None, 1, 0)], label).write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    rows = [
        (1, None, None, None, None), (1, "", "en", "a", 0), (None, "password=abcdefghijklmnop", "en", None, 5),
        (3, "same text\nof two lines", "en", "a", 22), (3, "same text\nof two lines", "en", "a", 22),
        (4, "x " * 50_000, "en", "b", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = spark.createDataFrame(rows, schema).selectExpr(
        "*", "1 kept", "2 score", "3 component_id", "4 secret_spans", "5 n_lines", "6 quality_score"
    )
    for odd in (table, table.limit(0)):
        docs = odd
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, f"{tmp_path}")
            assert set(schema.replace(",", "").split()[::2]) <= set(docs.columns)
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, f"{tmp_path}").collect()
        assert bool(pieces) == (odd is table)


def test_a_group_of_copies_keeps_one_text(spark):
    text = "first line of the copies\nand their second line"
    rows = [(i, text, "en", "a", len(text)) for i in range(20)]
    rows += [(20 + i, f"text {i} of its own\nw{i} x{i} y{i} z{i}", "en", "a", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lined = corpus_pipeline.dedup_lines(spark, docs, D)
    left = corpus_pipeline.dedup_near(spark, lined, D).collect()
    assert [r.text for r in left if r.doc_id < 20] == [text]
    assert sum(r.doc_id >= 20 for r in left) == 40


def test_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
