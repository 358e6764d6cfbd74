from __future__ import annotations

from hashlib import sha256

import pytest

from skyledger.llm import fingerprints as fp

D = "/root/testdata/sf0.001"


def brute(rows):
    """Edited texts by one sort of all rows."""
    rows = sorted(rows, key=lambda r: r[1] or "")
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        half = len(text) // 2
        yield doc_id, text, after, text[: len(text) - half] + after[:half]


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, near_next double")
    n = len(rows)
    df = {}
    for _, t in rows:
        for w in set((t or "").lower().split()):
            df[w] = df.get(w, 0) + 1
    band = [w for w, c in df.items() if fp.MIN_SHARE * n <= c <= fp.MAX_SHARE * n]
    assert sorted(fp.lexicon(docs)) == sorted(band)
    of = fp.Fingerprinter(band).of
    want = []
    for doc_id, text, after, changed in brute(rows):
        a, b, c = of(text), of(changed), of(after)
        want.append((doc_id, len(text), sha256(changed.encode()).hexdigest(), a, b,
                     fp.likeness(a, b), fp.likeness(a, c)))
    got = [tuple(r) for r in fp.compare_edited(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in docs])


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "only one \U0001f600 é")],
        [(1, None), (2, ""), (5, "a b c"), (9, "x" * 5001)],
        [(3, "b c d e"), (3, "a b c d"), (3, "a b c d"), (1, "tie")],
        [(None, "no id"), (None, "no id at all"), (7, "seven"), (-7, "minus")],
    ],
)
def test_small_tables(spark, rows):
    check(spark, rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fp.compare_edited(docs).count() == 0
    assert fp.fingerprints(docs).count() == 0


def test_edited_texts_are_nearer_than_strangers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = fp.compare_edited(docs).selectExpr(
        "avg(near_edited) e", "avg(near_next) n", "avg(double(near_edited > near_next)) wins"
    ).first()
    assert r.e > 3 * r.n and r.wins > 0.9, r


def test_equal_texts_have_equal_fingerprints(spark):
    docs = spark.createDataFrame([(i, "the same words") for i in range(5)], "doc_id long, text string")
    assert fp.fingerprints(docs).select("fingerprint").distinct().count() == 1
    assert fp.likeness(*[fp.Fingerprinter([]).of("")] * 2) == 1.0
