from __future__ import annotations

import math

import numpy as np
import pytest

from skyledger.llm import hard_negatives, queries
from tests.compare import difference, duck

D = "/root/testdata"
SCHEMA = "vec_id long, embedding array<double>, label int, score string"


def brute(rows):
    """All result rows from (vec_id, embedding, label), by Python integers."""
    good = set()
    for i, v, label in rows:
        if i is None or label is None or not v:
            continue
        if any(x is None or not math.isfinite(x) for x in v):
            continue
        moved = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        good.add((i, moved, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a in good:
        if a[0] % 50:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1])
            for r in good if r != a and len(r[2]) == len(a[2])
        )
        for minus, positive, _ in [s for s in scored if s[2] == a[1]][:5]:
            best = [s for s in scored if s[2] != a[1] and 50 * -minus <= 100 * -s[0] <= 95 * -minus]
            out += [
                (a[0], positive, rank, s[1], -minus, -s[0]) for rank, s in enumerate(best[:3], 1)
            ]
    return sorted(out)


def result(df):
    return sorted(map(tuple, hard_negatives.mine(df).collect()))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("cells", [1 << 17, 64 * 90])
def test_whole_table_equals_brute_force(spark, monkeypatch, cells):
    """In one shard and in many."""
    monkeypatch.setattr(hard_negatives, "LEAST_CELLS", cells)
    table = spark.read.parquet(f"{D}/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    if cells < 1 << 17:
        rows = rows[:700]
        table = table.where(f"vec_id in ({','.join(str(r[0]) for r in rows)})")
    assert result(table) == brute(rows)


def test_query_equals_sql(spark):
    df = queries.op11_hard_negatives(spark, f"{D}/sf0.01")
    assert difference(df, duck(f"{D}/sf0.01"), queries.ORACLE["op11_hard_negatives"]) is None


def test_lengths_ties_and_repeated_rows(spark, monkeypatch):
    """Clusters along one direction at many lengths, with copies of rows and of vectors."""
    monkeypatch.setattr(hard_negatives, "LEAST_CELLS", 8 * 150)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        base = np.zeros(8)
        base[i % 3] = 1
        v = (base + rng.normal(size=8) * 0.2) * 10.0 ** rng.integers(-2, 3)
        rows.append((i, [float(x) for x in v], int(i % 4)))
    rows += [(1000 + i, [0.5] * 8, i % 4) for i in range(200)]  # a third of all are equal
    rows += rows[:50]
    rows += [(50, [0.25] * 8, 1), (100, [0.0] * 8, 2), (2**61 - 2**61 % 50, [1.0] * 8, 9)]
    assert result(frame(spark, rows)) == brute(rows)


def test_rows_that_take_no_part(spark):
    good = [(i, [1.0, float(i % 5), 2.0], i % 2) for i in range(-101, 101)]
    bad = [(150, None, 1), (200, [], 1), (250, [1.0, None, 1.0], 1), (None, [1.0, 1.0, 1.0], 1)]
    bad += [(300, [1.0, math.nan, 1.0], 1), (350, [1.0, math.inf, 1.0], 1), (400, [9.0] * 3, None)]
    bad += [(450, [1.0, 1.0], 1), (0, [1.0, 2.0], 1), (3, [-1.0, 2.0], 1), (4, [1.0, 1.0], 0)]
    assert result(frame(spark, good + bad)) == brute(good + bad)
    assert result(frame(spark, good).limit(0)) == []


def test_products_beyond_doubles(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * 1e5 + 3e5).tolist(), i % 3) for i in range(200)]
    assert result(frame(spark, rows)) == brute(rows)


def test_pruning_leaves_out_only_what_cannot_enter():
    """On concentrated vectors most rows are never verified, and the best stay the same."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 16)) * 4
    vectors = np.floor((centres[rng.integers(0, 20, 6000)] + rng.normal(size=(6000, 16)) * 0.3) * 256)
    ids = np.arange(6000)
    verified = 0
    for i in range(0, 6000, 500):
        buckets = list(hard_negatives.length_buckets(vectors, ids, ids, np.zeros(6000)))
        row = {"vec_id": i, "_key": i, "label": 0, "wants": [0], "lows": [-(2**63)], "highs": [2**63 - 1]}
        anchor = hard_negatives.Anchor(row, vectors[i], 5, True)
        for b in buckets:
            if anchor.unreachable(b):
                continue
            rows = anchor.candidates(b)
            at = np.arange(len(b.ids)) if rows is None else rows
            verified += len(at)
            anchor.offer(b, rows, b.vectors[at] @ vectors[i])
        scores = vectors @ vectors[i]
        exact = sorted((-s, j) for j, s in enumerate(scores) if j != i)[:5]
        assert anchor.found[0] == exact
    assert verified < 0.6 * 12 * 6000
