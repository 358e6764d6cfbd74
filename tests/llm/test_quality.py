from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from skyledger.llm import quality as q

D = "/root/testdata/sf0.01"


def brute(potential, pairs):
    """Marginals and expected pairs by all labellings of one document."""
    n = len(potential)
    total, good, seen = 0.0, np.zeros(n), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        s = sum(p for p, y in zip(potential, labels) if y)
        s += sum(pairs[a, b] for a, b in zip(labels, labels[1:]))
        w = np.exp(s)
        total += w
        good += w * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            seen[a, b] += w
    return good / total, seen / total


def test_marginals_equal_those_of_all_labellings():
    rng = np.random.default_rng(1)
    counts = np.array([3, 1, 7, 2, 7])
    potential, pairs = rng.normal(size=counts.sum()) * 3, rng.normal(size=(2, 2))
    good, expected = q.Crf(np.zeros(1), pairs).marginals(potential, counts)
    ends = np.cumsum(counts)
    want = [brute(potential[e - n : e], pairs) for e, n in zip(ends, counts)]
    assert np.allclose(good, np.concatenate([w[0] for w in want]))
    assert np.allclose(expected, sum(w[1] for w in want))


def test_extreme_potentials_stay_finite():
    good, _ = q.Crf(np.zeros(1), np.zeros((2, 2))).marginals(
        np.array([1e4, -1e4, 0.0]), np.array([3])
    )
    assert np.allclose(good, [1, 0, 0.5])


def likelihood(model, lines, labels):
    """Log likelihood by all labellings."""
    potential = model.weights[lines.indices()].sum(axis=1)
    out, at = 0.0, 0
    for n, y in zip(lines.counts, labels):
        u = potential[at : at + n]
        norm = sum(
            np.exp(sum(p for p, k in zip(u, ys) if k)
                   + sum(model.pairs[a, b] for a, b in zip(ys, ys[1:])))
            for ys in itertools.product((0, 1), repeat=int(n))
        )
        out += y * u.sum() + (n - 1) * model.pairs[y, y] - np.log(norm)
        at += n
    return out / len(labels)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    lines = q.Lines.of(["One line, here.\nTWO!! TWO!!\n\nthree three", "a | b | c\nword"])
    labels = np.array([0, 1])
    model = q.Crf(rng.normal(size=q.N_WEIGHTS) / 5, rng.normal(size=(2, 2)))
    weights, pairs = q.gradient(model, lines, labels, lines.indices())
    for i in np.unique(lines.indices())[::5]:
        up, down = model.weights.copy(), model.weights.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        got = likelihood(q.Crf(up, model.pairs), lines, labels) - likelihood(
            q.Crf(down, model.pairs), lines, labels
        )
        assert weights[i] == pytest.approx(got / 2e-5, abs=1e-5)
    up = model.pairs + np.eye(2)[:, ::-1] * [[0, 0], [1e-5, 0]]
    down = model.pairs - np.eye(2)[:, ::-1] * [[0, 0], [1e-5, 0]]
    got = likelihood(q.Crf(model.weights, up), lines, labels) - likelihood(
        q.Crf(model.weights, down), lines, labels
    )
    assert pairs[1, 0] == pytest.approx(got / 2e-5, abs=1e-5)


def test_neighbouring_lines_count():
    a = q.Lines.of(["plain words here.\nTHE!! END!!\nplain words here."]).indices()
    b = q.Lines.of(["plain words here.\nplain words here.\nplain words here."]).indices()
    n = len(q.FEATURES)
    assert (a[0, :n] == b[0, :n]).all() and (a[0, 2 * n :] != b[0, 2 * n :]).any()
    assert (a[2, n : 2 * n] != b[2, n : 2 * n]).any()


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels")]


def test_held_out_documents(spark, tables):
    docs, labels = tables
    rows = {r.doc_id: r for r in q.classify(docs, labels).collect()}
    assert len(rows) == docs.count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(rows[x.doc_id], x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    assert sum(r.predicted == y for r, y in held) >= 0.97 * len(held)
    good = [r.score for r, y in held if y]
    bad = [r.score for r, y in held if not y]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.99


def test_held_out_labels_teach_nothing(spark, tables):
    docs, labels = tables
    turned = labels.withColumn(
        "quality",
        q.F.when(q.held_out(), 1 - q.F.col("quality")).otherwise(q.F.col("quality")),
    )
    a, b = q.train(docs, labels, 200), q.train(docs, turned, 200)
    assert (a.weights == b.weights).all() and (a.pairs == b.pairs).all()


def test_repeated_rows_teach_once(spark, tables):
    docs, labels = tables
    few = labels.where("quality in (0, 1)").where(~q.held_out()).orderBy("doc_id").limit(20)
    often = few.select("doc_id").orderBy("doc_id").limit(1)
    chosen = docs.join(few.select("doc_id"), "doc_id")
    again = chosen.join(often, "doc_id").join(spark.range(30).select(), how="cross")
    once, many = q.train(chosen, few), q.train(chosen.unionByName(again), few)
    assert np.array_equal(once.weights, many.weights)
    assert np.array_equal(once.pairs, many.pairs)


def test_edge_rows(spark):
    long = "A very long line of words. " * 20_000
    rows = [(1, None, 9.0), (1, None, 9.0), (2, "", 9.0), (None, long, 9.0), (4, "\n\n\n", 9.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Quality_Score double")
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (2, 0), (2, None), (None, 1), (4, 7)], "doc_id long, quality int"
    )
    for known in (labels, labels.limit(0)):
        got = q.classify(docs, known).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got} == {0.5}
    kept = q.score(docs, q.Crf.untrained())
    assert kept.columns == ["doc_id", "text", "quality_score"]
    assert q.accepted(kept, 0.6).count() == 0
    assert q.classify(docs.limit(0), labels).count() == 0
