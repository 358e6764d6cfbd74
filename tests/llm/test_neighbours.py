from __future__ import annotations

import math

import numpy as np
import pytest

from skyledger.llm import hnsw, neighbours, queries

D = "/root/testdata"


def brute(rows, k=20):
    """Exact neighbours; rows are distinct pairs of id and vector."""
    good = sorted(
        {
            (i, tuple(v)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        }
    )
    out = {}
    for i, q in good:
        if i % 20 == 0:
            scored = [
                (-float((np.array(v) * np.array(q)).sum()), j)
                for j, v in good if j != i and len(v) == len(q)
            ]
            out[i, q] = sorted(scored)[:k]
    return out


def result(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in got.items()}


@pytest.mark.parametrize("nodes", [8192, 200])
def test_recall_on_the_whole_table(spark, monkeypatch, nodes):
    monkeypatch.setattr(neighbours, "SHARD_NODES", nodes)
    table = spark.read.parquet(f"{D}/sf0.1/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, dtype=float) for r in table.collect()}
    ids, all_ = np.array(list(rows)), np.array(list(rows.values()))
    got = result(queries.op9_neighbours(spark, f"{D}/sf0.1"))
    assert set(got) == {i for i in rows if i % 20 == 0}
    hit = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(s == pytest.approx(rows[v] @ rows[q], rel=1e-12) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        exact = ids[np.argsort(-np.where(ids == q, -9e9, all_ @ rows[q]))[:20]]
        hit += len(set(exact) & {v for _, v, _ in found})
    assert hit >= 0.95 * 20 * len(got)


def test_edge_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(1, 60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]  # ties
    rows += [(0, [2.0, 0.0, -1.0, 0.5])] * 3
    rows += [(200, None), (220, []), (240, [0.0] * 4), (260, [1.0, None, 0.0, 0.0])]
    rows += [(280, [float("nan")] * 4), (300, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(320, [1.0, 1.0]), (321, [1.0, 0.5]), (340, [5.0, 5.0, 5.0])]
    rows += [(360, [30.0, -2.0, 1.0, 1e-3]), (361, [-0.0, 0.0, 0.0, 7.0])]
    table = spark.createDataFrame(
        [(*r, 7) for r in rows], "vec_id long, embedding array<float>, score int"
    )
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = brute(exact)
    got = result(neighbours.nearest_of_every(table))
    assert set(got) == {i for (i, _), hits in want.items() if hits}
    for (i, _), hits in want.items():
        if hits:
            assert [v for _, v, _ in got[i]] == [j for _, j in hits]
            assert [s for _, _, s in got[i]] == pytest.approx([-s for s, _ in hits])
    assert neighbours.nearest_of_every(table.limit(0)).count() == 0


def test_ties_beyond_k_go_to_the_smaller_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(500)] + [(1000, [2.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = result(neighbours.nearest_of_every(table))
    assert [v for _, v, _ in got[40]] == [1000, *range(19)]
    assert [v for _, v, _ in got[0]] == [1000, *range(1, 20)]


def test_links_are_bounded_and_levels_nested():
    rng = np.random.default_rng(2)
    graph = hnsw.Graph.build(rng.normal(size=(3000, 8)))
    for h, level in enumerate(graph.levels):
        assert level.links.shape[1] == (hnsw.LINKS if h else hnsw.BOTTOM_LINKS)
        held = level.links[level.nodes]
        assert np.isin(held[held >= 0], level.nodes).all()
        if h:
            assert np.isin(level.nodes, graph.levels[h - 1].nodes).all()
    assert len(graph.levels[0].nodes) == 3000 and len(graph.levels) > 1


@pytest.mark.parametrize("n", [1, 2, 20, 600, 1500])
def test_graph_search_against_brute_force(n):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(5, 16)) * 3
    x = centres[rng.integers(0, 5, n)] + rng.normal(size=(n, 16)) * 0.1  # tight clusters
    q = rng.normal(size=(50, 16))
    near = hnsw.Graph.build(x).search(q)
    hit = want = 0
    for i in range(50):
        top = np.argsort(-(x @ q[i]))[:10]
        want += len(top)
        hit += len(set(top) & set(near[i]))
    assert hit >= 0.9 * want


@pytest.mark.parametrize("times", [100, 1_000, 3_000, 10_000, 1_000_000])
def test_recall_beside_a_very_long_vector(times):
    """More than ``BRUTE`` nodes, one of them ``times`` as long as the rest."""
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(4000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[17] *= times
    graph = hnsw.Graph.build(vectors)
    queries = vectors[::40]
    near = graph.search(queries)
    hit = 0
    for q, found in zip(queries, near):
        exact = set(np.argsort(-(vectors @ q))[:20].tolist())
        found = found[found >= 0]
        hit += len(exact & set(found[np.argsort(-(vectors[found] @ q))[:20]].tolist()))
    assert hit >= 0.95 * 20 * len(queries)


def test_a_shard_is_moved_once(spark):
    """The index is read and shuffled as it is; only queries are copied."""
    vectors = neighbours.usable(spark.read.parquet(f"{D}/sf0.001/embeddings.parquet"))
    index = neighbours.build_index(vectors)
    found = neighbours.search(index, vectors.where("vec_id % 20 = 0"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "Generate explode" in x]
    assert lines and not any("links" in x or "id_counts" in x for x in lines)
    assert "FlatMapCoGroups" not in plan and found.count() == 25 * 20
