from __future__ import annotations

import random
import re

import numpy as np
import pytest

from skyledger.llm import near_dedup as nd
from skyledger.llm import queries
from skyledger.llm import shingles as sh
from skyledger.llm.components import components

D = "/root/testdata/sf0.01"


def shingle_set(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    """Components by comparing all pairs of rows."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    # Only sets that share a shingle can be similar.
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = set()
    for i, s in enumerate(sets):
        seen = {j for x in s for j in holders[x] if j < i}
        pairs.update((j, i) for j in seen)
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    for i, (doc_id, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else doc_id
        yield doc_id, len(sets[i]), c, doc_id == c


def found(df):
    return sorted(
        (tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()),
        key=repr,
    )


def table(spark, rows):
    return spark.createDataFrame(
        [(*r, "clash") for r in rows], "doc_id long, text string, Kept string"
    )


def test_registers_estimate_similarity():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.5, 0.9):
        got = []
        for _ in range(60):
            pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
            common = int(300 * share)
            a, b = np.unique(pool[:300]), np.unique(np.r_[pool[:common], pool[300 : 600 - common]])
            want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            x, y = sh.registers(a), sh.registers(b)
            got.append(sh.estimate(x[None], y[None], np.array([len(a)]), np.array([len(b)]))[0] - want)
        assert abs(np.mean(got)) < 0.02 and np.std(got) < 0.05


def test_chance_collisions():
    rng = np.random.default_rng(4)
    agree = []
    for _ in range(400):
        a, b = rng.integers(0, 2**63, (2, 100), dtype=np.uint64)
        agree.append((sh.registers(a) == sh.registers(b)).mean())
    want = sh.chance_collision(100, 100)
    assert want / 2 < np.mean(agree) < 2 * want


def test_similar_sets_share_a_band():
    rng = np.random.default_rng(5)
    for n in (7, 20, 200):
        for _ in range(150):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            b = np.unique(np.r_[a, rng.integers(0, 2**63, int(n * 0.17), dtype=np.uint64)])
            assert sh.similar(a, b, 85)
            assert (sh.bands(sh.registers(a)) == sh.bands(sh.registers(b))).any()


def test_words_and_sets():
    of = sh.Shingler()
    assert len(of.shingles("")) == len(of.shingles(" \t\n\x0b\x0c\r")) == 0
    assert len(of.shingles("a b c d")) == 1 and len(of.shingles("a b c d e f")) == 2
    assert (of.shingles("A É b\nc\x0bd e") == of.shingles("a É B c d  E")).all()
    assert (of.shingles("a\xa0b c d e f") != of.shingles("a b c d e f")).any()
    for text in ("x y z " * 40, "one two three four five six", "q"):
        assert len(of.shingles(text)) == len(shingle_set(text))


BASE = " ".join(f"w{i}" for i in range(120))


def test_edge_rows(spark):
    other = " ".join(f"v{i}" for i in range(60))
    rows = [
        (1, None), (2, ""), (2, " \n"), (3, "a b"), (4, "A  b"), (5, "a b c"), (9, BASE), (7, BASE.upper()),
        (7, BASE), (8, BASE + " tail"), (None, BASE), (None, None), (11, other), (11, "different text 11"),
        (12, other + " more"), (13, "w " * 30_000), (14, "w " * 4), (15, "w " * 5), (None, "nobody"),
    ]
    got = nd.near_duplicates(table(spark, rows))
    assert got.columns == ["doc_id", "text", "n_shingles", "component_id", "kept", "representative"]
    want = [
        (d, n, c, True if d is None and c is None else bool(k)) for d, n, c, k in brute(rows)
    ]
    assert found(got) == sorted(want, key=repr)
    assert nd.near_duplicates(table(spark, rows).limit(0)).count() == 0
    one = nd.one_of_each(table(spark, rows)).collect()
    texts = [r.text for r in one]
    assert sum(t is not None and t.lower().startswith("w0 ") for t in texts) == 1
    assert sum(not (t or "").strip() for t in texts) == 4


def near_copies(n, seed):
    rng = random.Random(seed)
    words = BASE.split()
    for i in range(n):
        copy = list(words)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**9)}"
        yield 10_000 - i, " ".join(copy)


@pytest.mark.parametrize("block", [512, 40])
def test_a_large_group_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK_NODES", block)
    rows = [*near_copies(300, 1), *((20_000 + i, BASE) for i in range(50))]
    want = sorted(brute(rows), key=repr)
    assert len({r[2] for r in want}) > 5
    assert found(nd.near_duplicates(table(spark, rows))) == want


def test_chains_are_followed(spark):
    """Each document is like the next but not like the one after."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(60)]
    want = sorted(brute(rows), key=repr)
    assert len({r[2] for r in want}) < 60
    assert found(nd.near_duplicates(table(spark, rows))) == want


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 50)]
    edges += [(5000, 5000), (7000 + rng.randrange(9), 7000 + rng.randrange(9))]
    rng.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(201)) and got[1049] == 1000 and got[5000] == 5000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text")
    want = sorted(brute([tuple(r) for r in docs.collect()]), key=repr)
    assert sum(not r[3] for r in want) > 10
    assert found(queries.op10_near_dedup(spark, D)) == want
