from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from skyledger.llm import manifest, queries
from tests.compare import difference, duck

D = "/root/testdata"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def framed(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(nodes):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def siblings(levels, i):
    """Pairs of the siblings before and after, from the leaf up."""
    out = []
    for level in levels[:-1]:
        start = i // 8 * 8
        out.append(("".join(level[start:i]), "".join(level[i + 1 : start + 8])))
        i //= 8
    return out


def brute(rows):
    """All result rows from (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        text = r[4]
        if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf = h(*map(framed, r))
        groups.setdefault(r[2], []).append((r[0], leaf, h(*map(framed, (*r[:4], text)))))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for v in groups.values():
        v.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {g: tree([x[1] for x in groups[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, (doc_id, leaf, copy) in enumerate(groups[g]):
            path = siblings(trees[g], i) + siblings(top, at)
            node = copy
            for left, right in path:
                node = h(left, node, right)
            proof = h(*(a + b for a, b in path))
            root = top[-1][0]
            out.append((doc_id, leaf, trees[g][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def result(docs, block_levels=4):
    found = manifest.verify_tampered(docs, block_levels)
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("block_levels", [1, 4])
def test_whole_table_equals_brute_force(spark, monkeypatch, block_levels):
    """Small partitions make several rounds with shorter subtrees at the end."""
    monkeypatch.setattr(manifest, "ROWS_PER_RANGE", 100)
    docs = spark.read.parquet(f"{D}/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = result(docs, block_levels)
    assert got == brute([tuple(r) for r in rows])
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_query_equals_sql(spark):
    df = queries.op12_manifest(spark, f"{D}/sf0.001")
    assert difference(df, duck(f"{D}/sf0.001"), queries.ORACLE["op12_manifest"]) is None


def test_edge_rows(spark):
    rows = [(i, "s", "en", 3, "Abc") for i in range(70)]
    rows += [(7, "s", "en", 3, "Abc")] * 40  # one row holds a third of all
    rows += [(None, None, None, None, None), (None, "S", None, 1, "É Z"), (3, "", "de", 0, "")]
    rows += [(i, None, f"x{i}", -1, "LONG " * 50_000) for i in range(9)]
    rows += [(-5, "s", "", 0, None), (2**62, "s", "é", 0, "\U0001f600A")]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA).repartition(5)
    assert result(docs, 1) == brute(rows)


def test_lone_leaf_and_empty_table(spark):
    one = spark.createDataFrame([(5, "s", "en", 1, "a", "x")], SCHEMA)
    ((_, leaf, subroot, root, proof, folded, verified),) = result(one)
    assert leaf == subroot == root == folded and verified and proof == h("")
    assert result(one.limit(0)) == []


def test_proofs_hold_the_siblings(spark):
    docs = spark.read.parquet(f"{D}/sf0.001/documents.parquet")
    rows = manifest.proofs(manifest.leaves(docs)).collect()
    assert len(rows) == 200 and all(r.verified for r in rows)
    for r in rows:
        node = r.leaf
        for left, right in zip(r.before, r.after):
            node = h(left, node, right)
        assert node == r.root
        assert r.proof_sha256 == h(*(a + b for a, b in zip(r.before, r.after)))


def test_unequal_groups_meet_at_the_top(spark):
    """Eleven groups of very different size: short ones stand in for missing partitions."""
    rows = [(i, "s", f"g{g}", 1, "T") for g in range(11) for i in range(g * g * 9 + 1)]
    docs = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    assert result(docs, 1) == brute(rows)
