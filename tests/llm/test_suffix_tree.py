from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skyledger.llm import queries, suffix_tree

D = "/root/testdata"
SCHEMA = "doc_id long, text string, score string"


def split(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w] + ["\n"]


def brute(rows, depth=2, min_count=32, min_gain=12.0):
    """Results of the contract's columns from (doc_id, text), context by context."""
    out = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    texts = [split(t) for _, t in rows]
    train = [t for t, o in zip(texts, out) if not o]
    next_of = defaultdict(Counter)
    for t in train:
        for i, w in enumerate(t):
            for d in range(min(i, depth) + 1):
                next_of[tuple(t[i - d : i])][w] += 1
    root = next_of[()]
    n, v = sum(root.values()), len(root)

    def base(w):
        return (root[w] + 0.5) / (n + 0.5 * (v + 1))

    def probability(state, w):
        if not state:
            return base(w)
        counts = next_of[state]
        back = len(counts) * probability(state[1:], w)
        return (max(counts[w] - 1, 0) + back) / sum(counts.values())

    states = {()}
    for d in range(1, depth + 1):
        for s in [s for s in next_of if len(s) == d and s[1:] in states]:
            counts = next_of[s]
            total = sum(counts.values())
            if total < min_count:
                continue
            gain = sum(
                c * (math.log((c - 1) / total) - float(np.float16(math.log(probability(s[1:], w)))))
                for w, c in counts.items() if c > 1
            )
            once = sum(c == 1 for c in counts.values())
            if gain + once * math.log(len(counts) / total) >= min_gain:
                states.add(s)
    result = []
    for (i, _), o, t in zip(rows, out, texts):
        score = 0.0
        for k, w in enumerate(t):
            s = ()
            for d in range(1, min(k, depth) + 1):
                if tuple(t[k - d : k]) not in states:
                    break
                s = tuple(t[k - d : k])
            score += math.log10(probability(s, w))
        known = sum(root[w] > 0 for w in t)
        result.append((i, o, len(t), known, n, sum(math.log10(base(w)) for w in t), score))
    return result, states


def key(r):
    return (r[0] is not None, r[0] or 0, *r[1:4], round(r[6], 3))


def same(got, expected):
    got, expected = sorted(got, key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for a, b in zip(got, expected):
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9)


def result(df, **options):
    return [tuple(r) for r in suffix_tree.score(df, **options).collect()]


@pytest.fixture(scope="module")
def whole(spark):
    docs = spark.read.parquet(f"{D}/sf0.01/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.collect()]


def test_whole_table_equals_brute_force(spark, whole):
    _, rows = whole
    expected, states = brute(rows)
    assert {len(s) for s in states} == {0, 1, 2}
    same([tuple(r) for r in queries.op13_suffix_tree(spark, f"{D}/sf0.01").collect()], expected)


@pytest.mark.parametrize("depth", [1, 3])
def test_parts_and_slices_change_nothing(spark, whole, depth):
    """Hot contexts in parts, texts longer than a slice, contexts of other lengths."""
    docs, rows = whole
    options = {"depth": depth, "min_count": 8, "min_gain": 3.0}
    expected, states = brute(rows, **options)
    assert max(len(s) for s in states) == depth
    same(result(docs, slice_tokens=1500, part_count=700, **options), expected)


def test_least_count_follows_the_corpus(spark, whole):
    docs, rows = whole
    total = brute(rows, depth=0)[0][0][4]
    same(result(docs, min_share=100 / total), brute(rows, min_count=100)[0])


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    found = result(spark.read.parquet(f"{D}/sf0.1/documents.parquet"))
    held = [r for r in found if r[1]]
    tokens, base, score = (sum(r[i] for r in held) for i in (2, 5, 6))
    assert score / tokens > base / tokens + 0.1


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "_CUT", 1000)
    rows = [(i, "The cat sat on the mat and The cat sat down") for i in range(60)]
    rows += [(7, "The cat sat")] * 40  # a third of all rows are one
    rows += [(100, None), (101, ""), (102, " \t\n\x0b\x0c\r "), (None, "the Cat ran"), (None, None)]
    rows += [(103, "É x İ the cat"), (104, "word " * 5000 + "the cat sat"), (105, "x" * 50_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], SCHEMA).repartition(3)
    options = {"min_count": 4, "min_gain": 0.5}
    same(result(df, slice_tokens=300, part_count=100, **options), brute(rows, **options)[0])


def test_only_held_out_rows_and_empty_table(spark):
    out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(i, "a b a") for i in out]
    df = spark.createDataFrame([(*r, "z") for r in rows], SCHEMA)
    same(result(df), brute(rows)[0])
    assert result(df.limit(0)) == []


def test_root_sorts_words_not_positions(monkeypatch):
    """The first step sends every word of a slice, by part, and sorts no longer array."""
    texts = [" ".join(f"w{(7 * i + j * j) % 50}" for j in range(400)) for i in range(20)]
    cutter = suffix_tree._Cutter(100_000, 2)
    made = [r for i, t in enumerate(texts) for r in cutter.add(i, i, i % 5 == 1, t)]
    (row,) = [*made, *cutter.rest()]
    part = suffix_tree.Slice(row, suffix_tree.Totals(6_400), part_count=2_000, min_count=2)
    sorted_rows, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, **k: (sorted_rows.append(len(a)), argsort(a, **k))[1])
    asked = part.tested()
    assert max(sorted_rows) <= len(part.hashes) < len(part.codes)
    counts = Counter()
    for i, t in enumerate(texts):
        counts.update(split(t) if i % 5 != 1 else [])
    number = {suffix_tree.xxhash.xxh3_64_intdigest(w.encode()): n for w, n in counts.items()}
    assert dict(zip(asked.symbols.tolist(), asked.counts.tolist())) == number
    assert asked.parts.tolist() == [0, 1, 2, 3]
    assert np.array_equal(asked.symbols[asked.entry], part.hashes[part.codes[asked.at]])
    rows = np.searchsorted(asked.starts, asked.entry, side="right") - 1
    assert np.array_equal(asked.row, rows)
