from __future__ import annotations

import pytest

from skyledger.llm import line_dedup, queries
from tests.compare import difference, duck

D = "/root/testdata/sf0.01"


def brute(rows, ratio, least):
    """Rows of id, host, text by counting in memory."""
    bare = lambda x: x.strip(" \t\r")
    total, n = {}, {}
    for _, host, text in rows:
        total[host] = total.get(host, 0) + 1
        for line in {bare(x) for x in (text or "").split("\n")} - {""}:
            n[host, line] = n.get((host, line), 0) + 1
    for i, host, text in rows:
        if text is None:
            yield i, host, None, 0, 0
            continue
        lines = text.split("\n")
        kept = [
            x for x in lines
            if (k := n.get((host, bare(x)), 0)) < least or k <= ratio * total[host]
        ]
        yield (i, host, "\n".join(kept), sum(bool(bare(x)) for x in lines),
               len(lines) - len(kept))


@pytest.mark.parametrize("ratio, least", [(0.1, 5), (0.5, 1), (0.3, 2)])
def test_edge_rows(spark, ratio, least):
    rows = [
        (1, "a", "menu\n\nown text 1\nmenu"), (2, "a", " menu\t\nown text 2\n"), (3, "a", "menu"),
        (4, "a", ""), (5, "a", None), (6, None, "menu\nx"), (7, None, "menu\nx"), (7, None, "menu\nx"),
        (8, "b", "menu\nlone"), (9, "a", "own text 1"), (10, "c", "w " * 100_000 + "\nmenu"),
    ] + [(20 + i, "hot", f"banner \U0001f600\nline {i}\n \n") for i in range(40)]
    pages = spark.createDataFrame(
        [(*r, "clash") for r in rows], "doc_id long, source string, text string, N_Lines string"
    )
    got = line_dedup.drop_boilerplate(pages, ratio=ratio, min_pages=least)
    assert got.columns == ["doc_id", "source", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows, ratio, least), key=repr)
    assert line_dedup.drop_boilerplate(pages.limit(0)).count() == 0


def test_query_equals_oracle(spark):
    df = queries.op2_line_dedup(spark, D)
    assert difference(df, duck(D), queries.ORACLE["op2_line_dedup"]) is None
    assert not df.where("n_dropped > 0").isEmpty()


def test_no_python_and_no_shuffle_of_texts(spark):
    plan = queries.op2_line_dedup(spark, D)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_shuffled_by_host(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries.op2_line_dedup(spark, D)
        assert difference(df, duck(D), queries.ORACLE["op2_line_dedup"]) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_copies_are_one_page(spark):
    """A third of all rows are copies, of a host's only text and beside other texts."""
    rows = [(i, "hot", "the text\nof all copies") for i in range(20)]
    rows += [(20 + i, "mixed", "menu\nthe text\nof some copies") for i in range(10)]
    rows += [(30 + i, "mixed", f"menu\nown text {i}") for i in range(20)]
    rows += [(50 + i, f"h{i}", None if i % 2 else "") for i in range(40)]
    pages = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(pages, copies=False).collect()}
    assert {i: got[i] for i in range(20)} == {i: t for i, _, t in rows[:20]}
    assert {got[i] for i in range(20, 30)} == {"the text\nof some copies"}
    assert [got[30 + i] for i in range(20)] == [f"own text {i}" for i in range(20)]
    assert [got[50 + i] for i in range(40)] == ["", None] * 20
