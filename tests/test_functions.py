from __future__ import annotations

import datetime as dt
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from skyledger import functions as fn


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, value",
    [
        ("3", 3),
        ("3.0", 3),
        ("650.7", 650),
        (" 12 ", 12),
        ("-7.9", -7),
        ("", None),
        ("x", None),
        ("99999999999", None),
        (None, None),
    ],
)
def test_to_int(spark, text, value):
    assert one(spark, text, fn.to_int) == value


@pytest.mark.parametrize(
    "text, value",
    [("1650112200", 1650112200), ("1650112200.0", 1650112200), ("a", None), (None, None)],
)
def test_to_long(spark, text, value):
    assert one(spark, text, fn.to_long) == value


@pytest.mark.parametrize(
    "text, value",
    [
        ("True", True),
        ("no", False),
        ("1", True),
        ("0", False),
        ("maybe", None),
        ("", None),
    ],
)
def test_to_bool(spark, text, value):
    assert one(spark, text, fn.to_bool) is value


@pytest.mark.parametrize(
    "text, value",
    [
        ("2022-04-16", dt.date(2022, 4, 16)),
        ("2022-04-16 10:00:00", None),
        ("2022-02-30", None),
        ("bad", None),
        ("", None),
    ],
)
def test_to_date(spark, text, value):
    assert one(spark, text, fn.to_date) == value


@pytest.mark.parametrize(
    "text, value", [("3719", 61), ("3720", 62), ("59", 0), ("", None), ("1e99", None)]
)
def test_whole_minutes(spark, text, value):
    assert one(spark, text, fn.whole_minutes) == value


def test_float_and_double(spark):
    assert one(spark, "1.5", fn.to_float) == 1.5
    assert one(spark, "1.5", fn.to_double) == 1.5
    assert one(spark, "-", fn.to_double) is None


@pytest.mark.parametrize(
    "path, clean",
    [
        (None, None),
        ("", ""),
        ("A", "A"),
        ("A -> A -> B -> A", "A -> B -> A"),
        (" A  -> A\t -> B", "A -> B"),
        ("A->A", "A->A"),
        ("A ->  -> B", "A ->  -> B"),
        ("A ->  -> ", "A -> "),
        (" A -> A", "A"),
    ],
)
def test_clean_path(spark, path, clean):
    assert one(spark, path, fn.clean_path) == clean


def test_clean_path_needs_no_python_worker(spark):
    df = spark.createDataFrame([("A -> A",)], "x string").select(fn.clean_path(F.col("x")))
    assert "Python" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    "text, query",
    [
        ("SQLQuery: select 1 ", "select 1"),
        ("  Select a, (SELECT 2)", "Select a, (SELECT 2)"),
        ("  none\n", "none"),
        ("", ""),
        (None, None),
    ],
)
def test_extract_select(spark, text, query):
    assert one(spark, text, fn.extract_select) == query


def test_strip_any_white_space(spark):
    assert one(spark, "　\t a b \n", fn.strip) == "a b"


def test_lookup_key_and_blank(spark):
    assert one(spark, " b12 ", fn.lookup_key) == "B12"
    assert one(spark, "  ", fn.not_blank) is False
    assert one(spark, None, fn.not_blank) is False
    assert one(spark, '"A"', fn.unquote) == "A"


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),)], "x date")
    row = df.select(*fn.date_parts(F.col("x"))).first()
    assert tuple(row) == (2022, 1, 1, 1, 7, 1, 52)


def test_random_texts_against_plain_python(spark):
    rng = random.Random(11)
    pieces = [" -> ", "->", " ", "\t", "\u3000", "\x1c", "\n", "A", "B", "select", "SeLeCT"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(3000)]
    rows = (
        spark.createDataFrame([(t,) for t in texts], "t string")
        .select(
            "t",
            fn.clean_path(F.col("t")).alias("path"),
            fn.extract_select(F.col("t")).alias("query"),
        )
        .collect()
    )
    for r in rows:
        stops = [stop.strip() for stop in r.t.split(" -> ")]
        assert r.path == " -> ".join(stop for stop, _ in groupby(stops)), repr(r.t)
        assert r.query == r.t[max(r.t.upper().find("SELECT"), 0):].strip(), repr(r.t)
