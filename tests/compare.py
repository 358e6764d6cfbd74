"""Run queries in Spark and their oracle SQL in DuckDB and compare the results."""

from __future__ import annotations

import math
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Type names of Spark and of DuckDB for the same type.
SAME_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def _rows(rows, order):
    return sorted(tuple(repr(_plain(r[i])) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns, types and rows, else what differs."""
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = df.columns
    mine = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    duck_names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(names) != sorted(duck_names):
        return f"columns {sorted(set(names) ^ set(duck_names))}"
    bad = {
        n: (t, duck_types[n])
        for n, t in spark_types.items()
        if SAME_TYPES.get(t) != duck_types[n]
    }
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    order = sorted(names)
    a = _rows(mine, [names.index(n) for n in order])
    b = _rows(theirs, [duck_names.index(n) for n in order])
    if a != b:
        first = next(i for i in range(len(a)) if a[i] != b[i])
        return f"values {order}\n  spark {a[first]}\n  duck  {b[first]}"
    return f"types {bad}" if bad else None


def report(spark, sf_dir: str, queries, oracle) -> list[str]:
    con = duck(sf_dir)
    failed = []
    for name, query in queries.items():
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problem = difference(df, con, oracle[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as e:  # report the rest too
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name:26} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
        if problem:
            failed.append(name)
    return failed
