"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.sources.scratch import materialize

# A side up to this size is broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Up to this many values of a column become a filter list.
MAX_LISTED = 400


def _width(field: T.StructField) -> Column:
    """Bytes of a value; nested ones by their text form, unknown kinds as too large."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) * 2 + 32
    if isinstance(kind, T.UserDefinedType):
        return F.lit(BROADCAST_BYTES + 1)
    return F.lit(8)


def _size(df: DataFrame) -> DataFrame:
    width = reduce(lambda a, b: a + b, map(_width, df.schema.fields)).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b"))


def which_fit_broadcast(
    dfs: Sequence[DataFrame],
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> list[bool]:
    """Count rows and bytes of stored or tiny tables, all in one job."""
    sizes = [_size(df).withColumn("i", F.lit(i)) for i, df in enumerate(dfs)]
    found = {r.i: r for r in reduce(DataFrame.unionAll, sizes).collect()}
    return [
        found[i].n <= max_rows and (found[i].b or 0) <= max_bytes for i in range(len(dfs))
    ]


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    return which_fit_broadcast([df], max_rows, max_bytes)[0]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Join ``right``, which has one row per key, to ``left`` (left or inner).

    A ``right`` that fits is broadcast, so ``left`` is not moved at all. Beyond that
    bound it is stored and both sides are shuffled once; then each side of the join
    is an exchange of its own, which lets the adaptive planner split the rows of a
    hot key, or of a missing one, over tasks. ``small`` tells whether ``right`` fits,
    if known.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    if fits_broadcast(right) if small is None else small:
        return left.join(F.broadcast(right), list(on), how)
    return left.join(materialize(right, "lookup"), list(on), how)


def listed_values(keys: DataFrame, limit: int = MAX_LISTED) -> dict[str, list]:
    """The values of each column of a small table that has few different ones."""
    found = {
        c: [r[0] for r in keys.select(c).distinct().limit(limit + 1).collect()]
        for c in keys.columns
    }
    return {c: v for c, v in found.items() if len(v) <= limit}


def semi_join(
    left: DataFrame,
    keys: DataFrame,
    small: bool | None = None,
    values: Mapping[str, list] | None = None,
) -> DataFrame:
    """Rows of ``left`` whose key is in ``keys``, a stored table (same column names).

    Short lists of values also become plain filters, which skip the partitions and
    row groups of ``left`` that a join would have read. ``small`` tells whether
    ``keys`` fits a broadcast and ``values`` are those lists, if known already.
    Beyond that bound ``left`` is still read once, and its hot keys are split by the
    adaptive planner.
    """
    if not (fits_broadcast(keys) if small is None else small):
        return left.join(keys, keys.columns, "left_semi")
    values = listed_values(keys) if values is None else values
    listed = [c for c in keys.columns if c in values]
    for name in listed:
        left = left.where(F.col(name).isin(values[name]))
    if listed == keys.columns and len(listed) == 1:
        return left
    return left.join(F.broadcast(keys.distinct()), keys.columns, "left_semi")
