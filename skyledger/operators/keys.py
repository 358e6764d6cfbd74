"""Surrogate keys. Key 0 is kept for "unknown"."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.sources.scratch import materialize

UNKNOWN = 0
# Up to this many members are ranked by one task.
SINGLE_TASK_ROWS = 100_000


def dense_key(
    members: DataFrame,
    order_by: Sequence[str],
    name: str,
    single_task_rows: int = SINGLE_TASK_ROWS,
    ranges: int | None = None,
) -> DataFrame:
    """Number the rows of a stored table 1..n in the order of a unique key.

    The same members always get the same keys. Beyond ``single_task_rows`` the
    members are cut into ranges, each ranked by its own task and shifted by the
    number of members in the ranges before it.
    """
    order = [F.col(c) for c in order_by]
    if members.count() <= single_task_rows:
        rank = F.row_number().over(Window.orderBy(*order))
        return members.withColumn(name, rank.cast("bigint"))
    spark = members.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Stored, because range borders are sampled and must not be drawn twice.
    ranged = materialize(
        members.repartitionByRange(ranges, *order).withColumn(
            "_range", F.spark_partition_id()
        ),
        f"{name}-ranges",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_rank") + F.col("_before"))
        .drop("_range", "_rank", "_before")
    )


def natural_key(members: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Keys that depend on the member alone, so inserting others changes none.

    64-bit hashes: not dense, never 0, and checked by ``assert_unique``.
    """
    value = F.xxhash64(*columns)
    return members.withColumn(name, F.when(value == UNKNOWN, 1).otherwise(value))


def assert_unique(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    """One row per ``columns``; reading the result fails if there were two."""
    others = [c for c in df.columns if c not in columns]
    kept = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in others])
    )
    message = F.lit(f"more than one row per {', '.join(columns)} in {what}")
    checked = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_n"))
    return kept.withColumn("_n", checked).where(F.col("_n") == 1).select(*df.columns)
