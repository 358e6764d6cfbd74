"""Summary reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stitched_share(segments: DataFrame) -> DataFrame:
    """Share of multi-segment tickets per airline, highest first.

    An itinerary counts once for each airline that flies a segment of it.
    """
    tickets = segments.groupBy("segment_airline_name", "leg_id").agg(
        F.max(F.col("total_segments") > 1).alias("stitched")
    )
    return (
        tickets.groupBy(F.col("segment_airline_name").alias("airline_name"))
        .agg(
            F.count(F.lit(1)).alias("tickets"),
            F.count_if("stitched").alias("stitched_tickets"),
        )
        .withColumn("stitched_share", F.col("stitched_tickets") / F.col("tickets"))
        .orderBy(F.col("stitched_share").desc(), "airline_name")
    )


def rmse(label: Column, prediction: Column) -> Column:
    """Root mean squared error as an aggregate expression."""
    return F.sqrt(F.avg(F.pow(label - prediction, F.lit(2))))
