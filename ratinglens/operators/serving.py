"""Merging the batch and speed layers at read time.

Submissions never rewrite the batch tables: the batch count (rating rows per
player) and the stream count (submissions per player) live apart and are
summed when read, so re-running the batch job cannot erase live increments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def games_count_merged(batch_counts: DataFrame, stream_counts: DataFrame) -> DataFrame:
    """(fide_id, batch_count, stream_count, games_count) for every player
    known to either side. A union plus one aggregation instead of a full
    outer join: map-side partial sums, no join, no skew on a hot id."""
    b = batch_counts.select(
        "fide_id",
        F.col("games_count").alias("batch_count"),
        F.lit(None).cast("bigint").alias("stream_count"),
    )
    s = stream_counts.select(
        "fide_id",
        F.lit(None).cast("bigint").alias("batch_count"),
        F.col("stream_count").cast("bigint").alias("stream_count"),
    )
    merged = (
        b.unionByName(s)
        .groupBy("fide_id")
        .agg(F.sum("batch_count").alias("batch_count"), F.sum("stream_count").alias("stream_count"))
    )
    return merged.select(
        "fide_id",
        "batch_count",
        "stream_count",
        (F.coalesce("batch_count", F.lit(0)) + F.coalesce("stream_count", F.lit(0))).alias("games_count"),
    )


def serving_counts(merged: DataFrame) -> DataFrame:
    """The (fide_id, games_count) view the lookups read."""
    return merged.select("fide_id", "games_count")
