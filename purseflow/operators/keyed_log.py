"""A keyed, partitioned log as a table: offsets, bounded polls, independent consumer groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fn
from .ordering import positions


def keyed_log(rows: DataFrame, key: str, buckets: int, order: Sequence[Column]) -> DataFrame:
    """Add ``bucket`` (same key, same bucket) and ``offset`` (0, 1, 2 ... per bucket).

    A bucket holds a large share of all rows by design; the offsets come from range
    sizes, so no task ever sees a whole bucket.
    """
    bucketed = rows.withColumn("bucket", fn.bucket(F.col(key), buckets))
    return positions(bucketed, order, ["bucket"], "keyed_log").withColumnRenamed("pos", "offset")


def distribution(log: DataFrame) -> DataFrame:
    return log.groupBy("bucket").agg(
        F.count("*").alias("messages"), (F.max("offset") + 1).alias("high_water_mark")
    )


def start_offsets(log: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Every group begins at offset 0 of every bucket; one row per group and bucket."""
    names = F.array(*[F.lit(g) for g in groups])
    return log.select("bucket").distinct().select(
        F.explode(names).alias("consumer"), "bucket", F.lit(0).cast("bigint").alias("next_offset")
    )


def poll(log: DataFrame, committed: DataFrame, max_per_bucket: Column) -> DataFrame:
    """The next messages of each group, at most ``max_per_bucket`` of every bucket.

    ``committed`` has one row per group and bucket (both fixed in number) and is broadcast.
    """
    limit = F.col("next_offset") + max_per_bucket
    return (
        log.join(F.broadcast(committed), "bucket")
        .where((F.col("offset") >= F.col("next_offset")) & (F.col("offset") < limit))
        .drop("next_offset")
    )


def commit(committed: DataFrame, polled: DataFrame) -> DataFrame:
    """Offsets after a poll; a bucket without new messages keeps its offset."""
    moved = polled.groupBy("consumer", "bucket").agg((F.max("offset") + 1).alias("moved_to"))
    return committed.join(F.broadcast(moved), ["consumer", "bucket"], "left").select(
        "consumer", "bucket", F.coalesce("moved_to", "next_offset").alias("next_offset")
    )


def seek(committed: DataFrame, consumer: str, offset: int = 0) -> DataFrame:
    """Set one group back (or forward) on all buckets, for a replay."""
    return committed.withColumn(
        "next_offset",
        F.when(F.col("consumer") == consumer, F.lit(offset).cast("bigint")).otherwise(F.col("next_offset")),
    )
