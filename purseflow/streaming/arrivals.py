"""Rows that arrive in the order of their event time, as bounded deliveries in a landing folder.

A file source takes files as they arrive, so event-time windows need deliveries in the
order of time. The table is read once and written into one folder per span of time, in whatever order its rows
lie; each delivery reads only its folders. More rows mean more deliveries, not larger ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from ..sources import files
from . import jobs

# A table arrives in at least so many deliveries, of about so many rows at most.
DELIVERIES = 12
DELIVERY_ROWS = 1_000_000
SPAN = "_span"  # folder column of rows that are laid out by span


@dataclass(frozen=True)
class Schedule:
    """Equal spans of event time, numbered from 0."""

    start: datetime
    width: timedelta
    n: int

    def span(self, number: int) -> tuple[datetime, datetime]:
        low = self.start + number * self.width
        return low, low + self.width


def schedule(rows: DataFrame, column: str = "ts", least: int = DELIVERIES, size: int = DELIVERY_ROWS) -> Schedule | None:
    """Spans that cover all times of the table; None if there is no row with a time."""
    seen = rows.agg(F.count(column).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).first()
    if not seen.n:
        return None
    n = max(least, -(-seen.n // size))
    width = (seen.high - seen.low) // timedelta(microseconds=1) // n + 1
    return Schedule(seen.low, timedelta(microseconds=width), n)


def by_span(rows: DataFrame, times: Schedule, column: str = "ts") -> DataFrame:
    """The rows that have a time, written once with a folder per span, so that ``in_span`` opens only its own."""
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "spans")
    number = F.call_function("div", F.col(column) - F.lit(times.start), F.lit(times.width)).cast("int")
    placed = rows.where(F.col(column).isNotNull()).withColumn(SPAN, number)
    files.write_partitioned(placed, path, [SPAN])
    return spark.read.schema(placed.schema).parquet(path)


def in_span(rows: DataFrame, times: Schedule, number: int, column: str = "ts") -> DataFrame:
    if SPAN in rows.columns:
        return rows.where(F.col(SPAN) == number).drop(SPAN)
    low, high = times.span(number)
    return rows.where((F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high)))


def deliver(
    rows: DataFrame,
    times: Schedule,
    path: str,
    numbers: Iterable[int],
    besides: Callable[[int], list[DataFrame]] = lambda number: [],
) -> None:
    """Write deliveries one after the other, each as one file; ``besides`` adds rows to a delivery."""
    for number in numbers:
        parts = [in_span(rows, times, number), *besides(number)]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        whole.coalesce(1).write.mode("overwrite").parquet(f"{path}/{number:06d}")


def landed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The deliveries as a stream, one in each micro-batch."""
    return jobs.file_stream(spark, f"{path}/*", schema, max_files=1)
