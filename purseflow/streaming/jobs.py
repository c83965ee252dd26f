"""Streaming queries over any source of payment rows, and their idempotent sink.

Each function takes a streaming DataFrame, so that a file source (used in the reports
and tests) and a message broker source (``format("kafka")``) are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as fn
from ..session import fresh_path

# Watermark, window lengths and the alert threshold's status.
WATERMARK = "30 seconds"
TUMBLING = "5 minutes"
VELOCITY_WINDOW = "1 minute"
ALERT_STATUS = "FAILED"
PARTITIONS = "spark.sql.shuffle.partitions"


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Parquet files as a stream, in order of their arrival; ``max_files`` or ``max_bytes`` bound a micro-batch.

    Files are admitted where they lie: nothing is listed, counted or copied beforehand. A batch
    takes files until the bound is reached, one file at least.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def event_time(df: DataFrame, column: str = "ts", delay: str = WATERMARK) -> DataFrame:
    """Set the watermark; it needs a timestamp with time zone."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def is_alert(threshold: int) -> Column:
    return (F.col("status") == ALERT_STATUS) & (F.col("amount") > F.lit(threshold).cast(fn.MONEY))


def fraud_alerts(rows: DataFrame, threshold: int) -> DataFrame:
    """Stateless, append mode."""
    return rows.where(is_alert(threshold)).select("txn_id", "amount", "ts")


def _by_name(entries: Column, key: str, value: str, zero: Column) -> Column:
    """``name=sum;...`` in order of name, from an array of (category, status) groups."""
    names = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e[key])))
    total = lambda n: F.aggregate(F.filter(entries, lambda e: e[key] == n), zero, lambda a, e: (a + e[value]).cast(_TOTAL if value == "revenue" else "bigint"))
    return F.array_join(F.transform(names, lambda n: F.concat(n, F.lit("="), total(n).cast("string"))), ";")


_TOTAL = "decimal(38,2)"
UNNAMED = "?"  # rows without a category or status
RECORD = (
    "records bigint, late bigint, alerts bigint, top timestamp, revenue_by_category string, count_by_status string"
)


def batch_record(batch: DataFrame, batch_id: int, table: str, threshold: int, delay: str = WATERMARK) -> DataFrame:
    """One row for a micro-batch: records, late ones, alerts, revenue by category, rows by status.

    A row is late if its event time is not after the watermark, which is the latest event time of
    all earlier batches less ``delay``. Earlier batches are known by their own records in ``table``, so
    a restart goes on with the same watermark, and a repeated batch, which replaces its
    record, comes to the same one. Rows without an event time are not late.

    The batch shrinks to one row per category and status in every task; both are short
    enumerations of the domain.
    """
    spark = batch.sparkSession
    mark = F.lit(None).cast("timestamp")
    if batch_id > 0:
        before = spark.read.schema(f"{RECORD}, batch_id int").option("basePath", table).parquet(table)
        top = before.where(F.col("batch_id") < batch_id).agg(F.max("top").alias("top"))
        mark = F.lit(top.select((F.col("top") - F.expr(f"interval {delay}")).alias("mark")).first().mark)
    ts = F.col("ts").cast("timestamp")
    groups = batch.groupBy(
        F.coalesce("category", F.lit(UNNAMED)).alias("category"), F.coalesce("status", F.lit(UNNAMED)).alias("status")
    ).agg(
        F.count("*").alias("n"),
        F.sum("amount").cast(_TOTAL).alias("revenue"),
        F.count_if(ts <= mark).alias("late"),
        F.count_if(is_alert(threshold)).alias("alerts"),
        F.max(ts).alias("top"),
    )
    none = F.lit(0).cast("bigint")
    one = groups.agg(
        *[F.coalesce(F.sum(c), none).alias(out) for c, out in (("n", "records"), ("late", "late"), ("alerts", "alerts"))],
        F.max("top").alias("top"),
        F.collect_list(F.struct("category", "status", "n", "revenue")).alias("entries"),
    )
    return one.select(
        "records", "late", "alerts", "top",
        _by_name(F.col("entries"), "category", "revenue", F.lit(0).cast(_TOTAL)).alias("revenue_by_category"),
        _by_name(F.col("entries"), "status", "n", none).alias("count_by_status"),
    )


def running_totals(rows: DataFrame, key: str = "category") -> DataFrame:
    """State of one row per key, kept over all batches."""
    return rows.groupBy(key).agg(F.sum("amount").alias("total"), F.count("*").alias("n_rows"))


def tumbling_totals(rows: DataFrame) -> DataFrame:
    window = F.window("ts", TUMBLING)
    return (
        event_time(rows)
        .groupBy(window.alias("w"), "category")
        .agg(F.count("*").alias("n_rows"), F.sum("amount").alias("total"))
        .select("w.start", "w.end", "category", "n_rows", "total")
    )


def velocity(rows: DataFrame) -> DataFrame:
    """Users with more than one row in a minute, once the minute is complete."""
    return (
        event_time(rows)
        .groupBy(F.window("ts", VELOCITY_WINDOW).alias("w"), "user_id")
        .agg(F.count("*").alias("n_txns"))
        .where(F.col("n_txns") > 1)
        .select("w.start", "user_id", "n_txns")
    )


def deduplicated(rows: DataFrame, key: str) -> DataFrame:
    """Each id once, with state kept only as long as the watermark allows repeats."""
    return event_time(rows).dropDuplicatesWithinWatermark([key])


def run_to_table(
    stream: DataFrame,
    name: str,
    mode: str = "append",
    per_batch=None,
    path: str | None = None,
    timeout_seconds: int | None = None,
    progress: list | None = None,
    bounded: bool = False,
) -> str:
    """Run until the available input is used up, into folders keyed by batch number.

    A batch that is repeated after a failure overwrites its own folder, and the
    checkpoint remembers finished batches, so every row counts once. A second run on the
    same ``path`` goes on where the first one stopped. ``per_batch`` (batch, number, table) may
    reduce a batch before it is written. Without ``timeout_seconds`` a long backfill may take
    its time. ``progress`` receives the engine's reports on the last batches. A ``bounded`` stream holds
    the rows of a delivery or two at most, so its state gets no more partitions than there are
    cores: every micro-batch opens and commits each of them. Returns the table's path.
    """
    spark = stream.sparkSession
    path = path or fresh_path(spark, name)

    def save(batch: DataFrame, batch_id: int) -> None:
        out = per_batch(batch, batch_id, f"{path}/table") if per_batch else batch
        out.write.mode("overwrite").parquet(f"{path}/table/batch_id={batch_id}")

    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(save)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
    )
    session_wide = int(spark.conf.get(PARTITIONS))
    try:  # a stream keeps the settings it was started with
        if bounded:
            spark.conf.set(PARTITIONS, str(min(session_wide, spark.sparkContext.defaultParallelism)))
        query = writer.start()
    finally:
        spark.conf.set(PARTITIONS, str(session_wide))
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_seconds} seconds")
    if progress is not None:
        progress.extend(query.recentProgress)
    return f"{path}/table"


def read_appended(spark: SparkSession, table: str) -> DataFrame:
    """All rows of an append-mode table."""
    return spark.read.option("basePath", table).parquet(table)


def read_complete(spark: SparkSession, table: str) -> DataFrame:
    """The last full result of a complete-mode table."""
    rows = read_appended(spark, table)
    last = rows.agg(F.max("batch_id")).scalar()
    return rows.where(F.col("batch_id") == last).drop("batch_id")


def read_updated(spark: SparkSession, table: str, key: str) -> DataFrame:
    """The latest state of every key of an update-mode table."""
    rows = read_appended(spark, table)
    rest = [c for c in rows.columns if c not in (key, "batch_id")]
    latest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "batch_id").alias("last"))
    return latest.select(key, "last.*")
