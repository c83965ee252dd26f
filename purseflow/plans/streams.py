"""Reports that run as streams until their input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..session import fresh_path
from ..sources import tables as t
from ..streaming import arrivals, jobs
from .registry import dbl, report, with_
from .relations import STREAM_ALERT

BATCH_BYTES = 8 << 30  # files admitted to one micro-batch of transactions
EVENT_ALERT = 48  # alert threshold of wallet events, whose values are a thousandth of amounts
LATE_IDS = 10**12  # added to the ids of rows planted as late ones
LATE_BY = 2  # deliveries by which they are late


def txn_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All transactions as a stream over the stored files themselves, in batches of bounded bytes."""
    # a pattern, because a stream does not take the path of a single file
    path = f"{folder}/{{orders.parquet}}"
    return t.as_txn(jobs.file_stream(spark, path, t.SCHEMAS["orders"], max_bytes=BATCH_BYTES))


def wallet_events(spark: SparkSession, folder: str) -> DataFrame:
    """Wallet events with a money amount and a status; rows without a time can't be placed."""
    return t.ev(spark, folder).where("ts is not null").select(
        "event_id", "ts", "user_id", "category", F.col("amount").cast(fn.MONEY).alias("amount"),
        F.when(F.col("category") == "error", jobs.ALERT_STATUS).otherwise("SUCCESS").alias("status"),
    )


def late_repeats(events: DataFrame, times: arrivals.Schedule):
    """Every seventh event once more under a new id, two deliveries after its own."""

    def planted(number: int) -> list[DataFrame]:
        if number < LATE_BY:
            return []
        rows = arrivals.in_span(events, times, number - LATE_BY).where("event_id % 7 = 3")
        return [rows.withColumn("event_id", F.col("event_id") + LATE_IDS)]

    return planted


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Wallet events in order of time, a delivery per micro-batch, with planted late rows."""
    events = wallet_events(spark, folder)
    path, times = fresh_path(spark, "landing"), arrivals.schedule(events)
    if times is None:
        events.write.parquet(f"{path}/none")
    else:
        placed = arrivals.by_span(events, times)
        arrivals.deliver(placed, times, path, range(times.n), late_repeats(placed, times))
    return arrivals.landed(spark, path, events.schema)


# The deliveries, and for each the watermark that earlier ones have set (mark_us). A window drops what came
# after it was closed, which the batch before did: with the watermark (whole milliseconds) of that batch (mark).
ARRIVED = f"""span AS (SELECT MIN(epoch_us(ts)) AS t0, MAX(epoch_us(ts)) AS t1,
    GREATEST({arrivals.DELIVERIES}, (COUNT(*) + {arrivals.DELIVERY_ROWS - 1}) // {arrivals.DELIVERY_ROWS}) AS n FROM ev),
placed AS (SELECT event_id, ts, user_id, category, CAST(amount AS DECIMAL(18,2)) AS amount,
    CASE WHEN category = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CAST((epoch_us(ts) - t0) // ((t1 - t0) // n + 1) AS INTEGER) AS k, n FROM ev, span),
came AS (SELECT * FROM placed UNION ALL
    SELECT event_id + {LATE_IDS}, ts, user_id, category, amount, status, k + {LATE_BY}, n FROM placed
    WHERE event_id % 7 = 3 AND k + {LATE_BY} < n),
tops AS (SELECT k, MAX(MAX(epoch_ms(ts))) OVER (ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 30000 AS mark,
    MAX(MAX(epoch_us(ts))) OVER (ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 30000000 AS mark_us
    FROM came GROUP BY k),
arrived AS (SELECT came.*, mark, mark_us FROM came JOIN tops USING (k)),
closed AS (SELECT MAX(epoch_ms(ts)) - 30000 AS closing FROM came)"""


@report(
    "stream_batch_stats",
    with_(t.EV, ARRIVED,
          f"""cats AS (SELECT k, string_agg(category || '=' || revenue, ';' ORDER BY category) AS revenue_by_category FROM
    (SELECT k, category, CAST(SUM(amount) AS VARCHAR) AS revenue FROM arrived GROUP BY 1, 2) GROUP BY k)""",
          """stats AS (SELECT k, string_agg(status || '=' || n, ';' ORDER BY status) AS count_by_status FROM
    (SELECT k, status, COUNT(*) AS n FROM arrived GROUP BY 1, 2) GROUP BY k)""",
          body=f"""SELECT k AS batch_id, COUNT(*) AS records,
    COUNT(*) FILTER (epoch_us(ts) <= mark_us) AS late,
    COUNT(*) FILTER (status = 'FAILED' AND amount > {EVENT_ALERT}) AS alerts,
    ANY_VALUE(revenue_by_category) AS revenue_by_category, ANY_VALUE(count_by_status) AS count_by_status
    FROM arrived JOIN cats USING (k) JOIN stats USING (k) GROUP BY k"""),
)
def stream_batch_stats(spark: SparkSession, folder: str) -> DataFrame:
    """One record per micro-batch, with the rows that came after their watermark."""
    table = jobs.run_to_table(
        event_stream(spark, folder), "batch_stats",
        per_batch=lambda batch, number, table: jobs.batch_record(batch, number, table, EVENT_ALERT),
    )
    return jobs.read_appended(spark, table).where("records > 0").drop("top")


TOTALS_SQL = with_(t.TXN, body=f"SELECT category, {dbl('SUM(amount)')} AS total, COUNT(*) AS n_rows FROM txn GROUP BY category")


@report("stream_running_totals", TOTALS_SQL)
def stream_running_totals(spark: SparkSession, folder: str) -> DataFrame:
    totals = jobs.running_totals(txn_stream(spark, folder))
    table = jobs.run_to_table(totals, "running_totals", "complete")
    return jobs.read_complete(spark, table).withColumn("total", fn.dbl(F.col("total")))


@report("stream_update_mode", TOTALS_SQL)
def stream_update_mode(spark: SparkSession, folder: str) -> DataFrame:
    totals = jobs.running_totals(txn_stream(spark, folder))
    table = jobs.run_to_table(totals, "updated_totals", "update")
    return jobs.read_updated(spark, table, "category").withColumn("total", fn.dbl(F.col("total")))


@report(
    "stream_fraud_alerts",
    with_(t.TXN, body=f"SELECT txn_id, {dbl('amount')} AS amount, ts FROM txn WHERE status = 'FAILED' AND amount > {STREAM_ALERT}"),
)
def stream_fraud_alerts(spark: SparkSession, folder: str) -> DataFrame:
    alerts = jobs.fraud_alerts(txn_stream(spark, folder), STREAM_ALERT)
    table = jobs.run_to_table(alerts, "fraud_alerts")
    return jobs.read_appended(spark, table).select("txn_id", fn.dbl(F.col("amount")).alias("amount"), "ts")


def on_time(window: str) -> str:
    """SQL: rows whose window the watermark had not closed when they came, of windows closed by the end."""
    return f"""w AS (SELECT * FROM (SELECT *, time_bucket(INTERVAL {window}, ts) AS w_start FROM arrived), closed
  WHERE (mark IS NULL OR epoch_ms(w_start + INTERVAL {window}) > mark) AND epoch_ms(w_start + INTERVAL {window}) <= closing)"""


@report(
    "stream_tumbling_5m",
    with_(t.EV, ARRIVED, on_time("5 MINUTE"),
          body=f"""SELECT w_start AS window_start, w_start + INTERVAL 5 MINUTE AS window_end, category, COUNT(*) AS n_rows,
          {dbl('SUM(amount)')} AS total FROM w GROUP BY 1, 2, 3"""),
)
def stream_tumbling_5m(spark: SparkSession, folder: str) -> DataFrame:
    """Windows are written, and their state is freed, once the watermark has passed their end.

    Rows of windows that are closed already are dropped; ``stream_batch_stats`` counts them.
    """
    table = jobs.run_to_table(jobs.tumbling_totals(event_stream(spark, folder)), "tumbling", bounded=True)
    return jobs.read_appended(spark, table).select(
        F.col("start").cast("timestamp_ntz").alias("window_start"),
        F.col("end").cast("timestamp_ntz").alias("window_end"),
        "category",
        "n_rows",
        fn.dbl(F.col("total")).alias("total"),
    )


def delivered_again(events: DataFrame, times: arrivals.Schedule):
    """Every fifth row twice in its own delivery, and the last quarter of a delivery again in the next one."""

    def repeated(number: int) -> list[DataFrame]:
        out = [arrivals.in_span(events, times, number).where("event_id % 5 = 0")]
        if number:
            tail = times.span(number)[0] - times.width / 4
            out.append(arrivals.in_span(events, times, number - 1).where(F.col("ts") >= F.lit(tail)))
        return out

    return repeated


@report("stream_dedup", with_(t.EV, body=f"SELECT event_id, ts, user_id, category, {dbl('CAST(amount AS DECIMAL(18,2))')} AS amount FROM ev"))
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Events delivered at least once come out once, also over a restart.

    The first run stops when half of the deliveries are used up. The second one starts from its
    checkpoint, so repeats of rows that the first run has written meet its state. Repeats
    from before the watermark are late and dropped.
    """
    events = wallet_events(spark, folder)
    path, out, times = fresh_path(spark, "landing"), fresh_path(spark, "dedup"), arrivals.schedule(events)
    halves = [range(times.n // 2), range(times.n // 2, times.n)] if times else []
    placed = arrivals.by_span(events, times) if times else events
    for half in halves:
        arrivals.deliver(placed, times, path, half, delivered_again(placed, times))
        stream = arrivals.landed(spark, path, events.schema)
        table = jobs.run_to_table(jobs.deduplicated(stream, "event_id"), "dedup", path=out, bounded=True)
    rows = jobs.read_appended(spark, table) if halves else events
    ts = F.col("ts").cast("timestamp_ntz").alias("ts")
    return rows.select("event_id", ts, "user_id", "category", fn.dbl(F.col("amount")).alias("amount"))


@report(
    "stream_user_balance",
    with_(t.TXN, body=f"SELECT user_id, {dbl('SUM(amount)')} AS total, COUNT(*) AS n_rows FROM txn GROUP BY user_id"),
)
def stream_user_balance(spark: SparkSession, folder: str) -> DataFrame:
    """A running sum per user: only changed users are written in each batch."""
    balance = jobs.running_totals(txn_stream(spark, folder), "user_id")
    table = jobs.run_to_table(balance, "user_balance", "update")
    return jobs.read_updated(spark, table, "user_id").withColumn("total", fn.dbl(F.col("total")))


@report(
    "stream_velocity",
    with_(t.EV, ARRIVED, on_time("1 MINUTE"),
          body="SELECT w_start AS minute, user_id, COUNT(*) AS n_txns FROM w GROUP BY 1, 2 HAVING COUNT(*) > 1"),
)
def stream_velocity(spark: SparkSession, folder: str) -> DataFrame:
    table = jobs.run_to_table(jobs.velocity(event_stream(spark, folder)), "velocity", bounded=True)
    rows = jobs.read_appended(spark, table)
    return rows.select(F.col("start").cast("timestamp_ntz").alias("minute"), "user_id", "n_txns")
