"""The daily batch: bronze rows are checked, enriched, stored by month and summarised."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import ingest, joins, rules, stored, warehouse
from ..session import fresh_path, stage, write_table
from ..sources import files
from ..sources import tables as t
from .quality import CATEGORY_LIST, NUM, STATUS_LIST
from .registry import dbl, pct2, report, with_
from .warehouse import GATE_SQL

SILVER_COLUMNS = [
    "txn_id", "user_id", "city", "kyc_status", "merchant", "category", "amount", "gst", "net_amount",
    "status", "is_success", "wallet_type", "date", "month", "quarter", "year",
]


def checked(raw: DataFrame) -> DataFrame:
    return rules.check(raw, rules.process_rules())


def silver(valid: DataFrame, users: DataFrame) -> DataFrame:
    """Valid rows with user attributes, tax split and calendar columns."""
    rows = joins.lookup(
        valid, users.select("user_id", "city", "kyc_status"), "user_id",
        {"city": t.UNKNOWN, "kyc_status": t.UNKNOWN},
    )
    amount = rules.strict_amount(F.col("amount")).cast(fn.MONEY)
    day = F.col("date").try_cast("date")
    return rows.withColumns({
        "is_success": fn.is_success(F.col("status")),
        "status": F.upper("status"),
        "gst": fn.gst(amount),
        "net_amount": fn.net(amount),
        "amount": amount,
        "month": F.substring("date", 1, 7),
        "quarter": fn.quarter_label(day),
        "year": F.substring("date", 1, 4),
    }).select("ordinal", *SILVER_COLUMNS)


def store_lake(rows: DataFrame, path: str) -> DataFrame:
    """Write all months as year/month folders and read them back.

    The folders have their own column names, since the rows carry ``month`` too.
    """
    files.write_partitioned(
        rows.withColumns({"p_year": F.col("year"), "p_month": F.substring("month", 6, 2)}),
        path,
        ["p_year", "p_month"],
    )
    return rows.sparkSession.read.option("basePath", path).parquet(path)


def monthly_gold(rows: DataFrame) -> DataFrame:
    return rows.groupBy("month").agg(
        F.count("*").alias("txns"),
        F.sum("is_success").alias("successes"),
        F.sum("amount").alias("revenue"),
        F.sum("gst").alias("gst"),
    )


def run(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """The whole batch into ``out``: bronze, silver, rejects, lake, gold and run metrics.

    The counts are observed while the tables are written; no row reaches the driver.
    """
    seen_in, seen_out = Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    bronze = write_table(t.raw(spark, folder).observe(seen_in, n), f"{out}/bronze")
    rows = checked(bronze)
    valid, rejected = rows.where(F.size("errors") == 0), rows.where(F.size("errors") > 0)
    silvered = write_table(
        silver(valid, t.raw_users(spark, folder)).observe(seen_out, n), f"{out}/silver"
    )
    write_table(rejected, f"{out}/rejects")
    files.write_partitioned(
        silvered.withColumns({"p_year": F.col("year"), "p_month": F.substring("month", 6, 2)}),
        f"{out}/lake",
        ["p_year", "p_month"],
    )
    write_table(monthly_gold(silvered), f"{out}/gold_monthly")
    n_in, n_out = seen_in.get["n"], seen_out.get["n"]
    metrics = spark.createDataFrame(
        [(n_in, n_out, n_in - n_out)], "records_in bigint, records_out bigint, rejected bigint"
    ).withColumn("valid_pct", fn.percent(F.col("records_out"), F.col("records_in")))
    files.write_metrics(metrics, f"{out}/summary")
    return metrics


AMOUNT = f"CAST({NUM} AS DECIMAL(18,2))"
CHECKED = f"""checked AS (SELECT *, list_filter([
    CASE WHEN {NUM} IS NULL THEN 'amount_type' END,
    CASE WHEN {NUM} IS NOT NULL AND NOT ({NUM} BETWEEN 1 AND 500000) THEN 'amount_range' END,
    CASE WHEN coalesce(status NOT IN ({STATUS_LIST}), true) THEN 'bad_status' END,
    CASE WHEN coalesce(category NOT IN ({CATEGORY_LIST}), true) THEN 'bad_category' END], lambda x: x IS NOT NULL) AS errors
  FROM raw)"""
SILVER = f"""silver AS (SELECT ordinal, txn_id, user_id, COALESCE(city, 'Unknown') AS city,
    COALESCE(kyc_status, 'Unknown') AS kyc_status, merchant, category, {AMOUNT} AS amount,
    ROUND({AMOUNT} * CAST(0.18 AS DECIMAL(2,2)), 2) AS gst, ROUND({AMOUNT} * CAST(0.82 AS DECIMAL(2,2)), 2) AS net_amount,
    upper(status) AS status, CAST(status = 'SUCCESS' AS INTEGER) AS is_success, wallet_type, "date",
    substr("date", 1, 7) AS month, 'Q' || CAST(quarter(CAST("date" AS DATE)) AS VARCHAR) AS quarter,
    substr("date", 1, 4) AS year
  FROM checked LEFT JOIN raw_users USING (user_id) WHERE len(errors) = 0)"""
BASE = (t.USERS, t.RAW_USERS, t.RAW, CHECKED, SILVER)


def silver_rows(spark: SparkSession, folder: str) -> DataFrame:
    valid = checked(t.raw(spark, folder)).where(F.size("errors") == 0)
    return silver(valid, t.raw_users(spark, folder))


@report(
    "silver_txns",
    with_(*BASE, body=f"""SELECT ordinal, txn_id, user_id, city, kyc_status, merchant, category, {dbl('amount')} AS amount,
    {dbl('gst')} AS gst, {dbl('net_amount')} AS net_amount, status, is_success, wallet_type, "date", month, quarter, year
    FROM silver"""),
)
def silver_txns(spark: SparkSession, folder: str) -> DataFrame:
    money = {c: fn.dbl(F.col(c)) for c in ("amount", "gst", "net_amount")}
    return silver_rows(spark, folder).withColumns(money)


@report(
    "silver_rejects",
    with_(t.RAW, CHECKED, body="""SELECT ordinal, txn_id, user_id, merchant, category, amount, status, wallet_type, "timestamp", "date",
    array_to_string(errors, '; ') AS errors FROM checked WHERE len(errors) > 0"""),
)
def silver_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejected = checked(t.raw(spark, folder)).where(F.size("errors") > 0)
    return rejected.withColumn("errors", F.array_join("errors", "; "))


@report(
    "run_summary",
    with_(t.RAW, CHECKED, "n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (len(errors) = 0) AS ok FROM checked)",
          body=f"""SELECT n AS records_in, ok AS records_out, n - ok AS rejected, {pct2('ok', 'n')} AS valid_pct FROM n"""),
)
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The complete batch run, from bronze to gold, and what it counted."""
    return run(spark, folder, fresh_path(spark, "batch"))


@report(
    "lake_partition_counts",
    with_(*BASE, body=f"""SELECT year AS p_year, substr(month, 6, 2) AS p_month, COUNT(*) AS n_rows,
    {dbl('SUM(amount)')} AS revenue FROM silver GROUP BY 1, 2"""),
)
def lake_partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = stage(silver_rows(spark, folder), "silver")
    lake = store_lake(rows, fresh_path(spark, "lake"))
    return lake.groupBy(
        F.col("p_year").cast("string").alias("p_year"),
        F.lpad(F.col("p_month").cast("string"), 2, "0").alias("p_month"),
    ).agg(F.count("*").alias("n_rows"), fn.dbl(F.sum("amount")).alias("revenue"))


@report(
    "lake_first_quarter",
    with_(*BASE, body=f"""SELECT category, COUNT(*) AS n_rows, {dbl('SUM(amount)')} AS revenue FROM silver
    WHERE CAST(substr(month, 6, 2) AS INTEGER) <= 3 GROUP BY category"""),
)
def lake_first_quarter(spark: SparkSession, folder: str) -> DataFrame:
    """First-quarter revenue from the lake; the calendar tells at run time which folders are read."""
    rows = stage(silver_rows(spark, folder), "silver")
    lake = store_lake(rows, fresh_path(spark, "lake"))
    calendar = warehouse.dim_date(rows.select(F.col("date").try_cast("date").alias("day")), "day")
    months = calendar.where("quarter = 1").select(F.col("year").alias("p_year"), F.col("month").alias("p_month")).distinct()
    # bounded by the months of the calendar
    return lake.join(F.broadcast(months), ["p_year", "p_month"]).groupBy("category").agg(
        F.count("*").alias("n_rows"), fn.dbl(F.sum("amount")).alias("revenue")
    )


@report(
    "medallion_gold",
    with_(*BASE, body=f"""SELECT month, COUNT(*) AS txns, CAST(SUM(is_success) AS BIGINT) AS successes,
    {dbl('SUM(amount)')} AS revenue, {dbl('SUM(gst)')} AS gst FROM silver GROUP BY month"""),
)
def medallion_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze, silver and gold tables written in turn; the gold table read back."""
    bronze = stage(t.raw(spark, folder), "bronze")
    valid = checked(bronze).where(F.size("errors") == 0)
    rows = stage(silver(valid, t.raw_users(spark, folder)), "silver")
    gold = stage(monthly_gold(rows), "gold")
    return gold.withColumns({c: fn.dbl(F.col(c)) for c in ("revenue", "gst")})


def transformed(raw: DataFrame, gate: int = rules.GATE_PERCENT) -> DataFrame:
    """Gate a delivery (a gate of 0 lets all through) and transform its valid rows."""
    if gate:
        rules.require_quality(raw, gate)
    amount = rules.strict_amount(F.col("amount")).cast(fn.MONEY)
    return raw.where(rules.gate_condition()).select(
        "ordinal", "txn_id", "user_id", "merchant", "category",
        amount.alias("amount"),
        fn.gst(amount).alias("gst"),
        fn.net(amount).alias("net_amount"),
        "status",
        fn.is_success(F.col("status")).alias("is_success"),
        "wallet_type", "date", F.substring("date", 1, 7).alias("month"),
    )


def daily_load(existing: DataFrame | None, raw: DataFrame, gate: int = rules.GATE_PERCENT) -> DataFrame:
    """Gate, transform, and replace rows by id; the last write of an id wins."""
    rows = transformed(raw, gate)
    before = rows.limit(0) if existing is None else existing
    return ingest.upsert_latest(before, rows, ["txn_id"], F.col("ordinal"))


def load_delivery(raw: DataFrame, path: str, gate: int = rules.GATE_PERCENT) -> DataFrame:
    """Load a delivery into the table stored by month, of which only the months it touches are rewritten."""
    rows = transformed(raw, gate)
    stored.upsert_partitions(rows, path, ["txn_id"], ["month"], F.col("ordinal"))
    return stored.read_stored(raw.sparkSession, path, rows.schema)


SECOND_LOAD = "1998-01-01"  # rows from this day on come with the second delivery


@report(
    "daily_load",
    with_(t.RAW, f"""valid AS (SELECT *, {AMOUNT} AS a,
          ROW_NUMBER() OVER (PARTITION BY txn_id ORDER BY "date" >= '{SECOND_LOAD}' DESC, ordinal DESC) AS nth
          FROM raw WHERE {GATE_SQL})""",
          body=f"""SELECT txn_id, ordinal, user_id, merchant, category, {dbl('a')} AS amount,
          CAST(ROUND(a * CAST(0.18 AS DECIMAL(2,2)), 2) AS DOUBLE) AS gst,
          CAST(ROUND(a * CAST(0.82 AS DECIMAL(2,2)), 2) AS DOUBLE) AS net_amount, status,
          CAST(status = 'SUCCESS' AS INTEGER) AS is_success, wallet_type, "date", substr("date", 1, 7) AS month
          FROM valid WHERE nth = 1"""),
)
def daily_load_report(spark: SparkSession, folder: str) -> DataFrame:
    """The stored table after two deliveries; the second one also brings ids of the first.

    Both come from one extract, which passes the gate as a whole.
    """
    raw, path = t.raw(spark, folder), fresh_path(spark, "daily")
    rules.require_quality(raw, rules.GATE_PERCENT)
    load_delivery(raw.where(F.col("date") < SECOND_LOAD), path, gate=0)
    loaded = load_delivery(raw.where(F.col("date") >= SECOND_LOAD), path, gate=0)
    return loaded.withColumns({c: fn.dbl(F.col(c)) for c in ("amount", "gst", "net_amount")})
