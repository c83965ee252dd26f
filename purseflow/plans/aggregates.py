"""Grouped and global reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import joins, ordering
from ..session import stage
from ..sources import tables as t
from .registry import avg2, dbl, mln2, pct2, report, with_

# Thresholds of the reports, ten times the original scale like the amounts.
HIGH_VALUE = 450_000
HIGH_FAILED = 400_000
HEAVY_USER_ROWS = 15


def n_rows(name: str = "txns") -> Column:
    return F.count("*").alias(name)


def total() -> Column:
    return F.sum("amount")


def average() -> Column:
    return fn.ratio(total(), F.count("*"))


@report(
    "q1_high_value",
    with_(t.TXN, body=f"""SELECT txn_id, user_id, category, {dbl('amount')} AS amount, status FROM txn
    WHERE amount > {HIGH_VALUE} ORDER BY txn.amount DESC, txn_id LIMIT 8"""),
)
def q1_high_value(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder, above=HIGH_VALUE)
        .orderBy(F.col("amount").desc(), "txn_id")
        .limit(8)
        .select("txn_id", "user_id", "category", fn.dbl(F.col("amount")).alias("amount"), "status")
    )


@report(
    "q2_category",
    with_(t.TXN, body=f"""SELECT category, COUNT(*) AS txn_count, {dbl('SUM(amount)')} AS total_inr,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_inr FROM txn GROUP BY category"""),
)
def q2_category(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder)
        .groupBy("category")
        .agg(n_rows("txn_count"), fn.dbl(total()).alias("total_inr"), average().alias("avg_inr"))
        .orderBy(F.col("total_inr").desc(), "category")
    )


@report(
    "q3_status_share",
    with_(t.TXN, body=f"""SELECT status, COUNT(*) AS n_txns,
    {pct2('COUNT(*)', '(SELECT COUNT(*) FROM txn)')} AS pct FROM txn GROUP BY status"""),
)
def q3_status_share(spark: SparkSession, folder: str) -> DataFrame:
    # the share is taken over the few grouped rows, so the table is read once
    per_status = t.txn(spark, folder).groupBy("status").agg(n_rows("n_txns"))
    whole = F.sum("n_txns").over(Window.partitionBy())
    return per_status.select("status", "n_txns", fn.percent(F.col("n_txns"), whole).alias("pct")).orderBy(
        F.col("n_txns").desc(), "status"
    )


@report(
    "q4_top_merchants",
    with_(t.TXN, t.SALES, body=f"""SELECT merchant, COUNT(*) AS txns, {dbl('SUM(amount)')} AS revenue
    FROM sales WHERE status = 'SUCCESS' GROUP BY merchant ORDER BY SUM(amount) DESC, merchant LIMIT 5"""),
)
def q4_top_merchants(spark: SparkSession, folder: str) -> DataFrame:
    by_supplier = (
        t.sales(spark, folder, status="SUCCESS")
        .groupBy("l_suppkey")
        .agg(n_rows(), total().alias("total"))
    )
    suppliers = t.read(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("merchant"))
    return (
        by_supplier.join(suppliers, by_supplier.l_suppkey == suppliers.s_suppkey, "left")
        .groupBy("merchant")
        .agg(F.sum("txns").alias("txns"), F.sum("total").alias("total"))
        .orderBy(F.col("total").desc(), "merchant")
        .limit(5)
        .select("merchant", "txns", fn.dbl(F.col("total")).alias("revenue"))
    )


@report(
    "q5_daily_volume",
    with_(t.TXN, body=f"""SELECT CAST(ts AS DATE) AS day, COUNT(*) AS txns,
    {dbl('SUM(amount)')} AS daily_total FROM txn GROUP BY 1"""),
)
def q5_daily_volume(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder)
        .groupBy(F.to_date("ts").alias("day"))
        .agg(n_rows(), fn.dbl(total()).alias("daily_total"))
        .orderBy("day")
    )


@report(
    "q6_failed_high_value",
    with_(t.TXN, body=f"""SELECT txn_id, user_id, category, {dbl('amount')} AS amount FROM txn
    WHERE status = 'FAILED' AND amount > {HIGH_FAILED} ORDER BY txn.amount DESC, txn_id LIMIT 8"""),
)
def q6_failed_high_value(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder, status="FAILED", above=HIGH_FAILED)
        .orderBy(F.col("amount").desc(), "txn_id")
        .limit(8)
        .select("txn_id", "user_id", "category", fn.dbl(F.col("amount")).alias("amount"))
    )


@report(
    "q7_heavy_users",
    with_(t.TXN, body=f"""SELECT user_id, COUNT(*) AS txn_count, {dbl('SUM(amount)')} AS total_spent
    FROM txn GROUP BY user_id HAVING COUNT(*) > {HEAVY_USER_ROWS}"""),
)
def q7_heavy_users(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder)
        .groupBy("user_id")
        .agg(n_rows("txn_count"), fn.dbl(total()).alias("total_spent"))
        .where(F.col("txn_count") > HEAVY_USER_ROWS)
    )


@report(
    "q8_wallet",
    with_(t.TXN, t.SALES, body=f"""SELECT wallet_type, COUNT(*) AS txns,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_txn,
    CAST(SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS successes
    FROM sales GROUP BY wallet_type"""),
)
def q8_wallet(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.sales(spark, folder)
        .groupBy("wallet_type")
        .agg(
            n_rows(),
            average().alias("avg_txn"),
            F.count_if(F.col("status") == "SUCCESS").alias("successes"),
        )
        .orderBy(F.col("txns").desc(), "wallet_type")
    )


@report(
    "agg_sum_by",
    with_(t.RAW, body=f"""SELECT category, {dbl('SUM(TRY_CAST(amount AS DECIMAL(18,2)))')} AS total_inr
    FROM raw GROUP BY category HAVING COUNT(TRY_CAST(amount AS DECIMAL(18,2))) > 0"""),
)
def agg_sum_by(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose amount is not a number are left out of the sum, not out of the table."""
    value = F.col("amount").try_cast(fn.MONEY)
    return (
        t.raw(spark, folder)
        .groupBy("category")
        .agg(F.count(value).alias("n"), fn.dbl(F.sum(value)).alias("total_inr"))
        .where("n > 0")
        .drop("n")
    )


@report(
    "agg_count_by",
    with_(t.RAW, body="""SELECT COALESCE(NULLIF(trim(user_id), ''), 'UNKNOWN') AS user_id, COUNT(*) AS n_txns
    FROM raw GROUP BY 1"""),
)
def agg_count_by(spark: SparkSession, folder: str) -> DataFrame:
    key = F.when(fn.blank(F.col("user_id")), "UNKNOWN").otherwise(F.trim("user_id"))
    return t.raw(spark, folder).groupBy(key.alias("user_id")).agg(n_rows("n_txns"))


@report(
    "agg_avg_by",
    with_(t.RAW, "num AS (SELECT category, TRY_CAST(amount AS DECIMAL(18,2)) AS a FROM raw)",
          body=f"""SELECT category, {avg2('SUM(a)', 'COUNT(a)')} AS avg_inr FROM num GROUP BY category
          HAVING COUNT(a) > 0"""),
)
def agg_avg_by(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("amount").try_cast(fn.MONEY)
    return (
        t.raw(spark, folder)
        .groupBy("category")
        .agg(F.count(value).alias("n"), F.sum(value).alias("total"))
        .where("n > 0")
        .select("category", fn.ratio(F.col("total"), F.col("n")).alias("avg_inr"))
    )


def percentile_picks(percents: list[int]) -> dict[str, Column]:
    """The two neighbours of each percentile in the sorted values."""
    picks = {}
    for p in percents:
        low = F.expr(f"((total - 1) * {p}) div 100")  # whole numbers, exact for any total
        picks[f"{p}:lo"] = low
        picks[f"{p}:hi"] = F.least(low + 1, F.col("total") - 1)
    return picks


def percentiles(df: DataFrame, value: str, percents: list[int]) -> DataFrame:
    """One row: exact percentiles with linear interpolation, in decimal arithmetic."""
    found = ordering.order_statistics(df.select(value), value, percentile_picks(percents))

    def at(p: int) -> Column:
        low = F.max(F.when(F.col("pick") == f"{p}:lo", F.col("value")))
        high = F.max(F.when(F.col("pick") == f"{p}:hi", F.col("value")))
        part = ((F.max("total") - 1) * p % 100).cast("decimal(3,0)") * F.lit(0.01).cast("decimal(3,2)")
        return fn.dbl(F.round(low + (high - low) * part, 2)).alias(f"p{p}")

    return found.agg(*[at(p) for p in percents])


def percentile_sql(source: str, percents: list[int]) -> str:
    """The same interpolation over fully sorted rows."""
    cols = []
    for p in percents:
        low = f"MAX(CASE WHEN rn - 1 = ((n - 1) * {p}) // 100 THEN amount END)"
        high = f"MAX(CASE WHEN rn - 1 = LEAST(((n - 1) * {p}) // 100 + 1, n - 1) THEN amount END)"
        part = f"CAST(((MAX(n) - 1) * {p}) % 100 AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2))"
        cols.append(f"CAST(ROUND({low} + ({high} - {low}) * {part}, 2) AS DOUBLE) AS p{p}")
    return (
        f"SELECT {', '.join(cols)} FROM (SELECT amount, ROW_NUMBER() OVER (ORDER BY amount) AS rn, "
        f"COUNT(*) OVER () AS n FROM {source})"
    )


@report("agg_percentiles", with_(t.TXN, body=percentile_sql("txn", [25, 75, 95])))
def agg_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return percentiles(t.txn(spark, folder), "amount", [25, 75, 95])


@report(
    "summary_stats",
    with_(t.TXN, body=f"""SELECT COUNT(*) AS n_rows, {dbl('SUM(amount)')} AS total_inr,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_inr, {dbl('MIN(amount)')} AS min_inr,
    {dbl('MAX(amount)')} AS max_inr FROM txn"""),
)
def summary_stats(spark: SparkSession, folder: str) -> DataFrame:
    return t.txn(spark, folder).agg(
        n_rows("n_rows"),
        fn.dbl(total()).alias("total_inr"),
        average().alias("avg_inr"),
        fn.dbl(F.min("amount")).alias("min_inr"),
        fn.dbl(F.max("amount")).alias("max_inr"),
    )


@report(
    "category_counts",
    with_(t.TXN, body="SELECT category, COUNT(*) AS txns FROM txn GROUP BY category"),
)
def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return t.txn(spark, folder).groupBy("category").agg(n_rows()).orderBy(F.col("txns").desc(), "category")


@report(
    "describe_amount",
    with_(t.TXN, f"pct AS ({percentile_sql('txn', [25, 50, 75, 95])})",
          body=f"""SELECT n_rows, total, mean, std, min_amount, max_amount, p25, p50 AS median, p75, p95
          FROM pct, (SELECT COUNT(*) AS n_rows, {dbl('SUM(amount)')} AS total,
          {avg2('SUM(amount)', 'COUNT(*)')} AS mean,
          ROUND(STDDEV_POP(CAST(amount AS DOUBLE)), 2) AS std, {dbl('MIN(amount)')} AS min_amount,
          {dbl('MAX(amount)')} AS max_amount FROM txn)"""),
)
def describe_amount(spark: SparkSession, folder: str) -> DataFrame:
    """The population description; the percentiles are exact, not sketched."""
    df = t.txn(spark, folder).select("amount")
    moments = df.agg(
        n_rows("n_rows"),
        fn.dbl(total()).alias("total"),
        average().alias("mean"),
        F.round(F.stddev_pop(fn.dbl(F.col("amount"))), 2).alias("std"),
        fn.dbl(F.min("amount")).alias("min_amount"),
        fn.dbl(F.max("amount")).alias("max_amount"),
    )
    cuts = percentiles(df, "amount", [25, 50, 75, 95])  # one row, read once
    named = {"p25": "p25", "median": "p50", "p75": "p75", "p95": "p95"}
    row = cuts.select(F.struct(*[F.col(c).alias(k) for k, c in named.items()])).scalar()
    return moments.withColumn("cuts", row).select("*", "cuts.*").drop("cuts")


@report(
    "category_describe",
    with_(t.TXN, body=f"""SELECT category, COUNT(*) AS n_rows, {dbl('SUM(amount)')} AS total,
    {avg2('SUM(amount)', 'COUNT(*)')} AS mean, ROUND(STDDEV_SAMP(CAST(amount AS DOUBLE)), 2) AS std
    FROM txn GROUP BY category"""),
)
def category_describe(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder)
        .groupBy("category")
        .agg(
            n_rows("n_rows"),
            fn.dbl(total()).alias("total"),
            average().alias("mean"),
            F.round(F.stddev_samp(fn.dbl(F.col("amount"))), 2).alias("std"),
        )
        .orderBy(F.col("total").desc(), "category")
    )


@report(
    "category_named_agg",
    with_(t.TXN, body=f"""SELECT category, COUNT(txn_id) AS txn_count, {dbl('SUM(amount)')} AS total_rev,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_txn FROM txn GROUP BY category"""),
)
def category_named_agg(spark: SparkSession, folder: str) -> DataFrame:
    named = {"txn_count": ("txn_id", F.count), "total_rev": ("amount", F.sum)}
    exprs = [func(col).alias(name) for name, (col, func) in named.items()]
    grouped = t.txn(spark, folder).groupBy("category").agg(*exprs)
    return grouped.select(
        "category",
        "txn_count",
        fn.dbl(F.col("total_rev")).alias("total_rev"),
        fn.ratio(F.col("total_rev"), F.col("txn_count")).alias("avg_txn"),
    ).orderBy(F.col("total_rev").desc(), "category")


@report(
    "wallet_success",
    with_(t.TXN, t.SALES, body=f"""SELECT wallet_type, COUNT(*) AS txns,
    CAST(SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS success,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_amount FROM sales GROUP BY wallet_type"""),
)
def wallet_success(spark: SparkSession, folder: str) -> DataFrame:
    flagged = t.sales(spark, folder).withColumn("is_success", fn.is_success(F.col("status")))
    return (
        flagged.groupBy("wallet_type")
        .agg(n_rows(), F.sum("is_success").alias("success"), average().alias("avg_amount"))
        .orderBy(F.col("txns").desc(), "wallet_type")
    )


MONTH_SQL = "strftime(ts, '%Y-%m')"


@report(
    "month_category",
    with_(t.TXN, body=f"""SELECT {MONTH_SQL} AS month, category, COUNT(*) AS txns,
    {dbl('SUM(amount)')} AS revenue FROM txn GROUP BY 1, 2"""),
)
def month_category(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder)
        .groupBy(fn.month(F.col("ts")).alias("month"), "category")
        .agg(n_rows(), fn.dbl(total()).alias("revenue"))
        .orderBy("month", "category")
    )


@report(
    "month_category_range",
    with_(t.TXN, body=f"""SELECT {MONTH_SQL} AS month, category, COUNT(*) AS txn_count,
    {mln2('SUM(amount)')} AS revenue_m FROM txn
    WHERE status = 'SUCCESS' AND CAST(ts AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
    GROUP BY 1, 2"""),
)
def month_category_range(spark: SparkSession, folder: str) -> DataFrame:
    # a half-open range on the stored column prunes row groups; a cast would not
    in_year = (F.col("ts") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (
        F.col("ts") < F.lit("1997-01-01").cast("timestamp_ntz")
    )
    return (
        t.txn(spark, folder, status="SUCCESS")
        .where(in_year)
        .groupBy(fn.month(F.col("ts")).alias("month"), "category")
        .agg(n_rows("txn_count"), fn.millions(total()).alias("revenue_m"))
        .orderBy("month", F.col("revenue_m").desc(), "category")
    )


@report(
    "monthly_revenue",
    with_(t.TXN, body=f"""SELECT {MONTH_SQL} AS month, COUNT(*) AS txns, {dbl('SUM(amount)')} AS revenue,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_txn FROM txn WHERE status = 'SUCCESS' GROUP BY 1"""),
)
def monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder, status="SUCCESS")
        .groupBy(fn.month(F.col("ts")).alias("month"))
        .agg(n_rows(), fn.dbl(total()).alias("revenue"), average().alias("avg_txn"))
        .orderBy("month")
    )


@report(
    "hourly_volume",
    with_(t.EV, body=f"""SELECT CAST(EXTRACT(hour FROM ts) AS INTEGER) AS hour, COUNT(*) AS txns,
    {avg2('SUM(CAST(amount AS DECIMAL(18,2)))', 'COUNT(*)')} AS avg_amount FROM ev GROUP BY 1
    ORDER BY txns DESC, hour LIMIT 8"""),
)
def hourly_volume(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.ev(spark, folder)
        .withColumn("amount", F.col("amount").cast(fn.MONEY))
        .groupBy(F.hour("ts").alias("hour"))
        .agg(n_rows(), average().alias("avg_amount"))
        .orderBy(F.col("txns").desc(), "hour")
        .limit(8)
    )


@report(
    "quarterly_split",
    with_(t.TXN, body=f"""SELECT 'Q' || CAST(EXTRACT(quarter FROM ts) AS VARCHAR) AS quarter,
    COUNT(*) AS txns, {mln2('SUM(amount)')} AS revenue_m, {avg2('SUM(amount)', 'COUNT(*)')} AS avg_txn
    FROM txn WHERE status = 'SUCCESS' GROUP BY 1"""),
)
def quarterly_split(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder, status="SUCCESS")
        .groupBy(fn.quarter_label(F.col("ts")).alias("quarter"))
        .agg(n_rows(), fn.millions(total()).alias("revenue_m"), average().alias("avg_txn"))
        .orderBy("quarter")
    )


@report(
    "feature_corr",
    with_(t.EV, body="""SELECT ROUND(CORR(amount, EXTRACT(hour FROM ts)), 4) AS corr_hour,
    ROUND(CORR(amount, isodow(ts) - 1), 4) AS corr_weekday,
    ROUND(CORR(amount, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END), 4) AS corr_weekend FROM ev"""),
)
def feature_corr(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    features = {"hour": F.hour(ts), "weekday": fn.weekday(ts), "weekend": fn.is_weekend(ts)}
    return t.ev(spark, folder).agg(
        *[F.round(F.corr("amount", fn.dbl(c)), 4).alias(f"corr_{n}") for n, c in features.items()]
    )


@report(
    "partition_stats",
    with_(t.TXN, f"sizes AS (SELECT {MONTH_SQL} AS month, COUNT(*) AS n FROM txn GROUP BY 1)",
          body="""SELECT COUNT(*) AS n_partitions,
          CAST((2 * SUM(n) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) AS avg_rows,
          MIN(n) AS min_rows, MAX(n) AS max_rows FROM sizes"""),
)
def partition_stats(spark: SparkSession, folder: str) -> DataFrame:
    sizes = t.txn(spark, folder).groupBy(fn.month(F.col("ts")).alias("month")).agg(n_rows("n"))
    return sizes.agg(
        n_rows("n_partitions"),
        fn.ratio(F.sum("n").cast(fn.COUNT), F.count("*"), 0).alias("avg_rows"),
        F.min("n").alias("min_rows"),
        F.max("n").alias("max_rows"),
    )


@report(
    "gst_inclusive_total",
    with_(t.TXN, body=f"""SELECT COUNT(*) AS n_rows,
    {dbl('SUM(amount * CAST(1.18 AS DECIMAL(3,2)))')} AS gross_total FROM txn"""),
)
def gst_inclusive_total(spark: SparkSession, folder: str) -> DataFrame:
    gross = F.col("amount") * F.lit(fn.GST_INCLUSIVE)
    return t.txn(spark, folder).agg(n_rows("n_rows"), fn.dbl(F.sum(gross)).alias("gross_total"))


GROUP_CHUNK = 1_000


@report(
    "group_collect",
    with_(t.TXN, f"""numbered AS (SELECT category, txn_id,
          (ROW_NUMBER() OVER (PARTITION BY category ORDER BY txn_id) - 1) // {GROUP_CHUNK} AS chunk FROM txn)""",
          body="""SELECT category, CAST(chunk AS BIGINT) AS chunk, COUNT(*) AS n_rows,
          string_agg(CAST(txn_id AS VARCHAR), ',' ORDER BY txn_id) AS txn_ids
          FROM numbered GROUP BY category, chunk"""),
)
def group_collect(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of each group, as lists of bounded length so that no group has to fit a task."""
    rows = ordering.positions(
        t.txn(spark, folder).select("category", "txn_id"), [F.col("txn_id")], ["category"]
    )
    return (
        rows.withColumn("chunk", F.floor(F.col("pos") / GROUP_CHUNK))
        .groupBy("category", "chunk")
        .agg(n_rows("n_rows"), F.sort_array(F.collect_list("txn_id")).alias("ids"))
        .select("category", "chunk", "n_rows", F.array_join(F.col("ids").cast("array<string>"), ",").alias("txn_ids"))
    )


@report(
    "group_rows",
    with_(t.TXN, body=f"""SELECT category, ROW_NUMBER() OVER (PARTITION BY category ORDER BY txn_id) - 1 AS nth,
    COUNT(*) OVER (PARTITION BY category) AS n_rows, txn_id, user_id, {dbl('amount')} AS amount, status, ts FROM txn"""),
)
def group_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Whole rows by group: each with its place in its group and the group's size, laid out in that order.

    A group may be of any size, as it spans as many ranges as it needs.
    """
    rows = ordering.positions(t.txn(spark, folder), [F.col("txn_id")], ["category"])
    sizes = t.txn(spark, folder).groupBy("category").agg(n_rows("n_rows"))
    joined = joins.join_on_groups(rows, joins.broadcast_if_small(sizes), ["category"], "inner")
    return joined.select(
        "category", F.col("pos").alias("nth"), "n_rows", "txn_id", "user_id", fn.dbl(F.col("amount")).alias("amount"), "status", "ts"
    )


# The dashboard reads the cleaned and enriched transactions; success is a flag there.


@report(
    "dashboard_kpis",
    with_(t.TXN, body=f"""SELECT COUNT(*) AS total_txns, {mln2('SUM(amount)')} AS revenue_m,
    {mln2("SUM(CASE WHEN status = 'SUCCESS' THEN amount END)")} AS success_rev_m,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_txn,
    {pct2("SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END)", 'COUNT(*)')} AS success_rate,
    COUNT(DISTINCT user_id) AS active_users FROM txn"""),
)
def dashboard_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """Key figures: group per user first, so the distinct count is a count of groups."""
    success = F.col("status") == "SUCCESS"
    per_user = (
        t.txn(spark, folder)
        .groupBy("user_id")
        .agg(
            n_rows("n"),
            total().alias("amount"),
            F.sum(F.when(success, F.col("amount"))).alias("success_amount"),
            F.count_if(success).alias("n_success"),
        )
    )
    n = F.sum("n")
    return per_user.agg(
        n.alias("total_txns"),
        fn.millions(F.sum("amount")).alias("revenue_m"),
        fn.millions(F.sum("success_amount")).alias("success_rev_m"),
        fn.ratio(F.sum("amount"), n).alias("avg_txn"),
        fn.percent(F.sum("n_success"), n).alias("success_rate"),
        F.count("user_id").alias("active_users"),
    )


BAR_CATEGORY, BAR_MONTH = 30, 28


def share_of_max(value: Column, width: int) -> Column:
    """Length of a bar: the value's share of the largest one, over a handful of grouped rows."""
    top = F.max(value).over(Window.partitionBy())
    return F.floor(F.try_divide(value * width, top)).cast("int")


@report(
    "dash_categories",
    with_(t.TXN, body=f"""SELECT category, COUNT(*) AS txns, {mln2('SUM(amount)')} AS rev_m
    FROM txn WHERE status = 'SUCCESS' GROUP BY category"""),
)
def dash_categories(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder, status="SUCCESS")
        .groupBy("category")
        .agg(n_rows(), fn.millions(total()).alias("rev_m"))
        .orderBy(F.col("rev_m").desc(), "category")
    )


@report(
    "dash_months",
    with_(t.TXN, body=f"""SELECT {MONTH_SQL} AS month, COUNT(*) AS txns, {mln2('SUM(amount)')} AS rev_m
    FROM txn WHERE status = 'SUCCESS' GROUP BY 1"""),
)
def dash_months(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder, status="SUCCESS")
        .groupBy(fn.month(F.col("ts")).alias("month"))
        .agg(n_rows(), fn.millions(total()).alias("rev_m"))
        .orderBy("month")
    )


@report(
    "dash_cities",
    with_(t.TXN, t.USERS, body=f"""SELECT COALESCE(city, 'Unknown') AS city, COUNT(*) AS txns,
    {mln2('SUM(amount)')} AS rev_m FROM txn LEFT JOIN users USING (user_id)
    WHERE status = 'SUCCESS' GROUP BY 1 ORDER BY SUM(amount) DESC, city LIMIT 5"""),
)
def dash_cities(spark: SparkSession, folder: str) -> DataFrame:
    per_user = (
        t.txn(spark, folder, status="SUCCESS")
        .groupBy("user_id")
        .agg(n_rows(), total().alias("amount"))
    )
    return (
        per_user.join(t.users(spark, folder).select("user_id", "city"), "user_id", "left")
        .groupBy(F.coalesce("city", F.lit(t.UNKNOWN)).alias("city"))
        .agg(F.sum("txns").alias("txns"), total().alias("total"))
        .orderBy(F.col("total").desc(), "city")
        .limit(5)
        .select("city", "txns", fn.millions(F.col("total")).alias("rev_m"))
    )


@report(
    "dash_alert_count",
    with_(t.TXN, body=f"""SELECT COUNT(*) AS alerts FROM txn
    WHERE status <> 'SUCCESS' AND amount > {HIGH_VALUE}"""),
)
def dash_alert_count(spark: SparkSession, folder: str) -> DataFrame:
    """Unsuccessful high-value rows, pending ones included."""
    return t.txn(spark, folder, but="SUCCESS", above=HIGH_VALUE).agg(n_rows("alerts"))


@report(
    "bar_share_of_max",
    with_(t.TXN, f"""m AS (SELECT {MONTH_SQL} AS month, CAST(SUM(amount) * 100 AS HUGEINT) AS cents
          FROM txn WHERE status = 'SUCCESS' GROUP BY 1)""",
          body=f"""SELECT month, CAST((cents * {BAR_MONTH}) // MAX(cents) OVER () AS INTEGER) AS bar FROM m"""),
)
def bar_share_of_max(spark: SparkSession, folder: str) -> DataFrame:
    per_month = (
        t.txn(spark, folder, status="SUCCESS")
        .groupBy(fn.month(F.col("ts")).alias("month"))
        .agg(total().alias("revenue"))
    )
    return per_month.select("month", share_of_max(F.col("revenue"), BAR_MONTH).alias("bar"))


@report(
    "top4_categories",
    with_(t.TXN, body=f"""SELECT category, COUNT(*) AS txns, {dbl('SUM(amount)')} AS total_inr,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_inr FROM txn GROUP BY category
    ORDER BY SUM(amount) DESC, category LIMIT 4"""),
)
def top4_categories(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder)
        .groupBy("category")
        .agg(n_rows(), total().alias("total"), average().alias("avg_inr"))
        .orderBy(F.col("total").desc(), "category")
        .limit(4)
        .select("category", "txns", fn.dbl(F.col("total")).alias("total_inr"), "avg_inr")
    )
