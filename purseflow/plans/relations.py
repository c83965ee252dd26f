"""Filters, joins, subqueries, windows, sorts and scalar functions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import ingest, joins, ordering
from ..session import stage
from ..sources import tables as t
from ..sources import views
from .aggregates import HIGH_FAILED, HIGH_VALUE, MONTH_SQL
from .registry import avg2, dbl, mln2, pct2, report, with_

# Thresholds, ten times the original scale like the amounts.
VERY_HIGH_SUCCESS = 470_000
STREAM_ALERT = 480_000
AVG_FACTOR = 3
ROLLING_ROWS = 3

amount = "amount"


# ---- filters ---------------------------------------------------------------


@report(
    "filter_success",
    with_(t.TXN, body=f"SELECT txn_id, user_id, category, {dbl('amount')} AS amount FROM txn WHERE status = 'SUCCESS'"),
)
def filter_success(spark: SparkSession, folder: str) -> DataFrame:
    return t.txn(spark, folder, status="SUCCESS").select(
        "txn_id", "user_id", "category", fn.dbl(F.col(amount)).alias(amount)
    )


@report(
    "filter_high_value",
    with_(t.TXN, body=f"SELECT txn_id, user_id, status, {dbl('amount')} AS amount FROM txn WHERE amount > {HIGH_FAILED}"),
)
def filter_high_value(spark: SparkSession, folder: str) -> DataFrame:
    return t.txn(spark, folder, above=HIGH_FAILED).select(
        "txn_id", "user_id", "status", fn.dbl(F.col(amount)).alias(amount)
    )


@report(
    "fraud_candidates",
    with_(t.TXN, body=f"""SELECT txn_id, user_id, {dbl('amount')} AS amount, ts FROM txn
    WHERE status = 'FAILED' AND amount > {HIGH_VALUE} ORDER BY txn.amount DESC, txn_id LIMIT 6"""),
)
def fraud_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder, status="FAILED", above=HIGH_VALUE)
        .orderBy(F.col(amount).desc(), "txn_id")
        .limit(6)
        .select("txn_id", "user_id", fn.dbl(F.col(amount)).alias(amount), "ts")
    )


LOOKUP_ID = 42


@report(
    "point_lookup",
    with_(t.TXN, body=f"SELECT txn_id, user_id, {dbl('amount')} AS amount, status, category, ts FROM txn WHERE txn_id = {LOOKUP_ID}"),
)
def point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return t.txn(spark, folder).where(F.col("txn_id") == LOOKUP_ID).select(
        "txn_id", "user_id", fn.dbl(F.col(amount)).alias(amount), "status", "category", "ts"
    )


# ---- joins -----------------------------------------------------------------


@report(
    "join_inner_user",
    with_(t.TXN, t.USERS, body=f"""SELECT txn_id, user_id, city, kyc_status, {dbl('amount')} AS amount, status
    FROM txn JOIN users USING (user_id) WHERE status = 'SUCCESS' AND amount > {VERY_HIGH_SUCCESS}
    ORDER BY txn.amount DESC, txn_id LIMIT 8"""),
)
def join_inner_user(spark: SparkSession, folder: str) -> DataFrame:
    return (
        t.txn(spark, folder, status="SUCCESS", above=VERY_HIGH_SUCCESS)
        .join(t.users(spark, folder).select("user_id", "city", "kyc_status"), "user_id")
        .orderBy(F.col(amount).desc(), "txn_id")
        .limit(8)
        .select("txn_id", "user_id", "city", "kyc_status", fn.dbl(F.col(amount)).alias(amount), "status")
    )


def success_of_1996(spark: SparkSession, folder: str) -> DataFrame:
    """Successful rows of one year: many users have none, so the outer joins show zeros."""
    return t.txn(spark, folder, status="SUCCESS").where(
        (F.col("ts") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("ts") < F.lit("1997-01-01").cast("timestamp_ntz"))
    )


S96 = """s96 AS (SELECT * FROM txn WHERE status = 'SUCCESS'
         AND ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '1997-01-01')"""


@report(
    "join_left_user_counts_all",
    with_(t.TXN, t.USERS, body=f"""SELECT u.user_id, u.city, u.kyc_status, COUNT(t.txn_id) AS txn_count,
    {dbl('COALESCE(SUM(t.amount), 0)')} AS total_spent
    FROM users u LEFT JOIN txn t ON u.user_id = t.user_id GROUP BY u.user_id, u.city, u.kyc_status"""),
)
def join_left_user_counts_all(spark: SparkSession, folder: str) -> DataFrame:
    return user_counts(spark, folder, t.txn(spark, folder))


@report(
    "join_left_user_counts",
    with_(t.TXN, t.USERS, S96, body=f"""SELECT u.user_id, u.city, u.kyc_status, COUNT(s.txn_id) AS txn_count,
    {dbl('COALESCE(SUM(s.amount), 0)')} AS total_spent
    FROM users u LEFT JOIN s96 s ON u.user_id = s.user_id GROUP BY u.user_id, u.city, u.kyc_status"""),
)
def join_left_user_counts(spark: SparkSession, folder: str) -> DataFrame:
    return user_counts(spark, folder, success_of_1996(spark, folder))


def user_counts(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Every user with the number and sum of their rows, 0 for users without any."""
    per_user = rows.groupBy("user_id").agg(F.count("txn_id").alias("n"), F.sum(amount).alias("spent"))
    return (
        t.users(spark, folder)
        .join(per_user, "user_id", "left")
        .select(
            "user_id",
            "city",
            "kyc_status",
            F.coalesce("n", F.lit(0)).alias("txn_count"),
            F.coalesce(fn.dbl(F.col("spent")), F.lit(0.0)).alias("total_spent"),
        )
    )


ENRICHED_SQL = with_(t.TXN, t.USERS, t.RAW, t.RAW_USERS, body=f"""SELECT ordinal, user_id,
    COALESCE(city, 'Unknown') AS city, COALESCE(kyc_status, 'Unknown') AS kyc_status, category, status
    FROM raw LEFT JOIN raw_users USING (user_id)""")


@report("enrich_users", ENRICHED_SQL)
def enrich_users(spark: SparkSession, folder: str) -> DataFrame:
    """Every raw row gets its user's attributes; blank and unknown users get a default."""
    known = t.raw_users(spark, folder).select("user_id", "city", "kyc_status", "source_key")
    # the last row of a repeated user wins; a written table keeps skew splitting possible
    dim = stage(
        joins.unique_last(known, "user_id", F.col("source_key")).select("user_id", "city", "kyc_status"),
        "users",
    )
    rows = t.raw(spark, folder).select("ordinal", "user_id", "category", "status")
    return joins.lookup(rows, dim, "user_id", {"city": t.UNKNOWN, "kyc_status": t.UNKNOWN})


@report(
    "enrich_repeated_users",
    with_(t.TXN, t.USERS, t.RAW, t.REPEATED_USERS,
          "latest AS (SELECT * FROM repeated_users QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY source_key DESC) = 1)",
          body="""SELECT ordinal, user_id, COALESCE(city, 'Unknown') AS city, COALESCE(kyc_status, 'Unknown') AS kyc_status, category, status
          FROM raw LEFT JOIN latest USING (user_id)"""),
)
def enrich_repeated_users(spark: SparkSession, folder: str) -> DataFrame:
    """The same enrichment from a source that repeats users: the last row of a user wins."""
    known = t.repeated_users(spark, folder).select("user_id", "city", "kyc_status", "source_key")
    last = ordering.head_per_group(known, ["user_id"], [F.col("source_key").desc()], 1)
    dim = stage(last.select("user_id", "city", "kyc_status"), "users")
    rows = t.raw(spark, folder).select("ordinal", "user_id", "category", "status")
    return joins.lookup(rows, dim, "user_id", {"city": t.UNKNOWN, "kyc_status": t.UNKNOWN})


@report(
    "join_match_report",
    with_(t.TXN, t.USERS, t.RAW, t.RAW_USERS, body="""SELECT COUNT(u.user_id) AS matched,
    COUNT(*) - COUNT(u.user_id) AS unmatched FROM raw LEFT JOIN raw_users u ON raw.user_id = u.user_id"""),
)
def join_match_report(spark: SparkSession, folder: str) -> DataFrame:
    per_user = t.raw(spark, folder).groupBy("user_id").agg(F.count("*").alias("n"))
    known = t.raw_users(spark, folder).select("user_id", F.lit(True).alias("known"))
    hit = F.col("known").isNotNull()
    return per_user.join(known, "user_id", "left").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("matched"),
        F.coalesce(F.sum(F.when(~hit, F.col("n"))), F.lit(0)).alias("unmatched"),
    )


@report(
    "join_broadcast",
    with_(t.TXN, t.USERS, body=f"""SELECT txn_id, user_id, city, {dbl('amount')} AS amount, status
    FROM txn LEFT JOIN users USING (user_id)"""),
)
def join_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    """The narrow side is broadcast only after its row count has been checked."""
    dim = joins.broadcast_if_small(t.users(spark, folder).select("user_id", "city"))
    return t.txn(spark, folder).join(dim, "user_id", "left").select(
        "txn_id", "user_id", "city", fn.dbl(F.col(amount)).alias(amount), "status"
    )


def per_user_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id").agg(F.count("*").alias("txns"), F.sum(amount).alias(amount))


@report(
    "city_revenue",
    with_(t.TXN, t.USERS, body=f"""SELECT city, COUNT(*) AS txns, {mln2('SUM(amount)')} AS revenue_m
    FROM txn JOIN users USING (user_id) WHERE status = 'SUCCESS' GROUP BY city
    ORDER BY SUM(amount) DESC, city LIMIT 6"""),
)
def city_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Grouped per user before the join, so the join sees one row per user."""
    return (
        per_user_sums(t.txn(spark, folder, status="SUCCESS"))
        .join(t.users(spark, folder).select("user_id", "city"), "user_id")
        .groupBy("city")
        .agg(F.sum("txns").alias("txns"), F.sum(amount).alias("total"))
        .orderBy(F.col("total").desc(), "city")
        .limit(6)
        .select("city", "txns", fn.millions(F.col("total")).alias("revenue_m"))
    )


@report(
    "kyc_spend",
    with_(t.TXN, t.USERS, body=f"""SELECT kyc_status, COUNT(*) AS txns,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_amount, {mln2('SUM(amount)')} AS total_m
    FROM txn JOIN users USING (user_id) GROUP BY kyc_status"""),
)
def kyc_spend(spark: SparkSession, folder: str) -> DataFrame:
    return (
        per_user_sums(t.txn(spark, folder))
        .join(t.users(spark, folder).select("user_id", "kyc_status"), "user_id")
        .groupBy("kyc_status")
        .agg(
            F.sum("txns").alias("txns"),
            fn.ratio(F.sum(amount), F.sum("txns")).alias("avg_amount"),
            fn.millions(F.sum(amount)).alias("total_m"),
        )
        .orderBy(F.col("total_m").desc(), "kyc_status")
    )


def with_user_average(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Attach each user's mean over all their transactions.

    Grouping and joining back instead of a window: a window would bring all rows of a
    heavy user into one task.
    """
    stats = t.txn(spark, folder).groupBy("user_id").agg(
        F.sum(amount).alias("user_total"), F.count("*").alias("user_n"), F.count("*").alias("n_rows")
    )
    return joins.join_group_stats(rows, stats, ["user_id"], "n_rows")


USER_AVG = """user_avg AS (
  SELECT user_id, SUM(amount) AS user_total, COUNT(*) AS user_n FROM txn GROUP BY user_id)"""


# amount / (user_total / user_n), rounded half up to two decimals in whole numbers
RATIO_TO_MEAN = """CAST((2 * CAST(amount * user_n * 10000 AS HUGEINT) + CAST(user_total * 100 AS HUGEINT))
    // (2 * CAST(user_total * 100 AS HUGEINT)) AS DOUBLE) / 100"""


def ratio_to_mean(n: Column) -> Column:
    return fn.dbl(F.round(F.col(amount) * n / F.col("user_total").cast("decimal(24,2)"), 2))


@report(
    "fraud_3x_user_avg",
    with_(t.TXN, USER_AVG, body=f"""SELECT txn_id, user_id, {dbl('amount')} AS amount,
    {avg2('user_total', 'user_n')} AS user_avg,
    {RATIO_TO_MEAN} AS ratio, 'FRAUD_ALERT' AS flag FROM txn JOIN user_avg USING (user_id)
    WHERE amount * user_n > {AVG_FACTOR} * user_total"""),
)
def fraud_3x_user_avg(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("user_n").cast(fn.COUNT)
    known = t.txn(spark, folder).where(F.col("user_id").isNotNull())
    return (
        with_user_average(spark, folder, known)
        .where(F.col(amount) * n > F.col("user_total") * AVG_FACTOR)
        .select(
            "txn_id",
            "user_id",
            fn.dbl(F.col(amount)).alias(amount),
            fn.ratio(F.col("user_total"), F.col("user_n")).alias("user_avg"),
            ratio_to_mean(n).alias("ratio"),
            F.lit("FRAUD_ALERT").alias("flag"),
        )
    )


# ---- SQL text over named views ---------------------------------------------


@report(
    "sql_monthly_revenue",
    with_(t.TXN, body=f"""SELECT {MONTH_SQL} AS month, COUNT(*) AS txns, {dbl('SUM(amount)')} AS revenue,
    {avg2('SUM(amount)', 'COUNT(*)')} AS avg_txn FROM txn WHERE status = 'SUCCESS' GROUP BY 1"""),
)
def sql_monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return views.query(spark, folder, """
        SELECT date_format(ts, 'yyyy-MM') AS month, COUNT(*) AS txns,
               CAST(SUM(amount) AS DOUBLE) AS revenue,
               CAST(ROUND(SUM(amount) / CAST(COUNT(*) AS DECIMAL(15,0)), 2) AS DOUBLE) AS avg_txn
        FROM transactions WHERE status = 'SUCCESS' GROUP BY 1 ORDER BY 1""")


@report(
    "sql_daily_running_total",
    with_(t.TXN, body=f"""SELECT day, daily_txns, {dbl('SUM(rev) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING)')}
    AS running_total FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS daily_txns, SUM(amount) AS rev FROM txn GROUP BY 1)"""),
)
def sql_daily_running_total(spark: SparkSession, folder: str) -> DataFrame:
    return views.query(spark, folder, """
        WITH daily AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS daily_txns, SUM(amount) AS rev
                       FROM transactions GROUP BY 1)
        SELECT day, daily_txns,
               CAST(SUM(rev) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total
        FROM daily ORDER BY day""")


# ---- subqueries ------------------------------------------------------------


@report(
    "sq_above_avg_users",
    with_(t.TXN, USER_AVG, body=f"""SELECT user_id, {dbl('user_total')} AS total_spent FROM user_avg
    WHERE user_total * (SELECT COUNT(*) FROM user_avg) > (SELECT SUM(user_total) FROM user_avg)"""),
)
def sq_above_avg_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users whose total is above the mean user total; the mean is a scalar subquery."""
    totals = t.txn(spark, folder).groupBy("user_id").agg(F.sum(amount).alias("spent"))
    mean = totals.agg(F.avg("spent")).scalar()
    return totals.where(F.col("spent") > mean).select("user_id", fn.dbl(F.col("spent")).alias("total_spent"))


@report(
    "sq_txn_vs_user_avg",
    with_(t.TXN, USER_AVG, body=f"""SELECT txn_id, user_id, {dbl('amount')} AS amount,
    {avg2('user_total', 'user_n')} AS user_avg,
    CASE WHEN amount * user_n > user_total THEN 'ABOVE_AVG' ELSE 'BELOW_AVG' END AS vs_avg
    FROM txn JOIN user_avg USING (user_id) WHERE status = 'SUCCESS'"""),
)
def sq_txn_vs_user_avg(spark: SparkSession, folder: str) -> DataFrame:
    """The mean covers all of a user's rows, the report only the successful ones."""
    n = F.col("user_n").cast(fn.COUNT)
    return with_user_average(spark, folder, t.txn(spark, folder, status="SUCCESS")).select(
        "txn_id",
        "user_id",
        fn.dbl(F.col(amount)).alias(amount),
        fn.ratio(F.col("user_total"), F.col("user_n")).alias("user_avg"),
        F.when(F.col(amount) * n > F.col("user_total"), "ABOVE_AVG").otherwise("BELOW_AVG").alias("vs_avg"),
    )


# ---- windows ---------------------------------------------------------------


@report(
    "w_rank_category",
    with_(t.TXN, body=f"""SELECT category, txn_id, {dbl('amount')} AS amount, CAST(rnk AS BIGINT) AS rnk FROM (
    SELECT category, txn_id, amount, RANK() OVER (PARTITION BY category ORDER BY amount DESC) AS rnk
    FROM txn WHERE status = 'SUCCESS')"""),
)
def w_rank_category(spark: SparkSession, folder: str) -> DataFrame:
    """RANK of every row. A category may own a third of the rows, so no window holds it whole."""
    rows = t.txn(spark, folder, status="SUCCESS").select("category", "txn_id", amount)
    ranked = ordering.ranks(rows, ["category"], F.col(amount), "txn_id")
    return ranked.select("category", "txn_id", fn.dbl(F.col(amount)).alias(amount), "rnk")


@report(
    "w_rank_category_top",
    with_(t.TXN, body=f"""SELECT category, txn_id, {dbl('amount')} AS amount, CAST(rnk AS INTEGER) AS rnk FROM (
    SELECT category, txn_id, amount, RANK() OVER (PARTITION BY category ORDER BY amount DESC) AS rnk,
    FROM txn WHERE status = 'SUCCESS') ORDER BY category, rnk, txn_id LIMIT 12"""),
)
def w_rank_category_top(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of the ranking; each map task passes on at most 12 rows per category."""
    rows = t.txn(spark, folder, status="SUCCESS").select("category", "txn_id", amount)
    top = ordering.head_per_group(rows, ["category"], [F.col(amount).desc(), F.col("txn_id")], 12)
    rank = F.rank().over(Window.partitionBy("category").orderBy(F.col(amount).desc()))
    return (
        top.withColumn("rnk", rank)
        .orderBy("category", "rnk", "txn_id")
        .limit(12)
        .select("category", "txn_id", fn.dbl(F.col(amount)).alias(amount), "rnk")
    )


DAILY = """daily AS (
  SELECT CAST(ts AS DATE) AS day, COUNT(*) AS cnt, SUM(amount) AS rev FROM txn GROUP BY 1)"""


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """One row per day, so the windows over it are bounded by the calendar."""
    return (
        t.txn(spark, folder)
        .groupBy(F.to_date("ts").alias("day"))
        .agg(F.count("*").alias("cnt"), F.sum(amount).alias("rev"))
    )


@report(
    "w_running_total",
    with_(t.TXN, DAILY, body=f"""SELECT day, cnt AS daily_txns, {dbl('rev')} AS daily_rev,
    {dbl('SUM(rev) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING)')} AS running_total FROM daily"""),
)
def w_running_total(spark: SparkSession, folder: str) -> DataFrame:
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily(spark, folder).select(
        "day",
        F.col("cnt").alias("daily_txns"),
        fn.dbl(F.col("rev")).alias("daily_rev"),
        fn.dbl(F.sum("rev").over(upto)).alias("running_total"),
    )


@report(
    "w_lag_delta",
    with_(t.TXN, DAILY, "l AS (SELECT *, LAG(cnt) OVER (ORDER BY day) AS prev_cnt FROM daily)",
          body=f"""SELECT day, cnt, {dbl('rev')} AS rev, prev_cnt, cnt - prev_cnt AS delta,
          CAST(sign(cnt - prev_cnt) * ((20000 * abs(cnt - prev_cnt) + NULLIF(prev_cnt, 0))
               // (2 * NULLIF(prev_cnt, 0))) AS DOUBLE) / 100 + 0.0 AS pct_chg FROM l"""),
)
def w_lag_delta(spark: SparkSession, folder: str) -> DataFrame:
    prev = F.lag("cnt").over(Window.orderBy("day"))
    change = (F.col("delta").cast(fn.COUNT) * F.lit(Decimal(100)))
    return (
        daily(spark, folder)
        .withColumn("prev_cnt", prev)
        .withColumn("delta", F.col("cnt") - F.col("prev_cnt"))
        .select(
            "day",
            "cnt",
            fn.dbl(F.col("rev")).alias("rev"),
            "prev_cnt",
            "delta",
            fn.ratio(change, F.nullif("prev_cnt", F.lit(0))).alias("pct_chg"),
        )
    )


@report(
    "cte_month_share",
    with_(t.TXN, f"""monthly AS (SELECT {MONTH_SQL} AS month, COUNT(*) AS txns, SUM(amount) AS revenue
          FROM txn WHERE status = 'SUCCESS' GROUP BY 1)""",
          f"w AS (SELECT *, CAST(SUM(revenue) OVER () * 100 AS HUGEINT) AS whole FROM monthly)",
          body=f"""SELECT month, txns, {dbl('revenue')} AS revenue, {avg2('revenue', 'txns')} AS avg_txn,
          {pct2('revenue * 100', 'whole')} AS pct_of_total FROM w"""),
)
def cte_month_share(spark: SparkSession, folder: str) -> DataFrame:
    monthly = (
        t.txn(spark, folder, status="SUCCESS")
        .groupBy(fn.month(F.col("ts")).alias("month"))
        .agg(F.count("*").alias("txns"), F.sum(amount).alias("revenue"))
    )
    whole = F.sum("revenue").over(Window.partitionBy()).cast("decimal(24,2)")
    share = F.round(F.col("revenue").cast("decimal(24,2)") * F.lit(Decimal(100)) / whole, 2)
    return monthly.select(
        "month",
        "txns",
        fn.dbl(F.col("revenue")).alias("revenue"),
        fn.ratio(F.col("revenue"), F.col("txns")).alias("avg_txn"),
        fn.dbl(share).alias("pct_of_total"),
    )


@report(
    "w_rolling_sum",
    with_(t.TXN, body=f"""SELECT txn_id, user_id, {dbl(f'''SUM(amount) OVER (PARTITION BY user_id
    ORDER BY ts, txn_id ROWS BETWEEN {ROLLING_ROWS - 1} PRECEDING AND CURRENT ROW)''')} AS rolling FROM txn"""),
)
def w_rolling_sum(spark: SparkSession, folder: str) -> DataFrame:
    rows = t.txn(spark, folder).select("txn_id", "user_id", "ts", amount)
    rolled = ordering.rolling_sum(rows, "user_id", ["ts", "txn_id"], amount, ROLLING_ROWS)
    return rolled.select("txn_id", "user_id", fn.dbl(F.col("rolling")).alias("rolling"))


# ---- sorts, samples --------------------------------------------------------


@report(
    "sort_nulls_last",
    with_(t.RAW, body="""SELECT txn_id, amt, CAST(place AS BIGINT) AS place FROM (
    SELECT txn_id, CAST(v AS DOUBLE) AS amt, ROW_NUMBER() OVER (ORDER BY v ASC NULLS LAST, ordinal) - 1 AS place
    FROM (SELECT ordinal, txn_id, TRY_CAST(amount AS DECIMAL(18,2)) AS v FROM raw))"""),
)
def sort_nulls_last(spark: SparkSession, folder: str) -> DataFrame:
    """A total sort, unreadable amounts last; ``place`` states the order that was reached."""
    rows = t.raw(spark, folder).select(
        "ordinal", "txn_id", F.col(amount).try_cast(fn.MONEY).alias("v")
    )
    placed = ordering.positions(rows, [F.col("v").asc_nulls_last(), F.col("ordinal")])
    return placed.select("txn_id", fn.dbl(F.col("v")).alias("amt"), F.col("pos").alias("place"))


HEAD_ROWS = 20


@report(
    "head_per_month",
    with_(t.TXN, body=f"""SELECT month, txn_id, {dbl('amount')} AS amount FROM (SELECT {MONTH_SQL} AS month, txn_id,
    amount, ROW_NUMBER() OVER (PARTITION BY strftime(ts, '%Y-%m') ORDER BY txn_id) AS nth FROM txn)
    WHERE nth <= {HEAD_ROWS}"""),
)
def head_per_month(spark: SparkSession, folder: str) -> DataFrame:
    rows = t.txn(spark, folder).select(fn.month(F.col("ts")).alias("month"), "txn_id", amount)
    head = ordering.head_per_group(rows, ["month"], [F.col("txn_id")], HEAD_ROWS)
    return head.select("month", "txn_id", fn.dbl(F.col(amount)).alias(amount))


SAMPLE_ROWS = 50


@report(
    "hash_sample",
    with_(t.TXN, body=f"""SELECT txn_id, user_id, {dbl('amount')} AS amount, status FROM txn
    ORDER BY md5(CAST(txn_id AS VARCHAR)), txn_id LIMIT {SAMPLE_ROWS}"""),
)
def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A repeatable random sample of a fixed size."""
    return (
        t.txn(spark, folder)
        .orderBy(F.md5(F.col("txn_id").cast("string")), "txn_id")
        .limit(SAMPLE_ROWS)
        .select("txn_id", "user_id", fn.dbl(F.col(amount)).alias(amount), "status")
    )


# ---- scalar functions ------------------------------------------------------

MONEY_SQL = "DECIMAL(18,2)"
GST_SQL = "CAST(ROUND(amount * CAST(0.18 AS DECIMAL(2,2)), 2) AS DOUBLE)"
NET_SQL = "CAST(ROUND(amount * CAST(0.82 AS DECIMAL(2,2)), 2) AS DOUBLE)"
SUCCESS_SQL = "CAST(status = 'SUCCESS' AS INTEGER)"


@report(
    "enrich_basic",
    with_(t.TXN, body=f"""SELECT txn_id, {dbl('amount')} AS amount, {GST_SQL} AS gst, {NET_SQL} AS net_amount,
    {SUCCESS_SQL} AS is_success, {MONTH_SQL} AS month FROM txn"""),
)
def enrich_basic(spark: SparkSession, folder: str) -> DataFrame:
    a = F.col(amount)
    return t.txn(spark, folder).select(
        "txn_id",
        fn.dbl(a).alias(amount),
        fn.dbl(fn.gst(a)).alias("gst"),
        fn.dbl(fn.net(a)).alias("net_amount"),
        fn.is_success(F.col("status")).alias("is_success"),
        fn.month(F.col("ts")).alias("month"),
    )


@report(
    "enrich_full",
    with_(t.TXN, body=f"""SELECT txn_id, {MONTH_SQL} AS month, 'Q' || EXTRACT(quarter FROM ts) AS quarter,
    strftime(ts, '%Y') AS year, CAST(EXTRACT(quarter FROM ts) AS INTEGER) AS quarter_no,
    CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_sk, strftime(ts, '%b') AS month_name FROM txn"""),
)
def enrich_full(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return t.txn(spark, folder).select(
        "txn_id",
        fn.month(ts).alias("month"),
        fn.quarter_label(ts).alias("quarter"),
        F.date_format(ts, "yyyy").alias("year"),
        F.quarter(ts).alias("quarter_no"),
        fn.date_key(ts).alias("date_sk"),
        F.date_format(ts, "MMM").alias("month_name"),
    )


@report(
    "time_features",
    with_(t.EV, body="""SELECT event_id, CAST(EXTRACT(hour FROM ts) AS INTEGER) AS hour,
    CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
    ROUND(ln(1 + greatest(amount, 0)), 6) AS log_amount FROM ev"""),
)
def time_features(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return t.ev(spark, folder).select(
        "event_id",
        F.hour(ts).alias("hour"),
        fn.weekday(ts).alias("day_of_week"),
        fn.is_weekend(ts).alias("is_weekend"),
        F.round(fn.log_clamped(F.col(amount)), 6).alias("log_amount"),
    )


@report(
    "norm_minmax",
    with_(t.EV, body="""SELECT event_id, CASE WHEN (SELECT MAX(amount) = MIN(amount) FROM ev) THEN 0.0::DOUBLE
    ELSE ROUND((amount - (SELECT MIN(amount) FROM ev))
               / ((SELECT MAX(amount) FROM ev) - (SELECT MIN(amount) FROM ev)), 6) END AS scaled FROM ev"""),
)
def norm_minmax(spark: SparkSession, folder: str) -> DataFrame:
    """The bounds are scalar subqueries; Spark computes both in one pass."""
    events = t.ev(spark, folder)
    low, high = events.agg(F.min(amount)).scalar(), events.agg(F.max(amount)).scalar()
    scaled = F.when(high == low, 0.0).otherwise((F.col(amount) - low) / (high - low))
    return events.select("event_id", F.round(scaled, 6).alias("scaled"))


@report(
    "norm_zscore",
    with_(t.EV, body="""SELECT event_id, CASE WHEN (SELECT STDDEV_POP(amount) FROM ev) = 0 THEN 0.0::DOUBLE
    ELSE ROUND((amount - (SELECT AVG(amount) FROM ev)) / (SELECT STDDEV_POP(amount) FROM ev), 6) END AS z FROM ev"""),
)
def norm_zscore(spark: SparkSession, folder: str) -> DataFrame:
    events = t.ev(spark, folder)
    mean, std = events.agg(F.avg(amount)).scalar(), events.agg(F.stddev_pop(amount)).scalar()
    z = F.when(std == 0, 0.0).otherwise((F.col(amount) - mean) / std)
    return events.select("event_id", F.round(z, 6).alias("z"))


@report(
    "norm_log1p",
    with_(t.EV, body="SELECT event_id, ROUND(ln(1 + greatest(amount, 0)), 6) AS logged FROM ev"),
)
def norm_log1p(spark: SparkSession, folder: str) -> DataFrame:
    return t.ev(spark, folder).select("event_id", F.round(fn.log_clamped(F.col(amount)), 6).alias("logged"))


@report(
    "clean_string",
    f"""SELECT doc_id, regexp_replace(regexp_replace(lower(regexp_replace(text,
    '^{fn.SPACE}+|{fn.SPACE}+$', '', 'g')), '{fn.NOT_WORD}', '', 'g'), '{fn.SPACE}+', '_', 'g') AS slug,
    source FROM documents""",
)
def clean_string(spark: SparkSession, folder: str) -> DataFrame:
    return t.read(spark, folder, "documents").select(
        "doc_id", fn.slug(F.col("text")).alias("slug"), "source"
    )


@report(
    "parse_amount",
    with_(t.RAW, "n AS (SELECT ordinal, TRY_CAST(regexp_replace(amount, '[^0-9.]', '', 'g') AS DECIMAL(18,2)) AS v FROM raw)",
          body=f"""SELECT ordinal, {dbl('COALESCE(v, 0)')} AS value, 'INR' AS currency, v IS NOT NULL AS valid FROM n"""),
)
def parse_amount(spark: SparkSession, folder: str) -> DataFrame:
    parsed = t.raw(spark, folder).select("ordinal", fn.parse_amount(F.col(amount)).alias("p"))
    return parsed.select("ordinal", fn.dbl(F.col("p.value")).alias("value"), "p.currency", "p.valid")


@report(
    "row_checksum",
    with_(t.RAW, body="SELECT ordinal, substr(md5(txn_id || amount), 1, 8) AS checksum FROM raw"),
)
def row_checksum(spark: SparkSession, folder: str) -> DataFrame:
    return t.raw(spark, folder).select(
        "ordinal", fn.row_checksum(F.col("txn_id"), F.col(amount)).alias("checksum")
    )


@report(
    "batch_checksum",
    with_(t.RAW, f"""numbered AS (SELECT (ROW_NUMBER() OVER (ORDER BY ordinal) - 1) // {ingest.BATCH_ROWS} + 1 AS batch_id,
    CAST('0x' || substr(md5(CAST(ordinal AS VARCHAR) || ':' || txn_id || ':' || coalesce(amount, '') || ':'
      || coalesce(status, '')), 1, 15) AS BIGINT) AS h FROM raw)""",
          body="""SELECT batch_id, COUNT(*) AS n_rows, bit_xor(h) AS row_xor, CAST(SUM(h) AS VARCHAR) AS row_sum
    FROM numbered GROUP BY batch_id"""),
)
def batch_checksum(spark: SparkSession, folder: str) -> DataFrame:
    """Audit trail: an order-free digest of every row of every batch."""
    text = F.concat_ws(
        ":", F.col("ordinal").cast("string"), "txn_id", F.coalesce("amount", F.lit("")), F.coalesce("status", F.lit(""))
    )
    digested = ingest.source_batches(t.raw(spark, folder, placed=True)).withColumn("h", fn.text_hash(text))
    return digested.groupBy("batch_id").agg(
        F.count("*").alias("n_rows"),
        F.bit_xor("h").alias("row_xor"),
        F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)").cast("string").alias("row_sum"),
    )


PAYLOAD_SQL = """'{"txn_id":"' || txn_id || '","user_id":"' || user_id || '","merchant":"' || merchant
    || '","amount":"' || amount || '","currency":"INR"' || CASE WHEN status IS NULL THEN '' ELSE ',"status":"' || status || '"' END || '}'"""


@report(
    "payload_fingerprint",
    with_(t.RAW, f"p AS (SELECT ordinal, {PAYLOAD_SQL} AS payload FROM raw)",
          body="""SELECT ordinal, CAST(octet_length(encode(payload)) AS INTEGER) AS payload_bytes,
          substr(sha256(payload), 1, 16) AS payload_hash FROM p"""),
)
def payload_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    record = F.struct(
        "txn_id", "user_id", "merchant", amount, F.lit("INR").alias("currency"), "status"
    )
    payload = t.raw(spark, folder).select("ordinal", F.to_json(record).alias("payload"))
    return payload.select(
        "ordinal",
        F.octet_length("payload").alias("payload_bytes"),
        F.substring(F.sha2("payload", 256), 1, 16).alias("payload_hash"),
    )


@report(
    "nested_payload",
    with_(t.RAW, f"p AS (SELECT ordinal, {PAYLOAD_SQL} AS payload FROM raw)",
          body="""SELECT ordinal, 'TCP' AS proto, CAST(443 AS INTEGER) AS dst_port, 'HTTPS' AS protocol,
          true AS encrypted, CAST(octet_length(encode(payload)) AS INTEGER) AS payload_b FROM p"""),
)
def nested_payload(spark: SparkSession, folder: str) -> DataFrame:
    """A packet as a nested record, and its fields read back."""
    record = F.struct(
        "txn_id", "user_id", "merchant", amount, F.lit("INR").alias("currency"), "status"
    )
    packet = F.struct(
        F.struct(F.lit(64).alias("ttl"), F.lit("TCP").alias("proto")).alias("network"),
        F.struct(F.lit(443).alias("dst_port"), F.lit("PSH+ACK").alias("flags")).alias("transport"),
        F.struct(
            F.lit("HTTPS").alias("protocol"),
            F.lit("POST /v1/transactions").alias("method"),
            F.lit(True).alias("encrypted"),
            F.octet_length(F.to_json(record)).alias("payload_b"),
        ).alias("application"),
    )
    rows = t.raw(spark, folder).select("ordinal", packet.alias("packet"))
    return rows.select(
        "ordinal",
        "packet.network.proto",
        "packet.transport.dst_port",
        "packet.application.protocol",
        "packet.application.encrypted",
        "packet.application.payload_b",
    )
