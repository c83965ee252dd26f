"""Cleaning, validation, data quality and anomaly reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import counting, joins, ordering, rules
from ..session import stage
from ..sources import tables as t
from .aggregates import HIGH_FAILED, HIGH_VALUE
from .registry import avg2, dbl, pct2, report, with_
from .relations import RATIO_TO_MEAN, STREAM_ALERT, ratio_to_mean

# Limits of the anomaly checks and grades of the quality score.
Z_LIMIT = 3.0
FENCE = 1.5
BEHAVIOUR_SIGMAS, BEHAVIOUR_MIN_ROWS = 4, 5
EXCELLENT, GOOD = 95, 85
TOP_HITS = 5

RAW_FIELDS = [
    "txn_id", "user_id", "merchant", "category", "amount", "status", "wallet_type", "timestamp", "date",
]
STATUS_LIST = ", ".join(f"'{s}'" for s in t.STATUSES)
CATEGORY_LIST = ", ".join(f"'{c}'" for c in t.CATEGORIES)
NUM = "TRY_CAST(amount AS DECIMAL(38,10))"


def case_list(*pairs: tuple[str, str]) -> str:
    """SQL: the codes whose condition holds, joined by semicolons."""
    parts = ", ".join(f"CASE WHEN {cond} THEN {code} END" for code, cond in pairs)
    return f"concat_ws('; ', {parts})"


# ---- cleaning --------------------------------------------------------------

TIDY = f"""tidy0 AS (
  SELECT ordinal, trim(txn_id) AS txn_id, trim(user_id) AS user_id, merchant, trim(category) AS category,
    TRY_CAST(regexp_replace(amount, '[^0-9.]', '', 'g') AS DECIMAL(18,2)) AS amount,
    upper(trim(status)) AS status, wallet_type, "timestamp", "date" FROM raw),
tidy1 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY txn_id ORDER BY ordinal) AS nth FROM tidy0),
tidy AS (SELECT *, {case_list(
    ("'duplicate txn_id'", "nth > 1"),
    ("'invalid amount'", "amount IS NULL"),
    ("'non-positive amount'", "amount <= 0"),
    ("'unknown status ''' || coalesce(status, '') || ''''", f"coalesce(status NOT IN ({STATUS_LIST}), true)"),
    ("'unknown category ''' || coalesce(category, '') || ''''", f"coalesce(category NOT IN ({CATEGORY_LIST}), true)"),
)} AS reasons FROM tidy1)"""


@report(
    "clean_rows",
    with_(t.RAW, TIDY, body=f"""SELECT ordinal, txn_id, user_id, merchant, category, {dbl('amount')} AS amount,
    status, wallet_type, "timestamp", "date" FROM tidy WHERE reasons = ''"""),
)
def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    tidy = rules.tidy(t.raw(spark, folder))
    return (
        tidy.where(F.size("reasons") == 0)
        .withColumn("amount", fn.dbl(F.col("amount")))
        .select("ordinal", *RAW_FIELDS)
    )


@report(
    "clean_rejects",
    with_(t.RAW, TIDY, body=f"""SELECT ordinal, txn_id, user_id, merchant, category, {dbl('amount')} AS amount, status, wallet_type,
    "timestamp", "date", reasons FROM tidy WHERE reasons <> ''"""),
)
def clean_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Whole rejected rows, as tidied, with all their reasons."""
    tidy = rules.tidy(t.raw(spark, folder))
    return (
        tidy.where(F.size("reasons") > 0)
        .withColumn("amount", fn.dbl(F.col("amount")))
        .select("ordinal", *RAW_FIELDS, F.array_join("reasons", "; ").alias("reasons"))
    )


# ---- validation ------------------------------------------------------------

OUTSIDE = f"{NUM} IS NOT NULL AND NOT ({NUM} BETWEEN 1 AND 1000000)"
VALIDATED = f"""validated AS (SELECT ordinal, {case_list(
    ("'txn_id must match TXNxxxxxxxx'", r"NOT regexp_matches(txn_id, '^TXN\d{8,}$')"),
    ("'user_id must match Uxxxx'", r"NOT regexp_matches(user_id, '^U\d{4,}$')"),
    ("'amount is not numeric'", f"{NUM} IS NULL"),
    ("'amount ' || CAST(TRY_CAST(amount AS DOUBLE) AS VARCHAR) || ' outside [1.0, 1000000.0]'", OUTSIDE),
    ("'unknown status: ' || coalesce(status, '')", f"coalesce(status NOT IN ({STATUS_LIST}), true)"),
    ("'unknown category: ' || coalesce(category, '')", f"coalesce(category NOT IN ({CATEGORY_LIST}), true)"),
    ("'timestamp must be YYYY-MM-DD HH:MM:SS'",
     "try_strptime(\"timestamp\", '%Y-%m-%d %H:%M:%S') IS NULL"),
)} AS errors FROM raw)"""


@report(
    "validate_rows",
    with_(t.RAW, VALIDATED, body="SELECT ordinal, errors = '' AS valid, errors FROM validated"),
)
def validate_rows(spark: SparkSession, folder: str) -> DataFrame:
    checked = rules.check(t.raw(spark, folder), rules.validator_rules())
    return checked.select(
        "ordinal",
        (F.size("errors") == 0).alias("valid"),
        F.array_join("errors", "; ").alias("errors"),
    )


@report(
    "validate_summary",
    with_(t.RAW, VALIDATED, body=f"""SELECT COUNT(*) AS total, COUNT(*) FILTER (errors = '') AS valid,
    COUNT(*) FILTER (errors <> '') AS invalid, {pct2("COUNT(*) FILTER (errors = '')", 'COUNT(*)')} AS valid_pct
    FROM validated"""),
)
def validate_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rules.summary(t.raw(spark, folder), rules.validator_rules())


@report(
    "split_valid_invalid",
    with_(t.RAW, VALIDATED, body="""SELECT ordinal, CASE WHEN errors = '' THEN 'valid' ELSE 'invalid' END AS side
    FROM validated"""),
)
def split_valid_invalid(spark: SparkSession, folder: str) -> DataFrame:
    """Both complementary parts of the table, from one pass of the rules."""
    valid, invalid = rules.split(t.raw(spark, folder), rules.validator_rules())
    return valid.select("ordinal", F.lit("valid").alias("side")).unionByName(
        invalid.select("ordinal", F.lit("invalid").alias("side"))
    )


CONSTRAINED = f"""constrained AS (SELECT *, list_filter([
    CASE WHEN NOT regexp_matches(txn_id, '^TXN\\d{{8,}}$') THEN 'bad_txn_id' END,
    CASE WHEN NOT regexp_matches(user_id, '^U\\d{{4,}}$') THEN 'bad_user_id' END,
    CASE WHEN {NUM} IS NULL THEN 'amount_type' END,
    CASE WHEN {OUTSIDE} THEN 'amount_range' END,
    CASE WHEN coalesce(status NOT IN ({STATUS_LIST}), true) THEN 'bad_status' END,
    CASE WHEN coalesce(category NOT IN ({CATEGORY_LIST}), true) THEN 'bad_category' END], lambda x: x IS NOT NULL) AS errors
  FROM raw)"""


@report(
    "dq_validity",
    with_(t.RAW, CONSTRAINED, body=f"""SELECT COUNT(*) AS total, COUNT(*) FILTER (len(errors) = 0) AS valid,
    COUNT(*) FILTER (len(errors) > 0) AS invalid, {pct2('COUNT(*) FILTER (len(errors) = 0)', 'COUNT(*)')} AS valid_pct
    FROM constrained"""),
)
def dq_validity(spark: SparkSession, folder: str) -> DataFrame:
    return rules.summary(t.raw(spark, folder), rules.constraint_rules())


@report(
    "dq_error_types",
    with_(t.RAW, CONSTRAINED, body="""SELECT error, COUNT(*) AS n_rows
    FROM (SELECT unnest(errors) AS error FROM constrained) GROUP BY error"""),
)
def dq_error_types(spark: SparkSession, folder: str) -> DataFrame:
    return rules.histogram(t.raw(spark, folder), rules.constraint_rules())


@report(
    "dq_null_profile",
    with_(t.RAW, body=" UNION ALL ".join(
        f"SELECT '{c}' AS field, COUNT(*) FILTER (\"{c}\" IS NULL OR trim(\"{c}\") = '') AS n_missing FROM raw"
        for c in RAW_FIELDS
    )),
)
def dq_null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rules.null_profile(t.raw(spark, folder), RAW_FIELDS)


@report(
    "dq_completeness",
    with_(t.RAW, body="""SELECT COUNT(*) AS n_rows, COUNT(*) - COUNT(DISTINCT txn_id) AS duplicate_ids,
    COUNT(*) FILTER (trim(amount) = '') AS null_amounts, COUNT(*) FILTER (trim(user_id) = '') AS null_users,
    COUNT(DISTINCT user_id) AS unique_users FROM raw"""),
)
def dq_completeness(spark: SparkSession, folder: str) -> DataFrame:
    counts = {
        "n_rows": F.count("*"),
        "null_amounts": F.count_if(fn.blank(F.col("amount"))),
        "null_users": F.count_if(fn.blank(F.col("user_id"))),
    }
    found = counting.totals_with_distinct(t.raw(spark, folder), counts, {"ids": "txn_id", "unique_users": "user_id"})
    return found.select(
        "n_rows", (F.col("n_rows") - F.col("ids")).alias("duplicate_ids"), "null_amounts", "null_users", "unique_users"
    )


@report(
    "dq_score",
    with_(t.RAW, CONSTRAINED, """counts AS (SELECT COUNT(*) AS n,
          COUNT(*) FILTER (trim(amount) <> '') AS complete, COUNT(DISTINCT txn_id) AS uniq,
          COUNT(*) FILTER (len(errors) = 0) AS valid FROM constrained)""",
          body=f"""SELECT {pct2('complete', 'n')} AS completeness, {pct2('uniq', 'n')} AS uniqueness,
          {pct2('valid', 'n')} AS validity, {pct2('complete + uniq + valid', '(3 * n)')} AS dq_score,
          CASE WHEN complete + uniq + valid > 0.95 * 3 * n THEN 'EXCELLENT'
               WHEN complete + uniq + valid > 0.85 * 3 * n THEN 'GOOD' ELSE 'POOR' END AS grade FROM counts"""),
)
def dq_score(spark: SparkSession, folder: str) -> DataFrame:
    """The mean of completeness, uniqueness and validity, from one pass over the rows."""
    checked = rules.check(t.raw(spark, folder), rules.constraint_rules())
    counts = checked.agg(
        F.count("*").alias("n"),
        F.count_if(~fn.blank(F.col("amount"))).alias("complete"),
        F.count_distinct("txn_id").alias("uniq"),
        F.count_if(F.size("errors") == 0).alias("valid"),
    )
    good, whole = F.col("complete") + F.col("uniq") + F.col("valid"), F.col("n") * 3
    return counts.select(
        fn.percent(F.col("complete"), F.col("n")).alias("completeness"),
        fn.percent(F.col("uniq"), F.col("n")).alias("uniqueness"),
        fn.percent(F.col("valid"), F.col("n")).alias("validity"),
        fn.percent(good, whole).alias("dq_score"),
        F.when(good * 100 > whole * EXCELLENT, "EXCELLENT")
        .when(good * 100 > whole * GOOD, "GOOD")
        .otherwise("POOR")
        .alias("grade"),
    )


@report(
    "quality_gate",
    with_(t.RAW, f"g AS (SELECT COUNT(*) AS n, COUNT(*) FILTER ({NUM} > 0 AND starts_with(txn_id, 'TXN')) AS ok FROM raw)",
          body=f"""SELECT n AS total, ok AS valid, {pct2('ok', 'n')} AS valid_pct, ok * 100 >= n * 90 AS passed FROM g"""),
)
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_gate(t.raw(spark, folder))


# ---- anomalies -------------------------------------------------------------


def z_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Rows far from the global mean; mean and deviation are scalar subqueries."""
    events = t.ev(spark, folder)
    mean, std = events.agg(F.avg("amount")).scalar(), events.agg(F.stddev_samp("amount")).scalar()
    z = F.try_divide(F.col("amount") - mean, std)
    return (
        events.select("event_id", "amount", z.alias("z"))
        .where(F.abs("z") > Z_LIMIT)
        .select("event_id", "amount", F.round("z", 3).alias("z_score"))
    )


ZED = f"""zed AS (SELECT event_id, amount, ROUND(z, 3) AS z_score FROM (
  SELECT event_id, amount, (amount - (SELECT AVG(amount) FROM ev)) / (SELECT STDDEV_SAMP(amount) FROM ev) AS z
  FROM ev) WHERE abs(z) > {Z_LIMIT})"""


@report("dq_zscore", with_(t.EV, ZED, body="SELECT event_id, amount, z_score FROM zed"))
def dq_zscore(spark: SparkSession, folder: str) -> DataFrame:
    return z_scores(spark, folder)


@report(
    "dq_zscore_top5",
    with_(t.EV, ZED, body=f"SELECT event_id, amount, z_score FROM zed ORDER BY abs(z_score) DESC, event_id LIMIT {TOP_HITS}"),
)
def dq_zscore_top5(spark: SparkSession, folder: str) -> DataFrame:
    return z_scores(spark, folder).orderBy(F.abs("z_score").desc(), "event_id").limit(TOP_HITS)


def quartile_fences(df: DataFrame) -> DataFrame:
    """One row: the order statistics at n/4 and 3n/4 and the fences around them, exactly."""
    picks = {"q1": F.expr("total div 4"), "q3": F.expr("(total * 3) div 4")}
    found = ordering.order_statistics(df, "amount", picks)
    one = found.agg(
        F.max(F.when(F.col("pick") == "q1", F.col("value"))).alias("q1"),
        F.max(F.when(F.col("pick") == "q3", F.col("value"))).alias("q3"),
    ).withColumn("iqr", F.col("q3") - F.col("q1"))
    reach = F.col("iqr") * F.lit(FENCE).cast("decimal(2,1)")
    return stage(
        one.withColumn("lo", F.col("q1") - reach).withColumn("hi", F.col("q3") + reach), "fences"
    )


def money_events(spark: SparkSession, folder: str) -> DataFrame:
    return t.ev(spark, folder).select("event_id", F.col("amount").cast(fn.MONEY).alias("amount"))


def outside(fences: DataFrame) -> Column:
    low, high = fences.select("lo").scalar(), fences.select("hi").scalar()
    return (F.col("amount") < low) | (F.col("amount") > high)


FENCES = """m AS (SELECT event_id, CAST(amount AS DECIMAL(18,2)) AS amount FROM ev),
srt AS (SELECT amount, ROW_NUMBER() OVER (ORDER BY amount) - 1 AS i, COUNT(*) OVER () AS n FROM m),
q AS (SELECT MAX(CASE WHEN i = n // 4 THEN amount END) AS q1,
             MAX(CASE WHEN i = (3 * n) // 4 THEN amount END) AS q3 FROM srt),
fences AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - CAST(1.5 AS DECIMAL(2,1)) * (q3 - q1) AS lo,
                  q3 + CAST(1.5 AS DECIMAL(2,1)) * (q3 - q1) AS hi FROM q)"""


@report(
    "dq_iqr",
    with_(t.EV, FENCES, "hit AS (SELECT COUNT(*) FILTER (amount < lo OR amount > hi) AS n_out, COUNT(*) AS n FROM m, fences)",
          body=f"""SELECT {dbl('q1')} AS q1, {dbl('q3')} AS q3, {dbl('iqr')} AS iqr, {dbl('lo')} AS lower_fence,
          {dbl('hi')} AS upper_fence, n_out AS n_outliers, {pct2('n_out', 'n')} AS outlier_pct FROM fences, hit"""),
)
def dq_iqr(spark: SparkSession, folder: str) -> DataFrame:
    events = money_events(spark, folder)
    fences = quartile_fences(events)
    n_out = F.count_if(outside(fences))
    counted = events.agg(
        n_out.alias("n_outliers"), fn.percent(n_out, F.count("*")).alias("outlier_pct")
    )
    named = {"q1": "q1", "q3": "q3", "iqr": "iqr", "lower_fence": "lo", "upper_fence": "hi"}
    return counted.withColumns({k: fn.dbl(fences.select(c).scalar()) for k, c in named.items()})


@report(
    "dq_iqr_rows",
    with_(t.EV, FENCES, body=f"SELECT event_id, {dbl('amount')} AS amount FROM m, fences WHERE amount < lo OR amount > hi"),
)
def dq_iqr_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = money_events(spark, folder)
    hits = events.where(outside(quartile_fences(events)))
    return hits.select("event_id", fn.dbl(F.col("amount")).alias("amount"))


@report(
    "dq_behavioural",
    with_(t.EV, f"""per_user AS (SELECT user_id, COUNT(*) AS user_n, AVG(amount) AS m, STDDEV_SAMP(amount) AS s,
          SUM(CAST(amount AS DECIMAL(18,2))) AS user_total FROM ev GROUP BY user_id)""",
          body=f"""SELECT event_id, user_id, {dbl('amount')} AS amount, {avg2('user_total', 'user_n')} AS user_avg,
          {RATIO_TO_MEAN} AS ratio
          FROM (SELECT event_id, user_id, CAST(ev.amount AS DECIMAL(18,2)) AS amount, user_total, user_n
                FROM ev JOIN per_user USING (user_id)
                WHERE user_n >= {BEHAVIOUR_MIN_ROWS} AND s <> 0 AND abs(ev.amount - m) / s > {BEHAVIOUR_SIGMAS})"""),
)
def dq_behavioural(spark: SparkSession, folder: str) -> DataFrame:
    """Rows far from their own user's mean; users with few or equal rows are left out."""
    events = t.ev(spark, folder).select("event_id", "user_id", "amount")
    stats = events.groupBy("user_id").agg(
        F.count("*").alias("user_n"),
        F.avg("amount").alias("m"),
        F.stddev_samp("amount").alias("s"),
        F.sum(F.col("amount").cast(fn.MONEY)).alias("user_total"),
        F.count("*").alias("n_rows"),
    ).where((F.col("user_n") >= BEHAVIOUR_MIN_ROWS) & (F.col("s") != 0))
    joined = joins.join_group_stats(events, stats, ["user_id"], "n_rows")
    hits = joined.where(F.abs(F.col("amount") - F.col("m")) / F.col("s") > BEHAVIOUR_SIGMAS)
    return hits.withColumn("amount", F.col("amount").cast(fn.MONEY)).select(
        "event_id",
        "user_id",
        fn.dbl(F.col("amount")).alias("amount"),
        fn.ratio(F.col("user_total"), F.col("user_n")).alias("user_avg"),
        ratio_to_mean(F.col("user_n").cast(fn.COUNT)).alias("ratio"),
    )


def velocity(events: DataFrame) -> DataFrame:
    """(user, minute) groups with more than one row."""
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    return (
        events.groupBy("user_id", minute.alias("minute"))
        .agg(F.count("*").alias("n_txns"))
        .where(F.col("n_txns") > 1)
    )


VELOCITY = """vel AS (SELECT user_id, date_trunc('minute', ts) AS minute, COUNT(*) AS n_txns
  FROM ev GROUP BY 1, 2 HAVING COUNT(*) > 1)"""


@report("dq_velocity", with_(t.EV, VELOCITY, body="SELECT user_id, minute, n_txns FROM vel"))
def dq_velocity(spark: SparkSession, folder: str) -> DataFrame:
    return velocity(t.ev(spark, folder))


@report(
    "dq_velocity_top5",
    with_(t.EV, VELOCITY, body=f"SELECT user_id, minute, n_txns FROM vel ORDER BY n_txns DESC, minute, user_id LIMIT {TOP_HITS}"),
)
def dq_velocity_top5(spark: SparkSession, folder: str) -> DataFrame:
    return velocity(t.ev(spark, folder)).orderBy(F.col("n_txns").desc(), "minute", "user_id").limit(TOP_HITS)


FRAUD_LIMITS = {"stream_alert": STREAM_ALERT, "sql_candidate": HIGH_VALUE, "high_value_failed": HIGH_FAILED}


@report(
    "fraud_rules",
    with_(t.TXN, body=" UNION ALL ".join(
        f"SELECT txn_id, '{name}' AS rule, {dbl('amount')} AS amount FROM txn WHERE status = 'FAILED' AND amount > {limit}"
        for name, limit in FRAUD_LIMITS.items()
    )),
)
def fraud_rules(spark: SparkSession, folder: str) -> DataFrame:
    """All threshold rules in one scan, filtered by the lowest threshold."""
    amount = F.col("amount")
    hits = F.array_compact(F.array(*[
        F.when(amount > F.lit(limit).cast(fn.MONEY), F.lit(name)) for name, limit in FRAUD_LIMITS.items()
    ]))
    rows = t.txn(spark, folder, status="FAILED", above=min(FRAUD_LIMITS.values()))
    return rows.select("txn_id", F.explode(hits).alias("rule"), fn.dbl(amount).alias("amount"))
