"""Ingestion, star schema, snapshots, keyed log and lake files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import ingest, keyed_log, rules, warehouse
from ..operators.snapshots import VersionedTable
from ..operators.stored import IntervalTable, row_differences
from ..session import fresh_path, stage
from ..sources import files, synthetic
from ..sources import tables as t
from .quality import NUM
from .registry import dbl, mln2, report, with_
from .relations import VERY_HIGH_SUCCESS

# ---- ingestion -------------------------------------------------------------

GATE_SQL = f"COALESCE({NUM} > 0 AND starts_with(txn_id, 'TXN'), false)"
BATCHES = f"""batches AS (SELECT *, {GATE_SQL} AS ok,
  (ROW_NUMBER() OVER (ORDER BY ordinal) - 1) // {ingest.BATCH_ROWS} + 1 AS batch_id FROM raw)"""


@report(
    "ingest_batch_log",
    with_(t.RAW, BATCHES, body="""SELECT batch_id, COUNT(*) AS size, COUNT(*) FILTER (ok) AS ok,
    COUNT(*) FILTER (NOT ok) AS failed FROM batches GROUP BY batch_id"""),
)
def ingest_batch_log(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.batch_log(ingest.numbered_batches(t.raw(spark, folder, placed=True)))


@report(
    "ingest_validate",
    with_(t.RAW, body=f"SELECT ordinal, txn_id, {GATE_SQL} AS ok FROM raw"),
)
def ingest_validate(spark: SparkSession, folder: str) -> DataFrame:
    """The condition a row has to meet to be loaded: a positive amount and a known id prefix."""
    return t.raw(spark, folder).select("ordinal", "txn_id", rules.gate_condition().alias("ok"))


@report(
    "ingested_rows",
    with_(t.RAW, BATCHES, f"""firsts AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY txn_id ORDER BY ordinal) AS nth
          FROM batches WHERE ok)""",
          body=f"""SELECT txn_id, user_id, merchant, category, {dbl(f'CAST({NUM} AS DECIMAL(18,2))')} AS amount,
          status, wallet_type, "date", batch_id, substr(md5(txn_id || amount), 1, 8) AS checksum
          FROM firsts WHERE nth = 1"""),
)
def ingested_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = ingest.ingested(ingest.numbered_batches(t.raw(spark, folder, placed=True)))
    return rows.withColumn("amount", fn.dbl(F.col("amount"))).drop("ordinal")


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LINE_COLS = ", ".join([*LINE_KEY, *LINE_REST])


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return t.read(spark, folder, "lineitem").select(*LINE_KEY, *LINE_REST)


@report(
    "dedup_first",
    f"""SELECT {LINE_COLS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(LINE_KEY)}
    ORDER BY {', '.join(LINE_REST)}) AS nth FROM lineitem) WHERE nth = 1""",
)
def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.first_per_key(lines(spark, folder), LINE_KEY, LINE_REST)


LOAD_CUT = "1999-01-01"


def two_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The order lines as an early and a late delivery, which share keys."""
    rows = lines(spark, folder)
    cut = F.lit(LOAD_CUT).cast("timestamp_ntz")
    return rows.where(F.col("l_shipdate") < cut), rows.where(F.col("l_shipdate") >= cut)


@report(
    "ingest_insert_ignore",
    f"""SELECT {LINE_COLS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(LINE_KEY)}
    ORDER BY l_shipdate >= TIMESTAMP '{LOAD_CUT}', {', '.join(LINE_REST)}) AS nth FROM lineitem) WHERE nth = 1""",
)
def ingest_insert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    """The table after two loads in which the first write of a key wins."""
    early, late = two_loads(spark, folder)
    stored = stage(ingest.first_per_key(early, LINE_KEY, LINE_REST), "stored_lines")
    return stored.unionByName(ingest.insert_ignore(stored, late, LINE_KEY, LINE_REST))


@report(
    "upsert_latest",
    f"""SELECT {LINE_COLS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(LINE_KEY)}
    ORDER BY {', '.join(f'{c} DESC' for c in LINE_REST)}) AS nth FROM lineitem) WHERE nth = 1""",
)
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The table after two loads in which the last shipment of a key wins."""
    early, late = two_loads(spark, folder)
    return ingest.upsert_latest(early, late, LINE_KEY, F.struct(*LINE_REST))


CLEAN_SQL = f"""ordinal, txn_id, user_id, merchant, category, {dbl('a')} AS amount,
    CAST(ROUND(a * CAST(0.18 AS DECIMAL(2,2)), 2) AS DOUBLE) AS gst,
    CAST(ROUND(a * CAST(0.82 AS DECIMAL(2,2)), 2) AS DOUBLE) AS net, upper(status) AS status,
    CAST(status = 'SUCCESS' AS INTEGER) AS is_success, wallet_type, "date", substr("date", 1, 7) AS month"""
TYPED = "typed AS (SELECT *, TRY_CAST(amount AS DECIMAL(18,2)) AS a FROM raw)"


def clean_columns(raw: DataFrame) -> DataFrame:
    a = F.col("amount").try_cast(fn.MONEY)
    return raw.select(
        "ordinal", "txn_id", "user_id", "merchant", "category",
        a.alias("money"),
        fn.dbl(a).alias("amount"),
        fn.dbl(fn.gst(a)).alias("gst"),
        fn.dbl(fn.net(a)).alias("net"),
        F.upper("status").alias("status"),
        fn.is_success(F.col("status")).alias("is_success"),
        "wallet_type",
        "date",
        F.substring("date", 1, 7).alias("month"),
    )


@report("etl_clean", with_(t.RAW, TYPED, body=f"SELECT {CLEAN_SQL} FROM typed"))
def etl_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Transform before the load: every row arrives, unreadable amounts as NULL."""
    return clean_columns(t.raw(spark, folder)).drop("money")


@report("elt_clean", with_(t.RAW, TYPED, body=f"SELECT {CLEAN_SQL} FROM typed WHERE a > 0"))
def elt_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Load first, then create the clean table from the loaded one, positive amounts only."""
    loaded = stage(t.raw(spark, folder), "raw_txn")
    return clean_columns(loaded).where(F.col("money") > 0).drop("money")


# ---- star schema -----------------------------------------------------------


DIM_USER = """dim_user AS (SELECT ROW_NUMBER() OVER (ORDER BY user_id) AS user_sk, user_id, city, kyc_status, city_tier
  FROM raw_users)"""


@report("dim_user", with_(t.USERS, t.RAW_USERS, DIM_USER, body="SELECT * FROM dim_user"))
def dim_user(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_user(t.raw_users(spark, folder))


@report(
    "dim_user_repeated",
    with_(t.USERS, t.REPEATED_USERS,
          "firsts AS (SELECT * FROM repeated_users QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY source_key) = 1)",
          body="SELECT ROW_NUMBER() OVER (ORDER BY user_id) AS user_sk, user_id, city, kyc_status, city_tier FROM firsts"),
)
def dim_user_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """The user dimension from a source that repeats users: the first row of a user wins."""
    return warehouse.dim_user(t.repeated_users(spark, folder))


def dim_sql(column: str, mapping: dict[str, str], attribute: str, sk: str) -> str:
    pairs = ", ".join(f"('{k}', '{v}')" for k, v in mapping.items())
    return f"""(SELECT ROW_NUMBER() OVER (ORDER BY {column}) AS {sk}, {column}, {attribute}
    FROM (SELECT DISTINCT {column} FROM raw) JOIN (VALUES {pairs}) AS m(k, {attribute}) ON {column} = k)"""


DIM_MERCHANT = "dim_merchant AS " + dim_sql("merchant", t.MERCHANT_TYPE, "type", "merchant_sk")
DIM_CATEGORY = "dim_category AS " + dim_sql("category", t.CATEGORY_PARENT, "parent", "cat_sk")
DIM_WALLET = "dim_wallet AS " + dim_sql("wallet_type", {w: w for w in t.WALLETS}, "known", "wallet_sk")


@report("dim_merchant", with_(t.RAW, DIM_MERCHANT, body="SELECT * FROM dim_merchant"))
def dim_merchant(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_merchant(t.raw(spark, folder))


@report("dim_category", with_(t.RAW, DIM_CATEGORY, body="SELECT * FROM dim_category"))
def dim_category(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_category(t.raw(spark, folder))


@report("dim_wallet", with_(t.RAW, DIM_WALLET, body="SELECT wallet_sk, wallet_type FROM dim_wallet"))
def dim_wallet(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_wallet(t.raw(spark, folder))


DIM_DATE = """dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS DATE) AS "date",
    CAST(day(d) AS INTEGER) AS "day", CAST(month(d) AS INTEGER) AS "month", strftime(d, '%b') AS month_name,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS "year",
    CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend
  FROM (SELECT unnest(generate_series(date_trunc('year', MIN(o_orderdate)),
        date_trunc('year', MAX(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders))"""


@report("dim_date", with_(DIM_DATE, body="SELECT * FROM dim_date"))
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    days = t.txn(spark, folder).select(F.to_date("ts").alias("d"))
    return warehouse.dim_date(days, "d")


FACTS = f"""fact AS (SELECT ROW_NUMBER() OVER (ORDER BY ordinal) AS txn_sk, txn_id, user_sk, merchant_sk,
    CAST(replace("date", '-', '') AS INTEGER) AS date_sk, cat_sk, wallet_sk,
    CAST({NUM} AS DECIMAL(18,2)) AS amount, status, CAST(status = 'SUCCESS' AS INTEGER) AS is_success,
    CAST(hour(try_strptime("timestamp", '%Y-%m-%d %H:%M:%S')) AS INTEGER) AS hour
  FROM raw LEFT JOIN dim_user USING (user_id) LEFT JOIN dim_merchant USING (merchant)
       LEFT JOIN dim_category USING (category) LEFT JOIN dim_wallet USING (wallet_type))"""
STAR = (t.USERS, t.RAW_USERS, t.RAW, DIM_USER, DIM_MERCHANT, DIM_CATEGORY, DIM_WALLET, DIM_DATE, FACTS)


@report(
    "fact_load",
    with_(*STAR, body=f"""SELECT txn_sk, txn_id, user_sk, merchant_sk, date_sk, cat_sk, wallet_sk,
    {dbl('amount')} AS amount, status, is_success, hour FROM fact"""),
)
def fact_load(spark: SparkSession, folder: str) -> DataFrame:
    """Facts numbered in source order, with their foreign keys."""
    users = stage(warehouse.dim_user(t.raw_users(spark, folder)), "dim_user")
    numbered = t.raw(spark, folder, placed=True).withColumn("txn_sk", F.col("pos") + 1)
    facts = warehouse.facts(numbered, users)
    return facts.withColumn("amount", fn.dbl(F.col("amount")))


@report(
    "star_q1_city_tier",
    with_(*STAR, body=f"""SELECT city_tier, city, COUNT(*) AS txns, {mln2('COALESCE(SUM(amount), 0)')} AS rev_m
    FROM fact JOIN dim_user USING (user_sk) JOIN dim_date USING (date_sk) WHERE quarter = 1 AND is_success = 1
    GROUP BY city_tier, city ORDER BY SUM(amount) DESC, city LIMIT 8"""),
)
def star_q1_city_tier(spark: SparkSession, folder: str) -> DataFrame:
    """Facts meet the calendar (bounded by its days), shrink to one row per user, then meet users."""
    users = stage(warehouse.dim_user(t.raw_users(spark, folder)), "dim_user")
    raw = t.raw(spark, folder)
    calendar = warehouse.dim_date(raw.select(F.to_date("date").alias("d")), "d")
    quarter = F.broadcast(calendar.where("quarter = 1").select("date_sk"))
    per_user = (
        warehouse.facts(raw, users, names=())
        .where("is_success = 1")
        .join(quarter, "date_sk")
        .groupBy("user_sk")
        .agg(F.count("*").alias("txns"), F.sum("amount").alias("amount"))
    )
    return (
        per_user.join(users, "user_sk")
        .groupBy("city_tier", "city")
        .agg(F.sum("txns").alias("txns"), F.sum("amount").alias("total"))
        .orderBy(F.col("total").desc(), "city")
        .limit(8)
        .select("city_tier", "city", "txns", fn.millions(F.coalesce("total", F.lit(0).cast(fn.MONEY))).alias("rev_m"))
    )


# ---- snapshots -------------------------------------------------------------

SNAPSHOT_SCHEMA = "txn_id bigint, user_id bigint, amount decimal(18,2), status string, ts timestamp_ntz"
CUTS = ["1997-01-01", "1999-01-01"]
WAVE = f"""CASE WHEN ts < TIMESTAMP '{CUTS[0]}' THEN 0 WHEN ts < TIMESTAMP '{CUTS[1]}' THEN 1 ELSE 2 END"""
VERSIONS = f"""loads AS (SELECT txn_id, user_id, amount, status, ts, {WAVE} AS wave FROM txn),
updated AS (SELECT txn_id, user_id, amount, CASE WHEN status = 'FAILED' AND amount > {VERY_HIGH_SUCCESS}
            THEN 'PENDING' ELSE status END AS status, ts FROM loads)"""
SNAP_COLS = f"txn_id, user_id, {dbl('amount')} AS amount, status, ts"


def versioned_txn(spark: SparkSession, folder: str) -> VersionedTable:
    """The transactions loaded in three waves (overwrite, append, append) and then updated."""
    table = VersionedTable(spark, fresh_path(spark, "versioned"), SNAPSHOT_SCHEMA)
    rows = t.txn(spark, folder)
    first, second = [F.lit(c).cast("timestamp_ntz") for c in CUTS]
    ts = F.col("ts")
    table.write(rows.where(ts < first), "overwrite")
    table.write(rows.where((ts >= first) & (ts < second)), "append")
    table.write(rows.where(ts >= second), "append")
    table.update(
        (F.col("status") == "FAILED") & (F.col("amount") > F.lit(VERY_HIGH_SUCCESS).cast(fn.MONEY)),
        {"status": F.lit("PENDING")},
    )
    return table


def shown(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", fn.dbl(F.col("amount")))


COMMITS = """commits AS (
  SELECT CAST(v AS INTEGER) AS version, action, n_rows, n_changed FROM (
    SELECT 0 AS v, 'OVERWRITE' AS action, COUNT(*) FILTER (wave = 0) AS n_rows, CAST(0 AS BIGINT) AS n_changed FROM loads
    UNION ALL SELECT 1, 'APPEND', COUNT(*) FILTER (wave = 1), 0 FROM loads
    UNION ALL SELECT 2, 'APPEND', COUNT(*) FILTER (wave = 2), 0 FROM loads
    UNION ALL SELECT 3, 'UPDATE', COUNT(*), COUNT(*) FILTER (status = 'FAILED' AND amount > 470000) FROM loads))"""


@report("snapshot_commits", with_(t.TXN, VERSIONS, COMMITS, body="SELECT version, action, n_rows FROM commits"))
def snapshot_commits(spark: SparkSession, folder: str) -> DataFrame:
    return versioned_txn(spark, folder).commits().select("version", "action", "n_rows")


@report("snapshot_history", with_(t.TXN, VERSIONS, COMMITS, body="SELECT * FROM commits"))
def snapshot_history(spark: SparkSession, folder: str) -> DataFrame:
    return versioned_txn(spark, folder).history()


def interval_txn(spark: SparkSession, folder: str) -> IntervalTable:
    """The transactions loaded in three waves (versions 0 to 2) and then updated (version 3)."""
    table = IntervalTable(spark, fresh_path(spark, "intervals"), SNAPSHOT_SCHEMA, ["txn_id"])
    rows = t.txn(spark, folder)
    first, second = [F.lit(c).cast("timestamp_ntz") for c in CUTS]
    ts = F.col("ts")
    for version, wave in enumerate([ts < first, (ts >= first) & (ts < second), ts >= second]):
        table.append(rows.where(wave), version)
    table.update(
        (F.col("status") == "FAILED") & (F.col("amount") > F.lit(VERY_HIGH_SUCCESS).cast(fn.MONEY)),
        {"status": F.lit("PENDING")},
        3,
    )
    return table


@report("snapshot_as_of", with_(t.TXN, VERSIONS, body=f"SELECT {SNAP_COLS} FROM loads WHERE wave <= 1"))
def snapshot_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return shown(interval_txn(spark, folder).as_of(1))


@report("snapshot_update", with_(t.TXN, VERSIONS, body=f"SELECT {SNAP_COLS} FROM updated"))
def snapshot_update(spark: SparkSession, folder: str) -> DataFrame:
    return shown(interval_txn(spark, folder).as_of(3))


@report(
    "snapshot_intervals",
    with_(t.TXN, VERSIONS, f"hit AS (SELECT * FROM loads WHERE status = 'FAILED' AND amount > {VERY_HIGH_SUCCESS})",
          body=f"""SELECT {SNAP_COLS}, CAST(wave AS INTEGER) AS since,
          CAST(CASE WHEN txn_id IN (SELECT txn_id FROM hit) THEN 3 END AS INTEGER) AS until FROM loads
          UNION ALL SELECT txn_id, user_id, {dbl('amount')}, 'PENDING', ts, 3, NULL FROM hit"""),
)
def snapshot_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Every row with the versions from and before which it holds."""
    return shown(interval_txn(spark, folder).intervals())


@report(
    "snapshot_update_counts",
    with_(t.TXN, VERSIONS, COMMITS, body="SELECT n_changed AS changed, n_rows - n_changed AS unchanged FROM commits WHERE version = 3"),
)
def snapshot_update_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = interval_txn(spark, folder).counts()
    last = F.col("version") == 3
    return counts.agg(
        F.sum(F.when(last, F.col("opened"))).alias("changed"),
        (F.sum(F.when(~last, F.col("opened"))) - F.sum("closed")).alias("unchanged"),
    )


@report(
    "snapshot_version_counts",
    with_(t.TXN, VERSIONS, body=" UNION ALL ".join(
        f"SELECT CAST({v} AS INTEGER) AS version, COUNT(*) AS visible_rows FROM loads WHERE wave <= {v}"
        for v in range(4)
    )),
)
def snapshot_version_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows visible at each version; the window runs over one row per version."""
    upto = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, 0)
    counts = interval_txn(spark, folder).counts()
    return counts.select("version", F.sum(F.col("opened") - F.col("closed")).over(upto).alias("visible_rows"))


@report(
    "snapshot_diff",
    with_(t.TXN, VERSIONS,
          "older AS (SELECT * FROM loads WHERE wave <= 1 AND user_id % 11 <> 3)",
          body=f"""SELECT coalesce(o.txn_id, u.txn_id) AS txn_id,
          CASE WHEN o.txn_id IS NULL THEN 'added' WHEN u.txn_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
          o.user_id AS old_user_id, {dbl('o.amount')} AS old_amount, o.status AS old_status, o.ts AS old_ts,
          u.user_id AS new_user_id, {dbl('u.amount')} AS new_amount, u.status AS new_status, u.ts AS new_ts
          FROM older o FULL OUTER JOIN (SELECT * FROM updated WHERE user_id % 13 <> 5) u ON o.txn_id = u.txn_id
          WHERE o.txn_id IS NULL OR u.txn_id IS NULL OR (o.user_id, o.amount, o.status, o.ts)
          IS DISTINCT FROM (u.user_id, u.amount, u.status, u.ts)"""),
)
def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    """What differs between the state at version 1 and the last one, when each lacks some users."""
    table = interval_txn(spark, folder)
    before, after = table.as_of(1).where("user_id % 11 <> 3"), table.as_of(3).where("user_id % 13 <> 5")
    found = row_differences(before, after, ["txn_id"])
    return found.withColumns({c: fn.dbl(F.col(c)) for c in ("old_amount", "new_amount")})


@report(
    "snapshot_vacuum",
    with_(t.TXN, VERSIONS, body="""SELECT CAST(3 AS INTEGER) AS version, COUNT(*) AS n_rows FROM loads
    UNION ALL SELECT 4, COUNT(*) FILTER (wave = 2) FROM loads"""),
)
def snapshot_vacuum(spark: SparkSession, folder: str) -> DataFrame:
    """After one more append, the last two versions (3 and 4) need only what they show."""
    table = versioned_txn(spark, folder)
    again = t.txn(spark, folder).where(F.col("ts") >= F.lit(CUTS[1]).cast("timestamp_ntz"))
    table.write(again, "append")
    table.vacuum(retain=2)
    return table.stored_rows()


@report("compact_by_user", with_(t.TXN, VERSIONS, body=f"SELECT {SNAP_COLS} FROM updated"))
def compact_by_user(spark: SparkSession, folder: str) -> DataFrame:
    """Rewritten in user order: the same rows, in files that a user filter can skip."""
    table = versioned_txn(spark, folder)
    table.optimize("user_id", "ts", "txn_id")
    return shown(table.as_of())


# ---- keyed log -------------------------------------------------------------

# Partitions of the log, consumer groups and how much they poll.
BUCKETS = 4
GROUPS = {"fraud-detection-group": 5, "analytics-group": 3}
REPLAY_GROUP, REPLAY_ROWS = "audit-replay-group", 3
LOG = f"""log AS (SELECT event_id, user_id, ts, CAST(h % {BUCKETS} AS INTEGER) AS bucket,
  ROW_NUMBER() OVER (PARTITION BY h % {BUCKETS} ORDER BY ts, event_id) - 1 AS "offset"
  FROM (SELECT *, CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM ev))"""


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    rows = t.ev(spark, folder).select("event_id", "user_id", "ts")
    return keyed_log.keyed_log(rows, "user_id", BUCKETS, [F.col("ts"), F.col("event_id")])


@report("keyed_log_offsets", with_(t.EV, LOG, body='SELECT event_id, user_id, ts, bucket, "offset" FROM log'))
def keyed_log_offsets(spark: SparkSession, folder: str) -> DataFrame:
    return event_log(spark, folder)


@report(
    "keyed_log_distribution",
    with_(t.EV, LOG, body='SELECT bucket, COUNT(*) AS messages, MAX("offset") + 1 AS high_water_mark FROM log GROUP BY bucket'),
)
def keyed_log_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return keyed_log.distribution(event_log(spark, folder))


def poll_size() -> Column:
    return t.mapped(F.col("consumer"), {k: str(v) for k, v in GROUPS.items()}).cast("bigint")


def after_first_poll(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    log = stage(event_log(spark, folder), "log")
    start = keyed_log.start_offsets(log, list(GROUPS))
    return log, keyed_log.commit(start, keyed_log.poll(log, start, poll_size()))


POLL_SQL = " UNION ALL ".join(
    f"SELECT '{g}' AS consumer, event_id, bucket, \"offset\" FROM log WHERE \"offset\" BETWEEN {n} AND {2 * n - 1}"
    for g, n in GROUPS.items()
)


@report("log_poll", with_(t.EV, LOG, body=POLL_SQL))
def log_poll(spark: SparkSession, folder: str) -> DataFrame:
    """The second poll of two independent groups: each goes on from its own offsets."""
    log, committed = after_first_poll(spark, folder)
    polled = keyed_log.poll(log, committed, poll_size())
    return polled.select("consumer", "event_id", "bucket", "offset")


@report(
    "log_committed_offsets",
    with_(t.EV, LOG, body=" UNION ALL ".join(
        f"SELECT '{g}' AS consumer, bucket, LEAST({n}, MAX(\"offset\") + 1) AS next_offset FROM log GROUP BY bucket"
        for g, n in GROUPS.items()
    )),
)
def log_committed_offsets(spark: SparkSession, folder: str) -> DataFrame:
    return after_first_poll(spark, folder)[1]


@report(
    "log_replay",
    with_(t.EV, LOG, body=f"SELECT event_id, bucket, \"offset\" FROM log WHERE bucket = 0 AND \"offset\" < {REPLAY_ROWS}"),
)
def log_replay(spark: SparkSession, folder: str) -> DataFrame:
    """A group set back to offset 0 reads bucket 0 once more."""
    log = stage(event_log(spark, folder), "log")
    start = keyed_log.seek(keyed_log.start_offsets(log, [REPLAY_GROUP]), REPLAY_GROUP).where("bucket = 0")
    return keyed_log.poll(log, start, F.lit(REPLAY_ROWS)).select("event_id", "bucket", "offset")


# ---- files -----------------------------------------------------------------


@report(
    "scan_multi_file",
    with_(t.RAW, body="""SELECT 'transactions_' || replace(substr("date", 1, 7), '-', '_') AS file, COUNT(*) AS n_rows,
    CAST(SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS readable_total FROM raw GROUP BY 1"""),
)
def scan_multi_file(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly CSV folders written, then read back by their common name prefix as one table."""
    path = fresh_path(spark, "monthly")
    rows = t.raw(spark, folder)
    name = F.concat(F.lit("transactions_"), F.regexp_replace(F.substring("date", 1, 7), "-", "_"))
    files.write_csv(rows.withColumn("file", name), path, ["file"])
    back = files.read_csv(spark, f"{path}/file=transactions_*", rows.columns)
    source = F.regexp_extract(F.col("_metadata.file_path"), r"file=([^/]+)/", 1)
    return back.groupBy(source.alias("file")).agg(
        F.count("*").alias("n_rows"), fn.dbl(F.sum(F.col("amount").try_cast(fn.MONEY))).alias("readable_total")
    )


@report(
    "parse_app_log",
    with_(t.RAW, body=f"""SELECT txn_id, CAST("timestamp" AS TIMESTAMP) AS ts, {dbl(f'CAST({NUM} AS DECIMAL(18,2))')} AS amount,
    coalesce(status, 'UNKNOWN') AS status
    FROM raw WHERE "timestamp" <> 'not-a-date' AND {NUM} IS NOT NULL AND coalesce(status, 'UNKNOWN') NOT LIKE ' %'"""),
)
def parse_app_log(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines written as plain text and parsed back; malformed lines are left out."""
    path = fresh_path(spark, "app_log")
    line = F.format_string(
        "[%s] %s PROCESSED amount=%s status=%s", F.col("timestamp"), F.col("txn_id"), F.col("amount"),
        F.coalesce("status", F.lit("UNKNOWN")),
    )
    t.raw(spark, folder).select(line.alias("value")).write.text(path)
    parsed = files.read_log(spark, path).where("ts IS NOT NULL AND amount IS NOT NULL")
    return parsed.select("txn_id", F.col("ts").cast("timestamp_ntz").alias("ts"), fn.dbl(F.col("amount")).alias("amount"), "status")


CSV_SCHEMA = "txn_id bigint, user_id bigint, amount decimal(18,2), status string, category string, ts timestamp_ntz"
CSV_LINES = """lined AS (SELECT *, CAST(txn_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || ',' ||
    CASE WHEN txn_id % 37 = 5 THEN 'n/a' WHEN txn_id % 31 = 3 THEN '' ELSE CAST(amount AS VARCHAR) END AS head,
    status || ',' || CASE WHEN txn_id % 29 = 2 THEN '"' || category || ', other"' ELSE category END || ',' ||
    CASE WHEN txn_id % 53 = 13 THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS tail,
    txn_id % 41 = 7 AS is_short, txn_id % 43 = 9 AS is_long FROM txn),
csv_lines AS (SELECT *, CASE WHEN is_short THEN head WHEN is_long THEN head || ',' || tail || ',more' ELSE head || ',' || tail END AS line,
    is_short OR is_long OR txn_id % 37 = 5 OR txn_id % 53 = 13 AS broken FROM lined)"""


def txn_csv(spark: SparkSession, folder: str) -> str:
    """The transactions as CSV lines, some of them with unreadable, missing or surplus fields."""
    key, path = F.col("txn_id"), fresh_path(spark, "txn_csv")
    amount = F.when(key % 37 == 5, "n/a").when(key % 31 == 3, "").otherwise(F.col("amount").cast("string"))
    category = F.when(key % 29 == 2, F.concat(F.lit('"'), "category", F.lit(', other"'))).otherwise(F.col("category"))
    ts = F.when(key % 53 == 13, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    head = [key.cast("string"), F.col("user_id").cast("string"), amount]
    tail = [F.col("status"), category, ts]
    line = (
        F.when(key % 41 == 7, F.concat_ws(",", *head))
        .when(key % 43 == 9, F.concat_ws(",", *head, *tail, F.lit("more")))
        .otherwise(F.concat_ws(",", *head, *tail))
    )
    t.txn(spark, folder).select(line.alias("value")).write.text(path)
    return path


def checked_txn_csv(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return files.read_checked_csv(spark, txn_csv(spark, folder), CSV_SCHEMA, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")


@report(
    "csv_typed_rows",
    with_(t.TXN, CSV_LINES, body=f"""SELECT txn_id, user_id, CASE WHEN txn_id % 31 <> 3 THEN {dbl('amount')} END AS amount, status,
    category || CASE WHEN txn_id % 29 = 2 THEN ', other' ELSE '' END AS category, ts FROM csv_lines WHERE NOT broken"""),
)
def csv_typed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions read back from CSV with declared types."""
    return shown(checked_txn_csv(spark, folder)[0])


@report("csv_rejects", with_(t.TXN, CSV_LINES, body="SELECT line FROM csv_lines WHERE broken"))
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the same files that could not be read, as they are."""
    return checked_txn_csv(spark, folder)[1]


@report("file_inventory")
def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return files.inventory(spark, folder)


@report("object_etags")
def object_etags(spark: SparkSession, folder: str) -> DataFrame:
    return files.etags(spark, folder)


@report(
    "roundtrip_fingerprint",
    f"""SELECT COUNT(*) AS rows_before, COUNT(*) AS rows_after, true AS identical,
    {dbl('SUM(CAST(l_extendedprice AS DECIMAL(18,2)))')} AS price_after,
    CAST(SUM(l_orderkey * l_linenumber) AS BIGINT) AS keys_after, COUNT(DISTINCT l_shipdate) AS days_after FROM lineitem""",
)
def roundtrip_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Rows before a write and after reading back, compared by count and content; totals of the rows read back."""
    rows = lines(spark, folder)
    back = stage(rows, "roundtrip")
    before, after = files.fingerprint(rows), files.fingerprint(back)
    days = back.groupBy("l_shipdate").agg(
        F.sum(F.col("l_extendedprice").cast(fn.MONEY)).alias("price"), F.sum(F.col("l_orderkey") * F.col("l_linenumber")).alias("keys")
    )
    totals = days.agg(fn.dbl(F.sum("price")).alias("price"), F.sum("keys").alias("keys"), F.count("*").alias("days"))
    total = totals.select(F.struct("price", "keys", "days")).scalar()
    pair = before.select(F.lit("before").alias("side"), "*").unionByName(after.select(F.lit("after").alias("side"), "*"))
    found = pair.agg(
        F.max(F.when(F.col("side") == "before", F.col("n_rows"))).alias("rows_before"),
        F.max(F.when(F.col("side") == "after", F.col("n_rows"))).alias("rows_after"),
        ((F.min("row_xor") == F.max("row_xor")) & (F.min("row_sum") == F.max("row_sum"))
         & (F.min("n_rows") == F.max("n_rows"))).alias("identical"),
    ).withColumn("total", total)
    return found.select(
        "rows_before", "rows_after", "identical",
        F.col("total.price").alias("price_after"), F.col("total.keys").alias("keys_after"), F.col("total.days").alias("days_after"),
    )


def hash_sql(salt: str) -> str:
    return f"CAST('0x' || substr(md5('{salt}:' || CAST(k AS VARCHAR)), 1, 15) AS BIGINT)"


@report(
    "synth_txns",
    f"""SELECT format('TXN{{:08d}}', k + 1) AS txn_id, format('U{{:04d}}', {hash_sql('user')} % 1000 + 1) AS user_id,
    ({t._sql_list(t.MERCHANTS)})[{hash_sql('merchant')} % 15 + 1] AS merchant,
    ({t._sql_list(t.CATEGORIES)})[{hash_sql('category')} % 8 + 1] AS category,
    CAST(1000 + {hash_sql('amount')} % 4999001 AS DOUBLE) / 100 AS amount,
    CASE WHEN {hash_sql('status')} % 100 < 75 THEN 'SUCCESS' WHEN {hash_sql('status')} % 100 < 85 THEN 'FAILED'
         WHEN {hash_sql('status')} % 100 < 95 THEN 'PENDING' ELSE 'REFUNDED' END AS status,
    ({t._sql_list(t.WALLETS)})[{hash_sql('wallet')} % 5 + 1] AS wallet_type,
    TIMESTAMP '2023-01-01' + to_seconds({hash_sql('time')} % 31536001) AS ts
    FROM (SELECT o_orderkey AS k FROM orders)""",
)
def synth_txns(spark: SparkSession, folder: str) -> DataFrame:
    """One synthetic transaction per order key, the same on every run."""
    keys = t.read(spark, folder, "orders").select("o_orderkey")
    return shown(synthetic.transactions(keys, "o_orderkey"))


BYTES = " + ".join(f"CAST('0x' || substr(d, {2 * i + 1}, 2) AS BIGINT)" for i in range(12))


@report(
    "replicate_11x",
    with_(t.TXN, """copies AS (SELECT txn_id, CAST(amount * 100 AS BIGINT) AS cents, copy,
          ROW_NUMBER() OVER (PARTITION BY copy ORDER BY txn_id) - 1 AS pos, COUNT(*) OVER (PARTITION BY copy) AS n,
          md5(CAST(copy AS VARCHAR) || ':' || CAST(txn_id AS VARCHAR)) AS d
          FROM txn, (SELECT unnest(range(11)) AS copy))""",
          body=f"""SELECT copy * n + pos + 1 AS new_id, txn_id AS source_id,
          (GREATEST(cents * 256 + ({BYTES} - 1530) * 5000, 25600) + 128) >> 8 AS cents FROM copies"""),
)
def replicate_11x(spark: SparkSession, folder: str) -> DataFrame:
    return synthetic.replicate(t.txn(spark, folder, placed=True).select("txn_id", "amount", "pos"), scan=t.read(spark, folder, "orders"))
