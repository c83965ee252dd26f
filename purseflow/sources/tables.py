"""The payment entities, read from the warehouse tables in a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..session import widen
from .files import in_source_order

# The codes and names of the payments domain.
STATUS_OF_CODE = {"F": "SUCCESS", "P": "FAILED", "O": "PENDING"}
STATUSES = ["SUCCESS", "FAILED", "PENDING", "REFUNDED"]
CATEGORIES = [
    "Shopping", "Food", "Transport", "Entertainment",
    "Utilities", "Travel", "Grocery", "Transfer",
]
CATEGORY_PARENT = {
    "Shopping": "Retail", "Food": "F&B", "Transport": "Mobility", "Entertainment": "Leisure",
    "Utilities": "Bills", "Travel": "Leisure", "Grocery": "F&B", "Transfer": "Financial",
}
MERCHANT_TYPE = {
    "Amazon": "E-Commerce", "Flipkart": "E-Commerce", "Zomato": "Food", "Swiggy": "Food",
    "Uber": "Transport", "Ola": "Transport", "Netflix": "Entertainment",
    "Spotify": "Entertainment", "BigBasket": "Grocery", "PhonePe": "Fintech",
    "Paytm": "Fintech", "GooglePay": "Fintech", "IRCTC": "Travel", "MakeMyTrip": "Travel",
    "BookMyShow": "Entertainment",
}
WALLETS = ["PayWallet", "QuickPay", "FastCash", "SafePay", "EasyWallet"]
MERCHANTS = list(MERCHANT_TYPE)
DEFAULT_TIER = "T3"
UNKNOWN = "Unknown"
# End of fixed values.

# This warehouse's own codes: nation and region stand in for city and tier.
REGION_TIER = {"ASIA": "T1", "EUROPE": "T1", "AMERICA": "T2"}
PRIORITY_CATEGORY = {
    "1-URGENT": "Transfer", "2-HIGH": "Shopping", "3-MEDIUM": "Food",
    "4-NOT SPECIFIED": "Travel", "5-LOW": "Utilities",
}


# Declared layouts, so that no job has to look into a file before the query starts.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read(spark: SparkSession, folder: str, table: str, placed: bool = False) -> DataFrame:
    """A warehouse table; ``placed`` adds each row's position in the source as ``pos``."""
    reader = spark.read.schema(SCHEMAS[table]) if table in SCHEMAS else spark.read
    rows = reader.parquet(f"{folder}/{table}.parquet")
    return in_source_order(rows) if placed else rows


def mapped(key: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """A small fixed mapping as CASE branches, so that it stays in generated code."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    return expr.otherwise(default) if default is not None else expr


def picked(index: Column, names: list[str]) -> Column:
    """The name at a 0-based position of a fixed list."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), index.cast("int") + 1)


def pos_of(rows: DataFrame) -> list[Column]:
    return [F.col("pos")] if "pos" in rows.columns else []


def txn(
    spark: SparkSession,
    folder: str,
    status: str | None = None,
    above: float | None = None,
    but: str | None = None,
    placed: bool = False,
) -> DataFrame:
    """Transactions with one status (or any ``but`` one) and an amount ``above`` a limit.

    The filters are stated on stored columns, so that they reach the scan.
    """
    orders = read(spark, folder, "orders", placed)
    code_of = {s: c for c, s in STATUS_OF_CODE.items()}
    if status is not None:
        orders = orders.where(F.col("o_orderstatus") == code_of[status])
    if but is not None:
        orders = orders.where(F.col("o_orderstatus") != code_of[but])
    if above is not None:
        orders = orders.where(F.col("o_totalprice") > float(above))
    out = as_txn(orders, status)
    return out if above is None else out.where(F.col("amount") > F.lit(above).cast(fn.MONEY))


def as_txn(orders: DataFrame, status: str | None = None) -> DataFrame:
    """Rows of the orders table, stored or streamed, as transactions."""
    return orders.select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(fn.MONEY).alias("amount"),
        (F.lit(status) if status else mapped(F.col("o_orderstatus"), STATUS_OF_CODE)).alias("status"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderdate").alias("ts"),
        *pos_of(orders),
    )


TXN = """txn AS (
  SELECT o_orderkey AS txn_id, o_custkey AS user_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'FAILED'
                            WHEN 'O' THEN 'PENDING' END AS status,
         o_orderpriority AS category, o_orderdate AS ts
  FROM orders)"""


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Wallet holders; the place tables have a fixed handful of rows and are broadcast."""
    nation = read(spark, folder, "nation")
    region = read(spark, folder, "region")
    places = nation.join(
        F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left"
    ).select(
        "n_nationkey",
        F.col("n_name").alias("city"),
        mapped(F.col("r_name"), REGION_TIER, DEFAULT_TIER).alias("city_tier"),
    )
    customer = read(spark, folder, "customer")
    return customer.join(
        F.broadcast(places), customer.c_nationkey == places.n_nationkey, "left"
    ).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        "city",
        F.col("c_mktsegment").alias("kyc_status"),
        F.coalesce("city_tier", F.lit(DEFAULT_TIER)).alias("city_tier"),
    )


USERS = """users AS (
  SELECT c_custkey AS user_id, c_name AS name, n_name AS city, c_mktsegment AS kyc_status,
         CASE WHEN r_name IN ('ASIA','EUROPE') THEN 'T1' WHEN r_name = 'AMERICA' THEN 'T2'
              ELSE 'T3' END AS city_tier
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey)"""


def sales(spark: SparkSession, folder: str, status: str | None = None) -> DataFrame:
    """Order lines with the ids of their merchant and product; names join after grouping."""
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        F.col("l_extendedprice").cast(fn.MONEY).alias("amount"),
        F.col("l_returnflag").alias("wallet_type"),
        F.col("l_shipdate").alias("ship_ts"),
    )
    heads = txn(spark, folder, status).select("txn_id", "user_id", "status", "ts")
    return lines.join(heads, lines.l_orderkey == heads.txn_id).drop("l_orderkey")


SALES = """sales AS (
  SELECT l_orderkey AS txn_id, l_linenumber, l_suppkey, l_partkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_returnflag AS wallet_type,
         l_shipdate AS ship_ts, txn.user_id, txn.status, txn.ts, s_name AS merchant,
         p_type AS category
  FROM lineitem JOIN txn ON l_orderkey = txn.txn_id
       LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey)"""


def ev(spark: SparkSession, folder: str) -> DataFrame:
    """Wallet events with a real time of day."""
    return read(spark, folder, "events").select(
        "event_id", "ts", "user_id", F.col("event_type").alias("category"),
        F.col("value").alias("amount"),
    )


EV = """ev AS (
  SELECT event_id, ts, user_id, event_type AS category, value AS amount FROM events)"""


def raw(spark: SparkSession, folder: str, placed: bool = False) -> DataFrame:
    """Bronze rows: every transaction as text, with realistic defects.

    The defects are a function of the key, so that other engines derive the same rows:
    repeated and malformed ids, blank users, messy, missing and out-of-range amounts,
    unknown, untidy and missing labels, unreadable times. ``ordinal`` is the source order.
    """
    key = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast(fn.MONEY)
    status = mapped(F.col("o_orderstatus"), STATUS_OF_CODE)
    clock = F.date_format(
        F.timestamp_add("SECOND", (key % 86400).cast("int"), F.col("o_orderdate")), "yyyy-MM-dd HH:mm:ss"
    )
    orders = widen(read(spark, folder, "orders", placed), read(spark, folder, "orders"))
    return orders.select(
        *pos_of(orders),
        key.alias("ordinal"),
        F.when(key % 97 == 0, F.concat(F.lit("BAD"), key.cast("string")))
        .otherwise(fn.txn_code(key - (key % 89 == 1).cast("int")))
        .alias("txn_id"),
        F.when(key % 101 == 0, F.lit(" ")).otherwise(fn.user_code(F.col("o_custkey"))).alias("user_id"),
        picked(key % len(MERCHANTS), MERCHANTS).alias("merchant"),
        F.when(key % 83 == 5, F.lit("Gambling"))
        .when(key % 109 == 13, F.lit(None).cast("string"))
        .otherwise(mapped(F.col("o_orderpriority"), PRIORITY_CATEGORY))
        .alias("category"),
        F.when(key % 71 == 3, F.lit("-50"))
        .when(key % 73 == 4, F.lit("Rs. 1,299.50"))
        .when(key % 79 == 6, F.concat(F.lit("INR "), amount.cast("string")))
        .when(key % 67 == 2, F.lit("0"))
        .when(key % 61 == 7, F.lit(""))
        .when(key % 59 == 8, F.lit("1.2.3"))
        .otherwise(amount.cast("string"))
        .alias("amount"),
        F.when(key % 113 == 12, F.lit(None).cast("string"))
        .when(key % 53 == 9, F.concat(F.lit(" "), F.lower(status), F.lit(" ")))
        .when(key % 47 == 10, F.lit("DONE"))
        .when((key % 5 == 1) & (status == "PENDING"), F.lit("REFUNDED"))
        .otherwise(status)
        .alias("status"),
        picked(F.col("o_custkey") % len(WALLETS), WALLETS).alias("wallet_type"),
        F.when(key % 43 == 11, F.lit("not-a-date")).otherwise(clock).alias("timestamp"),
        F.to_date("o_orderdate").cast("string").alias("date"),
    )


def _sql_list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


RAW = f"""raw AS (
  SELECT o_orderkey AS ordinal,
    CASE WHEN o_orderkey % 97 = 0 THEN 'BAD' || CAST(o_orderkey AS VARCHAR)
         ELSE format('TXN{{:08d}}', o_orderkey - CAST(o_orderkey % 89 = 1 AS INTEGER)) END AS txn_id,
    CASE WHEN o_orderkey % 101 = 0 THEN ' ' ELSE format('U{{:04d}}', o_custkey) END AS user_id,
    ({_sql_list(MERCHANTS)})[o_orderkey % {len(MERCHANTS)} + 1] AS merchant,
    CASE WHEN o_orderkey % 83 = 5 THEN 'Gambling' WHEN o_orderkey % 109 = 13 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'Transfer'
         WHEN o_orderpriority = '2-HIGH' THEN 'Shopping' WHEN o_orderpriority = '3-MEDIUM' THEN 'Food'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Travel'
         WHEN o_orderpriority = '5-LOW' THEN 'Utilities' END AS category,
    CASE WHEN o_orderkey % 71 = 3 THEN '-50' WHEN o_orderkey % 73 = 4 THEN 'Rs. 1,299.50'
         WHEN o_orderkey % 79 = 6 THEN 'INR ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
         WHEN o_orderkey % 67 = 2 THEN '0' WHEN o_orderkey % 61 = 7 THEN ''
         WHEN o_orderkey % 59 = 8 THEN '1.2.3'
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
    CASE WHEN o_orderkey % 113 = 12 THEN NULL WHEN o_orderkey % 53 = 9 THEN ' ' || lower(st) || ' ' WHEN o_orderkey % 47 = 10 THEN 'DONE'
         WHEN o_orderkey % 5 = 1 AND st = 'PENDING' THEN 'REFUNDED' ELSE st END AS status,
    ({_sql_list(WALLETS)})[o_custkey % {len(WALLETS)} + 1] AS wallet_type,
    CASE WHEN o_orderkey % 43 = 11 THEN 'not-a-date'
         ELSE strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') END AS "timestamp",
    strftime(o_orderdate, '%Y-%m-%d') AS "date"
  FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'FAILED'
                                     WHEN 'O' THEN 'PENDING' END AS st FROM orders))"""

RAW_USERS = """raw_users AS (
  SELECT format('U{:04d}', user_id) AS user_id, city, kyc_status, city_tier FROM users)"""


def raw_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users keyed by their text code, as the raw rows refer to them."""
    return users(spark, folder).select(
        fn.user_code(F.col("user_id")).alias("user_id"),
        "city",
        "kyc_status",
        "city_tier",
        F.col("user_id").alias("source_key"),
    )


def repeated_users(spark: SparkSession, folder: str) -> DataFrame:
    """Raw users as a source with repeats delivers them: every seventh user comes a second time, changed.

    ``source_key`` is the order of delivery: first all users, then the repeats.
    """
    known = raw_users(spark, folder)
    again = known.where("source_key % 7 = 2").withColumns({
        "city": F.concat("city", F.lit(" (moved)")),
        "kyc_status": F.lit("RENEWED"),
        "city_tier": F.lit(DEFAULT_TIER),
        "source_key": F.col("source_key") + REPEAT_KEYS,
    })
    return known.unionByName(again)


REPEAT_KEYS = 10**12
REPEATED_USERS = f"""repeated_users AS (SELECT format('U{{:04d}}', user_id) AS user_id, city, kyc_status, city_tier, user_id AS source_key FROM users
  UNION ALL SELECT format('U{{:04d}}', user_id), city || ' (moved)', 'RENEWED', '{DEFAULT_TIER}', user_id + {REPEAT_KEYS}
  FROM users WHERE user_id % 7 = 2)"""
