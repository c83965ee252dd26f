"""Synthetic transactions for scale tests, derived row by row from a table of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators.ordering import positions
from ..session import widen
from . import tables as t

# Amounts from 10.00 to 50,000.00, status weights, one year of seconds.
LOW_CENTS, HIGH_CENTS = 1_000, 5_000_000
STATUS_WEIGHTS = {"SUCCESS": 75, "FAILED": 10, "PENDING": 10, "REFUNDED": 5}
YEAR_SECONDS = 365 * 24 * 3600
YEAR_START = "2023-01-01 00:00:00"
N_USERS = 1_000
COPIES = 11


def draw(key: Column, salt: str) -> Column:
    """A repeatable pseudo-random whole number per key and attribute."""
    return fn.stable_hash(F.concat(F.lit(f"{salt}:"), key.cast("string")))


def weighted(draw_100: Column, weights: dict[str, int]) -> Column:
    expr, edge = None, 0
    for name, weight in weights.items():
        edge += weight
        expr = F.when(draw_100 < edge, name) if expr is None else expr.when(draw_100 < edge, name)
    return expr


def transactions(keys: DataFrame, key: str) -> DataFrame:
    """One transaction per key; any table (or a range) of unique numbers will do."""
    k = F.col(key)
    cents = F.lit(LOW_CENTS) + draw(k, "amount") % (HIGH_CENTS - LOW_CENTS + 1)
    second = draw(k, "time") % (YEAR_SECONDS + 1)
    ts = F.timestamp_add("SECOND", second.cast("int"), F.lit(YEAR_START).cast("timestamp_ntz"))
    return keys.select(
        fn.txn_code(k + 1).alias("txn_id"),
        fn.user_code(draw(k, "user") % N_USERS + 1).alias("user_id"),
        t.picked(draw(k, "merchant") % len(t.MERCHANTS), t.MERCHANTS).alias("merchant"),
        t.picked(draw(k, "category") % len(t.CATEGORIES), t.CATEGORIES).alias("category"),
        (cents.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(fn.MONEY).alias("amount"),
        weighted(draw(k, "status") % 100, STATUS_WEIGHTS).alias("status"),
        t.picked(draw(k, "wallet") % len(t.WALLETS), t.WALLETS).alias("wallet_type"),
        ts.alias("ts"),
    )


def byte_sum(digest: Column) -> Column:
    """The sum of the first 12 bytes of a hex digest: close to normal, mean 127.5 each."""
    total = F.lit(0)
    for start in (1, 13):  # six bytes at a time
        word = F.conv(F.substring(digest, start, 12), 16, 10).cast("bigint")
        for shift in range(0, 48, 8):
            total = total + F.shiftright(word, shift).bitwiseAND(F.lit(255))
    return total


def replicate(rows: DataFrame, copies: int = COPIES, scan: DataFrame | None = None) -> DataFrame:
    """Every row ``copies`` times, numbered anew, with clipped noise of deviation 50 on amounts.

    The copies are made in place by an explode; a small ``scan`` below the rows is spread first. The new number is copy * n + position, so the
    ids run from 1 without gaps. The noise is 50 * (sum of 12 bytes - 1530) / 256 and is kept
    in whole numbers: 1/256 cents.
    """
    placed = rows if "pos" in rows.columns else positions(rows, [F.col("txn_id")], name="replicate")
    n = rows.agg(F.count("*")).scalar()
    wide = placed if scan is None else widen(placed, scan)
    spread = wide.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    noise = byte_sum(F.md5(F.concat_ws(":", F.col("copy").cast("string"), F.col("txn_id").cast("string")))) - 1530
    fine = (F.col("amount") * 100).cast("bigint") * 256 + noise * 5000
    cents = F.shiftright(F.greatest(fine, F.lit(100 * 256)) + 128, 8)
    return spread.select(
        (F.col("copy") * n + F.col("pos") + 1).alias("new_id"),
        F.col("txn_id").alias("source_id"),
        cents.alias("cents"),
    )
