"""Star schema: dimensions with surrogate keys, calendar, facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..session import stage
from ..sources import tables as t
from .ordering import positions
from .rules import strict_amount


def surrogate(df: DataFrame, key: str, out: str) -> DataFrame:
    """Dense keys 1..n in the order of the natural key, without a single-task sequence."""
    return positions(df, [F.col(key)], name=out).withColumn(out, F.col("pos") + 1).drop("pos")


def dim_user(users: DataFrame) -> DataFrame:
    """First row per user wins; city tier comes with the place."""
    first = users.groupBy("user_id").agg(
        F.min_by(F.struct("city", "kyc_status", "city_tier"), "source_key").alias("first")
    )
    return surrogate(first.select("user_id", "first.*"), "user_id", "user_sk")


def named_dim(raw: DataFrame, column: str, mapping: dict[str, str], attribute: str, sk: str) -> DataFrame:
    """A small dimension: the names in use that the mapping knows, with their attribute.

    It has at most as many rows as the fixed mapping, so one window can number them.
    """
    names = raw.select(column).distinct().withColumn(attribute, t.mapped(F.col(column), mapping))
    number = F.row_number().over(Window.orderBy(column)).cast("bigint")
    return names.where(F.col(attribute).isNotNull()).withColumn(sk, number)


def dim_merchant(raw: DataFrame) -> DataFrame:
    return named_dim(raw, "merchant", t.MERCHANT_TYPE, "type", "merchant_sk")


def dim_category(raw: DataFrame) -> DataFrame:
    return named_dim(raw, "category", t.CATEGORY_PARENT, "parent", "cat_sk")


def dim_wallet(raw: DataFrame) -> DataFrame:
    known = {w: w for w in t.WALLETS}
    return named_dim(raw, "wallet_type", known, "known", "wallet_sk").drop("known")


def dim_date(facts: DataFrame, day: str) -> DataFrame:
    """A calendar over the years of the facts, so that no fact falls outside of it."""
    span = facts.agg(
        F.trunc(F.min(day), "year").alias("low"), F.trunc(F.max(day), "year").alias("high")
    )
    last = F.date_sub(F.add_months("high", 12), 1)
    d = F.col("date")
    return span.select(F.explode(F.sequence("low", last)).alias("date")).select(
        fn.date_key(d).alias("date_sk"),
        "date",
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        fn.is_weekend(d).alias("is_weekend"),
    )


NAME_DIMS = {
    "merchant": (dim_merchant, "merchant_sk"),
    "category": (dim_category, "cat_sk"),
    "wallet_type": (dim_wallet, "wallet_sk"),
}
NAME_MAPS = {
    "merchant": t.MERCHANT_TYPE, "category": t.CATEGORY_PARENT, "wallet_type": dict.fromkeys(t.WALLETS, "")
}


def names_in_use(raw: DataFrame) -> DataFrame:
    """The combinations of known names, from one pass over the rows.

    Names outside the mappings become NULL, so the result is bounded by the mappings.
    """
    known = [F.when(F.col(c).isin(list(m)), F.col(c)).alias(c) for c, m in NAME_MAPS.items()]
    return stage(raw.select(*known).distinct(), "names")


def facts(raw: DataFrame, users: DataFrame, names: Sequence[str] = tuple(NAME_DIMS)) -> DataFrame:
    """Facts with foreign keys; an unknown natural key gives NULL. ``raw`` may bring ``txn_sk``.

    ``names`` are the name dimensions to look up.

    The name dimensions are bounded by their fixed mappings and are broadcast. Users
    grow with the business, so their join is left to Spark: broadcast when small,
    otherwise a shuffle join with adaptive skew splitting.
    """
    out = raw.join(users.select("user_id", "user_sk"), "user_id", "left")
    in_use = names_in_use(raw) if NAME_DIMS.keys() & set(names) else raw
    for key in names:
        make, sk = NAME_DIMS[key]
        out = out.join(F.broadcast(make(in_use).select(key, sk)), key, "left")
    status = F.col("status")
    return out.select(
        *[c for c in ("txn_sk",) if c in raw.columns],
        "txn_id",
        "user_sk",
        *[NAME_DIMS[key][1] for key in names],
        F.regexp_replace("date", "-", "").try_cast("int").alias("date_sk"),
        strict_amount(F.col("amount")).cast(fn.MONEY).alias("amount"),
        "status",
        fn.is_success(status).alias("is_success"),
        F.hour(F.try_to_timestamp("timestamp", F.lit(fn.STAMP_FORMAT))).alias("hour"),
    )
