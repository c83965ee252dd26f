"""Scalar column functions of the payments domain."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
COUNT = T.DecimalType(15, 0)

# Tax shares, log bounds and the text patterns of the data contract.
GST_RATE = Decimal("0.18")
NET_RATE = Decimal("0.82")
GST_INCLUSIVE = Decimal("1.18")
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NOT_WORD = r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}]"
AMOUNT_NOISE = r"[^0-9.]"
STAMP_FORMAT = "yyyy-M-d H:m:s"
LOG_LINE = r"^\[([^\]]+)\] (\S+) PROCESSED amount=(\S+) status=(\S+)$"


def dbl(col: Column) -> Column:
    return col.cast("double")


def ratio(num: Column, den: Column, places: int = 2) -> Column:
    """``num / den`` rounded half up in decimal arithmetic; NULL when ``den`` is 0."""
    return dbl(F.round(F.try_divide(num, den.cast(COUNT)), places))


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two decimals."""
    return ratio(part.cast(COUNT) * F.lit(Decimal(100)), whole)


def millions(total: Column) -> Column:
    """A money sum in millions, two decimals."""
    return dbl(F.round(total * F.lit(Decimal("0.000001")), 2))


def gst(amount: Column) -> Column:
    return F.round(amount * F.lit(GST_RATE), 2).cast(MONEY)


def net(amount: Column) -> Column:
    return F.round(amount * F.lit(NET_RATE), 2).cast(MONEY)


def is_success(status: Column) -> Column:
    return (status == "SUCCESS").cast("int")


def month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def quarter_label(ts: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(ts).cast("string"))


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def blank(col: Column) -> Column:
    """Missing means NULL or only white space."""
    return col.isNull() | (F.trim(col) == "")


def log_clamped(value: Column) -> Column:
    return F.log1p(F.greatest(value, F.lit(0.0)))


def slug(text: Column) -> Column:
    """Trim, lower-case, drop punctuation, join words with an underscore."""
    trimmed = F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")
    return F.regexp_replace(F.regexp_replace(F.lower(trimmed), NOT_WORD, ""), f"{SPACE}+", "_")


def amount_digits(raw: Column) -> Column:
    return F.regexp_replace(raw, AMOUNT_NOISE, "")


def lenient_amount(raw: Column) -> Column:
    """The number left when everything but digits and dots is dropped; NULL if none."""
    return amount_digits(raw).try_cast(MONEY)


def parse_amount(raw: Column, currency: str = "INR") -> Column:
    value = lenient_amount(raw)
    return F.struct(
        F.coalesce(value, F.lit(Decimal("0.00")).cast(MONEY)).alias("value"),
        F.lit(currency).alias("currency"),
        value.isNotNull().alias("valid"),
    )


def parse_log_line(line: Column) -> Column:
    return F.struct(
        F.try_to_timestamp(F.regexp_extract(line, LOG_LINE, 1), F.lit(STAMP_FORMAT)).alias("ts"),
        F.regexp_extract(line, LOG_LINE, 2).alias("txn_id"),
        F.regexp_extract(line, LOG_LINE, 3).try_cast(MONEY).alias("amount"),
        F.regexp_extract(line, LOG_LINE, 4).alias("status"),
    )


def row_checksum(txn_id: Column, amount: Column) -> Column:
    return F.substring(F.md5(F.concat(txn_id, amount)), 1, 8)


def stable_hash(key: Column) -> Column:
    """A non-negative hash that other engines reproduce: 60 bits of the key's MD5."""
    return text_hash(key.cast("string"))


def text_hash(text: Column) -> Column:
    """60 bits of the text's MD5, which other engines can compute as well."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def bucket(key: Column, buckets: int) -> Column:
    """The same key always lands in the same bucket."""
    return (stable_hash(key) % buckets).cast("int")


def zero_padded(number: Column, width: int) -> Column:
    """At least ``width`` digits; longer numbers keep all of theirs."""
    digits = number.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def txn_code(number: Column) -> Column:
    return F.concat(F.lit("TXN"), zero_padded(number, 8))


def user_code(number: Column) -> Column:
    return F.concat(F.lit("U"), zero_padded(number, 4))
