"""Idempotent loading: batches, first-write-wins, last-write-wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fn
from .ordering import head_per_group, positions
from .rules import gate_condition, strict_amount

# Fixed value: rows per ingestion batch.
BATCH_ROWS = 5_000


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key; each map task passes on one row per key."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*order, *rest)).alias("kept"))
        .select(*[F.col(c) if c in keys else F.col(f"kept.{c}") for c in df.columns])
    )


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows to insert: the first per key among those whose key is not stored yet."""
    return first_per_key(incoming, keys, order).join(existing.select(*keys), list(keys), "left_anti")


def upsert_latest(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], version: Column
) -> DataFrame:
    """The stored table after replacing the keys that came again; the latest version wins."""
    both = existing.unionByName(incoming)
    return head_per_group(both, keys, [version.desc()], 1).drop("nth")


def numbered_batches(raw: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """Add ``batch_id``: the source order cut into runs of ``rows``, and whether a row is valid.

    Rows read in source order bring their ``pos``; others are put in order by ``ordinal``.
    """
    return source_batches(raw, rows).withColumn("ok", gate_condition())


def source_batches(raw: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """Add ``batch_id`` alone."""
    placed = raw if "pos" in raw.columns else positions(raw, [F.col("ordinal")], name="batches")
    return placed.select(
        *[c for c in raw.columns if c != "pos"], (F.floor(F.col("pos") / rows) + 1).alias("batch_id")
    )


def batch_log(batches: DataFrame) -> DataFrame:
    """One audit row per batch. ``ok`` counts rows before the primary key drops repeats."""
    return batches.groupBy("batch_id").agg(
        F.count("*").alias("size"),
        F.count_if("ok").alias("ok"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def ingested(batches: DataFrame) -> DataFrame:
    """The loaded table: valid rows, first write per id, with batch number and checksum.

    Every map task passes on one row per id, so repeats cost nothing beyond it.
    """
    rows = batches.where("ok").select(
        "ordinal",
        "txn_id",
        "user_id",
        "merchant",
        "category",
        strict_amount(F.col("amount")).cast(fn.MONEY).alias("amount"),
        "status",
        "wallet_type",
        "date",
        "batch_id",
        fn.row_checksum(F.col("txn_id"), F.col("amount")).alias("checksum"),
    )
    return head_per_group(rows, ["txn_id"], [F.col("ordinal")], 1).drop("nth")
