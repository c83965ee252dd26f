"""Joins that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import stage

HOT_KEYS = 2_000  # a key is hot above 1/2000 of all rows, so at most 2000 keys are hot
HOT_FLOOR = 5_000_000  # below this many rows a key is no burden for one task
BROADCAST_ROWS = 100_000
BROADCAST_FILES = 1_000_000  # one path and one number per file


def join_group_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    n_col: str,
    how: str = "inner",
    hot_floor: int = HOT_FLOOR,
    small: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join per-key statistics back to their rows.

    ``stats`` has one row per key with ``n_col``, the key's number of rows. Up to
    ``small`` keys are broadcast, so no row is shuffled. Beyond that, the hottest keys are
    split off: their statistics, at most ``HOT_KEYS`` rows, are broadcast, so their rows are
    not shuffled at all. The rows of the other keys meet theirs in an ordinary join, where
    adaptive skew splitting applies, since the statistics are read from a written table.
    """
    keys = list(keys)
    seen = Observation()  # number of keys, largest key and total, noted while writing
    noted = F.count(F.lit(1)).alias("n_keys"), F.max(n_col).alias("top"), F.sum(n_col).alias("total")
    known = stage(stats.observe(seen, *noted), "group_stats")
    if seen.get["n_keys"] <= small:
        return join_on_groups(rows, F.broadcast(known.drop(n_col)), keys, how)
    top, total = seen.get["top"] or 0, seen.get["total"] or 0
    limit = max(hot_floor, total // HOT_KEYS)
    if top <= limit:
        return join_on_groups(rows, known.drop(n_col), keys, how)
    hot = known.where(F.col(n_col) > limit)
    warm = join_on_groups(rows, F.broadcast(hot.drop(n_col)), keys, "inner")
    others = join_on_groups(rows, F.broadcast(hot.select(*keys)), keys, "left_anti")
    return warm.unionByName(join_on_groups(others, known.drop(n_col), keys, how))


def join_on_groups(rows: DataFrame, stats: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL matches NULL, since grouping makes NULL a group as well."""
    other = stats.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(other, same, how).drop(*[f"_{k}" for k in keys])


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after checking that it has at most ``max_rows`` rows.

    Beyond that the caller's join runs as a shuffle join with adaptive skew splitting.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def unique_last(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key, the last one by ``order`` winning; partial per map task."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(
        F.max_by(F.struct(*rest), order).alias("last")
    ).select(key, "last.*")


def lookup(
    rows: DataFrame, dim: DataFrame, key: str, defaults: dict[str, str]
) -> DataFrame:
    """Left join that fills the attributes of unknown keys with a default."""
    joined = rows.join(dim, key, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
    )
