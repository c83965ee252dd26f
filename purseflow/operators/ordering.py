"""Exact order-based operators that never put a whole group into one task.

All of them start from a range partitioning on a unique order. Its ranges are
balanced by sampling whatever the key distribution, so a user, category or bucket
that owns a third of the rows is spread over a third of the tasks. Each range only
reports its size; the offsets are a prefix sum over one row per range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .joins import join_group_stats, join_on_groups

_PART_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def in_order(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Stage ``df`` in total order with ``part`` (range number) and ``local`` (row in range).

    The row number within the sorted partition comes free with
    ``monotonically_increasing_id``, so no window and no second shuffle is needed.
    """
    slot = F.col("slot")
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("slot", F.monotonically_increasing_id())
    )
    return stage(placed, name).select(
        *df.columns,
        F.shiftright(slot, _PART_BITS).cast("int").alias("part"),
        slot.bitwiseAND(F.lit((1 << _PART_BITS) - 1)).alias("local"),
    )


def _part_offsets(sizes: DataFrame) -> DataFrame:
    """``base`` (rows before the range) and ``total``, from one row per range."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "part",
        "size",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"),
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )


def positions(
    df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "positions"
) -> DataFrame:
    """Add ``pos``, the row's 0-based place within its ``by`` group under ``order``.

    ``order`` must make rows unique. The range offsets (one row per range, bounded by
    the shuffle partition setting) are broadcast; the group starts join on the key.
    """
    group = [F.col(c) for c in by]
    spot = in_order(df, [*group, *order], name)
    offsets = _part_offsets(spot.groupBy("part").agg(F.count("*").alias("size")))
    placed = spot.join(F.broadcast(offsets.select("part", "base")), "part").withColumn(
        "pos", F.col("base") + F.col("local")
    )
    if by:
        # the first row of a group inside each range is enough to find its start
        starts = placed.groupBy(*by).agg(F.min("pos").alias("start"), F.count("*").alias("n_rows"))
        placed = join_group_stats(placed, starts, list(by), "n_rows").withColumn(
            "pos", F.col("pos") - F.col("start")
        )
    return placed.select(*df.columns, "pos")


def ranks(df: DataFrame, by: Sequence[str], value: Column, key: str) -> DataFrame:
    """RANK() of every row within its group by ``value`` descending, with one shuffle.

    Rows lie in ranges in order of group, value and key, so the rows of a tie are neighbours
    and only the first and last tie of a range can go on in another one. A pass over the
    sorted rows in Arrow batches notes where each row's tie and group begin in its range; where
    they go on from earlier ranges is found from one row per range, which is broadcast.
    A tie or a group may span any number of ranges.
    """
    group, sort_value = [F.col(c) for c in by], F.col("sort_value")
    valued = df.withColumn("sort_value", value)
    marks = [F.lit(0), *group, *[c.isNull() for c in group]]
    order = [*group, sort_value.desc(), F.col(key)]
    sorted_rows = (
        valued.withColumns({"in_group": F.xxhash64(*marks), "in_tie": F.xxhash64(*marks, sort_value, sort_value.isNull())})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("sort_value")
        .withColumn("slot", F.monotonically_increasing_id())
    )
    schema = T.StructType([*sorted_rows.schema.fields, *[T.StructField(c, T.LongType()) for c in ("tie_at", "group_at")]])
    mask = (1 << _PART_BITS) - 1

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = {"in_tie": None, "in_group": None}
        begun = {"in_tie": 0, "in_group": 0}
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column("slot").to_numpy() & mask
            starts = []
            for name in last:
                hashes = batch.column(name).to_numpy()
                new = np.append(hashes[0] != last[name], hashes[1:] != hashes[:-1])
                at = np.maximum.accumulate(np.where(new, place, begun[name]))
                last[name], begun[name] = hashes[-1], at[-1]
                starts.append(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *starts], names=schema.names)

    slot = F.col("slot")
    spot = stage(sorted_rows.mapInArrow(marked, schema), "ranked").withColumns(
        {"part": F.shiftright(slot, _PART_BITS).cast("int"), "local": slot.bitwiseAND(F.lit(mask))}
    )
    ranges = spot.groupBy("part").agg(
        F.count("*").alias("size"),
        F.min_by(F.struct("in_tie", "in_group"), "local").alias("first"),
        F.max_by(F.struct("in_tie", "in_group", "tie_at", "group_at"), "local").alias("last"),
    )
    in_turn = Window.orderBy("part")  # one row per range
    before = in_turn.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.lag("last").over(in_turn)
    placed = _part_offsets(ranges).join(ranges.drop("size"), "part").withColumns(
        {f"{c}_on": F.coalesce(F.col(f"first.in_{c}") == previous[f"in_{c}"], F.lit(False)) for c in ("tie", "group")}
    )
    # where the last tie and group of a range begin, unless they go on from before it
    opened = {
        c: F.when(~F.col(f"{c}_on") | (F.col(f"last.{c}_at") > 0), F.col("base") + F.col(f"last.{c}_at"))
        for c in ("tie", "group")
    }
    carried = placed.withColumns({f"{c}_from": F.last(opened[c], True).over(before) for c in opened})
    joined = spot.join(
        F.broadcast(carried.select("part", "base", "tie_on", "group_on", "tie_from", "group_from")), "part"
    )
    begin = {
        c: F.when((F.col(f"{c}_at") == 0) & F.col(f"{c}_on"), F.col(f"{c}_from")).otherwise(F.col("base") + F.col(f"{c}_at"))
        for c in ("tie", "group")
    }
    return joined.select(*df.columns, (begin["tie"] - begin["group"] + 1).alias("rnk"))


def order_statistics(df: DataFrame, value: str, picks: dict[str, Column]) -> DataFrame:
    """The sorted column's values at given positions, exactly, as rows (pick, idx, value, total).

    ``picks`` maps a name to a 0-based position written in terms of ``total``, the
    number of non-null values. Equal values are merged before the shuffle, so a hot
    value costs one row. Only the ranges that hold a pick are then read in order.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    spot = in_order(counts, [F.col(value)], "order_statistics")
    offsets = _part_offsets(spot.groupBy("part").agg(F.sum("n").alias("size")))
    wanted = (
        offsets.select(
            "part",
            "base",
            "size",
            "total",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(k).alias("pick"), idx.cast("bigint").alias("idx"))
                        for k, idx in picks.items()
                    ]
                )
            ).alias("p"),
        )
        .select("part", "base", "size", "total", "p.pick", "p.idx")
        .where((F.col("idx") >= F.col("base")) & (F.col("idx") < F.col("base") + F.col("size")))
        .drop("size")
    )
    upto = Window.partitionBy("part", "pick").orderBy(value)
    end = F.col("base") + F.col("seen")
    return (
        spot.join(F.broadcast(wanted), "part")  # one row per pick
        .withColumn("seen", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
        .where((F.col("idx") < end) & (F.col("idx") >= end - F.col("n")))
        .select("pick", "idx", F.col(value).alias("value"), "total")
    )


def rolling_sum(
    df: DataFrame, by: str, order: Sequence[str], value: str, window: int, out: str = "rolling"
) -> DataFrame:
    """Sum of the last ``window`` values per group, with groups split over ranges.

    A range sums its own rows; the rows at its start also take the last values of the
    ranges before it, which arrive as one short array per (group, range).
    """
    reach = window - 1
    cols = [F.col(by), *[F.col(c) for c in order]]
    spot = in_order(df, cols, "rolling")
    local = Window.partitionBy(by, "part").orderBy("local")
    own = spot.withColumn(
        "own", F.sum(value).over(local.rowsBetween(-reach, 0))
    ).withColumn("nth", F.row_number().over(local))
    if reach == 0:
        return own.select(*df.columns, F.col("own").alias(out))
    # A group continues into another range only if it holds the range's first row, so
    # the groups to look at are at most one per range.
    crossing = (
        spot.where("local = 0").select(by).distinct()
    )
    last = Window.partitionBy(by, "part").orderBy(F.col("local").desc())
    tails = (
        join_on_groups(spot, F.broadcast(crossing), [by], "left_semi")
        .select(by, "part", "local", F.struct(F.col(value).alias("v")).alias("tail_value"))
        .withColumn("back", F.row_number().over(last))
        .where(F.col("back") <= reach)
    )
    chain = Window.partitionBy(by).orderBy("part", "local")
    carry = (
        tails.withColumn(
            "before", F.collect_list("tail_value").over(chain.rowsBetween(-reach, -1))
        )
        .withColumn("first", F.min("local").over(Window.partitionBy(by, "part")))
        .where("local = first AND size(before) > 0")
        .select(by, "part", "before")
    )
    need = F.greatest(F.lit(0), F.least(F.size("before"), F.lit(window) - F.col("nth")))
    # the list holds structs, since a list of plain values would lose the NULLs and their places
    reached = F.slice("before", F.size("before") - need + 1, need)
    zero = F.lit(0).cast(spot.schema[value].dataType)
    carried = F.aggregate(
        reached, zero, lambda a, x: (a + F.coalesce(x["v"], zero)).cast(spot.schema[value].dataType)
    )
    none = F.col("own").isNull() & ~F.exists(reached, lambda x: x["v"].isNotNull())
    total = F.when(~none, F.coalesce(F.col("own"), F.lit(0)) + carried)
    joined = join_on_groups(own, F.broadcast(carry), [by, "part"], "left")  # at most one row per range
    return joined.select(
        *df.columns, F.when(F.col("before").isNull() | (need == 0), F.col("own")).otherwise(total).alias(out)
    )


def head_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group; each map task passes on at most ``n`` per group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n)
