"""Shards of nearly equal size from ordered groups that must not be split, by minimax cuts.

Documents with equal texts form a group. A group of more than an even share of what is left
gets a shard of its own (there are fewer of them than shards); the other groups stand in the
order of their text's digest, and the smallest shard capacity for which greedy filling needs
no more than the remaining shards is found by search. The shards are cut there.

The order is cut without gathering it: groups carry their cumulated size, a greedy step for
many capacities at once is one filtered aggregation ("the last end at most so far on"), and
once the capacities in question leave few groups near the cuts, these are collected (a
checked number) and the search ends with plain bisection. Rows find their shard by comparing
their digest with the cut points, without a join; so a group with a third of all rows is no
burden. Only DataFrame functions are used.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import in_order, positions
from .registry import query, table
from .tables import Workspace

SHARDS = 16
CAPACITIES = 32
NEAR_CUTS = 100_000


def _cumulated(groups: DataFrame) -> DataFrame:
    """``key, bytes, upto`` in order of the key; ``upto`` is the size up to and with the group."""
    spot = in_order(groups, [F.col("key")], "shard_groups")
    inside = Window.partitionBy("part").orderBy("local").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = spot.groupBy("part").agg(F.sum("bytes").alias("size")).select(
        "part", F.coalesce(F.sum("size").over(earlier), F.lit(0).cast("long")).alias("base")
    )
    # one row per range of the sort
    return spot.join(F.broadcast(bases), "part").select(
        "key", "bytes", (F.col("base") + F.sum("bytes").over(inside)).alias("upto")
    )


def greedy(ends: list[int], capacity: int, shards: int) -> list[int]:
    """Ends of the shards when each takes as many groups as fit."""
    cuts, at = [], 0
    for _ in range(shards):
        k = bisect_right(ends, at + capacity)
        at = ends[k - 1] if k else at
        cuts.append(at)
    return cuts


def _greedy_many(groups: DataFrame, capacities: list[int], shards: int, largest: int) -> list[list[int]]:
    """The same for many capacities at once over a table of cumulated sizes."""
    cuts: list[list[int]] = [[] for _ in capacities]
    at = [0] * len(capacities)
    for _ in range(shards):
        reach = [a + c for a, c in zip(at, capacities)]
        # an end at most ``reach`` lies no more than one group below it
        near = groups.where((F.col("upto") > min(reach) - largest) & (F.col("upto") <= max(reach)))
        found = near.agg(*[F.max(F.when(F.col("upto") <= r, F.col("upto"))).alias(f"c{i}") for i, r in enumerate(reach)])
        at = [a if f is None else max(a, f) for a, f in zip(at, found.first())]
        for c, a in zip(cuts, at):
            c.append(a)
    return cuts


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """Ends of the shards in cumulated bytes, for the smallest capacity that ``shards`` shards can have."""
    total, largest = groups.agg(F.max("upto"), F.max("bytes")).first()
    if not total:
        return [0] * shards
    low, high = max(-(-total // shards), largest), -(-total // shards) + largest
    low_cuts, high_cuts = [0] * shards, [total] * shards  # ends are monotone in the capacity
    while low < high:
        steps = sorted({low + (high - 1 - low) * i // (CAPACITIES - 1) for i in range(CAPACITIES)})
        tried = _greedy_many(groups, steps, shards, largest)
        fit = next((i for i, cuts in enumerate(tried) if cuts[-1] == total), len(steps))
        if fit < len(steps):
            high, high_cuts = steps[fit], tried[fit]
        if fit:
            low, low_cuts = steps[fit - 1] + 1, tried[fit - 1]
        wanted = F.lit(False)
        for a, b in zip(low_cuts, high_cuts):
            wanted = wanted | F.col("upto").between(a, b)
        near = groups.where(wanted).select("upto")
        if low < high and near.limit(NEAR_CUTS + 1).count() <= NEAR_CUTS:
            ends = sorted(r[0] for r in near.collect())
            while low < high:
                middle = (low + high) // 2
                if greedy(ends, middle, shards)[-1] == total:
                    high = middle
                else:
                    low = middle + 1
    return _even_cuts(groups, high, shards, total, largest)


def _even_cuts(groups: DataFrame, capacity: int, shards: int, total: int, largest: int) -> list[int]:
    """Cuts that keep every shard within ``capacity`` and lie as near to even shares as that allows.

    Greedy filling from the left gives the last possible place of each cut, from the right the
    first possible one; the group end nearest to the even share between them is taken.
    """
    shares = [total * k // shards for k in range(1, shards)]
    if not shares:
        return [total]
    near = groups.where(
        F.greatest(*[F.col("upto").between(s - largest, s + largest).cast("int") for s in [*shares, total]]) == 1
    )
    found = near.agg(
        *[F.max(F.when(F.col("upto") <= s, F.col("upto"))).alias(f"b{k}") for k, s in enumerate(shares)],
        *[F.min(F.when(F.col("upto") > s, F.col("upto"))).alias(f"a{k}") for k, s in enumerate(shares)],
    ).first()
    first = [total]
    for _ in shares:
        ahead = groups.where(F.col("upto").between(first[0] - capacity, first[0] - capacity + largest))
        least = 0 if first[0] <= capacity else ahead.agg(F.min("upto")).first()[0]
        first.insert(0, least)
    cuts, at = [], 0
    for k, share in enumerate(shares):
        options = [e for e in (found[k], found[k + len(shares)]) if e is not None and first[k] <= e <= at + capacity]
        if options:
            at = max(at, min(options, key=lambda e: abs(e - share)))
        elif found[k + len(shares)] is not None and first[k] > found[k + len(shares)]:
            at = first[k]
        else:  # the last end within reach
            reach = groups.where(F.col("upto").between(at + capacity - largest, at + capacity))
            at = max(at, reach.agg(F.max("upto")).first()[0] or 0)
        cuts.append(at)
    return [*cuts, total]


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``documents``.

    ``size`` is the text's UTF-8 bytes plus 1. Null and empty texts form one group of size 1
    each; rows may repeat or lack a doc_id and each gets a slot. Slots follow digest and doc_id.
    An empty table gives no rows. Other columns are ignored.
    """
    work = Workspace(documents, "sharding")
    text = F.coalesce("text", F.lit(""))
    rows = work.put(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    groups = work.put(rows.groupBy("key").agg(F.sum("size").alias("bytes")))
    left, rest = shards, groups.agg(F.sum("bytes")).first()[0] or 0
    own = []
    # at most shards - 1 groups can be larger than an even share
    for key, size in groups.orderBy(F.col("bytes").desc(), "key").limit(shards).collect():
        if left > 1 and size * left > rest:
            own.append(bytes(key))
            left, rest = left - 1, rest - size
    others = groups.where(~F.col("key").isin([bytearray(k) for k in own])) if own else groups
    ordered = work.put(_cumulated(others))
    cuts = minimax_cuts(ordered, left)
    # the first key behind each cut tells shards apart
    starts = {r["at"]: bytes(r["key"]) for r in ordered.select(
        (F.col("upto") - F.col("bytes")).alias("at"), "key"
    ).where(F.col("at").isin(sorted(set(cuts)))).collect()}
    number: Column = F.lit(len(own))
    for cut in cuts[:-1]:
        if cut in starts:
            number = number + F.when(F.col("key") >= F.lit(starts[cut]), 1).otherwise(0)
    for k, key in enumerate(own):
        number = F.when(F.col("key") == F.lit(key), k).otherwise(number)
    placed = rows.withColumn("shard", number.cast("int"))
    numbered = positions(
        placed, [F.col("key"), F.col("doc_id"), F.col("row")], ["shard"], "shard_rows"
    ).withColumnRenamed("pos", "slot")
    return numbered.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes, equal texts together."""
    placed = shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
