"""Exact distinct counts beside other totals, without multiplying rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals_with_distinct(rows: DataFrame, counts: dict[str, Column], distinct: dict[str, str]) -> DataFrame:
    """One row: the ``counts`` (count aggregates) and the number of distinct values of each column.

    Several COUNT DISTINCT in one aggregation copy every row once per column. Here each column is
    counted in two stages of its own, its values first and then their number, from a scan
    of that column alone; the first one carries the other counts along. Repeats of a value are
    merged before the shuffle. NULL is no value.
    """
    (name, column), *others = distinct.items()
    groups = rows.groupBy(column).agg(*[c.alias(k) for k, c in counts.items()], F.count(column).alias("_known"))
    nothing = F.lit(0).cast("bigint")
    out = groups.agg(
        *[F.coalesce(F.sum(k), nothing).alias(k) for k in counts], F.count_if(F.col("_known") > 0).alias(name)
    )
    for k, c in others:
        values = rows.select(c).groupBy(c).agg(F.count(c).alias("_known"))
        out = out.withColumn(k, values.agg(F.count_if(F.col("_known") > 0)).scalar())
    return out
