"""Stored tables that change: upserts by partition, rows with validity intervals, differences.

One writer at a time. Each write replaces its own folders, so repeating one that died
half-way leaves nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .joins import broadcast_if_small
from .ordering import head_per_group


def read_stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """A partitioned table; the declared schema also gives the types and places of the folder columns."""
    names = spark.createDataFrame([], schema).columns
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*names)


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _path(spark, path)
    return files.exists(where)


def _in_partitions(names: Sequence[str], values: Sequence[tuple]) -> Column:
    """A filter on folder columns with literal values, so that other folders are not even opened."""
    if len(names) == 1:
        known = [row[0] for row in values if row[0] is not None]
        return F.col(names[0]).isin(known) | F.lit((None,) in values) & F.col(names[0]).isNull()
    one = lambda row: reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(names, row)])
    return reduce(or_, [one(row) for row in values], F.lit(False))


def upsert_partitions(delivery: DataFrame, path: str, keys: Sequence[str], by: Sequence[str], version: Column) -> None:
    """Replace or add rows by key in the table at ``path``; only the folders that this touches are rewritten.

    ``by`` names the folder columns, which a key may change. The latest row of a key in the
    delivery (by ``version``) wins over stored ones. The stored table is searched by its keys
    alone, which gives one row per folder; whole rows are read only in folders that hold a
    delivered key or receive one. The rows kept there and the delivered
    ones go into a dynamic partition overwrite, and a folder that lost its last row is removed
    afterwards. A delivery may be repeated.
    """
    spark, keys, by = delivery.sparkSession, list(keys), list(by)
    newest = stage(head_per_group(delivery, keys, [version.desc()], 1).drop("nth"), "delivery")
    if not exists(spark, path):
        newest.hint("rebalance", *by).write.partitionBy(*by).parquet(path)
        return
    old = read_stored(spark, path, newest.schema)
    into = {tuple(r) for r in newest.select(*by).distinct().collect()}
    if not into:
        return
    came = newest.select(*keys, F.lit(True).alias("_came"))
    folders = (
        old.select(*keys, *by, F.col("_metadata.file_path").alias("_file"))
        .join(came, keys, "left")
        .groupBy(*by)
        .agg(
            F.bool_or(F.col("_came").isNotNull()).alias("any"),
            F.bool_and(F.col("_came").isNotNull()).alias("all"),
            F.min("_file").alias("file"),
        )
        .where("any")
        .collect()
    )
    hit = {tuple(r[c] for c in by): r for r in folders}
    there = old.where(_in_partitions(by, sorted(into | hit.keys(), key=repr)))
    kept = there.join(newest.select(*keys), keys, "left_anti").select(*newest.columns)
    (
        kept.unionByName(newest)
        .hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    # no row came for a folder that lost all of its rows, so the overwrite has left it alone
    for key, r in hit.items():
        if r["all"] and key not in into:
            where, files = _path(spark, r["file"].rpartition("/")[0])
            files.delete(where, True)


class IntervalTable:
    """Rows with validity intervals, of which an update writes only those it changes.

    ``opened`` has each row under the version that brought it, ``closed`` the key and start of
    each row that a later version ended. A row is visible at version v if it was opened at or
    before v and not closed by then. Folder columns hold the versions, so older states are
    read by partition pruning, and no file is ever rewritten. The caller numbers its writes
    from 0; repeating a write replaces that version.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str]) -> None:
        self.spark, self.schema, self.keys = spark, schema, list(keys)
        self.opened_path, self.closed_path = f"{path}/opened", f"{path}/closed"
        nothing = spark.createDataFrame([], schema)
        self.columns = nothing.columns
        kinds = {f.name: f.dataType.simpleString() for f in nothing.schema.fields}
        self.closed_schema = ", ".join([*[f"{k} {kinds[k]}" for k in self.keys], "since int", "until int"])
        if not exists(spark, self.closed_path):
            nothing.select(*self.keys, F.lit(0).alias("since")).write.parquet(f"{self.closed_path}/until=-1")

    def opened(self) -> DataFrame:
        return read_stored(self.spark, self.opened_path, f"{self.schema}, since int")

    def closed(self) -> DataFrame:
        return read_stored(self.spark, self.closed_path, self.closed_schema)

    def append(self, rows: DataFrame, version: int) -> None:
        """Rows with new keys, visible from ``version`` on."""
        rows.select(*self.columns).write.mode("overwrite").parquet(f"{self.opened_path}/since={version}")

    def _visible(self, version: int) -> DataFrame:
        opened = self.opened().where(F.col("since") <= version)
        closed = self.closed().where(F.col("until") <= version).drop("until")
        # as many rows as were ever changed; Spark broadcasts or shuffles them by their size
        return opened.join(closed, [*self.keys, "since"], "left_anti")

    def as_of(self, version: int) -> DataFrame:
        return self._visible(version).select(*self.columns)

    def update(self, predicate: Column, changes: dict[str, Column], version: int) -> None:
        """Close the matching rows of the version before and open them anew with the changes."""
        hit = stage(self._visible(version - 1).where(F.coalesce(predicate, F.lit(False))), "updated")
        hit.select(*self.keys, "since").write.mode("overwrite").parquet(f"{self.closed_path}/until={version}")
        self.append(hit.withColumns(changes), version)

    def intervals(self) -> DataFrame:
        """All rows ever stored with the versions from (``since``) and before (``until``) which they hold."""
        return self.opened().join(self.closed(), [*self.keys, "since"], "left").select(*self.columns, "since", "until")

    def counts(self) -> DataFrame:
        """Per version, the rows it opened and closed; only folder names and file footers are read."""
        opened = self.opened().groupBy(F.col("since").alias("version")).agg(F.count("*").alias("opened"))
        closed = self.closed().groupBy(F.col("until").alias("version")).agg(F.count("*").alias("closed"))
        return opened.join(closed, "version", "left").select(
            "version", "opened", F.coalesce("closed", F.lit(0).cast("bigint")).alias("closed")
        )


def _digest(columns: Sequence[str]) -> Column:
    """128 bits over the values and over which of them are missing."""
    missing = [F.col(c).isNull() for c in columns]
    values = [F.col(c) for c in columns]
    return F.struct(F.xxhash64(*values, *missing), F.xxhash64(F.lit("second"), *missing, *values))


def row_differences(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``added``, ``removed`` and ``changed`` between two states of a table with unique keys.

    Returns the keys, ``change``, and every other column as ``old_`` and ``new_``. Only keys and
    digests of rows are shuffled; the rows themselves meet the keys that differ, which are
    broadcast after a check of their number.
    """
    keys = list(keys)
    rest = [c for c in before.columns if c not in keys]
    sides = [df.select(*keys, _digest(rest).alias(f"{n}_digest")) for n, df in (("old", before), ("new", after))]
    both = sides[0].join(sides[1], keys, "full_outer").where("not (old_digest <=> new_digest)")
    change = F.when(F.col("old_digest").isNull(), "added").when(F.col("new_digest").isNull(), "removed").otherwise("changed")
    differ = broadcast_if_small(stage(both.select(*keys, change.alias("change")), "differences"))
    known = {
        name: df.join(differ.where(F.col("change") != gone), keys).select(*keys, "change", F.struct(*rest).alias(name))
        for name, df, gone in (("old", before, "added"), ("new", after, "removed"))
    }
    one_sided = known["old"].unionByName(known["new"], allowMissingColumns=True)
    met = one_sided.groupBy(*keys, "change").agg(F.first("old", True).alias("old"), F.first("new", True).alias("new"))
    return met.select(
        *keys, "change", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("old", "new") for c in rest]
    )
