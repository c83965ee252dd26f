"""A versioned table: appends, overwrites, time travel, updates and clean-up.

Rows live in Parquet folders partitioned by the version that wrote them; a commit
table says which version started afresh. A row is visible at version v when its own
version lies between the last overwrite at or before v and v itself, so time travel
is partition pruning and no write ever touches an older file. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

COMMITS = "version int, action string, n_rows bigint, n_changed bigint"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark = spark
        self.schema = schema
        self.rows_path = f"{path}/rows"
        self.commits_path = f"{path}/commits"
        self.freed_path = f"{path}/freed"
        self._empty(COMMITS).write.mode("append").parquet(self.commits_path)
        self._empty("version int").write.mode("append").parquet(self.freed_path)
        self._latest: int | None = None  # known after the first look, as there is one writer

    def _empty(self, schema: str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).parquet(self.commits_path)

    def latest(self) -> int:
        """The last committed version, -1 before the first write."""
        if self._latest is None:
            last = self.commits().agg(F.max("version").alias("v")).first().v
            self._latest = -1 if last is None else last
        return self._latest

    def _base(self, version: int) -> int:
        fresh = self.commits().where((F.col("version") <= version) & (F.col("action") != "APPEND"))
        return fresh.agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first().v

    def write(self, df: DataFrame, mode: str = "append", changed: Column | None = None) -> int:
        """Store rows as the next version and then commit it.

        The folder is overwritten, so repeating a write that died before its commit
        leaves no row twice; readers see a version only once it is committed.
        """
        action = {"append": "APPEND", "overwrite": "OVERWRITE", "update": "UPDATE", "optimize": "OPTIMIZE"}[mode]
        version = self.latest() + 1
        seen = Observation()
        n_changed = F.lit(0) if changed is None else F.coalesce(F.sum(changed.cast("int")), F.lit(0))
        columns = self._empty(self.schema).columns
        counted = df.observe(
            seen, F.count(F.lit(1)).alias("n_rows"), n_changed.cast("bigint").alias("n_changed")
        )
        counted.select(*columns).write.mode("overwrite").parquet(f"{self.rows_path}/version={version}")
        commit = [(version, action, seen.get["n_rows"], seen.get["n_changed"])]
        self.spark.createDataFrame(commit, COMMITS).coalesce(1).write.mode("append").parquet(self.commits_path)
        self._latest = version
        return version

    def as_of(self, version: int | None = None) -> DataFrame:
        """The rows visible at a version; only its partitions are read."""
        at = self.latest() if version is None else version
        if not 0 <= at <= self.latest() and version is not None:
            raise ValueError(f"version {version} was never committed")
        gone = self._freed().where(F.col("version").between(self._base(at), at))
        if gone.limit(1).count():
            raise ValueError(f"version {at} is no longer retained")
        stored = self.spark.read.schema(f"{self.schema}, version int").parquet(self.rows_path)
        return stored.where(F.col("version").between(self._base(at), at)).drop("version")

    def _freed(self) -> DataFrame:
        """The versions whose rows a clean-up has freed."""
        return self.spark.read.schema("version int").parquet(self.freed_path)

    def update(self, predicate: Column, changes: dict[str, Column]) -> int:
        """Copy-on-write: a new version in which the matching rows carry the changes."""
        hit = F.coalesce(predicate, F.lit(False))
        marked = self.as_of().withColumn("_hit", hit)
        renewed = marked.withColumns(
            {c: F.when(F.col("_hit"), new).otherwise(F.col(c)) for c, new in changes.items()}
        )
        return self.write(renewed, "update", changed=F.col("_hit"))

    def optimize(self, *order: str) -> int:
        """Rewrite the visible rows clustered by a column; the rows stay the same."""
        return self.write(
            self.as_of().repartitionByRange(*order).sortWithinPartitions(*order), "optimize"
        )

    def history(self) -> DataFrame:
        return self.commits().orderBy("version")

    def visible_counts(self) -> DataFrame:
        """Rows visible at every version, from the commit table alone."""
        by_version = Window.orderBy("version")
        epoch = F.count_if(F.col("action") != "APPEND").over(by_version)
        in_epoch = Window.partitionBy("epoch").orderBy("version")
        return self.commits().withColumn("epoch", epoch).select(
            "version", F.sum("n_rows").over(in_epoch).alias("visible_rows")
        )

    def vacuum(self, retain: int = 2) -> list[int]:
        """Free the versions that none of the last ``retain`` versions can see.

        A live append from before the retained commits stays, because a retained
        version still shows it. The freed folders are rewritten without rows.
        """
        keep_from = self._base(max(0, self.latest() - retain + 1))
        old = self.commits().where(F.col("version") < keep_from).select("version")
        freed = sorted(r.version for r in old.join(self._freed(), "version", "left_anti").collect())
        # noted first: a reader is refused before any row is gone
        noted = self.spark.createDataFrame([(v,) for v in freed], "version int")
        noted.coalesce(1).write.mode("append").parquet(self.freed_path)
        for version in freed:  # a handful of commits, not data
            self._empty(self.schema).write.mode("overwrite").parquet(f"{self.rows_path}/version={version}")
        return freed

    def stored_rows(self) -> DataFrame:
        """Rows still held per stored version."""
        stored = self.spark.read.schema(f"{self.schema}, version int").parquet(self.rows_path)
        return stored.groupBy("version").agg(F.count("*").alias("n_rows"))
