"""The queries of this package, and the SQL that states the same result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(func: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            modest_batches(spark)
            return func(spark, sf_dir)

        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return func

    return register


def modest_batches(spark: SparkSession) -> None:
    """Texts are long: a thousand rows are enough for one exchange with a Python worker.

    A setting that somebody made is left alone.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
