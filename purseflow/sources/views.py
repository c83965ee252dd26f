"""Named views, so that reports can also be written as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import tables as t

VIEWS = {"transactions": t.txn, "users": t.users, "sales": t.sales, "events_log": t.ev, "raw_transactions": t.raw}


def register(spark: SparkSession, folder: str) -> list[str]:
    """Create or replace the views of the payment entities in this session."""
    for name, make in VIEWS.items():
        make(spark, folder).createOrReplaceTempView(name)
    return list(VIEWS)


def query(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """Run SQL over the views; errors are raised, not turned into rows."""
    register(spark, folder)
    return spark.sql(text)
