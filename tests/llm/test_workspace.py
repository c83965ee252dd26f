"""Steps of an operator leave only their tables on disk."""

from pyspark.sql import functions as F

from purseflow.llm.bitmap import bit_map
from purseflow.llm.tables import Workspace
from purseflow.session import CLEANUP


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_written_tables_and_bit_maps_leave_no_shuffle_files(spark):
    was, before = spark.conf.get(CLEANUP), shuffle_files(spark)
    rows = spark.range(10_000, numPartitions=4)
    kept = Workspace(rows, "cleaned").put(rows.groupBy((F.col("id") % 700).alias("key")).count())
    bit_map(kept.select(F.xxhash64("key").alias("key")), "key")
    assert kept.count() == 700
    new = {name.split("_")[1] for name in shuffle_files(spark) - before}
    assert len(new) <= 1  # the count's own
    assert spark.conf.get(CLEANUP) == was
