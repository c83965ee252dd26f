"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "purseflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job relies on; sizing is left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.ui.enabled": "false",
        # state of streams with many keys stays on disk instead of the heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # recording the Python line of every column operation slows down plan building
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, where the driver and the executors are one process, may
    fall back to a fresh folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_DIRS[app]


def run_dir(spark: SparkSession) -> str:
    """The folder below the shared one that holds all this application writes for itself."""
    return f"{shared_dir(spark)}/purseflow/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the application's folder that no other call gets."""
    return f"{run_dir(spark)}/{uuid.uuid4().hex}/{name}"


def remove_staged(spark: SparkSession) -> None:
    """Delete all that this application has staged, once no result that reads it is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries built and run inside leave no shuffle files behind, which else stay until the driver's garbage collection."""
    was = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, was)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write rows and return a read of them; the layout is known, so no file is inspected."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    This cuts the lineage at a table that survives lost executors, pins values that
    depend on the physical plan (partition numbers), and keeps column pruning for
    the readers, which a row checkpoint would not.
    """
    return write_table(df, fresh_path(df.sparkSession, name))


def widen(df: DataFrame, scan: DataFrame) -> DataFrame:
    """Spread rows over all cores if the ``scan`` they come from has fewer splits than cores.

    A small file with one row group would keep a single core busy. A large table has
    more splits than cores and is left as it is, without a shuffle. ``scan`` is the plain
    read below ``df``: counting its splits lists files but starts no job.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if scan.rdd.getNumPartitions() < cores else df
