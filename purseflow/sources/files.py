"""File sources and sinks: CSV, text logs, partitioned lake folders, inventories, fingerprints."""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as fn
from ..operators.joins import BROADCAST_FILES
from ..session import stage


def text_schema(columns: Sequence[str]) -> T.StructType:
    """Every column as text: bronze data keeps what the file says."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Headed CSV files of one layout, without an inference pass. ``path`` may be a pattern."""
    return spark.read.schema(text_schema(columns)).option("header", True).csv(path)


def with_source_order(scan: DataFrame, out: str = "ordinal") -> DataFrame:
    """Add a sortable source position to rows of text files: file, block, row within the block.

    Text formats know no row numbers; rows of one block are read in order by one task, so
    its increasing id orders them, whatever blocks the task reads besides.
    """
    return scan.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(out),
    )


def read_typed_csv(spark: SparkSession, path: str, columns: Sequence[str], times: Sequence[str]) -> DataFrame:
    """CSV with amounts as money and the named columns as times."""
    rows = read_csv(spark, path, columns)
    typed = {"amount": F.col("amount").try_cast(fn.MONEY)}
    typed |= {c: F.try_to_timestamp(F.col(c), F.lit(fn.STAMP_FORMAT)) for c in times}
    return rows.withColumns({c: e for c, e in typed.items() if c in rows.columns})


UNREADABLE = "_unreadable"


def read_checked_csv(spark: SparkSession, path: str, schema: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows of CSV files, and as text the lines that don't fit the schema (``line``).

    A line with a value of another type or with too few or too many fields is a reject; an
    empty field is NULL. Both results come from one scan of the files, which is written once.
    """
    rows = (
        spark.read.schema(f"{schema}, {UNREADABLE} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", UNREADABLE)
        .options(**options)
        .csv(path)
    )
    known = stage(rows, "checked_csv")
    good = known.where(F.col(UNREADABLE).isNull()).drop(UNREADABLE)
    return good, known.where(F.col(UNREADABLE).isNotNull()).select(F.col(UNREADABLE).alias("line"))


def write_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    # few large files per folder, and a hot folder split over several tasks
    rows = df.hint("rebalance", *by) if by else df
    writer = rows.write.mode("overwrite").option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Hive-style folders. The rebalance keeps files large and splits a hot partition."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def in_source_order(scan: DataFrame) -> DataFrame:
    """Add ``pos``, the row's 0-based place in the source: by file name, then row in the file.

    The Parquet reader knows each row's number in its file, so no row is sorted or
    shuffled; the rows before a file come from one number per file. ``scan`` has to be a
    plain read, because the file columns are lost after other operations.
    """
    place = scan.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    sizes = place.groupBy("_file").agg((F.max("_row") + 1).alias("_size"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("_file", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    small = len(scan.inputFiles()) <= BROADCAST_FILES  # the driver has this listing anyway
    joined = place.join(F.broadcast(base) if small else base, "_file")
    return joined.select(*scan.columns, (F.col("_base") + F.col("_row")).alias("pos"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Application log lines as columns."""
    parsed = spark.read.text(path).select(fn.parse_log_line(F.col("value")).alias("p"))
    return parsed.select("p.*")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per folder; only the listing is read, not the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder")).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")
    )


AT_ONCE = 64 << 20  # bytes of a file that Spark reads as one value, and of Arrow batches
UNPACKED = ("gz", "bz2", "deflate", "lz4", "snappy", "zst", "zstd")  # the line reader would decompress files named so


def _digests() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Name, length and MD5 of each file from its lines in order, each with a line feed.

    The last line may have had none, and the reader leaves out a byte order mark before the
    first one: the file's length tells, and that nothing else is missing.
    """

    def rows(lines: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, size, seen, held, plain, marked = None, 0, 0, b"", None, None

        def row() -> pa.RecordBatch:
            for digest, n in ((plain, seen), (marked, seen + len(codecs.BOM_UTF8))):
                if size in (n, n - 1):
                    digest.update(held if size == n else b"")
                    name = unquote(path.rpartition("/")[2])
                    return pa.RecordBatch.from_pydict({"name": [name], "length": [size], "etag": [digest.hexdigest()]})
            raise OSError(f"one task read {seen} bytes as lines of {path}, which has {size}")

        for batch in lines:
            line = batch.column("line")
            kind = np.int64 if pa.types.is_large_binary(line.type) else np.int32
            offsets = np.frombuffer(line.buffers()[1], kind)[line.offset :]
            data = memoryview(line.buffers()[2])
            files = pc.run_end_encode(batch.column("path"))
            begin = 0
            for end, file in zip(files.run_ends.to_pylist(), files.values.to_pylist()):
                if file != path:
                    if path is not None:
                        yield row()
                    path, size, seen, held = file, batch.column("size")[begin].as_py(), 0, b""
                    plain, marked = hashlib.md5(), hashlib.md5(codecs.BOM_UTF8)
                part = data[offsets[begin] : offsets[end]]
                for digest in (plain, marked):
                    digest.update(held)  # the last line feed may not be the file's
                    digest.update(part[:-1])
                seen, held, begin = seen + len(part), bytes(part[-1:]), end
        if path is not None:
            yield row()

    return rows  # by value: workers need not find this package


@contextmanager
def _unsplit(spark: SparkSession, size: int) -> Iterator[None]:
    """Files of up to so many bytes that are read inside go to one task each, in Arrow batches of bounded bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxBytesPerBatch"]
    was = [spark.conf.get(k) for k in names]
    for k, v in zip(names, (size, size, AT_ONCE)):
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in zip(names, was):
            spark.conf.set(k, v)


def etags(spark: SparkSession, path: str) -> DataFrame:
    """The content digest of every file, computed where the file is read.

    A file above 64 MB is no single value: one task reads it as lines, in order, by Spark's
    reader, which also reaches stores that Python can't open. One line is still one value.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(path)
    packed = reader.option("pathGlobFilter", f"*.{{{','.join(UNPACKED)}}}").load(path).where(F.col("length") > AT_ONCE)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    whole = files.where(F.col("length") <= AT_ONCE).unionByName(packed).select(
        name.alias("name"), "length", F.md5("content").alias("etag")
    )
    most = files.agg(F.max("length")).first()[0] or 0
    if most <= AT_ONCE:
        return whole
    file = F.col("_metadata")
    lines = (
        spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
        .where((file["file_size"] > AT_ONCE) & ~file["file_name"].rlike(rf"\.({'|'.join(UNPACKED)})$"))
        .select(
            file["file_path"].alias("path"), file["file_size"].alias("size"),
            F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("line"),
        )
    )
    with _unsplit(spark, most):
        return whole.unionByName(stage(lines.mapInArrow(_digests(), "name string, length long, etag string"), "etags"))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that is equal for tables with equal rows, whatever their order.

    The sum catches a lost pair of equal rows, which would cancel out in the XOR.
    """
    digest = F.xxhash64(*df.columns)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.bit_xor(digest), F.lit(0)).alias("row_xor"),
        F.coalesce(F.sum(digest.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("row_sum"),
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Run metrics as JSON: one row, never the data itself."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
