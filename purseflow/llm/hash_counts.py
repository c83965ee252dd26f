"""Which 64-bit hashes occur often in a corpus, counted as packed arrays instead of rows.

A worker sorts some million hashes at once and writes one row per bucket, that is per value of
the highest bits: the next 32 bits of its hashes, and how often each occurs. Spark deals the
rows out by bucket, and a worker adds up one bucket at a time; what it holds is bounded by
the distinct hashes of a bucket. Counts stop at the asked minimum. 46 bits tell hashes
apart, so some rare ones pass for frequent ones; never the other way round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import mix

BUCKET_BITS = 14
PACKED = "bucket int, hashes binary, counts binary"
MERGE_AT = 1 << 20  # hashes of one bucket that wait to be added up
_UNUSED = np.uint64(64 - BUCKET_BITS - 32)


def marking(hashes: np.ndarray) -> np.ndarray:
    """What stands for a hash in the result of ``frequent``: a bit map of it can be asked with this."""
    return mix(hashes >> _UNUSED)


def _kind(least: int) -> np.dtype:
    return np.min_scalar_type(least)


def packed(hashes: np.ndarray, least: int) -> pa.RecordBatch:
    """One row per bucket of the given hashes, which may repeat."""
    keys, n = np.unique(hashes >> _UNUSED, return_counts=True)
    bucket = (keys >> np.uint64(32)).astype(np.int32)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else np.zeros(0, np.int64)
    at = np.append(first, len(keys)).astype(np.int32)
    low, counts = keys.astype(np.uint32), np.minimum(n, least).astype(_kind(least))
    columns = [
        pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(at * x.itemsize), pa.py_buffer(x)])
        for x in (low, counts)
    ]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *columns], names=["bucket", "hashes", "counts"])


def frequent(rows: DataFrame, least: int) -> DataFrame:
    """``key``: the ``marking`` of every hash that occurs ``least`` times or more in ``packed`` rows."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = None, 0
        keys, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]

        def merge() -> None:
            nonlocal keys, counts, waiting
            found, which = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(which, np.concatenate(counts), len(found)).astype(np.int64)
            keys, counts, waiting = [found], [np.minimum(total, least)], 0

        def done() -> pa.RecordBatch:
            merge()
            often = keys[0][counts[0] >= least].astype(np.uint64) | np.uint64(now) << np.uint64(32)
            return pa.RecordBatch.from_arrays([pa.array(mix(often).view(np.int64))], names=["key"])

        for batch in batches:
            for bucket, low, n in zip(batch.column("bucket").to_pylist(), batch.column("hashes"), batch.column("counts")):
                if bucket != now:
                    if now is not None:
                        yield done()
                    now, waiting = bucket, 0
                    keys, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
                keys.append(np.frombuffer(low.as_buffer(), np.uint32))
                counts.append(np.frombuffer(n.as_buffer(), _kind(least)).astype(np.int64))
                waiting += len(keys[-1])
                if waiting >= MERGE_AT:
                    merge()
        if now is not None:
            yield done()

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(added, "key long")
