"""Token ids on disk: one zstandard frame per document, all frames sharing a trained dictionary.

A token file is a folder of three Parquet tables, all written and committed by Spark, so
a lost executor only repeats its tasks:

* ``dictionary``: one row (hash, bytes, bytes per id);
* ``segments``: documents in ascending doc_id order, at most 4096 or 4 MB of frames per row;
  a row has the dictionary's hash, the documents' ids and numbers of tokens, the offset index
  (where each frame begins in ``body``, and the end) and ``body``, the frames;
* ``parts``: the number of ids before each range of segments, one row per range.

A short document is read through the index: its frame alone is cut out and decompressed.
The dictionary is trained on a bounded sample: the ids (the first 4096 of each) of the 512
documents whose doc_id hashes lowest. It only affects the size of the file.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .registry import query, table
from .tokens import encoder

END_ID = 2
SAMPLE_DOCUMENTS = 512
SAMPLE_IDS = 4096
DICTIONARY_BYTES = 64 << 10
SEGMENT_DOCUMENTS = 4096
SEGMENT_BYTES = 4 << 20
LEVEL = 3

_SEGMENT = (
    "part int, segment long, local_start long, n_tokens long, dictionary_hash string, first_id long, last_id long, "
    "doc_ids array<long>, counts array<int>, offsets array<long>, body binary"
)


def _ids_with_end(batch: pa.RecordBatch, path: str, end_id: int) -> Iterator[tuple[int, np.ndarray]]:
    for row, ids in encoder(path).documents(batch):
        yield row, np.append(ids, np.uint32(end_id))


def train_dictionary(documents: DataFrame, path: str, end_id: int, width: int) -> bytes:
    """A dictionary for serialized ids, from the bounded sample; empty if there is too little text."""
    picked = [
        r[0]
        for r in documents.select("doc_id")
        .where("doc_id is not null")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_DOCUMENTS)
        .collect()
    ]

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ids[:SAMPLE_IDS].astype(f"<u{width}").tobytes() for _, ids in _ids_with_end(batch, path, end_id)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["sample"])

    chosen = documents.where(F.col("doc_id").isin(picked)).select("text")
    samples = [bytes(r[0]) for r in chosen.mapInArrow(serialized, "sample binary").limit(2 * SAMPLE_DOCUMENTS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_token_file(documents: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Encode every whole text (null: empty), append ``end_id`` and write the token file ``folder``.

    Order is ascending doc_id; rows without a doc_id come first, repeated ids lie side by
    side. An empty table gives an empty file. Other columns of ``documents`` are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = 2 if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    raw = train_dictionary(docs, path, end_id, width)
    name = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame(
        [(name, bytearray(raw), width)], "dictionary_hash string, dictionary binary, width int"
    ).coalesce(1).write.parquet(f"{folder}/dictionary")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw), write_content_size=True)
        frames: list[bytes] = []
        ids: list = []
        counts: list[int] = []
        size = part = number = done = 0

        def flush() -> pa.RecordBatch:
            nonlocal size, number, done, frames, ids, counts
            ends = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            known = [i for i in ids if i is not None]
            row = {
                "part": part, "segment": number, "local_start": done, "n_tokens": sum(counts),
                "dictionary_hash": name, "first_id": min(known, default=None), "last_id": max(known, default=None),
                "doc_ids": ids, "counts": counts, "offsets": ends, "body": b"".join(frames),
            }
            number, done, size = number + 1, done + sum(counts), 0
            frames, ids, counts = [], [], []
            return pa.RecordBatch.from_pylist([row], _ARROW)

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            keys = batch.column("doc_id").to_pylist()
            for row, found in _ids_with_end(batch, path, end_id):
                frame = packer.compress(found.astype(f"<u{width}").tobytes())
                if frames and (len(frames) >= SEGMENT_DOCUMENTS or size + len(frame) > SEGMENT_BYTES):
                    yield flush()
                frames.append(frame)
                ids.append(keys[row])
                counts.append(len(found))
                size += len(frame)
        if frames:
            yield flush()

    # the length breaks ties between rows that repeat a doc_id
    order = [F.col("doc_id").asc_nulls_first(), F.length("text"), F.xxhash64("text")]
    (
        docs.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(segments, _SEGMENT)
        .write.parquet(f"{folder}/segments")
    )
    sizes = spark.read.parquet(f"{folder}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select(
        "part", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0).cast("long")).alias("base")
    ).coalesce(1).write.parquet(f"{folder}/parts")


_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("segment", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()),
        ("dictionary_hash", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64())),
        ("body", pa.binary()),
    ]
)


def read_token_file(spark: SparkSession, folder: str, ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) of the documents in the file.

    With ``ids`` only segments whose id range can hold one are read, and only their frames
    are decompressed. A segment written with another dictionary is refused.
    """
    head = spark.read.parquet(f"{folder}/dictionary").first()
    name, raw, width = head["dictionary_hash"], bytes(head["dictionary"]), head["width"]
    if hashlib.sha256(raw).hexdigest() != name:
        raise ValueError("the dictionary does not match its hash")
    wanted = None if ids is None else set(ids)
    segments = spark.read.parquet(f"{folder}/segments")
    if wanted is not None:
        low, high = (min(wanted), max(wanted)) if wanted else (0, -1)
        segments = segments.where((F.col("first_id") <= high) & (F.col("last_id") >= low))
    # one row per range of the writer, as many as its shuffle had partitions
    placed = segments.join(F.broadcast(spark.read.parquet(f"{folder}/parts")), "part").select(
        "base", "local_start", "dictionary_hash", "doc_ids", "counts", "offsets", "body"
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        for batch in batches:
            for k in range(batch.num_rows):
                seg = batch.slice(k, 1)
                if seg.column("dictionary_hash")[0].as_py() != name:
                    raise ValueError("a segment was written with another dictionary")
                doc_ids = seg.column("doc_ids")[0].as_py()
                counts = seg.column("counts")[0].values.to_numpy().astype(np.int64)
                starts = np.cumsum(counts) - counts + seg.column("base")[0].as_py() + seg.column("local_start")[0].as_py()
                offsets = seg.column("offsets")[0].values.to_numpy()
                body = seg.column("body")[0].as_buffer()
                pick = [i for i, d in enumerate(doc_ids) if wanted is None or d in wanted]
                for some in (pick[i : i + 512] for i in range(0, len(pick), 512)):
                    found = [
                        np.frombuffer(unpacker.decompress(body[int(offsets[i]) : int(offsets[i + 1])]), f"<u{width}")
                        .astype("<u4").tobytes()
                        for i in some
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_ids[i] for i in some], pa.int64()),
                            pa.array(starts[some], pa.int64()),
                            pa.array([len(f) // 4 for f in found], pa.int64()),
                            pa.array(found, pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def digests(ids: DataFrame) -> DataFrame:
    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = pa.array([zlib.crc32(x.as_buffer()) for x in b.column("ids")], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), b.column("n_tokens"), sums],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return ids.mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token file of all documents holds, read back from it."""
    folder = fresh_path(spark, "token_file")
    write_token_file(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return digests(read_token_file(spark, folder))
