"""Sentencepiece encoding and decoding of whole texts, checked against the library batch by batch.

``pieces.PieceCodec`` makes the ids: a score-ordered agenda of adjacent symbol pairs for
merge-type vocabularies. Both directions run inside Arrow batches and shuffle nothing. With
``check`` the same batch also goes through the sentencepiece library, and ``agrees`` says
for each row whether both came to the same; the ids and texts returned are always our own.

Nulls and empty texts have no ids, and no ids give the empty text. Rows that repeat a
doc_id or have none are rows like others; other columns of the documents are left out, and
an empty table gives an empty one. Texts of any length are encoded as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pieces import codec
from .registry import query, table

_ROWS = 256  # rows of ids that go through decoding at once

_libraries: dict[str, object] = {}


def library(path: str):
    """The worker's processor of the sentencepiece library, loaded once."""
    if path not in _libraries:
        from sentencepiece import SentencePieceProcessor

        _libraries[path] = SentencePieceProcessor(model_file=path)
    return _libraries[path]


def encode(documents: DataFrame, path: str, check: bool = True) -> DataFrame:
    """``doc_id, ids`` of every text without begin or end ids; with ``check`` also ``agrees``."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, ids, bounds in codec(path).documents(batch):
                columns = {
                    "doc_id": batch.column("doc_id").slice(first, end - first),
                    "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                }
                if check:
                    texts = pc.fill_null(batch.column("text").slice(first, end - first), "").to_pylist()
                    wanted = library(path).encode(texts, num_threads=1)
                    columns["agrees"] = pa.array(
                        [np.array_equal(ids[bounds[i] : bounds[i + 1]], w) for i, w in enumerate(wanted)], pa.bool_()
                    )
                yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(encoded, "doc_id long, ids array<int>" + ", agrees boolean" * check)


def decode(encoded: DataFrame, path: str, check: bool = True) -> DataFrame:
    """``doc_id, ids, text`` from ``doc_id, ids``; with ``check`` ``agrees`` covers the text as well."""
    known = F.col("agrees") if "agrees" in encoded.columns else F.lit(True)
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"), known.alias("agrees"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                lists = batch.column("ids")
                bounds = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.values.to_numpy()[bounds[0] : bounds[-1]].astype(np.uint32)
                bounds = bounds - bounds[0]
                texts = codec(path).texts(ids, bounds)
                columns = {"doc_id": batch.column("doc_id"), "ids": lists, "text": pa.array(texts, pa.string())}
                if check:
                    each = [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(batch.num_rows)]
                    same = [a == b for a, b in zip(texts, library(path).decode(each))]
                    columns["agrees"] = pc.and_(batch.column("agrees"), pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(decoded, "doc_id long, ids array<int>, text string" + ", agrees boolean" * check)


@query("op13_sentencepiece")
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every whole text and of what they decode to; ``agrees``: so does the library."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
        "agrees",
    )
