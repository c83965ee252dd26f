"""Exact repeated substrings: every byte covered by a 100-byte string that starts earlier too.

This is not external induced sorting with priority queues, which costs a push and a pop for
every byte and level (figures in the README). It keeps the idea of inducing from a locally
chosen sample, but nothing is sorted: windows are told apart by hashes of their anchors.

1. Sample. In every 100-byte window the 32-byte string with the smallest hash (the leftmost of
   them) is the window's anchor. Equal windows choose the same anchor at the same offset, and
   about one position in 35 is one. Each anchor carries the tuple of its suffix: the hash of its
   32 bytes, and the hash and length of its whole context, all the windows that chose it.
2. Class. Tuples of anchors that occur again (a bit map that grows with them leaves out the others)
   are grouped by Spark: anchors with equal contexts form a class; all its members but the first
   are covered completely.
3. Induce. A window's class follows from its anchor's: only where an anchor's 32 bytes occur
   in several different contexts can a first member hold a window that another context has
   earlier. The windows of these members, and only they, are compared one by one, after those
   are left out that hold their anchor with more bytes before or after it than any other context has.

No step gathers a group: classes are map-side aggregated minima. A shard may be far larger
than memory, since all state between the steps is in written tables and shuffles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import bit_map, bits_for, marked
from .registry import query, table
from .tables import Workspace, steady
from .text import EXACT_VALUE, PLACE, blocks, mix, prefix_sums, span_hashes, span_sums

LENGTH = 100
GRAM = 32
BYTES = 1 << 17  # arrays of eight times as many bytes stay in a core's cache
STEP = 11  # bytes from one reach beyond an anchor to the next
PASSES = 4  # windows are compared in so many parts, whose shuffles never lie on disk at the same time


def anchors(
    data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> tuple[np.ndarray, ...]:
    """Document, place, first and last window start, gram hash and prefix sums of a block's anchors.

    Places count from the start of the block.
    """
    none = np.zeros(0, np.int64)
    sums = prefix_sums(data, EXACT_VALUE)
    if len(data) < length:
        return none, none, none, none, none.view(np.uint64), sums
    sizes = np.diff(offsets)
    held = np.flatnonzero(sizes >= length)
    if not len(held):
        return none, none, none, none, none.view(np.uint64), sums
    # the sums themselves are compared, and only those of the anchors become hashes
    grams = span_sums(sums, gram)
    bits = np.uint64(len(data).bit_length())
    least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)  # equal sums: the leftmost is less
    wide, size = length - gram + 1, 1
    while 2 * size <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < wide:
        least = np.minimum(least[: len(least) - (wide - size)], least[wide - size :])
    new = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    begin = offsets[held]
    new[begin] = True
    first = np.flatnonzero(new)
    doc = held[np.maximum(np.searchsorted(begin, first, side="right") - 1, 0)]
    inside = (first >= offsets[doc]) & (first + length <= offsets[doc + 1])
    last = np.append(first[1:], len(least)) - 1
    doc, first, last = doc[inside], first[inside], last[inside]
    last = np.minimum(last, offsets[doc + 1] - length)
    place = (least[first] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return doc, place, first, last, mix(grams[place]), sums


def _numbered(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row")
    )


def _gram_counts(length: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks(batch, max_bytes=BYTES):
                found, n = np.unique(anchors(data, offsets, length, gram)[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["gram", "n"])

    return rows


_TUPLE = "doc_id long, row long, place long, first long, last long, gram long, context long"


def _tuples(documents: DataFrame, marks: Broadcast, length: int, gram: int) -> DataFrame:
    """The anchors whose gram is marked; places are bytes of the document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers = batch.column("doc_id"), batch.column("row")
            for begin, _, data, offsets in blocks(batch, max_bytes=BYTES):
                doc, place, first, last, grams, sums = anchors(data, offsets, length, gram)
                keep = np.flatnonzero(marked(marks.value, grams))
                doc, place, first, last, grams = (x[keep] for x in (doc, place, first, last, grams))
                context = mix(
                    span_hashes(sums, first, last + length)
                    + (place - first).astype(np.uint64) * PLACE[0] + (last - first).astype(np.uint64) * PLACE[1]
                )
                at, base = pa.array(begin + doc), offsets[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(at), numbers.take(at), pa.array(place - base), pa.array(first - base),
                        pa.array(last - base), pa.array(grams.view(np.int64)), pa.array(context.view(np.int64)),
                    ],
                    names=["doc_id", "row", "place", "first", "last", "gram", "context"],
                )

    return documents.mapInArrow(rows, _TUPLE)


def reaches(
    sums: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, gram: int
) -> Iterator[tuple[bool, int, np.ndarray, np.ndarray]]:
    """(after?, bytes, which anchors, hashes) of the anchors with so many bytes before or after them.

    Only such as lie in a window of the anchor. Equal windows have all of theirs in common.
    """
    for reach in range(min(STEP, length - gram), length - gram + 1, STEP):
        for after, there, start in (
            (False, place - first >= reach, place - reach), (True, last + length - place - gram >= reach, place)
        ):
            at = np.flatnonzero(there)
            yield after, reach, at, mix(span_hashes(sums, start[at], start[at] + gram + reach) + PLACE[int(after)])


def _spot_keys(row: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(mix(row.view(np.uint64)) + place.astype(np.uint64))


def _spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _spot_keys(batch.column("row").to_numpy(), batch.column("place").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])


class Contested:
    """The contested anchors (row, place), found again in the texts by bit maps."""

    def __init__(self, documents: DataFrame, contested: DataFrame, length: int, gram: int) -> None:
        self.documents = documents.withColumn("key", F.xxhash64("row"))
        bits = bits_for(contested.count())
        self.rows = bit_map(contested.select(F.xxhash64("row").alias("key")), "key", bits)
        self.spots = bit_map(contested.select("row", "place").mapInArrow(_spots, "key long"), "key", bits)
        self.length, self.gram = length, gram

    def _anchors(self) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
        rows, spots, length, gram = self.rows, self.spots, self.length, self.gram

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for batch in batches:
                batch = batch.filter(pa.array(marked(rows.value, batch.column("key").to_numpy().view(np.uint64))))
                numbers = batch.column("row").to_numpy()
                for begin, _, data, offsets in blocks(batch, max_bytes=BYTES):
                    doc, place, first, last, grams, sums = anchors(data, offsets, length, gram)
                    keep = np.flatnonzero(marked(spots.value, _spot_keys(numbers[begin + doc], place - offsets[doc])))
                    yield batch, begin, offsets, sums, *(x[keep] for x in (doc, place, first, last, grams))

        return found

    def repeated_reaches(self) -> DataFrame:
        """``hash``: the anchors, with so many bytes before or after them, that several contested ones have."""
        found, length, gram = self._anchors(), self.length, self.gram

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, _, _, sums, _, place, first, last, _ in found(batches):
                hashes = [h for *_, h in reaches(sums, place, first, last, length, gram)]
                keys, n = np.unique(np.concatenate(hashes), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["hash", "n"])

        counted = self.documents.mapInArrow(rows, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
        return counted.where("n > 1").select("hash")

    def windows(self, again: Broadcast) -> DataFrame:
        """Place and hash of the windows that hold no reach which isn't marked."""
        found, length, gram = self._anchors(), self.length, self.gram

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, begin, offsets, sums, doc, place, first, last, grams in found(batches):
                low, high = first.copy(), last.copy()
                for after, reach, at, hashes in reaches(sums, place, first, last, length, gram):
                    at = at[~marked(again.value, hashes)]
                    if after:
                        high[at] = np.minimum(high[at], place[at] + gram + reach - length - 1)
                    else:
                        low[at] = np.maximum(low[at], place[at] - reach + 1)
                n = np.maximum(high - low + 1, 0)
                which = np.repeat(np.arange(len(n)), n)
                start = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                keys = mix(span_hashes(sums, start, start + length) + (place[which] - start).astype(np.uint64) * PLACE[0])
                at = pa.array(begin + doc[which])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at), batch.column("row").take(at),
                        pa.array(grams[which].view(np.int64)), pa.array(start - offsets[doc[which]]), pa.array(keys.view(np.int64)),
                    ],
                    names=["doc_id", "row", "gram", "at", "hash"],
                )

        return self.documents.mapInArrow(rows, "doc_id long, row long, gram long, at long, hash long")


def repeated_spans(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``row, spans`` (struct a, b in bytes, unsorted, overlapping) of ``steady`` documents with repeated bytes."""
    work = Workspace(documents, "suffix_dedup")
    docs = _numbered(documents)
    again = work.put(
        docs.select("text").mapInArrow(_gram_counts(length, gram), "gram long, n long")
        .groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    )
    tuples = work.put(_tuples(docs, bit_map(again, "gram", bits_for(again.count())), length, gram))
    work.drop(again)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "place")
    key = ["gram", "context"]
    classes = work.put(tuples.groupBy(*key).agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("n")))
    copies = work.put(
        tuples.join(classes.where("n > 1").select(*key, "least"), key)
        .where((F.col("row") != F.col("least.row")) | (F.col("place") != F.col("least.place")))
        .select("row", F.col("first").alias("a"), (F.col("last") + length).alias("b"))
    )
    several = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    contested = work.put(
        classes.join(several, "gram").select("least.row", "least.place")
    )
    work.drop(tuples, classes)
    # most of these windows occur once and are told by their anchor and the bytes on one side
    places = Contested(docs, contested, length, gram)
    reached = work.put(places.repeated_reaches())
    windows = work.put(places.windows(bit_map(reached, "hash", bits_for(reached.count()))))
    work.drop(reached)
    begin = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "at")
    parts = []
    for k in range(PASSES):
        part = windows.where(F.pmod("hash", F.lit(PASSES)) == k)
        first = part.groupBy("gram", "hash").agg(F.min(begin).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(work.put(
            part.join(first.drop("n"), ["gram", "hash"])
            .where((F.col("row") != F.col("least.row")) | (F.col("at") != F.col("least.at")))
            .select("row", F.col("at").alias("a"), (F.col("at") + length).alias("b"))
        ))
    induced = work.together(*parts)
    work.drop(contested, windows)
    return copies.union(induced).groupBy("row").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def _judged(with_bytes: bool):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"]):
                raw = (text or "").encode()
                removed = n_spans = 0
                kept = raw
                if spans is not None and len(spans):
                    runs: list[list[int]] = []
                    for a, b in sorted((s["a"], s["b"]) for s in spans):
                        if runs and a <= runs[-1][1]:
                            runs[-1][1] = max(b, runs[-1][1])
                        else:
                            runs.append([a, b])
                    edges = [0, *[x for r in runs for x in r], len(raw)]
                    kept = b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                    removed, n_spans = len(raw) - len(kept), len(runs)
                row = [doc_id, len(raw), removed, n_spans, hashlib.sha256(kept).hexdigest()]
                out.append([*row, kept] if with_bytes else row)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            frame = pd.DataFrame(out, columns=names[: 5 + with_bytes])
            yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    return rows


def dedup_substrings(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, with_bytes: bool = True
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row of ``documents``.

    A byte goes if a string of ``length`` bytes covers it that also starts earlier: in a row
    with a smaller doc_id (rows without one come last, repeated rows follow their first) or
    further up in the same text. Strings never cross documents and are judged on the input.
    ``kept`` is the rest as bytes, as a cut may fall inside a character. Null and empty texts
    have no bytes. An empty table gives no rows; other columns are ignored.
    """
    documents = steady(documents.select("doc_id", "text"), "suffix_dedup_input")
    spans = repeated_spans(documents, length, gram).withColumnRenamed("row", "_row")
    docs = _numbered(documents)
    # the spans grow with the input, so they are not broadcast at any size
    joined = docs.join(spans.hint("merge"), docs["row"] == spans["_row"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInPandas(_judged(with_bytes), schema + (", kept binary" if with_bytes else ""))


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What exact substring dedup (100 bytes) removes from each document."""
    return dedup_substrings(table(spark, sf_dir, "documents"), with_bytes=False)
