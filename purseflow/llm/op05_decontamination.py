"""Words of documents that repeat a benchmark item, by a prefix-filtered set join.

A window is ten consecutive words of an item, or a whole shorter item. Its set of shingles
(three words, or the whole window if shorter) must be contained in a document for the window
to occur there, so one necessary shingle is enough to find every candidate:

1. rarity: occurrences of the benchmark's shingles are counted over all documents;
2. prefix: a window is represented by its rarest shingle alone (containment 1.0 leaves a
   prefix of length 1); a window with a shingle that no document has is given up;
3. join: documents contribute a row for each occurrence of a prefix shingle only, and meet
   the windows on it. Which shingles are worth a row is decided with a bit map of fixed size
   (8 MB, however large the benchmark is); false positives die in the join;
4. bounds: the shingle's place in the window fixes where the window would start and end,
   and both must lie inside the document;
5. verification: all words of the window are compared at that place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import bit_map, marked
from .registry import query, table
from .tables import Workspace
from .text import IS_ALNUM, blocks, runs, shingles, word_hashes

WINDOW = 10
SHINGLE = 3
_REACH = WINDOW - 1

_WINDOWS = "item_id string, words array<long>, shingles array<struct<shingle: long, size: int, place: int>>"


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("shingle", pa.int64()), ("size", pa.int32()), ("place", pa.int32())]))
    for batch in batches:
        names = batch.column("item_id").to_pylist()
        for first, end, data, offsets in blocks(batch):
            doc, words = word_hashes(data, offsets, IS_ALNUM)
            bounds = runs(doc, end - first)
            items, spans, parts = [], [], []
            for i in range(end - first):
                own = words[bounds[i] : bounds[i + 1]]
                for start in range(max(len(own) - WINDOW + 1, min(len(own), 1))):
                    window = own[start : start + WINDOW]
                    size = min(SHINGLE, len(window))
                    grams, _ = shingles(window, np.zeros(len(window), np.int64), size)
                    items.append(names[first + i])
                    spans.append(window.view(np.int64))
                    parts.append(
                        [{"shingle": int(g), "size": size, "place": k} for k, g in enumerate(grams.view(np.int64))]
                    )
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(spans, pa.list_(pa.int64())), pa.array(parts, kind)],
                names=["item_id", "words", "shingles"],
            )


def windows_of(benchmark: DataFrame) -> DataFrame:
    """The windows of every item with their word hashes and shingles."""
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(_window_rows, _WINDOWS)


def _rarity(documents: DataFrame, marks: Broadcast, sizes: list[int]) -> DataFrame:
    """Occurrences of marked shingles in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks(batch):
                doc, words = word_hashes(data, offsets, IS_ALNUM)
                for size in sizes:
                    grams, _ = shingles(words, doc, size)
                    found, n = np.unique(grams[marked(marks.value, grams)], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.view(np.int64)), pa.array(np.full(len(found), size, np.int32)), pa.array(n)],
                        names=["shingle", "size", "n"],
                    )

    return (
        documents.select("text")
        .mapInArrow(count, "shingle long, size int, n long")
        .groupBy("shingle", "size")
        .agg(F.sum("n").alias("n"))
    )


def _occurrences(documents: DataFrame, marks: Broadcast, sizes: list[int]) -> DataFrame:
    """Every document with its number of words and the places of marked shingles.

    ``around`` holds the hashes of the words from 9 before to 9 after the place, with zeros
    beyond the document.
    """
    kind = pa.list_(
        pa.struct([("shingle", pa.int64()), ("size", pa.int32()), ("at", pa.int64()), ("around", pa.list_(pa.int64()))])
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, end, data, offsets in blocks(batch):
                doc, words = word_hashes(data, offsets, IS_ALNUM)
                n_docs = end - first
                bounds = runs(doc, n_docs)
                rows: list[list] = [[] for _ in range(n_docs)]
                for size in sizes:
                    grams, place = shingles(words, doc, size)
                    hit = np.flatnonzero(marked(marks.value, grams))
                    for gram, at in zip(grams[hit].view(np.int64).tolist(), place[hit].tolist()):
                        own = doc[at]
                        low, high = bounds[own], bounds[own + 1]
                        around = np.zeros(2 * _REACH + 1, np.int64)
                        a, b = max(at - _REACH, low), min(at + _REACH + 1, high)
                        around[a - at + _REACH : b - at + _REACH] = words[a:b].view(np.int64)
                        rows[own].append({"shingle": gram, "size": size, "at": at - low, "around": around})
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, n_docs), pa.array(np.diff(bounds)), pa.array(rows, kind)],
                    names=["doc_id", "n_words", "found"],
                )

    return documents.mapInArrow(
        find,
        "doc_id long, n_words long, found array<struct<shingle: long, size: int, at: long, around: array<long>>>",
    ).withColumn("row", F.monotonically_increasing_id())


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, spans`` for every row of ``documents``.

    ``spans`` are the maximal runs of hit words (first word, number of words).
    Null, empty or wordless texts have no words and no hits, and wordless items no window.
    Rows may repeat or lack a doc_id; each is answered. Items without an item_id mark words
    but are not listed. Empty tables and other columns are fine.
    """
    work = Workspace(documents, "decontamination")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    windows = work.put(windows_of(benchmark))
    tokens = work.put(
        windows.select(F.explode("shingles").alias("s")).select("s.shingle", "s.size").distinct()
    )
    sizes = sorted(r[0] for r in tokens.select("size").distinct().collect())
    counts = work.put(_rarity(docs, bit_map(tokens, "shingle"), sizes))
    ranked = (
        windows.withColumn("window", F.monotonically_increasing_id())
        .select("window", "item_id", "words", F.posexplode("shingles").alias("k", "s"))
        .select("window", "item_id", "words", "s.*")
        .join(counts, ["shingle", "size"], "left")
        .groupBy("window")
        .agg(
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "shingle", "size")).alias("rare"),
            F.first("item_id").alias("item_id"),
            F.first("words").alias("words"),
        )
        .where("rare.n > 0")
    )
    # equal windows of several items are verified once
    prefixes = work.put(
        ranked.groupBy("words", "rare.shingle", "rare.size", "rare.place").agg(
            F.collect_set("item_id").alias("items")
        )
    )
    found = work.put(_occurrences(docs, bit_map(prefixes, "shingle"), sizes))
    start = F.col("at") - F.col("place")
    length = F.size("words").cast("long")
    hits = (
        found.where(F.size("found") > 0)
        .select("row", "n_words", F.explode("found").alias("f"))
        .select("row", "n_words", "f.*")
        .join(prefixes, ["shingle", "size"])
        .where((start >= 0) & (start + length <= F.col("n_words")))
        .where(F.slice("around", F.lit(_REACH + 1) - F.col("place"), F.size("words")) == F.col("words"))
        .select("row", F.struct(start.alias("a"), (start + length).alias("b")).alias("span"), "items")
    )
    # a word can lie in several windows; the distinct hit words in order give the runs
    per_row = hits.groupBy("row").agg(
        F.sort_array(
            F.array_distinct(
                F.flatten(F.transform(F.collect_set("span"), lambda s: F.sequence(s["a"], s["b"] - 1)))
            )
        ).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    none = F.array(F.lit(None).cast("long"))
    near = F.arrays_zip(
        F.concat(none, F.slice("hit", 1, F.size("hit") - 1)).alias("before"),
        F.col("hit").alias("word"),
        F.concat(F.slice("hit", 2, F.size("hit")), none).alias("after"),
    )
    firsts = F.filter(near, lambda z: z["before"].isNull() | (z["before"] < z["word"] - 1))
    lasts = F.filter(near, lambda z: z["after"].isNull() | (z["after"] > z["word"] + 1))
    spans = F.zip_with(
        firsts,
        lasts,
        lambda x, y: F.struct(x["word"].alias("first_word"), (y["word"] - x["word"] + 1).alias("n_words")),
    )
    return found.select("row", "doc_id", "n_words").join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("hit"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(spans, F.array().cast("array<struct<first_word: bigint, n_words: bigint>>")).alias("spans"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` without any hit, all columns kept; rows without doc_id stay."""
    dirty = contamination(documents, benchmark).where("n_hit > 0").select("doc_id").distinct()
    return documents.join(dirty.withColumnRenamed("doc_id", "_dirty"), F.col("doc_id") == F.col("_dirty"), "left_anti")


_WORDS = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

CHECK = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, CASE WHEN len(words) < 10 THEN words ELSE words[i:i+9] END AS w
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(words) - 8, 2))) AS i) WHERE len(words) > 0),
lengths AS (SELECT DISTINCT len(w) AS n FROM windows),
places AS (
  SELECT doc_id, i, n, words[i:i+n-1] AS w FROM (
    SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, lengths WHERE len(words) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (w)),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op5_decontamination", CHECK)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each document repeats the benchmark (windows of ten words)."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
