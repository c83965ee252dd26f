"""Near-duplicate documents through SetSketch registers.

A document is its set of distinct five-word shingles. Each register holds the exponent of
a truncated minimum of exponentially distributed values, one per shingle; registers of a
union are the larger of the two, and equal registers are about as likely as the Jaccard
similarity. Four neighbouring registers make a band, and documents that share a band are
candidates. A likelihood over all registers drops hopeless candidates, the full shingle
sets decide the rest.

Nothing is emitted for every pair of a group:

* documents with equal sets are one class, found by a map-side aggregated signature;
* in a band bucket every member is first compared with a few centres, the members that
  collide most often and are the same ones in many buckets;
* members of buckets that still hold several components go through an exact prefix filter
  with bounds on length and position. Pairs inside one component, of too different sizes, or
  whose shared shingle comes too late in a prefix for the overlap needed, are never made.

The bands miss a pair of similarity 0.75 with a probability of 5e-6 (32 bands of 4).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import join_group_stats
from .bitmap import bit_map, marked
from .components import components
from .registry import query, table
from .tables import Workspace
from .text import blocks, mix, runs, shingles, whole_hash, word_hashes

SHINGLE = 5
SIMILARITY = 0.75
REGISTERS = 128
BAND = 4
CENTRES = 4  # members of a bucket that all others meet first
COUNT_BITS = 20  # cells of the table of shingle counts that orders prefixes
_LOG_BASE = np.log(1.001)
_RATE = 20.0
_TOP = 65_535
_SALT = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def document_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each document) for runs of documents."""
    for first, end, data, offsets in blocks(batch):
        doc, words = word_hashes(data, offsets)
        grams, place = shingles(words, doc, SHINGLE)
        bounds, gram_bounds = runs(doc, end - first), runs(doc[place], end - first)
        sets = []
        for i in range(end - first):
            n = bounds[i + 1] - bounds[i]
            if n >= SHINGLE:
                sets.append(np.unique(grams[gram_bounds[i] : gram_bounds[i + 1]]))
            elif n:
                sets.append(np.array([whole_hash(words[bounds[i] : bounds[i + 1]])], np.uint64))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield first, sets


def registers(sets: list[np.ndarray], slack: float = 2.0) -> np.ndarray:
    """SetSketch registers (documents x REGISTERS) of non-empty sets.

    Each shingle seeds a Poisson process whose points fall on registers at random; a
    register keeps its smallest point. Only points below a limit are drawn, and documents
    with a register still empty are drawn again with a higher limit, so the result does
    not depend on the limit.
    """
    n = np.array([len(s) for s in sets])
    limit = (np.log(REGISTERS) + slack) / n
    low = np.full(len(sets) * REGISTERS, np.inf)
    item = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), n)
    at = np.zeros(len(item))
    draw = 0
    while len(item):
        draw += 1
        bits = mix(item + np.uint64(draw * _SALT & _MASK))
        at = at - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / REGISTERS
        keep = at <= limit[doc]
        item, doc, at, bits = item[keep], doc[keep], at[keep], bits[keep]
        np.minimum.at(low, doc * REGISTERS + (bits & np.uint64(REGISTERS - 1)).astype(np.int64), at)
    low = low.reshape(len(sets), REGISTERS)
    out = np.clip(np.floor(1 - np.log(low / _RATE) / _LOG_BASE), 0, _TOP).astype(np.uint16)
    short = np.flatnonzero(np.isinf(low).any(axis=1))
    if len(short):
        out[short] = registers([sets[i] for i in short], slack * 2 + 1)
    return out


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    base = np.exp(_LOG_BASE)
    return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / _LOG_BASE


_GRID = np.linspace(0, 1, 201)


def log_likelihood(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
    """Joint log-likelihood of the registers for every similarity of the grid."""
    u = n_a / (n_a + n_b)
    grid = np.minimum(_GRID, min(u, 1 - u) / max(u, 1 - u))
    more, less = _p(u - (1 - u) * grid), _p((1 - u) - u * grid)
    tiny = 1e-12
    up, down = int((a > b).sum()), int((a < b).sum())
    return (
        up * np.log(np.maximum(more, tiny))
        + down * np.log(np.maximum(less, tiny))
        + (len(a) - up - down) * np.log(np.maximum(1 - more - less, tiny))
    )


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """The most likely Jaccard similarity."""
    return float(_GRID[int(np.argmax(log_likelihood(a, b, n_a, n_b)))])


def _hopeless(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, similarity: float) -> bool:
    """No similarity at or above the threshold is within exp(-20) of the most likely one."""
    if min(n_a, n_b) < similarity * max(n_a, n_b) - 1e-9:
        return True
    fit = log_likelihood(a, b, n_a, n_b)
    return bool(fit[_GRID >= similarity - 0.005].max() < fit.max() - 20)


def _set_sums(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit sums over each set, equal for equal sets."""
    return np.array(
        [[int(s.sum(dtype=np.uint64)), int(mix(s ^ np.uint64(_SALT)).sum(dtype=np.uint64))] for s in sets], np.uint64
    ).reshape(-1, 2).view(np.int64)


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for first, sets in document_sets(batch):
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            bands: list = [None] * len(sets)
            if len(full):
                packed = registers([sets[i] for i in full]).view(np.uint64).view(np.int64)
                for row, i in enumerate(full):
                    bands[i] = packed[row]
            sums = _set_sums(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(first, len(sets)).cast(pa.int64()),
                    pa.array(n),
                    pa.array(sums[:, 0]),
                    pa.array(sums[:, 1]),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "sig1", "sig2", "bands"],
            )


def sketch(documents: DataFrame) -> DataFrame:
    """One row per document: size and two 64-bit sums of its set, and its band values.

    A band value is four 16-bit registers side by side, so the bands are the registers.
    """
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _sketch_rows, "doc_id long, n_shingles long, sig1 long, sig2 long, bands array<long>"
    )


def _class(n: str = "n_shingles") -> Column:
    """One number for all documents with equal sets."""
    return F.xxhash64(n, "sig1", "sig2")


def _sides(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, regs, members``: registers and full set of every class in ``wanted(id, doc)``.

    Sets are derived again from the texts of these documents, so no table of all sets is
    ever stored, and texts are not shuffled: a bit map of the wanted documents leaves out
    others. A document with several texts gives several classes, of which the wanted ones stay.
    """
    marks = bit_map(wanted.select(F.xxhash64("doc").alias("key")), "key")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(marked(marks.value, keys)))
            for _, sets in document_sets(batch):
                sets = [s for s in sets if len(s)]
                sums = _set_sums(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(sums[:, 0]),
                        pa.array(sums[:, 1]),
                        pa.array([r.tobytes() for r in (registers(sets) if sets else [])], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["n_shingles", "sig1", "sig2", "regs", "members"],
                )

    docs = documents.select(F.xxhash64(F.col("doc_id").cast("long")).alias("key"), "text").where("doc_id is not null")
    found = docs.mapInArrow(rows, "n_shingles long, sig1 long, sig2 long, regs binary, members binary")
    return found.select(_class().alias("id"), "regs", "members").join(wanted, "id", "left_semi")


def _linked(similarity: float):
    hundredths = round(similarity * 100)

    @F.pandas_udf("boolean")
    def linked(regs_a: pd.Series, set_a: pd.Series, regs_b: pd.Series, set_b: pd.Series) -> pd.Series:
        out = []
        for ra, sa, rb, sb in zip(regs_a, set_a, regs_b, set_b):
            a, b = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
            ra, rb = np.frombuffer(ra, np.uint16), np.frombuffer(rb, np.uint16)
            if _hopeless(ra, rb, len(a), len(b), similarity):
                out.append(False)
                continue
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= hundredths * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    return linked


def verified(pairs: DataFrame, sides: DataFrame, similarity: float, work: Workspace) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets are similar enough, written as a table."""
    left = sides.select(F.col("id").alias("a"), F.col("regs").alias("regs_a"), F.col("members").alias("set_a"))
    right = sides.select(F.col("id").alias("b"), F.col("regs").alias("regs_b"), F.col("members").alias("set_b"))
    return work.put(
        pairs.join(right, "b").join(left, "a")
        .where(_linked(similarity)("regs_a", "set_a", "regs_b", "set_b"))
        .select("a", "b")
    )


def _only(sides: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sides that occur in a pair; the bit map drops the others before any shuffle."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    marks = bit_map(wanted.select(F.xxhash64("id").alias("key")), "key")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = marked(marks.value, batch.column("key").to_numpy().view(np.uint64))
            yield batch.filter(pa.array(keep)).select(["id", "regs", "members"])

    return sides.withColumn("key", F.xxhash64("id")).mapInArrow(rows, "id long, regs binary, members binary")


def _untested(pairs: DataFrame, tested: list[DataFrame], work: Workspace) -> DataFrame:
    out = pairs.distinct()
    for old in tested:
        out = out.join(old, ["a", "b"], "left_anti")
    return work.put(out)


def _prefix_pairs(sides: DataFrame, similarity: float, work: Workspace) -> DataFrame:
    """Pairs ``a, b`` of different groups that share a shingle of both prefixes.

    With the shingles of all sets in one order, rare ones first, sets that are similar enough
    share one of their first ``n - ceil(similarity * n) + 1`` shingles. A table of counts of
    fixed size gives the order, and any order is right.

    Two sets of n and m shingles need an overlap of s / (1 + s) * (n + m), and the first
    shingle that they share at place i leaves n - i at most. So a shingle at a late place is of use
    only against small enough sets: each row carries that ``largest`` size. Rows that no other
    set of their shingle is small enough for are left out, then shingles of one group.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(1 << COUNT_BITS, np.int64)
            for members in batch.column("members"):
                cells = np.frombuffer(members.as_buffer(), np.uint64) >> np.uint64(64 - COUNT_BITS)
                np.add.at(total, cells.astype(np.int64), 1)
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["cell", "n"])

    counted = sides.select("members").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << COUNT_BITS, np.int64)  # bounds what the driver gets
    counts[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    shared = sides.sparkSession.sparkContext.broadcast(counts)
    hundredths = round(similarity * 100)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, groups = batch.column("id").to_pylist(), batch.column("group").to_pylist()
            tokens, sizes, largest = [np.zeros(0, np.uint64)], [], [np.zeros(0, np.int64)]
            kept: list[int] = []
            for members in batch.column("members"):
                own = np.frombuffer(members.as_buffer(), np.uint64)
                rare = np.lexsort((own, shared.value[(own >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]))
                take = len(own) - -(-len(own) * hundredths // 100) + 1
                tokens.append(own[rare[:take]])
                largest.append((100 + hundredths) * (len(own) - np.arange(take)) // hundredths - len(own))
                kept.append(take)
                sizes.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens).view(np.int64)),
                    pa.array(np.repeat(np.array(ids, np.int64), kept)),
                    pa.array(np.repeat(np.array(groups, np.int64), kept)),
                    pa.array(np.repeat(np.array(sizes, np.int64), kept)),
                    pa.array(np.concatenate(largest)),
                ],
                names=["token", "id", "group", "n", "largest"],
            )

    schema = "token long, id long, group long, n long, largest long"
    rows = work.put(sides.select("id", "group", "members").mapInArrow(prefixes, schema))
    met = _meeting(_meeting(rows, work), work)
    per_group = met.groupBy("token", "group").agg(F.count(F.lit(1)).alias("n"))
    main = per_group.groupBy("token").agg(F.max_by("group", F.struct("n", "group")).alias("main"))
    named = met.join(main, "token")
    x = named.where("group <> main").select(
        "token", F.col("id").alias("x"), F.col("group").alias("gx"), F.col("n").alias("nx"), F.col("largest").alias("lx")
    )
    y = named.select(
        "token", "main", F.col("id").alias("y"), F.col("group").alias("gy"), F.col("n").alias("ny"), F.col("largest").alias("ly")
    )
    apart = F.expr("gx <> gy and (gy = main or x < y)")
    close = 100 * F.least("nx", "ny") >= hundredths * F.greatest("nx", "ny")
    reached = (F.col("ny") <= F.col("lx")) & (F.col("nx") <= F.col("ly"))
    return x.join(y, [x.token == y.token, apart, close, reached]).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    )


def _meeting(rows: DataFrame, work: Workspace) -> DataFrame:
    """The rows that can meet one of another group: its set is small enough for them, and they for it.

    Per shingle the smallest set and the farthest reach come from map-side aggregates, and with
    them whether there is more than one group.
    """
    ends = (
        rows.groupBy("token")
        .agg(
            F.min("n").alias("smallest"), F.max("largest").alias("farthest"),
            F.min("group").alias("first"), F.max("group").alias("last"), F.count(F.lit(1)).alias("n_rows"),
        )
        .where(F.col("first") != F.col("last"))
        .select("token", "smallest", "farthest", "n_rows")
    )
    # a shingle that very many sets share must not put all of its rows into one task
    return work.put(
        join_group_stats(rows, ends, ["token"], "n_rows")
        .where((F.col("smallest") <= F.col("largest")) & (F.col("n") <= F.col("farthest")))
        .select(rows.columns)
    )


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents``.

    Two documents are linked when the Jaccard similarity of their sets of five-word
    shingles is at least ``similarity``; a component's smallest doc_id is kept.

    * Fewer than five words: the whole sequence is the one shingle.
    * Null, empty or blank text: no shingle, linked with nothing, kept.
    * Null doc_id: such a row joins no component; component_id is null and it is kept.
    * Repeated rows: each is returned; rows with one doc_id share its component, also if
      their texts differ: then the document is linked with all that any of its texts is.
    * Empty table: no rows. Other columns are ignored.
    """
    work = Workspace(documents, "near_duplicates")
    sketches = work.put(sketch(documents))
    key = ["n_shingles", "sig1", "sig2"]
    filled = sketches.where("n_shingles > 0 and doc_id is not null").withColumn("class", _class())
    classes = work.put(filled.groupBy("class").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("n")))
    # one row per class carries the bands: that of its smallest document
    shared = classes.where("n > 1").select("class", "doc")
    placed = work.put(
        filled.join(shared, "class", "left")
        .where(F.col("doc_id") == F.coalesce("doc", "doc_id"))
        .select("class", F.col("doc_id").alias("doc"), "n_shingles", "bands")
        .dropDuplicates(["class"])
    )
    rows = placed.select(F.col("class").alias("rep"), "doc", "n_shingles", F.posexplode("bands").alias("band", "value"))
    bucket = ["band", "value"]
    sizes = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = work.put(rows.join(sizes, bucket))
    # the members that collide most often come first in their buckets: they are the likeliest
    # to be linked with many others, and they are the same ones in many buckets
    popular = members.groupBy("rep").agg(F.sum("n").alias("met"))
    first = Window.partitionBy(*bucket).orderBy(F.col("met").desc(), "rep")
    centres = work.put(
        members.select("rep", "n_shingles", *bucket)
        .join(popular, "rep")
        .withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= CENTRES)
        .select(*bucket, F.col("rep").alias("centre"), F.col("n_shingles").alias("n_centre"))
    )
    wanted = members.groupBy(F.col("rep").alias("id")).agg(F.min("doc").alias("doc"))
    members = members.select("rep", "n_shingles", *bucket)
    sides = work.put(_sides(documents, wanted).dropDuplicates(["id"]))
    similar_size = 100 * F.least("n_shingles", "n_centre") >= round(similarity * 100) * F.greatest(
        "n_shingles", "n_centre"
    )
    # every member against a few centres of its buckets
    met = members.join(centres, bucket).where((F.col("rep") != F.col("centre")) & similar_size)
    tested = _untested(met.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")), [], work)
    links = verified(tested, _only(sides, tested), similarity, work)
    # texts of one doc_id belong together as well
    several = filled.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z")
    own = several.join(filled.select("doc_id", F.col("class").alias("b")), "doc_id").where("a <> b").select("a", "b")
    links = work.put(links.union(own).distinct())
    groups = work.put(components(links, work))
    # buckets that still hold several components: an exact prefix filter finds all their similar pairs
    named = members.join(groups, members.rep == groups.node, "left").select(
        "rep", *bucket, F.coalesce("component", "rep").alias("group")
    )
    split = named.groupBy(*bucket).agg((F.min("group") != F.max("group")).alias("split")).where("split")
    apart = named.join(split.select(*bucket), bucket, "left_semi").select(F.col("rep").alias("id"), "group").distinct()
    rest = work.put(sides.join(apart, "id"))
    more = _untested(_prefix_pairs(rest, similarity, work), [tested], work)
    links = links.union(verified(more, _only(sides, more), similarity, work))
    groups = work.put(components(links, work))
    work.drop(sides, centres, rest)

    # back to all documents: a component has the smallest doc_id of all its classes
    owned = classes.join(groups, classes["class"] == groups.node, "left").select(
        "class", "doc", F.coalesce("component", "class").alias("component")
    )
    lowest = owned.groupBy("component").agg(F.min("doc").alias("component_id"))
    labels = owned.join(lowest, "component").select("class", "component_id")
    return (
        sketches.select("doc_id", *key, _class().alias("class"))
        .join(labels, "class", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

CHECK = rf"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce({_WORDS}, []) AS words FROM documents),
grams AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN words ELSE words[i:i+4] END AS gram
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(words) - 3, 2))) AS i) WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
  FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
reach AS (
  SELECT a AS doc_id, least(a, b) AS seen FROM links
  UNION SELECT l.b, r.seen FROM reach r JOIN links l ON l.a = r.doc_id),
lowest AS (SELECT doc_id, least(doc_id, min(seen)) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  doc_id = coalesce(component_id, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""


@query("op4_setsketch", CHECK)
def op4_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents (five words, similarity 0.75)."""
    return near_duplicates(table(spark, sf_dir, "documents"))
