"""Repeated runs of lines, found with a suffix array over line-id sequences.

A document is the sequence of its lines that have a word. Distributed prefix doubling ranks
its suffixes: first by one line, then by 2, 4, ... lines, each round ranking the pairs of
ranks that lie 2^k lines apart. Suffixes whose prefix occurs once are discarded, since their
longest common prefix with any other suffix is known by then; so every round is smaller than
the one before. Suffixes of equal rank after ``min_lines`` lines form the interval of the
suffix array whose common prefix is at least that long. All of an interval but its first
suffix begin a later copy, and overlapping copies add up to maximal runs. Doubling ends at ``min_lines``:
with two lines, as the query asks, it is a single step.

A line's rank comes from sorting distinct ids, and an interval's first suffix is a map-side
aggregated minimum, so a line that every third document has is no burden for one task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators.ordering import positions
from .registry import query, table
from .tables import Workspace, steady, unused

MIN_LINES = 2
LONG_LINE_WORDS = 50

_WORD = r"[^\x20\x09-\x0D]+"


def line_table(documents: DataFrame, long_line_words: int = LONG_LINE_WORDS) -> DataFrame:
    """``doc, row, seq, at, h1, h2, long``: one row per line that has a word.

    ``doc`` orders documents (those without an id last), ``row`` tells repeated rows apart,
    ``at`` is the line's number among all lines and ``seq`` its number among the worded ones.
    """
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("at"), line.alias("line")))
    worded = F.filter(lines, lambda s: s["line"].rlike(_WORD))
    many = F.when(
        F.length("line") >= 2 * long_line_words - 1, F.regexp_count("line", F.lit(_WORD)) >= long_line_words
    ).otherwise(False)
    return (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .select(
            F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id").alias("doc"),
            F.monotonically_increasing_id().alias("row"),  # before the lines are spread
            "text",
        )
        .select("doc", "row", F.posexplode(worded).alias("seq", "s"))
        .select("doc", "row", "seq", "s.at", "s.line")
        .select(
            "doc", "row", "seq", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
            many.alias("long"),
        )
    )


def _ranked(suffixes: DataFrame, by: list[str], work: Workspace) -> DataFrame:
    """Replace the key columns ``by`` by their rank; suffixes with a key of their own are discarded."""
    groups = work.put(suffixes.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*by))
    ranks = positions(groups, [F.col(c) for c in by], name="ranks").withColumnRenamed("pos", "rank")
    rest = [c for c in suffixes.columns if c not in by]
    return work.put(suffixes.join(ranks, by).select(*rest, F.col("rank").alias("r")))


def _at_distance(suffixes: DataFrame, lines: int) -> DataFrame:
    """Add ``after``, the rank of the suffix ``lines`` further on; suffixes without one are dropped."""
    by_place = Window.partitionBy("row").orderBy("seq").rangeBetween(lines, lines)
    return suffixes.withColumn("after", F.max("r").over(by_place)).where("after is not null")


def later_copies(lines: DataFrame, min_lines: int, work: Workspace) -> DataFrame:
    """``row, seq`` of every suffix whose first ``min_lines`` lines also start an earlier suffix."""
    base = lines.select("doc", "row", "seq", "h1", "h2")
    now, reach = _ranked(base, ["h1", "h2"], work), 1
    while 2 * reach <= min_lines:
        now, reach = _ranked(_at_distance(now, reach), ["r", "after"], work), 2 * reach
    if reach < min_lines:  # two overlapping prefixes of 2^k lines cover the rest
        now = _ranked(_at_distance(now, min_lines - reach), ["r", "after"], work)
    return _not_first(now, ["r"])


def _not_first(suffixes: DataFrame, by: list[str]) -> DataFrame:
    place = F.struct("doc", "row", "seq")
    first = suffixes.groupBy(*by).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return suffixes.join(first.drop("n"), by).where(place > F.col("first")).select("row", "seq")


def repeated_lines(
    documents: DataFrame, min_lines: int = MIN_LINES, long_line_words: int = LONG_LINE_WORDS
) -> DataFrame:
    """``row, removed, n_removed, n_runs`` of every one of the ``steady`` documents that has later copies."""
    work = Workspace(documents, "line_runs")
    lines = work.put(line_table(documents, long_line_words))
    starts = later_copies(lines, min_lines, work).select(
        "row", F.explode(F.sequence(F.col("seq"), F.col("seq") + (min_lines - 1))).alias("seq")
    )
    alone = _not_first(lines.where("long").select("doc", "row", "seq", "h1", "h2"), ["h1", "h2"])
    doomed = starts.union(alone).distinct()
    placed = lines.select("row", "seq", "at").join(doomed, ["row", "seq"])
    before = F.lag("seq").over(Window.partitionBy("row").orderBy("seq"))
    return work.put(
        placed.withColumn("opens", F.coalesce(before < F.col("seq") - 1, F.lit(True)).cast("long"))
        .groupBy("row")
        .agg(
            F.sort_array(F.collect_list("at")).alias("removed"),
            F.count(F.lit(1)).alias("n_removed"),
            F.sum("opens").alias("n_runs"),
        )
    )


@F.pandas_udf(StringType())
def _without(texts: pd.Series, removed: pd.Series) -> pd.Series:
    out = []
    for text, gone in zip(texts, removed):
        if gone is not None and text is not None:
            gone = set(gone.tolist())
            text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
        out.append(text)
    return pd.Series(out, dtype=object)


def _worded(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n", -1), lambda line: line.rlike(_WORD))).cast("long")


def dedup_lines(
    documents: DataFrame, min_lines: int = MIN_LINES, long_line_words: int = LONG_LINE_WORDS
) -> DataFrame:
    """``documents`` with later copies of line runs deleted from ``text``, and what was deleted.

    A line goes if it lies in a run of ``min_lines`` worded lines that also starts earlier (in
    a document with a smaller doc_id, or further up in the same one), or if it has at least
    ``long_line_words`` words and occurs earlier. Lines compare byte by byte.

    Adds ``n_lines`` (worded lines), ``n_removed`` and ``n_runs`` (maximal deleted runs); a column
    of that name in the input is replaced. Lines without a word are never part of a run and
    stay, but a document that loses all its worded lines becomes empty. Null texts stay null
    and have no lines. Rows without doc_id come last; of repeated rows the first stays.
    """
    documents = steady(documents, "line_runs_input")
    gone = repeated_lines(documents, min_lines, long_line_words)
    columns = documents.columns
    own = {"n_lines", "n_removed", "n_runs"}
    row, removed = unused(documents, "row"), unused(documents, "removed")
    numbered = documents.drop(*own).withColumn(row, F.monotonically_increasing_id())
    # the deletions grow with the input, so they are not broadcast at any size
    joined = numbered.join(gone.withColumnsRenamed({"row": row, "removed": removed}).hint("merge"), row, "left")
    n_lines = F.coalesce(_worded(F.col("text")), F.lit(0).cast("long"))
    changed = F.when(F.col("n_removed") == F.col("n_lines"), F.lit("")).when(
        F.col("n_removed") > 0, _without("text", removed)
    ).otherwise(F.col("text"))
    return (
        joined.withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(n_lines))
        .withColumn("text", changed)
        .withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
        .withColumn("n_runs", F.coalesce("n_runs", F.lit(0).cast("long")))
        .select(*[c for c in columns if c not in own], "n_lines", "n_removed", "n_runs")
    )


CHECK = rf"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
every AS (SELECT doc_id, a[place] AS line, place FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS place FROM raw)),
lines AS (
  SELECT doc_id, place, line, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS seq,
    len(regexp_extract_all(line, '{_WORD}')) >= {LONG_LINE_WORDS} AS is_long
  FROM every WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs AS (
  SELECT x.doc_id, x.seq, x.line AS l1, y.line AS l2
  FROM lines x JOIN lines y ON x.doc_id = y.doc_id AND y.seq = x.seq + 1),
copies AS (
  SELECT doc_id, seq FROM (
    SELECT doc_id, seq, row_number() OVER (PARTITION BY l1, l2 ORDER BY doc_id, seq) AS nth FROM pairs) WHERE nth > 1),
alone AS (
  SELECT doc_id, seq FROM (
    SELECT doc_id, seq, row_number() OVER (PARTITION BY line ORDER BY doc_id, seq) AS nth
    FROM lines WHERE is_long) WHERE nth > 1),
doomed AS (SELECT doc_id, seq FROM copies UNION SELECT doc_id, seq + 1 FROM copies UNION SELECT doc_id, seq FROM alone),
opened AS (
  SELECT doc_id, count(*) AS n_removed,
    count(*) FILTER (before IS NULL OR before < seq - 1) AS n_runs
  FROM (SELECT doc_id, seq, lag(seq) OVER (PARTITION BY doc_id ORDER BY seq) AS before FROM doomed) GROUP BY doc_id),
kept AS (
  SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.place) AS text
  FROM every e LEFT JOIN lines l ON l.doc_id = e.doc_id AND l.place = e.place
  LEFT JOIN doomed x ON x.doc_id = l.doc_id AND x.seq = l.seq
  WHERE x.seq IS NULL GROUP BY e.doc_id),
totals AS (SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs,
  CASE WHEN d.text IS NOT NULL THEN sha256(CASE WHEN n_removed = n_lines THEN '' ELSE coalesce(k.text, '') END) END
    AS kept_sha256
FROM documents d LEFT JOIN totals USING (doc_id) LEFT JOIN opened USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


@query("op10_line_runs", CHECK)
def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup deletes from each document (runs of two lines, single lines of 50 words)."""
    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))
