"""Collocations: phrases of two to four words that keep together, per language.

Counting is by top-order marginalisation. Every word starts one window: itself and the words
after it in its piece, up to four, padded with empty strings. Only these longest windows are
counted, and one Spark ROLLUP over (lang, w1, w2, w3, w4) sums them into the counts of all
shorter prefixes: each occurrence of a phrase is a prefix of exactly one window, so there
is no separate explosion per phrase length. The shortest level is the number of words.

Windows that can't matter are cut short before they are shuffled. A phrase with at least
``min_count`` occurrences has only runs of two (and of three) words with as many, so first
passes count hashes of such runs, those of three only where both pairs are common, and keep
the common ones in bit maps of fixed size; a window ends, padded, where a run isn't in
them. Too many runs in a map cost time, never a count: what is counted is words, and each
prefix that can reach ``min_count`` is complete. Workers add up the equal windows of a
million words before Spark sees them, so a very common phrase is a few rows.

Null and empty texts have no words, a null language is ``und`` (and joins one of that name),
repeated rows count again, ties are in the order stated, other columns are left out, an
empty table gives an empty one. Texts are never cut; a word may have any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bitmap import bit_map, marked
from .hash_counts import PACKED, frequent, marking, packed
from .registry import query, table
from .tables import Workspace
from .text import EXACT_VALUE, PLACE, blocks, hash_long, mix, prefix_sums, span_hashes, word_spans

MIN_COUNT = 30
LONGEST = 4
COVERED = 80  # percent of a phrase's occurrences that a longer one may have without replacing it
TOP = 2000
NO_LANGUAGE = "und"
UNIT_WORDS = 1_000_000  # words whose equal windows a worker adds up at once
UNIT_RUNS = 2_000_000
THINNED = 2  # passes that look for common runs, of two words and of three

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IN_WORD = ~_PIECE_END
_IN_WORD[[0x20, 0x09]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of every word, and whether the next word follows it in its piece."""
    doc, start, end = word_spans(data, offsets, _IN_WORD)
    breaks = np.concatenate([[0], np.cumsum(_PIECE_END[data])])
    follows = np.zeros(len(doc), bool)
    follows[:-1] = (doc[1:] == doc[:-1]) & (breaks[start[1:]] == breaks[end[:-1]])
    return doc, start, end, follows


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return hash_long(span_hashes(prefix_sums(data, EXACT_VALUE), start, end), data, start, end)


def _run_keys(words: np.ndarray, lang: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on, and of their language."""
    total = lang[at] * PLACE[size]
    for k in range(size):
        total = total + words[at + k] * PLACE[k]
    return mix(total)


def _common_runs(words: np.ndarray, lang: np.ndarray, follows: np.ndarray, maps: list[np.ndarray]) -> list[np.ndarray]:
    """For sizes 2, 3, .. where a common run of so many words begins; the last size isn't looked up yet."""
    found, run = [], follows
    for size, cells in enumerate([*maps, None], 2):
        if cells is not None:
            at = np.flatnonzero(run)
            run = run.copy()
            run[at] = marked(cells, marking(_run_keys(words, lang, at, size)))
        found.append(run)
        run = run & np.append(run[1:], False)
    return found


def _language_hashes(languages: pa.Array) -> np.ndarray:
    encoded = pc.dictionary_encode(languages)
    raw = [np.frombuffer(name.encode(), np.uint8) for name in encoded.dictionary.to_pylist()]
    hashes = np.array([mix(np.array([len(r), *(EXACT_VALUE[r] * np.arange(1, len(r) + 1, dtype=np.uint64))], np.uint64).sum(keepdims=True))[0] for r in raw], np.uint64)
    return hashes[encoded.indices.to_numpy()]


def common_runs(documents: DataFrame, min_count: int, maps: list[Broadcast]) -> DataFrame:
    """``key``: hashes of runs of words that occur often enough, or share a hash that does.

    The runs have one word more than those of the last of ``maps``, of which they consist.
    """
    size_of_run = len(maps) + 2

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        size = 0

        for batch in batches:
            languages = _language_hashes(batch.column("lang"))
            for row, stop, data, offsets in blocks(batch):
                data = _LOWER[data]
                doc, start, end, follows = _words(data, offsets)
                words, lang = _word_hashes(data, start, end), languages[row:stop][doc]
                run = _common_runs(words, lang, follows, [m.value for m in maps])[-1]
                kept.append(_run_keys(words, lang, np.flatnonzero(run), size_of_run))
                size += len(kept[-1])
                if size >= UNIT_RUNS:
                    yield packed(np.concatenate(kept), min_count)
                    kept, size = [], 0
        if size:
            yield packed(np.concatenate(kept), min_count)

    return frequent(documents.mapInArrow(counted, PACKED), min_count)


def longest_windows(documents: DataFrame, min_count: int, longest: int, unit_words: int = UNIT_WORDS) -> DataFrame:
    """``lang, w1 .. wN, n``: windows at every word, padded with empty strings, added up per unit of words."""
    maps: list[Broadcast] = []
    for _ in range(min(longest - 1, THINNED)):
        maps.append(bit_map(common_runs(documents, min_count, maps), "key"))
    names = [f"w{k}" for k in range(1, longest + 1)]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[pa.Array] = []
        reaches: list[np.ndarray] = []
        languages: list[pa.Array] = []
        size = 0
        for batch in batches:
            hashes = _language_hashes(batch.column("lang"))
            for row, stop, data, offsets in blocks(batch):
                data = _LOWER[data]
                doc, start, end, follows = _words(data, offsets)
                runs = _common_runs(_word_hashes(data, start, end), hashes[row:stop][doc], follows, [m.value for m in maps])
                # how many words the window at each word has: as many as all its runs are common for
                reach = np.ones(len(doc), np.uint8)
                run = follows
                for k in range(longest - 1):
                    run = runs[k] if k < len(maps) else run & np.append(run[1:], False)
                    reach += run
                lengths = np.concatenate([[0], np.cumsum(end - start)])
                texts.append(pa.LargeStringArray.from_buffers(len(doc), pa.py_buffer(lengths), pa.py_buffer(data[_IN_WORD[data]])))
                reaches.append(reach)
                languages.append(batch.column("lang").slice(row, stop - row).take(pa.array(doc)))
                size += len(doc)
                if size >= unit_words:
                    yield from _added_up(texts, reaches, languages, names)
                    texts, reaches, languages, size = [], [], [], 0
        if size:
            yield from _added_up(texts, reaches, languages, names)

    schema = ", ".join(["lang string", *[f"{w} string" for w in names], "n long"])
    return documents.mapInArrow(windows, schema)


def _added_up(texts: list[pa.Array], reaches: list[np.ndarray], languages: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Equal windows of a unit as one row each; words are told apart as strings, not by hashes."""
    words = pa.chunked_array(texts).combine_chunks().dictionary_encode()
    langs = pa.chunked_array(languages).combine_chunks().dictionary_encode()
    code = words.indices.to_numpy().astype(np.int64) + 1  # 0 is the padding
    lang = langs.indices.to_numpy().astype(np.int64)
    reach = np.concatenate(reaches)
    strings = pa.concat_arrays([pa.array([""], pa.large_string()), words.dictionary])
    for wanted in (reach == 1, reach > 1):
        at = np.flatnonzero(wanted)
        if not len(at):
            continue
        columns = [lang[at]]
        for k in range(len(names)):
            inside = reach[at] > k
            columns.append(np.where(inside, code[np.where(inside, at + k, 0)], 0))
            if not inside.any():
                break
        group = columns[0]
        for column in columns[1:]:  # dense numbers of ever longer prefixes
            _, group = np.unique((group << 32) | column, return_inverse=True)
        _, first, n = np.unique(group, return_index=True, return_counts=True)
        out = [langs.dictionary.take(pa.array(columns[0][first])).cast(pa.string())]
        for k in range(len(names)):
            chosen = columns[k + 1][first] if k + 1 < len(columns) else np.zeros(len(first), np.int64)
            out.append(strings.take(pa.array(chosen)).cast(pa.string()))
        whole = pa.RecordBatch.from_arrays([*out, pa.array(n, pa.int64())], names=["lang", *names, "n"])
        for k in range(0, whole.num_rows, 1 << 16):
            yield whole.slice(k, 1 << 16)


def phrase_counts(documents: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> DataFrame:
    """``lang, k, words, f``: all phrases of up to ``longest`` words found ``min_count`` times or more, and
    with ``k`` 0 the number of words of each language."""
    docs = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col("text").cast("string").alias("text")
    )
    names = [f"w{k}" for k in range(1, longest + 1)]
    counted = longest_windows(docs, min_count, longest).groupBy("lang", *names).agg(F.sum("n").alias("n"))
    summed = counted.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    # the rolled-up columns are the lowest bits: 0 for whole windows, all words for a language's total
    k = sum([(F.col("rolled") < (1 << j)).cast("int") for j in range(longest)], F.lit(0))
    leveled = summed.where(F.col("rolled") < (1 << longest)).select("lang", k.alias("k"), F.array(*names).alias("words"), "f")
    # a prefix that ends in padding is only a part of the shorter phrase, whose own level has all of it
    whole = (F.col("k") == 0) | ((F.col("f") >= min_count) & (F.get("words", F.col("k") - 1) != ""))
    return leveled.where(whole).select("lang", "k", F.slice("words", F.lit(1), F.col("k")).alias("words"), "f")


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(
    documents: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, covered: int = COVERED
) -> DataFrame:
    """All phrases of two words or more that no longer one covers: ``lang, phrase, words, a, l, r, n, score``.

    ``l`` and ``r`` are the counts of both parts at the cut that holds worst, the first such cut.
    """
    work = Workspace(documents, "collocations")
    grams = work.put(phrase_counts(documents, min_count, longest))
    known = grams.where("k > 0").select("lang", _phrase(F.col("words")).alias("part"), "f")
    phrases = grams.where("k > 1").select("lang", "words", "k", F.col("f").alias("a"))
    cuts = phrases.select("*", F.explode(F.expr("sequence(1, k - 1)")).alias("cut")).select(
        "lang", "words", "a", "cut",
        _phrase(F.slice("words", F.lit(1), F.col("cut"))).alias("left"),
        _phrase(F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut"))).alias("right"),
    )
    left = known.select("lang", F.col("part").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("part").alias("right"), F.col("f").alias("r"))
    # exact beyond 64 bits: a whole-number division of decimals
    score = F.expr("cast(a as decimal(20, 0)) * cast(2000000 as decimal(7, 0)) div cast(l + r as decimal(20, 0))")
    worst = (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .withColumn("score", score)
        .groupBy("lang", "words", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
        .select("lang", "words", _phrase(F.col("words")).alias("phrase"), "a", "worst.l", "worst.r", "worst.score")
    )
    parts = phrases.where("k > 2").select("lang", "words", "k", "a", F.explode(F.expr("sequence(2, k - 1)")).alias("size"))
    inside = parts.select(
        "lang", "a",
        F.explode(
            F.transform(F.expr("sequence(1, k - size + 1)"), lambda s: _phrase(F.slice("words", s, F.col("size"))))
        ).alias("phrase"),
    )
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    totals = grams.where("k = 0").select("lang", F.col("f").alias("n"))
    return (
        worst.join(longer, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
        .join(totals, "lang")
        .select("lang", "phrase", "words", "a", "l", "r", "n", "score")
    )


_SQL = f"""WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '{NO_LANGUAGE}') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT d, lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs),
split AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
placed AS (SELECT p, lang, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split),
led AS (SELECT lang, w AS w1, lead(w, 1) OVER pw AS w2, lead(w, 2) OVER pw AS w3, lead(w, 3) OVER pw AS w4
  FROM placed WINDOW pw AS (PARTITION BY p ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM led GROUP BY lang),
grams AS (
  SELECT lang, [w1] AS words, count(*) AS f FROM led GROUP BY ALL HAVING count(*) >= {MIN_COUNT}
  UNION ALL SELECT lang, [w1, w2], count(*) FROM led WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {MIN_COUNT}
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM led WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {MIN_COUNT}
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM led WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
cuts AS (SELECT lang, words, f AS a, unnest(range(1, len(words))) AS cut FROM grams WHERE len(words) > 1),
scored AS (SELECT c.lang, c.words, c.a, c.cut, x.f AS l, y.f AS r,
  CAST(2000000::HUGEINT * c.a // (x.f + y.f) AS BIGINT) AS score FROM cuts c
  JOIN grams x ON x.lang = c.lang AND x.words = c.words[1:c.cut]
  JOIN grams y ON y.lang = c.lang AND y.words = c.words[c.cut + 1:]),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1),
sizes AS (SELECT lang, words, f, unnest(range(2, len(words))) AS size FROM grams WHERE len(words) > 2),
starts AS (SELECT lang, words, f, size, unnest(range(1, len(words) - size + 2)) AS s FROM sizes),
inside AS (SELECT lang, words[s:s + size - 1] AS words, max(f) AS longer FROM starts GROUP BY ALL),
kept AS (SELECT w.lang, array_to_string(w.words, ' ') AS phrase, w.a, w.l, w.r, t.n, w.score FROM worst w
  LEFT JOIN inside i ON i.lang = w.lang AND i.words = w.words JOIN totals t ON t.lang = w.lang
  WHERE i.longer IS NULL OR 100 * i.longer < {COVERED} * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a, l, r, n, score FROM kept QUALIFY rank <= {TOP}"""


@query("op12_collocations", _SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best 2000 collocations; strings compare by their UTF-8 bytes."""
    found = collocations(table(spark, sf_dir, "documents"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= TOP)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
