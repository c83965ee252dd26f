"""Quality rules: base counts of a text, and robust multivariate outliers among them.

Every text gets a vector of transformed statistics. For each language and source (small
groups of a language are pooled) location and scatter are estimated by the minimum covariance
determinant: from two robust starts, concentration steps take the three quarters of the
vectors that lie nearest and re-estimate, which never raises the determinant; the start with
the smaller one wins, and a reweighting step follows. A text is rejected when its squared
Mahalanobis distance exceeds a chi-square quantile.

Only DataFrame functions are used, so all of it runs in the JVM. Texts are read once: the
compact vectors are written, and every step is two map-side aggregations over them. Group
parameters are joined back, and broadcast only if their number was checked to be small, so a
source with a third of all rows is spread like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .registry import query, table
from .tables import Workspace

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
COVERAGE = 0.75
MIN_GROUP = 200
STEPS = 4
REJECT_LEVEL = 1 - 1e-5

#: transformed statistic -> smallest scale taken seriously. A statistic that is nearly constant
#: in a group must not turn tiny differences into outliers.
FEATURES = {"size": 0.5, "word_length": 0.1, "symbols": 0.04, "dup_lines": 0.2, "repeats": 0.2}
P = len(FEATURES)


def statistics(documents: DataFrame) -> DataFrame:
    """The input's doc_id, lang and source with the base counts of its whole text (null: none)."""
    words = F.filter(F.split("text", SPACES, -1), lambda w: w != "")
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    base = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.coalesce("text", F.lit("")).alias("text")
    ).select("doc_id", "lang", "source", words.alias("words"), lines.alias("lines"), F.regexp_count("text", F.lit(SYMBOLS)).alias("n_symbols"))
    n = F.size("words")
    triples = F.arrays_zip(
        F.slice("words", 1, n - 2).alias("a"), F.slice("words", 2, n - 2).alias("b"), F.slice("words", 3, n - 2).alias("c")
    )
    hashed = base.select(
        "doc_id", "lang", "source",
        n.cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"])))
        .otherwise(F.array().cast("array<bigint>")).alias("grams"),
    )
    # sorted by hash, equal windows are neighbours; their places give the repeated words
    ordered = F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array(F.lit(None).cast("struct<h: bigint, i: int>"))
    sorted_ = hashed.withColumn("s", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), ordered)).drop("grams")
    near = F.arrays_zip(
        F.concat(none, F.slice("s", 1, F.size("s") - 1)).alias("x"), F.col("s").alias("y"),
        F.concat(F.slice("s", 2, F.size("s")), none).alias("z"),
    )
    twice = F.filter(near, lambda t: F.coalesce(t["x"]["h"] == t["y"]["h"], F.lit(False)) | F.coalesce(t["z"]["h"] == t["y"]["h"], F.lit(False)))
    placed = sorted_.withColumn("d", F.sort_array(F.transform(twice, lambda t: t["y"]["i"]))).drop("s")
    gaps = F.arrays_zip(
        F.col("d").alias("at"), F.concat(F.slice("d", 2, F.size("d")), F.array(F.lit(None).cast("int"))).alias("after")
    )
    covered = F.aggregate(
        gaps, F.lit(0).cast("long"), lambda acc, t: acc + F.least(F.lit(3), F.coalesce(t["after"] - t["at"], F.lit(3)))
    )
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("d")


def _vectors(stats: DataFrame) -> DataFrame:
    words = F.col("n_words")
    share = lambda part, whole: F.asin(F.sqrt(F.least(F.lit(1.0), part / F.greatest(whole, F.lit(1)))))
    return stats.select(
        "*",
        F.array(
            F.log1p(words),
            F.log(F.col("word_chars") / F.greatest(words, F.lit(1)) + 1),
            share(F.col("n_symbols"), F.col("n_symbols") + F.col("word_chars")),
            share(F.col("n_dup_lines"), F.col("n_lines")),
            share(F.col("n_repeat_words"), words),
        ).alias("x"),
    )


def _gamma_cdf(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    term = total = 1 / a
    k = a
    while term > total * 1e-17:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_cdf(x: float, k: int) -> float:
    return _gamma_cdf(k / 2, x / 2) if x > 0 else 0.0


def chi2_quantile(level: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < level else (low, middle)
    return (low + high) / 2


def consistency(share: float, p: int = P) -> float:
    """Factor that makes the scatter of the innermost ``share`` of normal vectors unbiased."""
    return share / chi2_cdf(chi2_quantile(share, p), p + 2)


def _moments(name: str, keep: Column) -> list[Column]:
    """Number, sums and sums of products of the vectors that ``keep`` selects (centred by ``c``)."""
    value = lambda i: F.when(keep, F.col("x")[i] - F.col("c")[i])
    return [
        F.count(F.when(keep, 1)).alias(f"{name}_n"),
        F.array(*[F.sum(value(i)) for i in range(P)]).alias(f"{name}_s"),
        F.array(*[F.sum(value(i) * value(j)) for i in range(P) for j in range(i + 1)]).alias(f"{name}_q"),
    ]


def _at(i: int, j: int) -> int:
    return i * (i + 1) // 2 + j


def _estimate(groups: DataFrame, name: str, factor: float) -> DataFrame:
    """Turn moments into ``{name}_m`` (mean), ``{name}_l`` (Cholesky factor) and ``{name}_det``."""
    n = F.greatest(F.col(f"{name}_n"), F.lit(1))
    mean = F.transform(f"{name}_s", lambda s: s / n)
    out = groups.withColumn("mu", mean)
    cov = []
    floors = list(FEATURES.values())
    for i in range(P):
        for j in range(i + 1):
            c = (F.col(f"{name}_q")[_at(i, j)] / n - F.col("mu")[i] * F.col("mu")[j]) * factor
            cov.append(F.greatest(c, F.lit(0.0)) + floors[i] ** 2 if i == j else c)
    out = out.withColumn("cov", F.array(*cov))
    for i in range(P):
        for j in range(i + 1):
            rest = F.col("cov")[_at(i, j)]
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            entry = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", entry)
    det = F.lit(0.0)
    for i in range(P):
        det = det + 2 * F.log(F.col(f"l{i}{i}"))
    factors = [f"l{i}{j}" for i in range(P) for j in range(i + 1)]
    return (
        out.withColumn(f"{name}_m", F.transform(F.arrays_zip(F.col("mu").alias("m"), F.col("c").alias("c")), lambda t: t["m"] + t["c"]))
        .withColumn(f"{name}_l", F.array(*factors))
        .withColumn(f"{name}_det", det)
        .drop("mu", "cov", *factors, f"{name}_s", f"{name}_q")
    )


def _distance(rows: DataFrame, name: str) -> DataFrame:
    """Add ``{name}_d``, the squared Mahalanobis distance, by forward substitution."""
    for i in range(P):
        rest = F.col("x")[i] - F.col(f"{name}_m")[i]
        for k in range(i):
            rest = rest - F.col(f"{name}_l")[_at(i, k)] * F.col(f"z{k}")
        rows = rows.withColumn(f"z{i}", rest / F.col(f"{name}_l")[_at(i, i)])
    total = F.lit(0.0)
    for i in range(P):
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    return rows.withColumn(f"{name}_d", total).drop(*[f"z{i}" for i in range(P)])


def _with(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_small(groups), "stratum")


def estimate(vectors: DataFrame, work: Workspace) -> DataFrame:
    """``stratum, n, f_m, f_l``: reweighted MCD location and scatter of every stratum of ``vectors``."""
    centre = F.array(*[F.percentile_approx(F.col("x")[i], 0.5, 10_000) for i in range(P)])
    groups = work.put(vectors.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), centre.alias("c")))
    rows = _with(vectors, groups)
    spread = F.array(*[F.percentile_approx(F.abs(F.col("x")[i] - F.col("c")[i]), 0.5, 10_000) for i in range(P)])
    groups = work.put(groups.join(rows.groupBy("stratum").agg(spread.alias("mad")), "stratum"))
    # start a: distances scaled by the median deviations; start b: scatter of spatial signs
    floors = list(FEATURES.values())
    scaled = [(F.col("x")[i] - F.col("c")[i]) / F.greatest(F.col("mad")[i] * 1.4826, F.lit(floors[i])) for i in range(P)]
    square = scaled[0] * scaled[0]
    for s in scaled[1:]:
        square = square + s * s
    away = F.greatest(F.sqrt(square), F.lit(1e-9))
    signs = F.array(*[F.col("x")[i] / F.lit(1.0) for i in range(P)])
    rows = _with(vectors, groups).withColumn("a_d", square).withColumn("weight", 1 / away)
    signed = rows.withColumn(
        "x", F.transform(F.arrays_zip(signs.alias("x"), F.col("c").alias("c")), lambda t: t["c"] + (t["x"] - t["c"]) * F.col("weight"))
    )
    b = signed.groupBy("stratum").agg(*_moments("b", F.lit(True)))
    a = F.percentile_approx("a_d", COVERAGE, 10_000).alias("a_t")
    limits = rows.groupBy("stratum").agg(a)
    first = _with(rows.drop("weight"), limits).groupBy("stratum").agg(*_moments("a", F.col("a_d") <= F.col("a_t")))
    groups = groups.join(first, "stratum").join(b, "stratum")
    groups = work.put(_estimate(_estimate(groups, "a", 1.0), "b", float(P)))
    for _ in range(STEPS):
        base = groups.select("stratum", "n", "c")
        rows = _distance(_distance(_with(vectors, groups), "a"), "b").select("stratum", "x", "c", "a_d", "b_d")
        limits = work.put(
            rows.groupBy("stratum").agg(
                F.percentile_approx("a_d", COVERAGE, 10_000).alias("a_t"),
                F.percentile_approx("b_d", COVERAGE, 10_000).alias("b_t"),
            )
        )
        inner = _with(rows, limits).groupBy("stratum").agg(
            *_moments("a", F.col("a_d") <= F.col("a_t")), *_moments("b", F.col("b_d") <= F.col("b_t"))
        )
        groups = work.put(_estimate(_estimate(base.join(inner, "stratum"), "a", 1.0), "b", 1.0))
    better = F.col("b_det") < F.col("a_det")
    chosen = groups.select(
        "stratum", "n", "c",
        F.when(better, F.col("b_m")).otherwise(F.col("a_m")).alias("r_m"),
        F.when(better, F.col("b_l")).otherwise(F.col("a_l")).alias("r_l"),
    )
    rows = _distance(_with(vectors, chosen), "r")
    inside = F.col("r_d") <= consistency(COVERAGE) * chi2_quantile(0.975, P)
    final = rows.groupBy("stratum").agg(*_moments("f", inside))
    return work.put(
        _estimate(chosen.select("stratum", "n", "c").join(final, "stratum"), "f", consistency(0.975)).select(
            "stratum", "n", "f_m", "f_l"
        )
    )


def quality(documents: DataFrame, reject_level: float = REJECT_LEVEL) -> DataFrame:
    """Base counts, ``base_failed``, ``distance`` and ``kept`` for every row of ``documents``.

    * ``base_failed``: fewer than 50 words, or more than half of them in repeated windows.
    * Estimates are per (lang, source) where it has at least ``MIN_GROUP`` texts that pass the
      base rules; the texts of smaller groups are pooled by language, and those of still
      smaller pools over all languages. A last pool below ``MIN_GROUP`` is judged by the estimate
      over all texts that pass; only if these are fewer too, nothing in it is rejected.
    * Null lang or source is a value like any other; null, empty and blank texts have no words
      and fail the base rule. Rows may repeat or lack a doc_id; each is answered.
    * An empty table gives no rows; other columns are ignored.
    """
    work = Workspace(documents, "outliers")
    counts = statistics(documents)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    stats = work.put(_vectors(counts).withColumn("base_failed", failed))
    passing = F.count(F.when(~F.col("base_failed"), 1))
    sizes = stats.groupBy("lang", "source").agg(passing.alias("n"))
    group = F.struct(F.col("lang"), F.col("source"), F.lit(0).alias("level"))
    language = F.struct(F.col("lang"), F.lit(None).cast("string").alias("source"), F.lit(1).alias("level"))
    anything = F.struct(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(2).alias("level"))
    small = sizes.where(F.col("n") < MIN_GROUP).groupBy("lang").agg(F.sum("n").alias("pooled"))
    named = (
        sizes.join(small.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .select(
            F.col("lang").alias("_lang"), F.col("source").alias("_source"),
            F.when(F.col("n") >= MIN_GROUP, group).when(F.col("pooled") >= MIN_GROUP, language).otherwise(anything).alias("stratum"),
        )
    )
    named = broadcast_if_small(work.put(named))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    placed = stats.join(named, same).drop("_lang", "_source")
    vectors = work.put(placed.where(~F.col("base_failed")).select("stratum", "x"))
    last = F.col("stratum.level") == 2
    if 0 < vectors.where(last).limit(MIN_GROUP).count() < MIN_GROUP:
        vectors = work.put(vectors.unionByName(vectors.where(~last).withColumn("stratum", anything)))
    found = estimate(vectors, work).where(F.col("n") >= MIN_GROUP)
    judged = _distance(placed.join(broadcast_if_small(found.drop("n")), "stratum", "left"), "f")
    limit = chi2_quantile(reject_level, P)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("f_d") <= limit, F.lit(True))).alias("kept"),
        F.col("f_d").alias("distance"),
    )


@query("op1_outliers")
def op1_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers of all documents, per language and source."""
    return quality(table(spark, sf_dir, "documents"))
