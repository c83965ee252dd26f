import brute
import numpy as np
from pyspark.sql import functions as F

from purseflow.llm import op01_outliers as op


def test_base_counts(edge, rows):
    got = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                 for r in op.statistics(edge).collect())
    assert got == sorted((i or 0, *brute.base_counts(t)) for i, t in rows)


def test_edge_rows_and_empty_table(edge, empty, rows):
    got = op.quality(edge).collect()
    assert len(got) == len(rows)
    for r in got:
        want = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == want and r.kept == (not want)  # too few texts for estimates
    assert op.quality(empty).count() == 0


def test_chi_square():
    assert abs(op.chi2_quantile(0.975, 5) - 12.8325) < 1e-3
    assert abs(op.chi2_cdf(op.chi2_quantile(0.75, 5), 5) - 0.75) < 1e-9


def test_estimates_resist_a_fifth_of_outliers(spark):
    rng = np.random.default_rng(3)
    good = rng.normal([5, 1.8, 0, 0, 0], [0.8, 0.3, 0.2, 0.3, 0.3], (4_000, 5))
    bad = rng.normal([9, 0.2, 1.3, 1.2, 1.2], 0.05, (1_000, 5))
    data = [("g", [float(v) for v in row]) for row in np.vstack([good, bad])]
    vectors = spark.createDataFrame(data, "name string, x array<double>").select(F.struct("name").alias("stratum"), "x")
    work = op.Workspace(vectors, "test")
    found = op.estimate(vectors, work)
    row = found.first()
    assert np.abs(np.array(row.f_m) - good.mean(axis=0)).max() < 0.05
    judged = op._distance(vectors.join(found, "stratum"), "f").select("f_d").collect()
    limit = op.chi2_quantile(op.REJECT_LEVEL, op.P)
    far = np.array([r.f_d > limit for r in judged])
    assert far.sum() == 1_000


def test_junk_goes_and_clean_documents_stay(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    got = op.quality(docs).where("not base_failed").join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")
    )
    kept = {r.quality: r.kept for r in got.collect()}
    assert kept[1] > 0.999 and kept[0] < 0.2


def test_junk_of_a_thin_tail_of_languages_goes(spark):
    rng = np.random.default_rng(5)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(n))

    rows = [(i, prose(int(rng.integers(80, 400))), "en", "web") for i in range(400)]
    rows += [(1000 + i, prose(int(rng.integers(80, 400))), f"l{i % 20}", "web") for i in range(60)]
    rows += [(2000 + i, " ".join(f"#$%&|{w}#$%&|" for w in prose(200).split()), f"l{i}", "web") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in op.quality(docs).collect()}
    assert len(got) == len(rows) and not any(got[2000 + i].kept or got[2000 + i].base_failed for i in range(3))
    assert sum(got[1000 + i].kept for i in range(60)) >= 55
    few = {r.doc_id: r.kept for r in op.quality(docs.where("doc_id >= 1000")).collect()}
    assert all(few.values())
