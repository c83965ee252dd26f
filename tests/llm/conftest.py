import os
import random

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
CLASHING = [
    "row", "key", "n", "seed", "gram", "block", "bin", "offset", "uid", "part", "score", "words", "x", "stratum",
    "size", "shard", "label_id", "toxic", "id", "rep", "n_lines", "n_removed", "spans", "_row",
]


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(HERE))


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


def edge_rows():
    """(doc_id, text): copies, near copies, shared passages, ties, nulls, empty and very long texts."""
    rng = random.Random(7)
    passage, other = sentence(rng, 60), sentence(rng, 80)
    words = other.split()
    words[40] = "changed"
    rows = [
        (1, other), (2, other), (3, " ".join(words)), (4, None), (5, ""), (6, " \n\t \r "), (7, "one two"), (8, "one two"),
        (9, sentence(rng, 30) + "\n" + passage + "\n" + sentence(rng, 20)),
        (10, passage + "\n" + sentence(rng, 40)), (11, "the " * 150), (12, "the " * 130), (13, "É ü " * 40 + "ß日本"),
        (14, sentence(rng, 30_000)), (15, "x" * 5_000), (16, "word\n\nword\n\nword\nword"), (17, "it's <|endoftext|>  a  b\x1c c"),
        (20, passage), (20, passage), (None, other), (None, None), (-3, "one two"),
        (21, "line one is here\nline two is here\nline three\n" + sentence(rng, 12)),
        (22, "start\nline one is here\nline two is here\nend " + sentence(rng, 12)),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return edge_rows()


@pytest.fixture(scope="session")
def edge(spark, rows):
    """The edge rows with columns whose names the operators use themselves."""
    columns = ", ".join(f"`{c}` string" for c in CLASHING)
    full = [(i, t, "en" if i and i % 2 else None, None, len(t or ""), *["clash"] * len(CLASHING)) for i, t in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {columns}").repartition(3)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def corpus(spark, folder):
    """The smallest given table, collected in order of doc_id."""
    found = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return sorted(((r.doc_id, r.text) for r in found), key=lambda r: r[0])
