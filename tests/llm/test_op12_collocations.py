import random
import re
from collections import Counter

import numpy as np
import pytest

from purseflow.llm import hash_counts
from purseflow.llm import op12_collocations as op


def brute(docs, min_count, longest=4, covered=80):
    """Every phrase of every length counted by itself."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {key: c for key, c in f.items() if c >= min_count}
    out = []
    for (lang, words), a in often.items():
        if len(words) == 1:
            continue
        cuts = []
        for cut in range(1, len(words)):
            left, right = f[lang, words[:cut]], f[lang, words[cut:]]
            cuts.append((2_000_000 * a // (left + right), cut, left, right))
        score, _, left, right = min(cuts)
        longer = [
            c for (other, w), c in often.items()
            if other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))
        ]
        if not any(100 * c >= covered * a for c in longer):
            out.append((lang, " ".join(words), a, left, right, n[lang], score))
    return sorted(out)


def rows(df):
    return sorted((r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("min_count", [1, 2, 5])
def test_drawn_texts(spark, min_count):
    rng = random.Random(min_count)
    vocabulary = ["New", "new", "york", "city", "of", "the", "É", "é", "日本", "a", "b", "x" * 100, "\0"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", " !", "?", ";", ":", "\xa0"]
    docs = [
        (rng.choice(["en", "de", "und", None, ""]), "".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(rng.randint(0, 60))))
        for _ in range(60)
    ]
    docs += [("en", "new york city of the a new york city of the"), ("de", None), (None, ""), (None, " . "), ("fr", "  ")]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    assert rows(op.collocations(df, min_count=min_count)) == brute(docs, min_count)


@pytest.mark.parametrize("longest", [2, 3, 5])
def test_other_lengths(spark, longest):
    rng = random.Random(longest)
    docs = [("en", " ".join(rng.choices("abcd", k=80)))] * 3 + [("de", "a b c d e f g a b c d e f g")]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert rows(op.collocations(df, min_count=3, longest=longest)) == brute(docs, 3, longest)


def test_units_and_languages_stay_apart(spark):
    docs = [("en", "a b c"), ("de", "a b c"), ("de", "a b c d")] * 4
    df = spark.createDataFrame(docs * 9, "lang string, text string").repartition(3)
    got = op.longest_windows(df, 36, 4, unit_words=5).collect()
    count = Counter()
    for r in got:
        count[r.lang, r.w1, r.w2, r.w3, r.w4] += r.n
    assert len(got) > len(count)
    # a unit ends with the block that fills it, so one task's rows repeat as well
    long = spark.createDataFrame([("en", "a b " * 100_000)] * 3, "lang string, text string").coalesce(1)
    assert len(op.longest_windows(long, 36, 4, unit_words=5).collect()) > len(op.longest_windows(long, 36, 4).collect())
    assert count["en", "a", "b", "c", ""] == count["de", "a", "b", "c", ""] == count["de", "a", "b", "c", "d"] == 36
    assert count["de", "c", "d", "", ""] == 36 and count["en", "c", "", "", ""] == 36


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 9 * 10**12
    counts = spark.createDataFrame(
        [("en", 0, [], 10**14), ("en", 1, ["a"], big + 7), ("en", 1, ["b"], big), ("en", 2, ["a", "b"], big - 1)],
        "lang string, k int, words array<string>, f long",
    )
    monkeypatch.setattr(op, "phrase_counts", lambda *_: counts)
    got = op.collocations(counts).first()
    assert got.score == 2_000_000 * (big - 1) // (2 * big + 7)


def test_edge_rows(edge, empty, rows_of_edge):
    got = rows(op.collocations(edge, min_count=2))
    assert got == brute(rows_of_edge, 2)
    assert op.collocations(empty).collect() == []


@pytest.fixture(scope="session")
def rows_of_edge(edge):
    return [(r.lang, r.text) for r in edge.select("lang", "text").collect()]


@pytest.mark.parametrize("least", [1, 2, 30, 300])
def test_frequent_hashes(spark, least):
    rng = np.random.default_rng(least)
    values = rng.integers(0, 2**64, 500, dtype=np.uint64)
    values[:3] = [0, 2**64 - 1, 2**63]
    n = rng.integers(1, 2 * least + 2, len(values))
    every = rng.permutation(np.repeat(values, n))
    parts = [hash_counts.packed(x, least).to_pylist() for x in np.array_split(every, 4)]
    rows = spark.createDataFrame([tuple(r.values()) for part in parts for r in part], hash_counts.PACKED)
    got = {r.key for r in hash_counts.frequent(rows, least).collect()}
    assert got == set(hash_counts.marking(values[n >= least]).view(np.int64).tolist())
    assert hash_counts.packed(np.zeros(0, np.uint64), least).num_rows == 0
