import random

import brute
import numpy as np
import pytest

from purseflow.llm import op04_setsketch as op


def test_agrees_with_brute_force(spark, folder, corpus):
    got = {r.doc_id: r for r in op.near_duplicates(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    sets = {i: brute.shingle_set(t) for i, t in corpus}
    want = brute.components(sets)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in sets
    }


def test_a_large_group_of_near_copies(spark):
    """Most pairs of copies are less similar than the threshold, so links must be searched for."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(120)] = f"x{rng.random()}"
        docs.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in op.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.components({i: brute.shingle_set(t) for i, t in docs})


def copies(rng, n, edits, words=120):
    base = [f"w{i}" for i in range(words)]
    docs = []
    for i in range(n):
        own = list(base)
        for _ in range(edits(rng)):
            own[rng.randrange(words)] = f"x{rng.random()}"
        docs.append((i, " ".join(own)))
    return docs


def test_candidates_grow_with_the_group_not_with_its_square(spark, monkeypatch):
    """Copies with one to nine changed words: most pairs are below the threshold."""
    seen = []
    plain = op.verified
    monkeypatch.setattr(op, "verified", lambda pairs, *rest: seen.append(pairs.count()) or plain(pairs, *rest))
    found = {}
    for n in (250, 500, 1000):
        seen.clear()
        docs = copies(random.Random(n), n, lambda r: r.randint(1, 9))
        got = op.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
        found[n] = sum(seen)
        if n == 250:
            assert {r.doc_id: r.component_id for r in got} == brute.components({i: brute.shingle_set(t) for i, t in docs})
    assert found[1000] < 60_000 and found[1000] < 6 * found[250], found


def test_a_document_with_two_texts_joins_both(spark):
    rng = random.Random(4)
    text_a, text_b = ([f"{c}{rng.random()}" for _ in range(100)] for c in "ab")
    near = lambda words: " ".join([*words[:50], "changed", *words[51:]])
    rows = [(20, " ".join(text_a)), (20, " ".join(text_b)), (30, near(text_a)), (31, near(text_b)), (19, "other words only")]
    got = op.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(19, 19), (20, 20), (20, 20), (30, 20), (31, 20)]


def test_edge_rows(edge, empty, rows):
    got = op.near_duplicates(edge).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1 and not by[3].kept
    assert by[7].component_id == by[8].component_id == by[-3].component_id == -3
    assert all(by[i].component_id == i and by[i].n_shingles == 0 and by[i].kept for i in (4, 5, 6))
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert sum(r.doc_id == 20 for r in got) == 2
    assert op.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("n, shared", [(400, 1.0), (400, 0.75), (50, 0.5), (3, 0.0)])
def test_registers_estimate_and_merge(n, shared):
    rng = np.random.default_rng(n)
    pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
    both = round(2 * n * shared / (1 + shared))  # of n items each, so that the similarity is ``shared``
    a, b = pool[:n], np.concatenate([pool[:both], pool[n : 2 * n - both]])
    ra, rb, ru = op.registers([np.unique(a), np.unique(b), np.unique(np.concatenate([a, b]))])
    assert (op.merge_registers(ra, rb) == ru).all()
    assert abs(op.estimate(ra, rb, n, n) - shared) < 0.2


def test_registers_do_not_depend_on_the_limit():
    item = [np.arange(1, 300, dtype=np.uint64)]
    assert (op.registers(item, 0.1) == op.registers(item, 9.0)).all()
