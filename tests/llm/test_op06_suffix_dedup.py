import random

import brute
import numpy as np

from purseflow.llm import bitmap
from purseflow.llm import op06_suffix_dedup as op


def test_agrees_with_brute_force(spark, folder, corpus):
    got = {r.doc_id: r for r in op.dedup_substrings(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    want = brute.substring_dedup([t for _, t in corpus])
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in (got[i] for i, _ in corpus)] == want


def test_edge_rows(edge, empty, rows):
    got = op.dedup_substrings(edge, with_bytes=False).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    want = brute.substring_dedup([t for _, t in ordered])
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    # which of the equal rows keeps its text is free
    assert sorted((tuple(r) for r in got), key=key) == sorted(
        ((i, *w) for (i, _), w in zip(ordered, want)), key=key
    )
    assert op.dedup_substrings(empty).count() == 0


def test_equal_windows_choose_the_same_anchor():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 100, 400).astype(np.uint8)
    data = np.concatenate([rng.integers(97, 100, 300).astype(np.uint8), shared, rng.integers(97, 100, 77).astype(np.uint8), shared])
    doc, place, first, last, grams, _ = op.anchors(data, np.array([0, len(data)]))
    chosen = np.repeat(place, last - first + 1)
    assert len(chosen) == len(data) - 99
    assert (chosen[300 : 300 + 301] - 300 == chosen[777 : 777 + 301] - 777).all()


def test_anchors_hold_every_window_of_every_document_once():
    rng = np.random.default_rng(2)
    for _ in range(50):
        docs = [rng.integers(97, 99 + rng.integers(3), rng.integers(400)).astype(np.uint8) for _ in range(rng.integers(1, 6))]
        offsets = np.cumsum([0, *map(len, docs)])
        doc, place, first, last, _, _ = op.anchors(np.concatenate(docs), offsets)
        held = [(d, s) for d, a, b in zip(doc.tolist(), first.tolist(), last.tolist()) for s in range(a, b + 1)]
        assert held == [(d, s) for d, t in enumerate(docs) for s in range(offsets[d], offsets[d] + len(t) - 99)]
        assert (place >= last).all() and (place <= first + op.LENGTH - op.GRAM).all()


def test_windows_whose_anchor_has_other_bytes_around_it_are_left_out(spark, monkeypatch):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    docs = []
    for _ in range(40):  # shared strings of 32 to 160 bytes between others
        shared = text(rng.randint(32, 160))
        docs += [text(rng.randint(80, 200)) + shared + text(rng.randint(80, 200)) for _ in range(3)]
    made, real = [], op.Contested.windows
    monkeypatch.setattr(op.Contested, "windows", lambda self, again: made.append(real(self, again)) or made[-1])
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: r for r in op.dedup_substrings(table).collect()}
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in map(got.get, range(len(docs)))] == brute.substring_dedup(docs)
    seen = [t[k : k + 100] for t in docs for k in range(len(t) - 99)]
    repeated = len(seen) - len(set(seen))
    assert made[0].count() < 6 * repeated < len(seen)


def test_maps_do_not_fill_as_tables_grow(spark, monkeypatch):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    again = [text(150) for _ in range(60)]  # with as many anchors, about 250, as a small map has bits
    docs = [text(600) + (again[k % 60] if k < 120 else "") + text(600) for k in range(300)]
    monkeypatch.setattr(bitmap, "BITS", 8)
    monkeypatch.setattr(bitmap.bit_map, "__defaults__", (8,))
    made, real = [], op._tuples
    monkeypatch.setattr(op, "_tuples", lambda *given: made.append(real(*given)) or made[-1])
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: r for r in op.dedup_substrings(table).collect()}
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in map(got.get, range(len(docs)))] == brute.substring_dedup(docs)
    some = made[0].groupBy("gram").count()
    assert some.where("count > 1").count() < made[0].count() < 3 * some.where("count > 1").groupBy().sum("count").first()[0]


def test_size_of_maps():
    assert [bitmap.bits_for(n) for n in (0, 1, 1 << 23, (1 << 23) + 1, 1 << 26, 1 << 40)] == [26, 26, 26, 27, 29, 30]
