"""The registered queries against their SQL, the pipeline stage by stage, and the shared helpers."""

from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from oracle import connect, differences
from tokenizers import Tokenizer

from purseflow.llm import CHECKS, QUERIES
from purseflow.llm.bitmap import bit_map, marked
from purseflow.llm.components import components
from purseflow.llm.tables import Workspace
from purseflow.llm.text import IS_ALNUM, IS_WORD, word_hashes
from purseflow.llm.tokens import Encoder


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_sql(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), connect(folder), CHECKS[name]) == []


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = step(spark, docs, folder)
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
            docs = corpus_pipeline.stage(out, "test_stage")
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
            assert set(kept[name]) <= set(before)
        if name == "toxicity":
            gone = set(before) - set(kept[name])
            assert all(labels.get(i, 1) == 1 for i in gone)
        if name == "near_dedup":
            want = brute.components({i: brute.shingle_set(t) for i, t in before.items()})
            assert set(kept[name]) == {i for i, c in want.items() if i == c}
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == set(before)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_edge_rows_and_empty_tables(spark, edge, rows, folder, name):
    step = dict(corpus_pipeline.STAGES)[name]
    assert step(spark, edge.where("false"), folder).count() == 0
    out = step(spark, edge, folder)
    got = out.collect()
    count = Counter(r.doc_id for r in got)
    given = Counter(i for i, _ in rows)
    blank = {4, 5, 6}
    if name == "packing":
        assert set(count) == set(given) and all(count[i] >= given[i] for i in given)
        return
    assert out.columns == corpus_pipeline.COLUMNS
    assert blank <= set(count) and count <= given
    if name == "near_dedup":
        groups = brute.components({i: brute.shingle_set(t) for i, t in rows if i is not None})
        assert set(count) - {None} == {i for i, c in groups.items() if i == c}
        assert all(count[i] == given[i] for i in count)  # repeated rows and rows without an id stay
    if name in ("toxicity", "decontamination"):
        assert all(count[i] == given[i] for i in count)
    if name == "line_dedup":
        texts = {r.doc_id: r for r in got}
        assert texts[22].n_chars == len(texts[22].text) and texts[22].text.startswith("start") and "line one" not in texts[22].text


@pytest.mark.parametrize("few", [0, 50_000])
def test_components(spark, monkeypatch, few):
    edges = [(5, 9), (9, 2), (7, 8), (20, 21), (21, 22), (22, 23), (23, 24), (24, 3), (1, 1)]
    df = spark.createDataFrame(edges, "a long, b long")
    monkeypatch.setattr("purseflow.llm.components.FEW_EDGES", few)
    got = {r.node: r.component for r in components(df, Workspace(df, "test")).collect()}
    assert got == {2: 2, 5: 2, 9: 2, 7: 7, 8: 7, 3: 3, 20: 3, 21: 3, 22: 3, 23: 3, 24: 3}
    assert components(df.where("false"), Workspace(df, "test")).count() == 0


def test_bit_map(spark):
    keys = [1, -5, 2**62, -(2**63), 77]
    marks = bit_map(spark.createDataFrame([(k,) for k in keys], "key long"), "key")
    assert marked(marks.value, np.array(keys, np.int64).view(np.uint64)).all()
    others = np.random.default_rng(0).integers(0, 2**63, 10_000).astype(np.uint64)
    assert marked(marks.value, others).sum() == 0


def test_long_patterned_words_are_told_apart():
    """A word of 2,048 bytes and its complement, whose polynomial sums modulo 2^64 are equal."""
    word = b"a"
    for _ in range(11):
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    other = word.translate(bytes.maketrans(b"ab", b"ba"))
    data = np.frombuffer(word + other + word + word.upper(), np.uint8)
    offsets = np.arange(5) * len(word)
    for is_word in (IS_WORD, IS_ALNUM):
        _, hashes = word_hashes(data, offsets, is_word)
        assert hashes[0] != hashes[1] and hashes[0] == hashes[2] == hashes[3]
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    ids, bounds = Encoder(path).encode_block(data, offsets)
    for i, text in enumerate([word, other, word, word.upper()]):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == plain.encode(text.decode()).ids
