import brute
import pytest

from purseflow.llm import op10_line_runs as op


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_edge_rows_against_brute_force(edge, rows, min_lines):
    got = op.dedup_lines(edge, min_lines).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    want = [(i, *w) for (i, _), w in zip(ordered, brute.line_dedup([t for _, t in ordered], min_lines))]
    mine = [(r.doc_id, r.n_lines, r.n_removed, r.n_runs, r.text) for r in got]
    key = lambda r: (r[0] is None, r[0] or 0, repr(r))
    assert sorted(mine, key=key) == sorted(want, key=key)


def test_longer_runs(spark):
    texts = ["a b\nc d\ne f\ng h\ni j", "x\nc d\ne f\ng h\ny", "c d\ne f\nz", "q\nq\nq\nq\nq", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for n in (2, 3, 4):
        got = op.dedup_lines(docs, n).orderBy("doc_id").collect()
        assert [(r.n_lines, r.n_removed, r.n_runs, r.text) for r in got] == brute.line_dedup(texts, n)


def test_empty_table(empty):
    assert op.dedup_lines(empty).count() == 0
