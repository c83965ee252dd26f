import re

from purseflow.llm import op05_decontamination as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = set()
    for name, text in items:
        w = words_of(text)
        windows |= {(name, tuple(w[i : i + 10])) for i in range(max(len(w) - 9, 1)) if w}
    out = []
    for i, text in docs:
        w, hit, names = words_of(text), set(), set()
        for name, window in windows:
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    names.add(name)
        out.append((i, len(w), len(hit), sorted(str(n) for n in names if n is not None)))
    return out


def test_edge_rows_against_brute_force(spark, edge, empty, rows):
    passage = dict((i, t) for i, t in rows)[10].split("\n")[0]
    items = [
        (1, passage), (2, "one two"), (3, "THE"), (4, None), (5, "!!!"), (6, " ".join(passage.split()[5:17])), (10, "the the the"),
        (7, "nothing of this kind occurs"), (None, "É ü"), (8, "one two"),
    ]
    bench = spark.createDataFrame([(*i, "clash", "clash") for i in items], "item_id long, text string, words string, shingle string")
    got = op.contamination(edge, bench).collect()
    short = [r for r in rows if len(r[1] or "") < 50_000]
    want = sorted(brute(short, items), key=repr)
    mine = sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in got if r.doc_id != 14), key=repr)
    assert mine == want
    for r in got:
        assert sum(s.n_words for s in r.spans) == r.n_hit and r.n_items == len(r.items)
    left = {r.doc_id for r in op.decontaminate(edge, bench).collect()}
    assert 9 not in left and 14 in left and None in left
    assert op.contamination(empty, bench).count() == 0
    assert {r.n_hit for r in op.contamination(edge, bench.where("false")).collect()} == {0}
