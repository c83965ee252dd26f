import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from purseflow.llm import op11_alignment as op

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Brute:
    """Everything by byte: which token covers it on each side."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
        self.a.encode_special_tokens = True

    def tokens(self, text):
        if not text or "▁" in text:  # nothing else changes bytes, as both vocabularies cover all of them
            return [], [], []
        found = self.a.encode(" " + text, add_special_tokens=False)
        assert self.a.decode(found.ids, skip_special_tokens=False) == " " + text
        letters = op._byte_of_letter()
        sizes_a = [len(bytes(letters[c] for c in t)) for t in found.tokens]
        ids_a, ids_b = found.ids, self.b.encode(text)
        sizes_b = [1 if self.b.is_byte(i) else len(self.b.id_to_piece(i).replace("▁", " ").encode()) for i in ids_b]
        over_a = [k for k, n in enumerate(sizes_a) for _ in range(n)]
        over_b = [k for k, n in enumerate(sizes_b) for _ in range(n)]
        assert len(over_a) == len(over_b) == len(text.encode()) + 1
        links = sorted(set(zip(over_a, over_b)))
        groups, group = [], ([], [])
        for k in range(len(over_a)):
            for side, over in zip(group, (over_a, over_b)):
                if over[k] not in side:
                    side.append(over[k])
            if all(k + 1 == len(o) or o[k] != o[k + 1] for o in (over_a, over_b)):
                groups.append(([ids_a[i] for i in group[0]], [ids_b[j] for j in group[1]]))
                group = ([], [])
        return ids_a, ids_b, (groups, [(ids_a[i], ids_b[j]) for i, j in links])

    def rows(self, docs):
        known = [(i, *self.tokens(t)) for i, t in docs]
        count = Counter(p for *_, found in known if found for p in found[1])
        top = Counter()
        for (_, b), n in count.items():
            top[b] = max(top[b], n)
        out = []
        for i, a, b, found in known:
            groups, links = found or ([], [])
            line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            sha = hashlib.sha256(line.encode()).hexdigest() if line else ""
            out.append((i, len(a), len(b), len(groups), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links), sha))
        return sorted(out, key=lambda r: (r[0] is not None, *(x or 0 for x in r[:-1])))


@pytest.fixture(scope="module")
def brute():
    return Brute()


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, *(x or 0 for x in r[:-1])))


@pytest.mark.parametrize("density", [0.02, 0.3, 0.9])
def test_walk_over_drawn_ends(density):
    rng = np.random.default_rng(3)
    for n in [1, 2, 3, 5, 17, 64, 1000]:
        cuts = [np.append(np.flatnonzero(rng.random(n) < p) + 1, n + 1) for p in (density, density)]
        if n % 2:  # long equal stretches
            cuts[1] = np.unique(np.append(cuts[0], rng.integers(1, n + 2, 2)))
        inner_a, inner_b, linked_a, linked_b = op.align_ends(*cuts)
        common = set(cuts[0]) & set(cuts[1])
        assert inner_a == [k for k, e in enumerate(cuts[0]) if e not in common]
        assert inner_b == [k for k, e in enumerate(cuts[1]) if e not in common]
        starts = [np.concatenate([[0], c[:-1]]) for c in cuts]
        every = {(i, j) for i in range(len(cuts[0])) for j in range(len(cuts[1]))
                 if max(starts[0][i], starts[1][j]) < min(cuts[0][i], cuts[1][j])}
        single = zip(sorted(set(range(len(cuts[0]))) - set(linked_a)), sorted(set(range(len(cuts[1]))) - set(linked_b)))
        assert {*zip(linked_a, linked_b), *single} == every
        assert len(linked_a) == len(set(zip(linked_a, linked_b)))


def test_statistics_of_edge_rows(spark, edge, rows, brute):
    rng = random.Random(2)
    parts = ["a", " ", "▁", "the", "\n", "é", "日本", "🙂", "\0", "<s>", "ing", "  ", "0", "..."]
    more = [(100 + k, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for k in range(300)]
    docs = edge.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    assert tuples(op.link_statistics(docs, *PATHS)) == brute.rows(rows + more)
    assert tuples(op.link_statistics(edge, *PATHS)) == brute.rows(rows)


def test_many_chunks_give_the_same(spark, folder, corpus, brute):
    docs = spark.read.parquet(f"{folder}/documents.parquet").repartition(3)
    assert tuples(op.link_statistics(docs, *PATHS, chunk_links=1)) == brute.rows(corpus)


def test_groups_of_edge_rows(edge, rows, brute):
    got = sorted((r.doc_id, r.a_ids, r.b_ids, r.a_ends, r.b_ends) for r in op.align(edge, *PATHS).collect() if r.doc_id is not None)
    want = []
    for i, t in rows:
        a, b, found = brute.tokens(t)
        groups = found[0] if found else []
        want.append((i, a, b, np.cumsum([len(x) for x, _ in groups]).tolist(), np.cumsum([len(y) for _, y in groups]).tolist()))
    assert got == sorted(w for w in want if w[0] is not None)


def test_empty_table(empty):
    assert op.link_statistics(empty, *PATHS).collect() == [] and op.align(empty, *PATHS).collect() == []


def test_query(spark, folder, corpus, brute):
    assert tuples(op.op11_alignment(spark, folder)) == brute.rows(corpus)
