import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from purseflow.llm import op08_sharding as op


def smallest(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, n, at = (low + high) // 2, 1, 0
        for s in sizes:
            if at + s > middle:
                n, at = n + 1, s
            else:
                at += s
        low, high = (low, middle) if n <= shards else (middle + 1, high)
    return low


def check(docs, got, shards):
    assert len(got) == len(docs)
    sizes, where, total, slots = defaultdict(int), defaultdict(set), defaultdict(int), defaultdict(list)
    text_of = defaultdict(list)
    for i, t in docs:
        text_of[i].append((t or "").encode())
        sizes[hashlib.md5((t or "").encode()).digest()] += len((t or "").encode()) + 1
    for r in got:
        assert any(r.size == len(x) + 1 and r.text_crc32 == zlib.crc32(x) for x in text_of[r.doc_id])
        where[(r.size, r.text_crc32)].add(r.shard)
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in where.values())  # equal texts together
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(total) < shards
    left, rest, own = shards, sum(sizes.values()), []
    for key, size in sorted(sizes.items(), key=lambda x: -x[1]):
        if left > 1 and size * left > rest:
            own.append(size)
            left, rest = left - 1, rest - size
            sizes[key] = 0
    best = max([smallest([sizes[k] for k in sorted(sizes) if sizes[k]] or [0], left), *own])
    assert max(total.values()) <= best


@pytest.mark.parametrize("n, kinds, hot", [(40, 1000, 0), (300, 40, 0), (200, 5, 150), (3, 3, 0)])
def test_minimax(spark, n, kinds, hot):
    rng = random.Random(n)
    docs = [(i, f"x{rng.randint(0, kinds)} " * rng.randint(1, 60)) for i in range(n)]
    docs += [(1000 + i, "hot " * 30) for i in range(hot)]
    check(docs, op.shard(spark.createDataFrame(docs, "doc_id long, text string"), 5).collect(), 5)


def test_edge_rows(edge, empty, rows):
    check(rows, op.shard(edge).collect(), 16)
    assert op.shard(empty).count() == 0
