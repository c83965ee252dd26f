import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from purseflow.llm import op02_packing as op

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def check_layout(pieces, capacity):
    bins = defaultdict(list)
    for p in pieces:
        bins[p.sequence_id].append((p.offset, p.length))
    for found in bins.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("seed", range(6))
def test_search_never_adds_bins_and_loses_nothing(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 60), rng.randint(30, 70)]) for _ in range(300)]
    first = op.best_fit(lengths, 100)
    best = op.improve(first, lengths, 100)
    assert sorted(i for b in best for i in b) == list(range(300))
    assert all(sum(lengths[i] for i in b) <= 100 for b in best)
    assert -(-sum(lengths) // 100) <= len(best) <= len(first)


def test_local_search_empties_a_bin():
    lengths = [60, 60, 40, 40, 50, 50]
    poor = [[0, 4], [], [1, 5], [], [2], [3]]
    best = op.improve([b for b in poor if sum(lengths[i] for i in b) <= 100], lengths, 100)
    assert sum(bool(b) for b in best) <= 4


def test_pieces_and_layout(edge, rows, empty):
    pieces = op.pack_documents(edge, PATH).collect()
    lengths = sorted(len(ids_of(t)) + 1 for _, t in rows)
    total = defaultdict(int)
    for p in pieces:
        total[p.doc_id] += p.length
    assert sum(total.values()) == sum(lengths)
    want = {i: (np.array([*ids_of(t), 0], "<u4")) for i, t in rows if i is not None and i != 20}
    for p in pieces:
        if p.doc_id in want:
            ids = want[p.doc_id][p.start : p.start + p.length]
            assert p.ids_crc32 == zlib.crc32(ids.tobytes()) and (p.piece == 0 or p.length == 2048)
    n = check_layout(pieces, 2048)
    assert n <= -(-sum(lengths) // 2048) + 1
    assert op.pack_documents(empty, PATH).count() == 0


def test_blocks_cost_few_sequences(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([rng.randint(1, 300), rng.randint(400, 1500)])) for i in range(3_000)]
    pieces = op.pack(spark.createDataFrame(data, "doc_id long, length long"), 2048, block_pieces=400).collect()
    n = check_layout(pieces, 2048)
    assert len(pieces) == 3_000 and n <= sum(x for _, x in data) / 2048 * 1.01 + 2


@pytest.mark.parametrize("seed", range(3))
def test_search_ends_only_when_no_exchange_is_left(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.choice([rng.randint(50, 53), rng.randint(100, 104)]) for _ in range(400)), reverse=True)
    bins = op.improve(op.best_fit(lengths, 205), lengths, 205)
    fill = [sum(lengths[i] for i in b) for b in bins]
    if len(bins) == -(-sum(lengths) // 205):
        return
    for a, own in enumerate(bins):
        room = 205 - fill[a]
        for b, other in enumerate(bins):
            if a == b or fill[b] > fill[a] or not room or fill[b] == 205:
                continue
            come = {lengths[i] for i in other} | {lengths[i] + lengths[j] for i in other for j in other if i < j}
            assert not any(lengths[i] <= room for i in other)
            # equal fills: exchanges go one way only
            if fill[b] < fill[a]:
                assert not any(0 < c - lengths[i] <= room for c in come for i in own)


def test_blocks_of_like_lengths_come_near_the_bound():
    rng = random.Random(3)
    lengths = sorted((rng.choice([rng.randint(500, 530), rng.randint(1000, 1040)]) for _ in range(3000)), reverse=True)
    assert len(op.improve(op.best_fit(lengths, 2048), lengths, 2048)) <= -(-sum(lengths) // 2048) * 1.005
