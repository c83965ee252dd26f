import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from purseflow.llm import op07_token_files as op
from purseflow.llm.tokens import Encoder
from purseflow.session import fresh_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_round_trip(spark, edge, rows, plain):
    folder = fresh_path(spark, "tokens")
    op.write_token_file(edge, folder, PATH)
    got = op.read_token_file(spark, folder).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    known = [i for i in ids if i is not None]
    assert len(got) == len(rows) and known == sorted(known) and ids[:2] == [None, None]
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    want = {i: [*plain(t), 2] for i, t in rows if i is not None}
    assert all(np.frombuffer(r.ids, "<u4").tolist() == want[r.doc_id] for r in got if r.doc_id is not None)
    few = op.read_token_file(spark, folder, [7, 14, 99]).collect()
    assert sorted(r.doc_id for r in few) == [7, 14]
    assert {r.doc_id: r.start for r in few} == {r.doc_id: r.start for r in got if r.doc_id in (7, 14)}


def test_digests_of_the_given_table(spark, folder, corpus, plain):
    got = {r.doc_id: r for r in op.op7_token_files(spark, folder).collect()}
    at = 0
    for i, text in corpus:
        ids = np.array([*plain(text), 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_empty_table(spark, empty):
    folder = fresh_path(spark, "tokens")
    op.write_token_file(empty, folder, PATH)
    assert op.read_token_file(spark, folder).count() == 0


def test_foreign_dictionary_is_refused(spark, edge):
    one, two = fresh_path(spark, "tokens"), fresh_path(spark, "tokens")
    op.write_token_file(edge, one, PATH)
    spark.createDataFrame([("00", bytearray(b""), 2)], "dictionary_hash string, dictionary binary, width int").write.parquet(f"{two}/dictionary")
    spark.read.parquet(f"{one}/segments").write.parquet(f"{two}/segments")
    with pytest.raises(ValueError):
        op.read_token_file(spark, two)


def test_a_full_piece_table_changes_nothing(corpus, plain):
    import pyarrow as pa

    batch = pa.record_batch({"text": pa.array([t for _, t in corpus], pa.string())})
    small = Encoder(PATH, kept=500)
    assert all(ids.tolist() == plain(corpus[row][1]) for row, ids in small.documents(batch))
