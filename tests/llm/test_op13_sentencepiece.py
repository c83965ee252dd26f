import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from purseflow.llm import op13_sentencepiece as op
from purseflow.llm.pieces import PieceCodec

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def encode_all(codec, texts):
    got = []
    for first, end, ids, bounds in codec.documents(pa.record_batch([pa.array(texts)], names=["text"])):
        assert codec.texts(ids, bounds) == [(t or "").replace("▁", " ") for t in texts[first:end]]
        got += [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(end - first)]
    return got


def test_ids_of_drawn_texts_equal_the_library(library):
    rng = random.Random(5)
    codec = PieceCodec(PATH)
    parts = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "日", "本", "<s>", "</s>", "<unk>", "<0x41>", "\0", "​", "🙂", "é", "the", "ing"]
    pieces = list(codec.ids_of)
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3_000)]
    texts += ["".join(rng.choices(pieces, k=rng.randint(0, 30))).replace("▁", " ") for _ in range(3_000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x250), rng.randint(0x370, 0x3000), rng.randint(0x10000, 0x10FFFF)])) for _ in range(20)) for _ in range(500)]
    texts += ["a" * 5_000, "ab" * 4_000, "日本" * 3_000, " " * 3_000, "", " ", "▁"]
    assert encode_all(codec, texts) == library.encode(texts)
    few = PieceCodec(PATH, kept=300)  # a table that is emptied again and again
    assert encode_all(few, texts[:2_000]) == library.encode(texts[:2_000])


def test_both_agendas_agree():
    rng = random.Random(8)
    codec = PieceCodec(PATH)
    letters = "".join(c for c in codec.ids_of if len(c) == 1)
    segments = ["".join(rng.choices("aabcehinorst▁", k=rng.randint(2, 24))) for _ in range(3_000)]
    segments += ["".join(rng.choices(letters, k=rng.randint(2, 24))) for _ in range(1_000)]
    segments += ["a" * k for k in range(2, 25)]
    width = max(map(len, segments))
    symbols = np.full((len(segments), width), -1, np.int64)
    for i, text in enumerate(segments):
        symbols[i, : len(text)] = codec.symbol_of_letter[codec.letter[[ord(c) for c in text]]]
    got = codec.merge_rows(symbols)
    assert [codec.id_of_symbol[r[r >= 0]].tolist() for r in got] == [codec.merge(text) for text in segments]


def test_long_patterned_words_keep_their_own_ids(library):
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba"))]
    assert encode_all(PieceCodec(PATH), texts) == library.encode(texts)


def test_decoding_any_ids_equals_the_library(library):
    rng = random.Random(6)
    codec = PieceCodec(PATH)
    rows = [[rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31_999), 29_871]) for _ in range(rng.randint(0, 12))] for _ in range(5_000)]
    rows += [[1, 29_871, 29_871], [1, 2], [], [2, 198, 1, 165, 1], [198, 165]]
    ids = np.array([i for r in rows for i in r], np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    assert codec.texts(ids, bounds) == [library.decode(r) for r in rows]


def test_edge_rows(spark, edge, rows, library):
    got = op.decode(op.encode(edge, PATH), PATH).collect()
    assert all(r.agrees for r in got)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    want = sorted(((i, library.encode(t or ""), t or "") for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.ids, r.text) for r in got), key=key) == want
    assert op.encode(edge, PATH, check=False).columns == ["doc_id", "ids"]
    assert op.decode(op.encode(edge, PATH, check=False), PATH, check=False).columns == ["doc_id", "ids", "text"]


def test_empty_table_and_null_ids(spark, empty):
    assert op.decode(op.encode(empty, PATH), PATH).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in op.decode(nothing, PATH).collect()] == ["", ""]


def test_query(spark, folder, corpus, library):
    got = {r.doc_id: r for r in op.op13_sentencepiece(spark, folder).collect()}
    assert len(got) == len(corpus)
    for doc, text in corpus:
        ids = library.encode(text or "")
        assert got[doc].n_tokens == len(ids) and got[doc].agrees
        assert got[doc].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_other_models_are_refused(tmp_path):
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    other = tmp_path / "other.model"
    other.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        PieceCodec(str(other))
