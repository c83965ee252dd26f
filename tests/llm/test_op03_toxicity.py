import zlib

from purseflow.llm import op03_toxicity as op


def test_grammar_composes_aspects():
    lexicon = op.Lexicon({"idiot": 5.0}, {"grumb": 4.0})
    found = lambda text: dict(zip(op.FEATURES, op.matches(text, lexicon)))
    plain, negated, said = found("what an idiot"), found("he is not an idiot"), found("she said he is an idiot")
    assert plain["asserted"] > 0 and not plain["negated"] and plain["clauses"] > 0
    assert negated["negated"] > 0 and not negated["asserted"]
    assert said["reported"] > 0 and not said["asserted"]
    assert found("you idiot")["aimed"] > 0 and found("idiot you")["aimed"] > 0 and not plain["aimed"]
    assert found("we will kill you")["threats"] > 0 and not found("kill the process")["threats"]
    assert found("not here, idiot")["asserted"] > 0  # a new clause ends the negation
    assert found("you Grumblers!")["asserted"] > 0  # by its stem
    assert not any(found("idiotic is another word").values()) and not any(found(None).values())


def test_machine_tables_are_complete():
    assert all(len(row) == 6 for row in op.NEXT) and max(max(r) for r in op.NEXT) < len(op.NEXT)


def test_held_out_accuracy_and_whole_result(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in op.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    truth = [(r.toxic, got[r.doc_id]) for r in labels.collect() if r.toxic is not None and got[r.doc_id].held_out]
    assert sum(p.predicted == y for y, p in truth) >= 0.97 * len(truth)


def test_held_out_labels_are_never_read(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    one, two = ({r.doc_id: r.score for r in op.toxicity(docs, x).collect()} for x in (labels, turned))
    assert one == two


def test_edge_rows(spark, edge, empty, rows):
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, None), (None, 1), (3, 1), (3, 0)], "doc_id long, toxic int")
    got = op.toxicity(edge, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in op.toxicity(edge, labels.where("false")).collect()} == {0}
    assert op.toxicity(empty, labels).count() == 0


def trained(spark, toxic, clean):
    ids = [i for i in range(20 * (len(toxic) + len(clean))) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, text, k < len(toxic)) for k, (i, text) in enumerate(zip(ids, toxic + clean))]
    return op.train(
        spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"),
        spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int"),
    ).lexicon


def test_copies_of_a_clean_text_do_not_clear_an_insult(spark):
    toxic = [f"a{i} plonk b{i}" for i in range(20)]
    copied = ["nobody is a plonk here"] * 2000 + [f"c{i} d{i}" for i in range(20)]
    assert trained(spark, toxic, copied).weight("plonk") > 0
    many = [f"e{i} plonk f{i}" for i in range(2000)]  # as often, but in contexts of their own
    assert not trained(spark, toxic, many).weight("plonk")


def test_lexicon_has_every_entry_with_enough_contexts(spark):
    words = [f"{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}q" for i in range(5_300)]
    toxic = [" ".join(f"x{k} {w}" for w in words) + f" x{k}" for k in range(op.MIN_CONTEXTS)]
    lexicon = trained(spark, toxic, [f"clean text {i}" for i in range(200)])
    assert all(lexicon.weight(w) > 0 for w in words)
