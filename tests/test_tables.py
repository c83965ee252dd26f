"""Snapshots, idempotent loads, keyed log, files and the batch run."""

import codecs
import gzip
import hashlib
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from purseflow.operators import ingest, keyed_log, rules, warehouse
from purseflow.operators.snapshots import VersionedTable
from purseflow.plans import batch
from purseflow.session import fresh_path, remove_staged, run_dir, shared_dir, stage
from purseflow.sources import files, synthetic

SCHEMA = "id bigint, v string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def contents(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def versioned(spark):
    t = VersionedTable(spark, fresh_path(spark, "t"), SCHEMA)
    t.write(table(spark, (1, "a"), (2, "b")), "overwrite")
    t.write(table(spark, (3, "c")), "append")
    return t


def test_time_travel_and_update(versioned):
    assert versioned.update(F.col("id") >= 2, {"v": F.lit("z")}) == 2
    assert contents(versioned.as_of(0)) == [(1, "a"), (2, "b")]
    assert contents(versioned.as_of(1)) == [(1, "a"), (2, "b"), (3, "c")]
    assert contents(versioned.as_of()) == [(1, "a"), (2, "z"), (3, "z")]
    last = versioned.history().collect()[-1]
    assert (last.action, last.n_rows, last.n_changed) == ("UPDATE", 3, 2)


def test_vacuum_keeps_live_appends(spark, versioned):
    versioned.write(table(spark, (4, "d")), "append")
    versioned.write(table(spark, (5, "e")), "append")
    before = contents(versioned.as_of())
    assert versioned.vacuum(retain=2) == []  # versions 0 and 1 are still visible
    assert contents(versioned.as_of()) == before
    versioned.write(table(spark, (9, "n")), "overwrite")
    versioned.write(table(spark, (10, "o")), "append")
    assert versioned.vacuum(retain=2) == [0, 1, 2, 3]
    assert contents(versioned.as_of()) == [(9, "n"), (10, "o")]
    assert versioned.vacuum(retain=2) == []  # nothing is freed twice
    for gone in (0, 99, -1):
        with pytest.raises(ValueError):
            versioned.as_of(gone)
    assert {r.version for r in versioned.stored_rows().collect()} == {4, 5}


def test_a_write_that_died_before_its_commit_is_not_seen_and_can_be_repeated(spark, versioned):
    table(spark, (7, "lost")).write.parquet(f"{versioned.rows_path}/version=2")
    assert contents(versioned.as_of()) == [(1, "a"), (2, "b"), (3, "c")]
    versioned.write(table(spark, (4, "d")), "append")
    assert contents(versioned.as_of()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_optimize_keeps_rows_and_counts(versioned):
    before = contents(versioned.as_of())
    versioned.optimize("id")
    assert contents(versioned.as_of()) == before
    assert contents(versioned.visible_counts()) == [(0, 2), (1, 3), (2, 3)]


def test_insert_ignore_and_upsert(spark):
    cols = "k bigint, seq bigint, v string"
    old = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], cols)
    new = spark.createDataFrame([(2, 3, "x"), (3, 4, "y"), (3, 5, "z")], cols)
    assert contents(ingest.insert_ignore(old, new, ["k"], ["seq"])) == [(3, 4, "y")]
    assert contents(ingest.upsert_latest(old, new, ["k"], F.col("seq"))) == [(1, 1, "a"), (2, 3, "x"), (3, 5, "z")]


def test_batches_cover_the_source_in_order(spark):
    raw = spark.range(23).select(
        F.col("id").alias("ordinal"), F.concat(F.lit("TXN"), F.col("id")).alias("txn_id"),
        F.when(F.col("id") == 7, "0").otherwise("5.00").alias("amount"),
    ).repartition(6)
    log = ingest.batch_log(ingest.numbered_batches(raw, 5))
    assert contents(log) == [(1, 5, 5, 0), (2, 5, 4, 1), (3, 5, 5, 0), (4, 5, 5, 0), (5, 3, 3, 0)]


def test_dim_date_covers_whole_years(spark):
    days = spark.createDataFrame([("2023-06-01",), ("2024-01-01",)], "d string").select(F.to_date("d").alias("d"))
    dim = warehouse.dim_date(days, "d")
    assert dim.count() == 365 + 366
    first = dim.orderBy("date_sk").first()
    assert (first.date_sk, first.month_name, first.quarter, first.is_weekend) == (20230101, "Jan", 1, 1)


def test_log_polls_move_on_independently(spark):
    rows = spark.range(40).select((F.col("id") % 7).alias("user"), F.col("id").alias("n"))
    log = stage(keyed_log.keyed_log(rows, "user", 2, [F.col("n")]), "log")
    assert log.groupBy("user").agg(F.count_distinct("bucket").alias("b")).where("b > 1").count() == 0
    sizes = {r.bucket: r.messages for r in keyed_log.distribution(log).collect()}
    start = keyed_log.start_offsets(log, ["a", "b"])
    size = F.when(F.col("consumer") == "a", 3).otherwise(100)
    polled = keyed_log.poll(log, start, size)
    after = {(r.consumer, r.bucket): r.next_offset for r in keyed_log.commit(start, polled).collect()}
    assert after == {("a", b): min(3, n) for b, n in sizes.items()} | {("b", b): n for b, n in sizes.items()}
    committed = keyed_log.commit(start, polled)
    again = keyed_log.commit(committed, keyed_log.poll(log, committed, size))
    assert {(r.consumer, r.bucket): r.next_offset for r in again.collect()}[("b", 0)] == sizes.get(0)
    back = keyed_log.seek(again, "b").where("consumer = 'b'")
    assert keyed_log.poll(log, back, F.lit(100)).count() == 40


def test_inventory_and_etags_match_the_file_system(spark, folder):
    names = [n for n in os.listdir(folder) if n.endswith(".parquet")]
    paths = [os.path.join(folder, n) for n in names]
    got = files.inventory(spark, folder).first()
    assert (got.n_files, got.n_bytes) == (len(paths), sum(os.path.getsize(p) for p in paths))
    want = {n: hashlib.md5(open(p, "rb").read()).hexdigest() for n, p in zip(names, paths)}
    assert {r["name"]: r.etag for r in files.etags(spark, folder).collect()} == want


def test_etags_of_large_files_are_read_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "AT_ONCE", 5_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "20000")  # stands for the 2 GB of one value
    try:
        rng = random.Random(3)
        noise = rng.randbytes(50_000)
        made = {
            "noise.parquet": noise, "feed": noise + b"\n", "feeds": noise + b"\n\n", "returns": b"a\r\nb\r" * 9_000, "b c%20d+é": noise[1:],
            "mark": codecs.BOM_UTF8 + noise, "mark feed": codecs.BOM_UTF8 + noise + b"\n", "marks": codecs.BOM_UTF8 * 10_000, "line": b"x" * 60_000,
            "only feeds": b"\n" * 30_000, "packed.gz": gzip.compress(noise[:10_000]), "small": b"ab", "deep/small": b"cd", "deep/noise.parquet": noise[2:],
        }
        (tmp_path / "deep").mkdir()
        for name, content in made.items():
            (tmp_path / name).write_bytes(content)
        want = sorted((n.rpartition("/")[2], len(c), hashlib.md5(c).hexdigest()) for n, c in made.items())
        assert sorted(map(tuple, files.etags(spark, str(tmp_path)).collect())) == want
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "4k"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_fingerprint_notices_every_change(spark):
    base = table(spark, (1, "a"), (2, "b"))
    same = table(spark, (2, "b"), (1, "a"))
    assert contents(files.fingerprint(base)) == contents(files.fingerprint(same))
    for other in (table(spark, (1, "a")), table(spark, (1, "a"), (2, "x")), table(spark, (1, "a"), (2, "b"), (3, "c"), (3, "c"))):
        assert contents(files.fingerprint(base)) != contents(files.fingerprint(other))


def test_source_order_runs_through_the_files_by_name(spark):
    path = fresh_path(spark, "many")
    spark.range(1_000).repartitionByRange(7, "id").sortWithinPartitions("id").write.parquet(path)
    scan = spark.read.schema("id bigint").parquet(path)
    placed = files.in_source_order(scan)
    assert placed.count() == 1_000 and placed.where("id <> pos").count() == 0
    assert placed.where("id % 2 = 1").where("id <> pos").count() == 0  # a filter moves no row


def test_the_first_row_of_a_repeated_id_follows_file_and_line_order(spark):
    path = fresh_path(spark, "ordered")
    cols = ["txn_id", "user_id", "merchant", "category", "amount", "status", "wallet_type", "timestamp", "date"]
    names = ["transactions_2023_01", "transactions_2023_02", "transactions_2023_03"]
    for name in reversed(names):  # written in another order than they are named
        lines = [(f"TXN{i % 10:08d}", "U0001", name, "Food", "5", "SUCCESS", "w", f"row {i}", "d") for i in range(20)]
        one = spark.createDataFrame(lines, ", ".join(f"{c} string" for c in cols)).coalesce(1)
        files.write_csv(one, f"{path}/file={name}")
    scan = files.read_csv(spark, f"{path}/file=*", cols)
    tidy = rules.tidy(files.with_source_order(scan))
    kept = {(r.txn_id, r.merchant, r.timestamp) for r in tidy.where(F.size("reasons") == 0).collect()}
    assert kept == {(f"TXN{i:08d}", names[0], f"row {i}") for i in range(10)}
    assert tidy.where(F.array_contains("reasons", "duplicate txn_id")).count() == 50


def test_csv_round_trip_as_text(spark):
    path = fresh_path(spark, "csv")
    rows = spark.createDataFrame([("a", "1,5"), (None, 'q"x')], "k string, amount string")
    files.write_csv(rows, path)
    back = files.read_csv(spark, path, ["k", "amount"])
    assert back.dtypes == [("k", "string"), ("amount", "string")]
    assert {tuple(r) for r in back.collect()} == {("a", "1,5"), (None, 'q"x')}


def test_typed_csv(spark):
    path = fresh_path(spark, "csv")
    files.write_csv(spark.createDataFrame([("1", "5.5", "2023-01-02 03:04:05"), ("2", "x", "bad")], "id string, amount string, at string"), path)
    got = sorted(tuple(map(str, r)) for r in files.read_typed_csv(spark, path, ["id", "amount", "at"], ["at"]).collect())
    assert got == [("1", "5.50", "2023-01-02 03:04:05"), ("2", "None", "None")]


def test_synthetic_rows_follow_the_contract(spark):
    rows = synthetic.transactions(spark.range(5_000), "id").cache()
    bounds = rows.agg(F.min("amount"), F.max("amount"), F.min("ts"), F.max("ts")).first()
    assert Decimal("10.00") <= bounds[0] and bounds[1] <= Decimal("50000.00")
    assert bounds[2].year == 2023
    share = {r.status: r["count"] / 5_000 for r in rows.groupBy("status").count().collect()}
    assert abs(share["SUCCESS"] - 0.75) < 0.03 and abs(share["REFUNDED"] - 0.05) < 0.02
    assert rows.select("txn_id").distinct().count() == 5_000


def test_replication_numbers_without_gaps_and_noise_is_centred(spark):
    rows = spark.range(300).select(F.col("id").alias("txn_id"), F.lit(Decimal("1000.00")).cast("decimal(18,2)").alias("amount"))
    got = synthetic.replicate(rows)
    ids = sorted(r.new_id for r in got.collect())
    assert ids == list(range(1, 3301))
    spread = got.agg(F.avg("cents"), F.stddev("cents")).first()
    assert abs(spread[0] - 100_000) < 500 and abs(spread[1] - 5_000) < 300


def test_batch_run_writes_every_layer(spark, folder):
    out = fresh_path(spark, "run")
    metrics = batch.run(spark, folder, out).first()
    layer = lambda name: spark.read.parquet(f"{out}/{name}")
    assert layer("bronze").count() == metrics.records_in == 1_500
    assert layer("silver").count() == metrics.records_out
    assert layer("rejects").count() == metrics.rejected > 0
    months = layer("silver").select("month").distinct().count()
    assert layer("lake").select("p_year", "p_month").distinct().count() == months > 6
    one = layer("lake").where("p_year = 1996 AND p_month = 3")
    assert "p_month" in one._jdf.queryExecution().toString() and one.count() > 0
    assert layer("gold_monthly").agg(F.sum("txns")).first()[0] == metrics.records_out
    assert spark.read.json(f"{out}/summary").first().records_in == 1_500


def test_daily_load_stops_at_the_gate(spark, folder):
    from purseflow.sources import tables

    raw = tables.raw(spark, folder)
    with pytest.raises(ValueError):
        batch.daily_load(None, raw, 99)
    once = batch.daily_load(None, raw, 50)
    twice = batch.daily_load(once, raw, 50)
    assert contents(files.fingerprint(once)) == contents(files.fingerprint(twice))


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    else:
        assert shared_dir(spark).startswith("/tmp/run-")


def test_checked_csv_keeps_unreadable_lines(spark):
    path = fresh_path(spark, "csv")
    lines = ["1,2.50,x", "two,1,y", "3,,z", '4,7,"a, b"', "5,1", "6,1,x,more", "", "8,1.005,", "9,abc,q"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, rejects = files.read_checked_csv(spark, path, "id int, amount decimal(9,2), name string")
    assert sorted(tuple(r) for r in good.where("id <> 8").collect()) == [
        (1, Decimal("2.50"), "x"), (3, None, "z"), (4, Decimal("7.00"), "a, b")
    ]
    assert {r.line for r in rejects.collect()} >= {"two,1,y", "5,1", "6,1,x,more", "9,abc,q"}
    assert good.count() + rejects.count() == 8  # the empty line is none


def test_staged_tables_lie_in_one_folder_that_can_be_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("purseflow.session.shared_dir", lambda spark: str(tmp_path))
    assert stage(spark.range(3), "three").count() == 3
    assert [spark.sparkContext.applicationId] == os.listdir(tmp_path / "purseflow")
    assert run_dir(spark) == f"{tmp_path}/purseflow/{spark.sparkContext.applicationId}"
    remove_staged(spark)
    assert os.listdir(tmp_path / "purseflow") == []
    remove_staged(spark)  # nothing left to remove
