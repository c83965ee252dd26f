"""Streaming jobs: restarts, new files, late rows, repeated deliveries."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from purseflow.session import fresh_path
from purseflow.streaming import arrivals, jobs

SCHEMA = "txn_id bigint, user_id bigint, category string, status string, amount decimal(18,2), ts timestamp_ntz"
START = datetime(2024, 1, 1)


def deliver(spark, path, *rows):
    full = [(i, u, c, s, Decimal(a), START + timedelta(seconds=sec)) for i, u, c, s, a, sec in rows]
    spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return jobs.file_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, max_files=1)


def test_restart_adds_nothing_and_new_files_are_added_once(spark):
    path, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    deliver(spark, path, (1, 1, "Food", "FAILED", "500000", 0), (2, 1, "Food", "SUCCESS", "500000", 1))
    run = lambda: jobs.run_to_table(jobs.fraud_alerts(source(spark, path), 480_000), "alerts", path=out)
    ids = lambda: sorted(r.txn_id for r in jobs.read_appended(spark, f"{out}/table").collect())
    run()
    assert ids() == [1]
    run()
    assert ids() == [1]
    deliver(spark, path, (3, 1, "Food", "FAILED", "490000", 5), (4, 1, "Food", "FAILED", "480000", 6))
    run()
    assert ids() == [1, 3]


def test_running_totals_continue_after_a_restart(spark):
    path, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    run = lambda: jobs.run_to_table(jobs.running_totals(source(spark, path)), "totals", "complete", path=out)
    got = lambda: {r.category: (r.total, r.n_rows) for r in jobs.read_complete(spark, f"{out}/table").collect()}
    deliver(spark, path, (1, 1, "Food", "SUCCESS", "10", 0), (2, 1, "Travel", "SUCCESS", "20", 0))
    run()
    assert got() == {"Food": (Decimal("10.00"), 1), "Travel": (Decimal("20.00"), 1)}
    deliver(spark, path, (3, 1, "Food", "SUCCESS", "5", 0))
    run()
    assert got() == {"Food": (Decimal("15.00"), 2), "Travel": (Decimal("20.00"), 1)}


def test_updates_hold_the_latest_state_per_user(spark):
    path, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    run = lambda: jobs.run_to_table(jobs.running_totals(source(spark, path), "user_id"), "balance", "update", path=out)
    deliver(spark, path, (1, 1, "Food", "SUCCESS", "10", 0), (2, 2, "Food", "SUCCESS", "20", 0))
    run()
    deliver(spark, path, (3, 1, "Food", "SUCCESS", "5", 0))
    run()
    got = {r.user_id: r.total for r in jobs.read_updated(spark, f"{out}/table", "user_id").collect()}
    assert got == {1: Decimal("15.00"), 2: Decimal("20.00")}


def test_late_rows_are_dropped_once_the_watermark_has_passed(spark):
    path, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    run = lambda: jobs.run_to_table(jobs.tumbling_totals(source(spark, path)), "windows", path=out)
    got = lambda: sorted((r.start.minute, r.n_rows) for r in jobs.read_appended(spark, f"{out}/table").collect())
    deliver(spark, path, (1, 1, "Food", "SUCCESS", "1", 10), (2, 1, "Food", "SUCCESS", "1", 320))
    run()
    assert got() == []  # the first window ends at 300 s, the watermark stands at 290 s
    deliver(spark, path, (3, 1, "Food", "SUCCESS", "1", 20), (4, 1, "Food", "SUCCESS", "1", 331))
    run()
    assert got() == [(0, 2)]
    deliver(spark, path, (5, 1, "Food", "SUCCESS", "1", 30), (6, 1, "Food", "SUCCESS", "1", 700))
    run()
    assert got() == [(0, 2), (5, 2)]


def test_repeats_within_the_watermark_come_out_once(spark):
    path, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    run = lambda: jobs.run_to_table(jobs.deduplicated(source(spark, path), "txn_id"), "dedup", path=out)
    deliver(spark, path, (1, 1, "Food", "SUCCESS", "1", 0), (1, 1, "Food", "SUCCESS", "1", 0), (2, 1, "Food", "SUCCESS", "1", 2))
    run()
    deliver(spark, path, (2, 1, "Food", "SUCCESS", "1", 2), (3, 1, "Food", "SUCCESS", "1", 4))
    run()
    assert sorted(r.txn_id for r in jobs.read_appended(spark, f"{out}/table").collect()) == [1, 2, 3]


def test_velocity_reports_only_complete_minutes(spark):
    path = fresh_path(spark, "in")
    deliver(spark, path, *[(i, 7, "Food", "SUCCESS", "1", s) for i, s in enumerate([1, 2, 59, 61, 62, 200])])
    stream = jobs.file_stream(spark, path, spark.createDataFrame([], SCHEMA).schema)
    table = jobs.run_to_table(jobs.velocity(stream), "velocity")
    got = sorted((r.start.minute, r.n_txns) for r in jobs.read_appended(spark, table).collect())
    assert got == [(0, 3), (1, 2)]


def record_run(spark, path, out):
    record = lambda batch, number, table: jobs.batch_record(batch, number, table, 480_000)
    return jobs.run_to_table(source(spark, path), "records", per_batch=record, path=out)


def test_one_record_per_batch_goes_on_after_a_restart_and_is_replaced(spark):
    path, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    deliver(spark, path, (1, 1, "Food", "FAILED", "500000", 100), (2, 1, "Travel", "SUCCESS", "5.50", 0))
    record_run(spark, path, out)
    deliver(spark, path, (3, 1, "Food", "FAILED", "480000", 70), (4, 1, None, "SUCCESS", "1", 71), (5, 1, "Food", None, "2", 0))
    table = record_run(spark, path, out)
    rows = lambda: [tuple(r) for r in jobs.read_appended(spark, table).orderBy("batch_id").collect()]
    top = lambda s: START + timedelta(seconds=s)
    want = [
        (2, 0, 1, top(100), "Food=500000.00;Travel=5.50", "FAILED=1;SUCCESS=1", 0),
        (3, 2, 0, top(71), "?=1.00;Food=480002.00", "?=1;FAILED=1;SUCCESS=1", 1),
    ]
    assert rows() == want
    again = spark.read.schema(SCHEMA).parquet(path).where("txn_id > 2")
    jobs.batch_record(again, 1, table, 480_000).write.mode("overwrite").parquet(f"{table}/batch_id=1")
    assert rows() == want


def test_an_empty_batch_has_a_record(spark):
    path = fresh_path(spark, "in")
    deliver(spark, path)
    row = jobs.batch_record(spark.read.schema(SCHEMA).parquet(path), 0, path, 1).first()
    assert (row.records, row.late, row.alerts, row.top, row.revenue_by_category) == (0, 0, 0, None, "")


def timed(spark, n, seconds):
    rows = [(i, i % 7, "Food", "SUCCESS", Decimal("1"), START + timedelta(seconds=seconds * i)) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_state_stays_bounded_over_many_deliveries(spark):
    rows, path, progress = timed(spark, 600, 60), fresh_path(spark, "landing"), []
    times = arrivals.schedule(rows)
    assert times.n == arrivals.DELIVERIES
    arrivals.deliver(rows, times, path, range(times.n))
    table = jobs.run_to_table(jobs.tumbling_totals(arrivals.landed(spark, path, rows.schema)), "windows", progress=progress)
    windows = jobs.read_appended(spark, table)
    assert windows.select("batch_id").distinct().count() >= 10
    assert windows.agg(F.sum("n_rows")).first()[0] == 595  # the last window is still open
    held = [p.stateOperators[0].numRowsTotal for p in progress]
    assert len(held) >= times.n and max(held) <= 12 < windows.count()


def test_rows_behind_the_watermark_are_dropped_and_counted_per_batch(spark):
    rows, path, out = timed(spark, 600, 60), fresh_path(spark, "landing"), fresh_path(spark, "out")
    times = arrivals.schedule(rows)
    behind = lambda k: [arrivals.in_span(rows, times, k - 3).limit(3).withColumn("txn_id", F.col("txn_id") + 1_000)] if k == 5 else []
    arrivals.deliver(rows, times, path, range(times.n), behind)
    stream = lambda: arrivals.landed(spark, path, rows.schema)
    windows = jobs.read_appended(spark, jobs.run_to_table(jobs.tumbling_totals(stream()), "windows"))
    assert windows.agg(F.sum("n_rows")).first()[0] == 595
    table = record_run(spark, f"{path}/*", out)
    late = {r.batch_id: (r.records, r.late) for r in jobs.read_appended(spark, table).collect()}
    assert late == {k: (53, 3) if k == 5 else (50, 0) for k in range(12)}


def test_more_rows_mean_more_deliveries(spark):
    rows = timed(spark, 100, 60)
    assert arrivals.schedule(rows, size=5).n == 20
    times = arrivals.schedule(rows, size=5)
    assert sum(arrivals.in_span(rows, times, k).count() for k in range(times.n)) == 100
    assert arrivals.schedule(rows.limit(0)) is None


def test_stored_files_are_streamed_in_place_in_bounded_batches(spark):
    path, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    for i in range(6):
        deliver(spark, path, *[(10 * i + j, 1, "Food", "SUCCESS", "1", j) for j in range(10)])
    size = max(f.length for f in spark.read.format("binaryFile").load(f"{path}/*.parquet").select("length").collect())
    stream = jobs.file_stream(spark, path, SCHEMA, max_bytes=2 * size + 1)
    rows = jobs.read_appended(spark, jobs.run_to_table(stream, "bounded", path=out))
    sizes = [r["count"] for r in rows.groupBy("batch_id").count().collect()]
    assert sum(sizes) == 60 and len(sizes) >= 3 and max(sizes) <= 20


def test_a_filtered_delivery_reads_only_its_time(spark):
    path = fresh_path(spark, "table")
    timed(spark, 100, 60).write.parquet(path)
    rows = spark.read.schema(SCHEMA).parquet(path)
    plan = arrivals.in_span(rows, arrivals.schedule(rows), 3)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan and "Exchange" not in plan


def test_rows_laid_out_by_span_are_the_same_and_a_delivery_opens_only_its_folder(spark):
    rows = timed(spark, 100, 60).orderBy(F.xxhash64("txn_id"))  # not in order of time
    rows = rows.unionByName(rows.limit(1).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    times = arrivals.schedule(rows)
    placed = arrivals.by_span(rows, times)
    for k in range(times.n):
        assert sorted(arrivals.in_span(placed, times, k).collect()) == sorted(arrivals.in_span(rows, times, k).collect())
    plan = arrivals.in_span(placed, times, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_span" in plan and "Exchange" not in plan


def test_bounded_state_has_no_more_partitions_than_cores(spark):
    path, progress, was = fresh_path(spark, "in"), [], spark.conf.get("spark.sql.shuffle.partitions")
    deliver(spark, path, *[(i, 7, "Food", "SUCCESS", "1", s) for i, s in enumerate([1, 2, 59, 61, 62, 200])])
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(cores + 12))
    try:
        table = jobs.run_to_table(jobs.velocity(source(spark, path)), "velocity", progress=progress, bounded=True)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(cores + 12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert {p.stateOperators[0].numShufflePartitions for p in progress} == {cores}
    assert sorted(r.n_txns for r in jobs.read_appended(spark, table).collect()) == [2, 3]
