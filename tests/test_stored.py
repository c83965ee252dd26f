"""Upserts by partition, validity intervals, differences between states."""

import os

from pyspark.sql import functions as F

from purseflow.operators import stored
from purseflow.operators.stored import IntervalTable, row_differences
from purseflow.session import fresh_path

SCHEMA = "k long, v string, month string, seq long"


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def contents(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def upsert(df, path):
    stored.upsert_partitions(df, path, ["k"], ["month"], F.col("seq"))
    return stored.read_stored(df.sparkSession, path, SCHEMA)


def files_of(path):
    return {f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_an_upsert_rewrites_only_the_folders_it_touches(spark):
    path = fresh_path(spark, "table")
    upsert(frame(spark, (1, "a", "2024-01", 1), (2, "b", "2024-02", 1), (3, "c", "2024-03", 1), (4, "d", "2024-03", 1)), path)
    before = files_of(path)
    # 3 is replaced, 1 moves and leaves its folder empty, 5 opens a folder, 6 comes twice
    second = frame(spark, (3, "C", "2024-03", 2), (1, "A", "2024-04", 2), (5, "e", "2024-04", 2), (6, "f", "2024-03", 2), (6, "F", "2024-03", 3))
    want = [(1, "A", "2024-04", 2), (2, "b", "2024-02", 1), (3, "C", "2024-03", 2), (4, "d", "2024-03", 1), (5, "e", "2024-04", 2), (6, "F", "2024-03", 3)]
    assert contents(upsert(second, path)) == want
    after = files_of(path)
    assert {f for f in before & after} == {f for f in before if "2024-02" in f}
    assert not any("2024-01" in f for f in after)
    assert contents(upsert(second, path)) == want  # a repeated delivery changes nothing


def test_upserts_of_nothing_and_of_null_folders(spark):
    path = fresh_path(spark, "table")
    upsert(frame(spark, (1, "a", None, 1), (2, "b", None, 1), (3, None, "x", 1)), path)
    upsert(frame(spark), path)
    assert contents(upsert(frame(spark, (1, "A", "y", 2)), path)) == [(1, "A", "y", 2), (2, "b", None, 1), (3, None, "x", 1)]
    assert contents(upsert(frame(spark, (2, "B", "y", 2)), path)) == [(1, "A", "y", 2), (2, "B", "y", 2), (3, None, "x", 1)]


def test_an_empty_first_delivery(spark):
    path = fresh_path(spark, "table")
    assert upsert(frame(spark), path).count() == 0
    assert contents(upsert(frame(spark, (1, "a", "x", 1)), path)) == [(1, "a", "x", 1)]


def test_the_kept_rows_are_read_from_touched_folders_only(spark):
    path = fresh_path(spark, "table")
    rows = upsert(frame(spark, *[(i, "a", f"2024-{i:02d}", 1) for i in range(1, 13)]), path)
    plan = rows.where(stored._in_partitions(["month"], [("2024-03",), (None,)]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((month" in plan


def interval_table(spark):
    table = IntervalTable(spark, fresh_path(spark, "intervals"), "k long, v long", ["k"])
    table.append(spark.range(0, 1000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v")), 0)
    table.append(spark.range(1000, 1100).select(F.col("id").alias("k"), F.lit(None).cast("long").alias("v")), 1)
    table.update(F.col("k") % 100 == 7, {"v": F.col("k")}, 2)
    table.update(F.col("v") > 500, {"v": F.col("v") + 1}, 3)  # a missing value is no match
    return table


def test_an_update_writes_as_many_rows_as_it_changes(spark):
    table = interval_table(spark)
    counts = {r.version: (r.opened, r.closed) for r in table.counts().collect()}
    assert counts == {0: (1000, 0), 1: (100, 0), 2: (11, 11), 3: (6, 6)}
    files = files_of(table.opened_path)
    table.update(F.lit(False), {"v": F.lit(1).cast("long")}, 4)
    assert files <= files_of(table.opened_path)
    assert contents(table.as_of(4)) == contents(table.as_of(3))


def test_states_and_intervals(spark):
    table = interval_table(spark)
    state = lambda v: {r.k: r.v for r in table.as_of(v).collect()}
    assert [len(state(v)) for v in range(4)] == [1000, 1100, 1100, 1100]
    assert state(0)[7] == 0 and state(2)[7] == 7 and state(2)[507] == 507 and state(3)[507] == 508
    assert state(2)[1007] == 1007 and state(1)[1007] is None
    found = contents(table.intervals().where("k in (7, 507, 1007, 8)"))
    assert found == sorted([
        (7, 0, 0, 2), (7, 7, 2, None), (8, 0, 0, None), (507, 0, 0, 2), (507, 507, 2, 3), (507, 508, 3, None),
        (1007, None, 1, 2), (1007, 1007, 2, 3), (1007, 1008, 3, None),
    ], key=repr)


def test_a_repeated_update_replaces_itself(spark):
    table = interval_table(spark)
    before = contents(table.as_of(3))
    table.update(F.col("v") > 500, {"v": F.col("v") + 1}, 3)
    assert contents(table.as_of(3)) == before


def test_an_old_state_reads_only_its_folders(spark):
    plan = interval_table(spark).as_of(1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(since" in plan and "since" in plan


DIFF = "k long, a string, b long"


def test_row_differences(spark):
    before = frame(spark, (1, "x", 1), (2, None, 1), (3, "x", None), (4, "x", 1), (5, None, None), schema=DIFF)
    after = frame(spark, (1, "x", 1), (2, "1", None), (3, "x", None), (4, "x", 2), (6, None, None), schema=DIFF)
    got = contents(row_differences(before, after, ["k"]))
    assert got == [
        (2, "changed", None, 1, "1", None), (4, "changed", "x", 1, "x", 2),
        (5, "removed", None, None, None, None), (6, "added", None, None, None, None),
    ]
    assert row_differences(before, before, ["k"]).count() == 0
    assert row_differences(before.limit(0), after.limit(0), ["k"]).count() == 0


def test_values_that_move_between_columns_are_changes(spark):
    before = frame(spark, (1, None, 5), schema="k long, a long, b long")
    after = frame(spark, (1, 5, None), schema="k long, a long, b long")
    assert contents(row_differences(before, after, ["k"])) == [(1, "changed", None, 5, 5, None)]
