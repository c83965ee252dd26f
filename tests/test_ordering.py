"""Order-based operators against brute force, on skewed groups spread over many ranges."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from purseflow.operators import counting, joins, ordering


def rows(seed: int, n: int = 400):
    rng = random.Random(seed)
    # one group owns most rows, one value is frequent, some groups have a single row
    return [
        (i, rng.choice(["hot"] * 7 + ["warm", "cold"]) if i else "single",
         Decimal(rng.choice([1, 1, 1, rng.randint(0, 40)])).quantize(Decimal("0.01")))
        for i in range(n)
    ]


# hot keys split off, no key hot, all keys broadcast
WAYS = [{"hot_floor": 0, "small": 0}, {"hot_floor": 10**9, "small": 0}, {}]


@pytest.fixture(params=[1, 2])
def data(request):
    return rows(request.param)


@pytest.fixture
def frame(spark, data):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.createDataFrame(data, "id bigint, grp string, v decimal(18,2)").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_positions_without_groups(frame, data):
    got = {r.id: r.pos for r in ordering.positions(frame, [F.col("v"), F.col("id")]).collect()}
    want = {r[0]: i for i, r in enumerate(sorted(data, key=lambda r: (r[2], r[0])))}
    assert got == want


def test_positions_within_groups(frame, data):
    placed = ordering.positions(frame, [F.col("id")], ["grp"])
    got = {r.id: (r.grp, r.pos) for r in placed.collect()}
    seen, want = defaultdict(int), {}
    for i, g, _ in data:
        want[i] = (g, seen[g])
        seen[g] += 1
    assert got == want


def test_the_hot_group_is_spread_over_ranges(frame):
    placed = ordering.in_order(frame, [F.col("grp"), F.col("id")], "spread")
    hot = placed.where("grp = 'hot'")
    assert hot.select("part").distinct().count() >= 4
    largest = placed.groupBy("part").count().agg(F.max("count")).first()[0]
    assert largest <= 400 // 3


def test_ranks_share_places_on_ties(frame, data):
    got = {r.id: r.rnk for r in ordering.ranks(frame, ["grp"], F.col("v"), "id").collect()}
    want = {
        i: 1 + sum(1 for j, h, w in data if h == g and w > v) for i, g, v in data
    }
    assert got == want


@pytest.mark.parametrize("window", [1, 2, 3, 7, 60])
def test_rolling_sum(frame, data, window):
    rolled = ordering.rolling_sum(frame, "grp", ["id"], "v", window)
    got = {r.id: r.rolling for r in rolled.collect()}
    history, want = defaultdict(list), {}
    for i, g, v in data:
        history[g].append(v)
        want[i] = sum(history[g][-window:])
    assert got == want


def test_order_statistics(frame, data):
    n = F.col("total")
    picks = {"first": F.lit(0), "q1": F.floor(n / 4), "mid": F.floor(n / 2), "last": n - 1}
    got = {r.pick: r.value for r in ordering.order_statistics(frame, "v", picks).collect()}
    ordered = sorted(r[2] for r in data)
    assert got == {"first": ordered[0], "q1": ordered[100], "mid": ordered[200], "last": ordered[-1]}


def test_order_statistics_of_one_row(spark):
    one = spark.createDataFrame([(Decimal("5.00"),)], "v decimal(18,2)")
    got = ordering.order_statistics(one, "v", {"q": F.floor(F.col("total") / 4)}).collect()
    assert [(r.pick, r.value, r.total) for r in got] == [("q", Decimal("5.00"), 1)]


def test_head_per_group(frame, data):
    head = ordering.head_per_group(frame, ["grp"], [F.col("v").desc(), F.col("id")], 3)
    got = {(r.grp, r.id) for r in head.collect()}
    want = set()
    for g in {r[1] for r in data}:
        best = sorted((r for r in data if r[1] == g), key=lambda r: (-r[2], r[0]))[:3]
        want |= {(g, r[0]) for r in best}
    assert got == want


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("how", ["inner", "left"])
def test_group_stats_join_in_every_way(frame, data, way, how):
    stats = frame.groupBy("grp").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    stats = stats.where("grp <> 'cold'")
    joined = joins.join_group_stats(frame, stats, ["grp"], "n", how=how, **way)
    sums = defaultdict(Decimal)
    for _, g, v in data:
        sums[g] += v
    want = {
        (i, None if g == "cold" else sums[g]) for i, g, _ in data if how == "left" or g != "cold"
    }
    assert {(r.id, r.total) for r in joined.collect()} == want


def test_null_is_a_group_like_any_other(spark):
    rows_ = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id bigint, grp string")
    assert {(r.id, r.pos) for r in ordering.positions(rows_, [F.col("id")], ["grp"]).collect()} == {(1, 0), (2, 1), (3, 0)}
    stats = rows_.groupBy("grp").agg(F.count("*").alias("size"), F.count("*").alias("n"))
    for way in WAYS:
        joined = joins.join_group_stats(rows_, stats, ["grp"], "n", **way)
        assert {(r.id, r.size) for r in joined.collect()} == {(1, 2), (2, 2), (3, 1)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id bigint, grp string")
    assert ordering.positions(none, [F.col("id")], ["grp"]).count() == 0
    assert ordering.order_statistics(none, "id", {"a": F.col("total") - 1}).count() == 0
    assert ordering.rolling_sum(none, "grp", ["id"], "id", 3).count() == 0
    assert ordering.ranks(none, ["grp"], F.col("id"), "id").count() == 0


def test_broadcast_only_below_the_bound(frame):
    assert "broadcast" in plan(frame.join(joins.broadcast_if_small(frame, 1_000), "id")).lower()
    frame.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "broadcast" not in plan(frame.join(joins.broadcast_if_small(frame, 10), "id")).lower()
    finally:
        frame.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_rolling_sum_of_nulls_over_several_ranges(spark):
    rows = [
        (i, None if i % 3 == 0 else "ab"[i % 2], None if i % 5 else i) for i in range(4_000)
    ]
    df = spark.createDataFrame(rows, "id bigint, grp string, v bigint").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rolled = ordering.rolling_sum(df, "grp", ["id"], "v", 3)
        got = {r.id: r.rolling for r in rolled.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    df.createOrReplaceTempView("rolling_rows")
    want = spark.sql(
        "SELECT id, SUM(v) OVER (PARTITION BY grp ORDER BY id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s FROM rolling_rows"
    )
    assert got == {r.id: r.s for r in want.collect()}


@pytest.mark.parametrize("values", [[5], [1, 2], [None, 3], list(range(400)), [None]])
def test_ranks_of_ties_over_many_ranges(spark, values):
    """One tie, and one group, may go on over several ranges; missing groups and values are groups and ties too."""
    rows = [(["a", "b", None][i % 3] if i % 7 else "hot", values[(i * 31) % len(values)], i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(5)
    got = {r.id: r.rnk for r in ordering.ranks(df, ["g"], F.col("v"), "id").collect()}
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    assert got == {r.id: r.rnk for r in df.withColumn("rnk", F.rank().over(w)).collect()}


def test_ranks_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([(i % 4, i) for i in range(50)], "v int, id int")
    got = {r.id: r.rnk for r in ordering.ranks(df, [], F.col("v"), "id").collect()}
    assert got == {i: 1 + sum(j % 4 > i % 4 for j in range(50)) for i in range(50)}
    assert ordering.ranks(df.limit(0), [], F.col("v"), "id").collect() == []


def test_totals_with_distinct_counts(spark):
    rows = [("a", 1, 5), ("a", None, 5), (None, 2, None), ("b", 1, 5), (None, 2, 7)]
    df = spark.createDataFrame(rows, "x string, y int, z int")
    counts = {"n": F.count("*"), "big": F.count_if(F.col("z") > 5)}
    got = counting.totals_with_distinct(df, counts, {"xs": "x", "ys": "y", "zs": "z"}).first()
    assert got.asDict() == {"n": 5, "big": 1, "xs": 2, "ys": 2, "zs": 2}
    assert tuple(counting.totals_with_distinct(df.limit(0), counts, {"xs": "x", "ys": "y"}).first()) == (0, 0, 0, 0)
