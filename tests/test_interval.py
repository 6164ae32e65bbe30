"""Interval join + aggregate: closed windows, fallbacks, pooled duplicate keys, bucketing."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from haulstat.operators.interval import attach_interval_aggregate, interval_aggregate
from tests.conftest import ts

TRIPS = "trip_id int, route_id string, dep timestamp_ntz, arr timestamp_ntz"
READ = "route_id string, t timestamp_ntz, v double, acc int"


def test_closed_window_and_fallbacks(spark):
    trips = spark.createDataFrame([
        (1, "r1", ts("2024-01-01 07:00:00"), ts("2024-01-01 10:00:00")),
        (2, "r1", ts("2024-01-05 07:00:00"), ts("2024-01-05 08:00:00")),   # no reading inside
        (3, "r9", ts("2024-01-01 07:00:00"), ts("2024-01-01 10:00:00")),   # route without readings
    ], TRIPS)
    readings = spark.createDataFrame([
        ("r1", ts("2024-01-01 07:00:00"), 10.0, 0),          # exactly at departure
        ("r1", ts("2024-01-01 10:00:00"), 20.0, 1),          # exactly at arrival
        ("r1", ts("2024-01-01 06:59:59"), 1000.0, 1),        # just before
        ("r1", ts("2024-01-01 10:00:01"), 1000.0, 1),        # just after
        ("r1", None, 70.0, 0),                               # null time: only in the fallback
    ], READ)
    out = attach_interval_aggregate(
        trips, readings, by="route_id", start="dep", end="arr", ts="t",
        aggs={"v": ("avg", "v"), "acc": ("max", "acc")}, keys=["trip_id"],
        fallback_mean=["v"], constant_fill={"acc": 0})
    got = {r["trip_id"]: (r["v"], r["acc"]) for r in out.collect()}
    assert got[1] == (15.0, 1)
    assert got[2] == ((10 + 20 + 1000 + 1000 + 70) / 5, 0)
    assert got[3] == (None, 0)


def test_duplicate_keys_pool_their_windows(spark):
    trips = spark.createDataFrame([
        (1, "r1", ts("2024-01-01 00:00:00"), ts("2024-01-01 02:00:00")),
        (1, "r1", ts("2024-01-01 00:00:00"), ts("2024-01-01 05:00:00")),
    ], TRIPS)
    readings = spark.createDataFrame([("r1", ts("2024-01-01 01:00:00"), 1.0, 0),
                                      ("r1", ts("2024-01-01 04:00:00"), 4.0, 0)], READ)
    agg = interval_aggregate(trips, readings, by="route_id", start="dep", end="arr", ts="t",
                             aggs={"v": ("avg", "v"), "n": ("count", "v")}, keys=["trip_id"])
    row = agg.collect()[0]
    assert row["n"] == 3 and row["v"] == pytest.approx(2.0)


@pytest.mark.parametrize("bucket_hours", [1, 5, 24, 24 * 7])
def test_bucketed_equals_plain_join(spark, bucket_hours):
    rnd = random.Random(bucket_hours)
    base = dt.datetime(2024, 1, 1)
    trips = []
    for i in range(150):
        d = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 30))
        trips.append((i, rnd.choice(["a", "b", "c"]), d, d + dt.timedelta(minutes=rnd.randrange(-30, 60 * 24 * 4))))
    readings = [(rnd.choice(["a", "b", "c"]), base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 34)),
                 float(rnd.randrange(100)), rnd.randrange(2)) for _ in range(2000)]
    t = spark.createDataFrame(trips, TRIPS)
    r = spark.createDataFrame(readings, READ)
    got = interval_aggregate(t, r, by="route_id", start="dep", end="arr", ts="t",
                             aggs={"s": ("sum", "v"), "n": ("count", "v"), "m": ("max", "acc")},
                             keys=["trip_id"], bucket_hours=bucket_hours)
    plain = (t.join(r, (t.route_id == r.route_id) & (r.t >= t.dep) & (r.t <= t.arr))
             .groupBy("trip_id").agg(F.sum("v").alias("s"), F.count("v").alias("n"), F.max("acc").alias("m")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.select("trip_id", "s", "n", "m").collect()))


@pytest.mark.parametrize("bucket_hours", [6, 24])
def test_broadcast_path_equals_shuffle_path(spark, bucket_hours):
    from haulstat.operators.interval import window_size_bound
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    trips = []
    for i in range(120):
        d = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 20))
        trips.append((i, rnd.choice(["a", "b"]), d, d + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 3))))
    readings = [(rnd.choice(["a", "b", None]), base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 24)),
                 float(rnd.randrange(100)), rnd.randrange(2)) for _ in range(1500)]
    t = spark.createDataFrame(trips, TRIPS)
    r = spark.createDataFrame(readings, READ)
    bound = window_size_bound(t, "dep", "arr", bucket_hours)
    kw = dict(by="route_id", start="dep", end="arr", ts="t", aggs={"v": ("avg", "v"), "acc": ("max", "acc")},
              keys=["trip_id"], fallback_mean=["v"], constant_fill={"acc": 0}, bucket_hours=bucket_hours)
    bc = attach_interval_aggregate(t, r, window_size_bound=bound, broadcast_max_rows=10**9, **kw)
    sh = attach_interval_aggregate(t, r, window_size_bound=None, **kw)
    assert "BroadcastHashJoin" in bc._jdf.queryExecution().executedPlan().toString()
    rows = lambda df: sorted((x["trip_id"], round(x["v"], 9) if x["v"] is not None else None, x["acc"])
                             for x in df.collect())
    assert rows(bc) == rows(sh)


def test_plan_windows_width_and_bound(spark):
    from haulstat.operators.interval import plan_windows
    rows = [(i, "a", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1) + dt.timedelta(hours=h))
            for i, h in enumerate([2, 4, 6, 8])]
    width, (n, widest) = plan_windows(spark.createDataFrame(rows, TRIPS), "dep", "arr")
    assert width == pytest.approx(5.0 / 8) and n == 4 and widest == 8 // (5.0 / 8) + 2


def test_long_windows_meet_few_summaries(spark):
    """Windows of 1 to 4,000 buckets over one hot key: equal to plain sums, and a window meets at most two blocks a level."""
    from haulstat.operators.interval import covering_blocks
    base = dt.datetime(1969, 12, 1)  # buckets below and above 0
    readings = spark.range(20_000).select(F.lit("hot").alias("route_id"), F.expr(
        "timestampadd(MINUTE, CAST(id * 13 AS INT), TIMESTAMP_NTZ '1969-12-01 00:00:00')").alias("t"),
        F.when(F.col("id") % 17 > 0, (F.col("id") % 101).cast("double")).alias("v"), (F.col("id") % 2).cast("int").alias("acc"))
    trips = spark.createDataFrame([(i, "hot", base + dt.timedelta(minutes=37 * i), base + dt.timedelta(minutes=37 * i + 1 + i ** 2 % 240_000))
                                   for i in range(0, 1200, 3)], TRIPS)
    got = interval_aggregate(trips, readings, by="route_id", start="dep", end="arr", ts="t", keys=["trip_id"], bucket_hours=1,
                             aggs={"s": ("sum", "v"), "n": ("count", "v"), "m": ("avg", "v"), "lo": ("min", "v"), "hi": ("max", "acc")})
    plain = (trips.join(readings, (trips.route_id == readings.route_id) & (readings.t >= trips.dep) & (readings.t <= trips.arr))
             .groupBy("trip_id").agg(F.sum("v").alias("s"), F.count("v").alias("n"), F.avg("v").alias("m"), F.min("v").alias("lo"),
                                     F.max("acc").alias("hi")))
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    assert key(got.collect()) == key(plain.collect())
    spans = spark.range(3000).select((F.col("id") * 7 % 991 - 500).alias("a"), (F.col("id") * 11 % 4001).alias("n"))
    x = F.expr("flatten(transform(c, x -> sequence(x.block * shiftleft(1L, x.level), (x.block + 1) * shiftleft(1L, x.level) - 1)))")
    bad = (spans.withColumn("c", covering_blocks(F.col("a"), F.col("a") + F.col("n"), 12))
           .where((F.size("c") > 26) | (F.array_sort(x) != F.sequence("a", F.col("a") + F.col("n")))))
    assert bad.count() == 0


def test_summaries_of_other_types(spark):
    trips = spark.createDataFrame([(1, "a", ts("2024-01-01 00:30:00"), ts("2024-01-09 10:00:00"))], TRIPS)
    readings = spark.range(0, 400).select(F.lit("a").alias("route_id"), F.expr(
        "timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("t"),
        (F.col("id") % 9).cast("decimal(9,2)").alias("d"), (F.col("id") % 7).cast("int").alias("i"), F.lit(None).cast("double").alias("z"))
    aggs = {"d": ("avg", "d"), "ds": ("sum", "d"), "i": ("avg", "i"), "im": ("max", "i"), "z": ("avg", "z"), "zn": ("count", "z")}
    got = interval_aggregate(trips, readings, by="route_id", start="dep", end="arr", ts="t", keys=["trip_id"], aggs=aggs, bucket_hours=2)
    inside = readings.where("t BETWEEN TIMESTAMP_NTZ '2024-01-01 00:30:00' AND TIMESTAMP_NTZ '2024-01-09 10:00:00'")
    want = inside.agg(F.avg("d").alias("d"), F.avg("i").alias("i"), F.max("i").alias("im"), F.sum("d").alias("ds")).first()
    row = got.first()
    assert (row["d"], row["i"], row["im"], row["ds"], row["z"], row["zn"]) == (want["d"], want["i"], want["im"], want["ds"], None, 0)
    assert got.schema["d"].dataType == inside.agg(F.avg("d").alias("d")).schema["d"].dataType


def _joined_rows(df):
    """Rows that the joins of a plan that has run put out."""
    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        m = node.metrics().get("numOutputRows")
        own = m.get().value() if "Join" in name and m.isDefined() else 0
        kids = node.children()
        return own + sum(walk(kids.apply(i)) for i in range(kids.size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("step", [1, 3600])
def test_work_grows_with_rows_not_with_pairs(spark, step):
    """Windows of no length up to weeks, thousands in a bucket that holds thousands of readings: plain sums, and few joined rows."""
    base = "timestampadd(SECOND, CAST({} AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')"
    n, span = 2000, 400 * step
    readings = spark.range(20_000).select(
        F.when(F.col("id") % 100 > 0, "hot").alias("route_id"), F.expr(base.format(f"id * 7919 % {span} DIV 3")).alias("t"),
        F.when(F.col("id") % 17 > 0, (F.col("id") % 101).cast("double")).alias("v"), (F.col("id") % 2).cast("int").alias("acc"))
    trips = spark.range(n).select(
        F.when(F.col("id") % 50 > 0, F.col("id") % 1900).cast("int").alias("trip_id"), F.lit("hot").alias("route_id"),
        F.expr(base.format(f"id * 31 % {span}")).alias("dep"),
        F.expr(base.format(f"id * 31 % {span} + CASE id % 4 WHEN 0 THEN 0 WHEN 1 THEN id % 7 ELSE id * 13 % {span} END")).alias("arr"))
    aggs = {"s": ("sum", "v"), "n": ("count", "v"), "m": ("avg", "v"), "lo": ("min", "v"), "hi": ("max", "acc")}
    got = interval_aggregate(trips, readings, by="route_id", start="dep", end="arr", ts="t", keys=["trip_id"], bucket_hours=24, aggs=aggs)
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert _joined_rows(got) <= 4 * (n + 20_000)
    plain = (trips.join(readings, (trips.route_id == readings.route_id) & (readings.t >= trips.dep) & (readings.t <= trips.arr))
             .groupBy("trip_id").agg(F.sum("v").alias("s"), F.count("v").alias("n"), F.avg("v").alias("m"), F.min("v").alias("lo"),
                                     F.max("acc").alias("hi")))
    assert rows == sorted(map(tuple, plain.collect()), key=repr)


def test_rows_with_keys_of_their_own_are_not_shuffled_by_them(spark):
    """Keys that no rows share need no pooling; the rows are the same either way, null keys and bounds included."""
    day = lambda d: dt.datetime(2024, 1, d)
    trips = spark.createDataFrame([(1, "a", day(1), day(3)), (2, "a", day(2), day(4)), (3, "b", day(9), day(9)), (None, "a", day(1), day(3)),
                                   (None, "a", day(1), day(3)), (4, None, day(1), day(3)), (5, "a", day(4), day(2)), (6, "b", None, day(2))], TRIPS)
    readings = spark.createDataFrame([("a", day(d), float(d), d % 2) for d in range(1, 6)] + [("b", day(1), 7.0, 1), ("b", None, 9.0, 0)], READ)
    kw = dict(by="route_id", start="dep", end="arr", ts="t", aggs={"v": ("avg", "v"), "n": ("count", "v"), "acc": ("max", "acc")},
              keys=["trip_id"], fallback_mean=["v"], constant_fill={"acc": 0})
    met = {u: attach_interval_aggregate(trips, readings, unique=u, **kw) for u in (None, False)}
    rows = {u: sorted(map(tuple, d.collect()), key=repr) for u, d in met.items()}
    assert rows[None] == rows[False] and len(rows[None]) == 8
    plans = {u: d._jdf.queryExecution().executedPlan().toString() for u, d in met.items()}
    assert "hashpartitioning(trip_id" not in plans[None] and "hashpartitioning(trip_id" in plans[False]


def test_shared_keys_are_seen(spark):
    from haulstat.operators.interval import keys_unique
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, "a")], "k int, g string")
    assert keys_unique(rows, ["k", "g"]) and not keys_unique(rows, ["k"])
