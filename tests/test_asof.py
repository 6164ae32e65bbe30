"""Nearest as-of join: ledger cases and a brute-force property check."""

import datetime as dt
import random

import pytest

from haulstat.operators.asof import asof_nearest
from tests.conftest import ts

LEFT = "lid int, k string, t timestamp_ntz"
RIGHT = "rid int, rk string, rt timestamp_ntz, v double"


def _run(spark, left, right, num_buckets=4, tie="rid", **kw):
    l_df = spark.createDataFrame(left, LEFT)
    r_df = spark.createDataFrame(right, RIGHT)
    out = asof_nearest(l_df, r_df, left_by="k", right_by="rk", left_on="t", right_on="rt",
                       payload=["rid", "v"], prefix="m_", tie=tie, num_buckets=num_buckets, **kw)
    return {r["lid"]: (r["m_rid"], r["m_v"]) for r in out.collect()}


@pytest.mark.parametrize("bh", [1, 2, 30])
def test_equal_distance_prefers_earlier(spark, bh):
    left = [(1, "a", ts("2024-01-02 12:00:00"))]
    right = [(10, "a", ts("2024-01-02 10:00:00"), 1.0), (11, "a", ts("2024-01-02 14:00:00"), 2.0)]
    assert _run(spark, left, right, bh)[1] == (10, 1.0)


@pytest.mark.parametrize("bh", [1, 8])
def test_duplicate_times_last_before_first_after(spark, bh):
    left = [(1, "a", ts("2024-01-02 12:00:00")), (2, "a", ts("2024-01-02 13:59:00"))]
    right = [(10, "a", ts("2024-01-02 11:00:00"), 1.0), (11, "a", ts("2024-01-02 11:00:00"), 2.0),
             (12, "a", ts("2024-01-02 14:00:00"), 3.0), (13, "a", ts("2024-01-02 14:00:00"), 4.0)]
    got = _run(spark, left, right, bh)
    assert got[1] == (11, 2.0)   # last of the equal times at or before
    assert got[2] == (12, 3.0)   # first of the equal times after


def test_null_metric_kept_no_tolerance_null_time_unmatched_key(spark):
    left = [(1, "a", ts("2030-01-01 00:00:00")), (2, "a", None), (3, "zz", ts("2024-01-01 00:00:00")),
            (4, None, ts("2024-01-01 00:00:00"))]
    right = [(10, "a", ts("2024-01-02 11:00:00"), None), (9, "a", ts("2024-01-01 11:00:00"), 5.0)]
    got = _run(spark, left, right, 24)
    assert got[1] == (10, None)      # far future takes the latest reading, null metric kept
    assert got[2] == (None, None)    # null left time: row kept, no match
    assert got[3] == (None, None)    # key without readings
    assert got[4] == (None, None)    # null key
    assert len(got) == 4


def test_exact_match_and_tolerance(spark):
    left = [(1, "a", ts("2024-01-02 12:00:00")), (2, "a", ts("2024-03-01 00:00:00"))]
    right = [(10, "a", ts("2024-01-02 12:00:00"), 1.0)]
    got = _run(spark, left, right, 24, tolerance_us=3600 * 10**6)
    assert got[1] == (10, 1.0)
    assert got[2] == (None, None)


def _brute(left, right):
    out = {}
    for lid, k, t in left:
        cands = [r for r in right if r[1] == k and k is not None and t is not None]
        back = [r for r in cands if r[2] <= t]
        fwd = [r for r in cands if r[2] > t]
        b = max(back, key=lambda r: (r[2], r[0])) if back else None
        f = min(fwd, key=lambda r: (r[2], r[0])) if fwd else None
        if b is None and f is None:
            out[lid] = (None, None)
        elif f is None or (b is not None and (t - b[2]) <= (f[2] - t)):
            out[lid] = (b[0], b[3])
        else:
            out[lid] = (f[0], f[3])
    return out


@pytest.mark.parametrize("seed,bh", [(1, 1), (2, 6), (3, 24), (4, 100), (5, 300), (6, None)])
def test_matches_brute_force(spark, seed, bh):
    import datetime as dt
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    keys = ["a", "b", "c", None]
    # coarse times so that ties and equal distances are common
    right = [(i, rnd.choice(keys[:3]), base + dt.timedelta(hours=rnd.randrange(0, 24 * 20, 3)),
              rnd.choice([None, float(i)])) for i in range(300)]
    left = [(i, rnd.choice(keys), None if rnd.random() < 0.05 else
             base + dt.timedelta(hours=rnd.randrange(-48, 24 * 24))) for i in range(200)]
    assert _run(spark, left, right, bh) == _brute(left, right)


def test_hub_burst_is_spread_and_cold_keys_are_not(spark):
    """A third of all arrivals at one hub in one minute: many buckets there, one for a cold key, tasks of like size, right answers."""
    from pyspark.sql import functions as F

    from haulstat.operators.asof import ORDER, asof_cuts
    from haulstat.operators.order import bucket_of

    n = 60_000
    micro = "timestampadd(MICROSECOND, CAST({} AS BIGINT), TIMESTAMP_NTZ '2024-01-01 00:00:00')"
    hot = F.col("id") % 3 == 0
    key = F.when(hot, 0).otherwise(1 + F.col("id") % 2000)
    left = spark.range(n).select(F.col("id").alias("lid"), key.alias("k"), F.when(
        hot, F.expr(micro.format("id * 997 % 60000000"))).otherwise(F.expr(micro.format("id * 7919000000 % 2592000000000"))).alias("t"))
    right = spark.range(n).select(F.col("id").alias("rid"), key.alias("rk"), F.when(
        hot, F.expr(micro.format("id * 991 % 60000000"))).otherwise(F.expr(micro.format("id * 104729000000 % 2592000000000"))).alias("rt"))
    cuts = asof_cuts([(left, "k", "t"), (right, "rk", "rt")], 24)
    at = left.select(F.col("k").alias("__k"), F.col("t").alias("__t")).withColumn("b", bucket_of(ORDER, cuts))
    per = {r["__k"]: r["n"] for r in at.groupBy("__k").agg(F.count_distinct("b").alias("n")).collect()}
    assert per[0] >= 6 and sum(v for k, v in per.items() if k) <= 2000 + 24
    assert at.groupBy("b").count().agg(F.max("count")).first()[0] < n / 8
    got = asof_nearest(left, right, left_by="k", right_by="rk", left_on="t", right_on="rt", payload=["rid", "rt"], tie="rid", num_buckets=24)
    mine = got.toPandas().sort_values("t", kind="stable")
    import pandas as pd
    r = right.toPandas().sort_values(["rt", "rid"], kind="stable")
    want = pd.merge_asof(mine[["lid", "k", "t"]], r.rename(columns={"rt": "wt", "rid": "wid"}).assign(rt2=lambda d: d["wt"]),
                         left_on="t", right_on="wt", left_by="k", right_by="rk", direction="nearest")
    assert len(mine) == n
    gap = (mine["t"].to_numpy() - mine["rt"].to_numpy()).astype("timedelta64[us]")
    assert (abs(gap) == abs((want["t"].to_numpy() - want["rt2"].to_numpy()).astype("timedelta64[us]"))).all()
    assert (mine["rid"].to_numpy() == want["wid"].to_numpy()).all()


def test_equal_times_meet_before_the_shuffle(spark):
    """All arrivals and readings of a hub at one time: one row of each task passes the windows; one sort serves both directions."""
    from pyspark.sql import functions as F

    left = spark.range(5000).select(F.col("id").alias("lid"), F.lit("hub").alias("k"), F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("t"))
    right = spark.range(5000).select(F.col("id").alias("rid"), F.lit("hub").alias("rk"), F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("rt"))
    got = asof_nearest(left, right, left_by="k", right_by="rk", left_on="t", right_on="rt", payload=["rid"], tie="rid", num_buckets=8)
    assert got.where("rid = 4999").count() == 5000
    from haulstat.operators.asof import asof_matches
    m = asof_matches(left, right, left_by="k", right_by="rk", left_on="t", right_on="rt", payload=["rid"], tie="rid", num_buckets=8)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "DESC" not in plan and "partial_max_by" in plan


def test_duplicate_left_rows_do_not_multiply(spark):
    left = [(1, "a", ts("2024-01-02 12:00:00")), (1, "a", ts("2024-01-02 12:00:00"))]
    right = [(10, "a", ts("2024-01-02 10:00:00"), 1.0)]
    l_df = spark.createDataFrame(left, LEFT)
    r_df = spark.createDataFrame(right, RIGHT)
    once = asof_nearest(l_df, r_df, left_by="k", right_by="rk", left_on="t", right_on="rt",
                        payload=["rid"], prefix="o_", num_buckets=4)
    twice = asof_nearest(once, r_df, left_by="k", right_by="rk", left_on="t", right_on="rt",
                         payload=["rid"], prefix="d_", num_buckets=4)
    assert twice.count() == 2


def test_trips_meet_stored_city_weather(spark):
    """Each (city, time) is asked for once; the answers are stored, so that few of them are broadcast and no trip is shuffled."""
    from haulstat.plans.trips import add_city_weather
    day = lambda d: dt.datetime(2024, 1, d)
    city = spark.createDataFrame([("a", day(1), 1.0), ("a", day(4), None), ("b", day(2), 5.0)], "city_id string, timestamp timestamp_ntz, temp double")
    trips = spark.createDataFrame([(1, "a", "b", day(1), day(2)), (1, "a", "b", day(1), day(2)), (2, "a", None, day(3), day(9)), (3, "c", "a", None, day(2))],
                                  "trip int, origin_id string, destination_id string, departure_date timestamp_ntz, estimated_arrival timestamp_ntz")
    out = add_city_weather(trips, city, cols=["temp"])
    got = sorted((r["trip"], r["origin_temp"], r["destination_temp"]) for r in out.collect())
    assert got == [(1, 1.0, 5.0), (1, 1.0, 5.0), (2, None, None), (3, None, 1.0)]
    assert sum("/nearest-" in f for f in out.inputFiles()) >= 2
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
