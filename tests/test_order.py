"""Ranks, splits, AUC and quantiles on rows that outgrow every sample."""

import pytest
from pyspark.sql import functions as F

from haulstat.operators.metrics import roc_auc
from haulstat.operators.order import exact_quantiles, ordered_rank
from haulstat.operators.split import time_split

N = 400_000


@pytest.fixture(scope="module")
def wide(spark):
    """One day, three timestamps, a unique key in scattered order, wide payload columns."""
    key = (F.col("id") * 7919) % 1_000_003
    return spark.range(0, N, 1, 16).select(
        key.alias("k"), F.expr("make_timestamp_ntz(2019, 2, 1, CAST(7 + id % 3 AS INT), 0, 0)").alias("ts"),
        F.md5(F.col("id").cast("string")).alias("a"), (F.col("id") % 11).alias("b"))


def test_ranks_are_exact_with_payload(wide):
    got = ordered_rank(wide, ["ts", "k"], num_partitions=16)
    plain = wide.select("k", "ts").toPandas().sort_values(["ts", "k"], kind="stable").reset_index(drop=True)
    mine = got.select("k", "rank", F.length("a").alias("n")).toPandas().set_index("k")["rank"]
    assert (mine.loc[plain["k"]].to_numpy() == plain.index.to_numpy() + 1).all()


def test_split_inside_one_timestamp(wide):
    got = time_split(wide, "ts", ["k"], test_size=0.2)
    counts = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert counts == {"train": int(N * 0.8), "test": N - int(N * 0.8)}
    last, first = (got.where(F.col("split") == s).agg(f(F.struct("ts", "k"))).first()[0] for s, f in
                   (("train", F.max), ("test", F.min)))
    assert tuple(last) < tuple(first)


@pytest.mark.parametrize("parts", [4, 64])
def test_auc_of_distinct_scores(spark, parts):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(N).select((((F.col("id") * 7919) % 1_000_003) / 1_000_003).alias("s"),
                               (F.pmod(F.xxhash64("id"), F.lit(100)) < 30 + 20 * ((F.col("id") * 7919) % 1_000_003) / 1_000_003)
                               .cast("double").alias("y"))
    want = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert roc_auc(df, "y", "s", num_partitions=parts).first()[0] == pytest.approx(want, abs=1e-9)


def test_quantiles_with_a_hot_group(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
                                    F.when(F.col("id") % 13 > 0, F.pmod(F.xxhash64("id"), F.lit(20_000)) / 7.0).alias("x"))
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "x", qs, num_buckets=16).collect()}
    for r in df.groupBy("g").agg(F.percentile("x", qs).alias("q"), F.count("x").alias("n")).collect():
        assert got[r["g"]]["n"] == r["n"] and got[r["g"]]["qs"] == pytest.approx(r["q"], abs=1e-9)
    whole = exact_quantiles(df, [], "x", [0.75]).first()
    assert whole["qs"][0] == pytest.approx(df.agg(F.percentile("x", 0.75)).first()[0], abs=1e-9)
    assert exact_quantiles(df.limit(0), ["g"], "x", qs).count() == 0


def test_no_quantile_buffer_in_plans(spark):
    import __spark_entry__ as E

    for name in ("high_quantile_flag", "fill_median", "fill_group_median", "describe", "describe_dates", "boxplot_stats"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "percentile(" not in plan and "median(" not in plan


def test_profiles_start_no_job_on_construction(spark):
    from haulstat.operators import profile as PR

    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").alias("x"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("profiles", "building only")
    PR.histogram(df, ["x"])
    PR.kde_curve(df, ["x"])
    assert list(tracker.getJobIdsForGroup("profiles")) == []
    spark.sparkContext._jsc.clearJobGroup()


def test_interval_join_splits_a_hot_key(spark):
    """90 % of the readings on one key and bucket: the executed plan shows a skew split, totals are those of plain sums."""
    from haulstat.operators.interval import interval_aggregate

    old = {k: spark.conf.get(k, None) for k in (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("64k", "32k", "false", "-1", "8")):
            spark.conf.set(k, v)
        readings = spark.range(300_000).select(
            F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id") % 50).alias("key"),
            F.expr("timestampadd(SECOND, CAST(id % 3600 AS INT), TIMESTAMP_NTZ '2019-02-01 07:00:00')").alias("t"),
            (F.col("id") % 7).cast("double").alias("v"))
        trips = spark.range(200).select(F.col("id").alias("trip"), (F.col("id") % 50).alias("key"),
                                        F.expr("TIMESTAMP_NTZ '2019-02-01 07:00:00'").alias("s"),
                                        F.expr("TIMESTAMP_NTZ '2019-02-01 09:00:00'").alias("e"))
        got = interval_aggregate(trips, readings, by="key", start="s", end="e", ts="t", keys=["trip"],
                                 aggs={"total": ("sum", "v"), "n": ("count", "v")})
        rows = {r["trip"]: (r["total"], r["n"]) for r in got.collect()}
        plan = got._jdf.queryExecution().executedPlan().toString()
        sums = {r["key"]: (r["s"], r["n"]) for r in readings.groupBy("key").agg(F.sum("v").alias("s"), F.count("v").alias("n")).collect()}
        assert rows == {t: sums[t % 50] for t in range(200) if t % 50 in sums}
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_quantiles_of_small_and_tied_groups(spark):
    """Groups of 1 to 60 rows, with ties, nulls, infinities and a null group: equal to Spark's exact percentile."""
    df = spark.range(60 * 61 // 2 + 400).select(
        F.when(F.col("id") < 1830, F.floor((F.sqrt(8.0 * F.col("id") + 1) - 1) / 2)).alias("g"),
        F.when(F.col("id") % 11 > 0, F.when(F.col("id") % 97 == 1, float("inf")).otherwise(F.pmod(F.xxhash64("id"), F.lit(13)) * 0.5)).alias("x"))
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9999, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "x", qs).collect()}
    want = {r["g"]: r for r in df.groupBy("g").agg(F.percentile("x", qs).alias("q"), F.count("x").alias("n")).collect()}
    assert set(got) == {g for g, r in want.items() if r["n"]} and None in got
    for g, r in got.items():
        for mine, plain in zip(r["qs"], want[g]["q"]):
            assert mine == pytest.approx(plain) or {mine, plain} <= {float("inf")} or mine != mine and plain != plain


def test_quantiles_read_twice(spark, tmp_path):
    """At most two scans of the input in the final plan and the stored brackets together, and two jobs before it."""
    spark.range(50_000).select((F.col("id") % 5).alias("g"), F.rand(1).alias("x")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("quantiles", "building")
    out = exact_quantiles(df, ["g"], "x", [0.25, 0.5, 0.75])
    assert len(tracker.getJobIdsForGroup("quantiles")) <= 3  # the brackets' stages and their file listing
    sc._jsc.clearJobGroup()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path}/t") == 1 and out.count() == 5
