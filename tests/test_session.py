"""Checkpoint directory: the cluster's setting wins; a scratch one only when unset."""

from haulstat.session import ensure_checkpoint_dir


def test_checkpoint_dir_follows_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    assert got
    if named:
        assert named.rstrip("/") in got
    assert ensure_checkpoint_dir(spark) == got   # stable: not reset on every call


def test_checkpoint_cuts_lineage(spark):
    from haulstat.plans.trips import materialize
    df = spark.range(100).selectExpr("id", "id * 2 AS x")
    out = materialize(df)
    assert out.count() == 100
    assert "Scan ExistingRDD" in out._jdf.queryExecution().executedPlan().toString() or \
        "LogicalRDD" in out._jdf.queryExecution().optimizedPlan().toString()
