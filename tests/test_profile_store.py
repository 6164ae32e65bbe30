"""Profiling reports on hand-made frames and the feature table round trip."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from haulstat.operators import profile as PR
from haulstat.operators.order import exact_quantiles
from haulstat.sources.feature_store import get_or_create, latest_per_key, round_trip_counts


def test_describe_matches_pandas_conventions(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    r = PR.describe(df, ["x"]).first()
    assert r["std"] == pytest.approx(1.29099, abs=1e-5)
    assert (r["q25"], r["q50"], r["q75"]) == (1.75, 2.5, 3.25)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(31)], "x double")
    h = {r["bin"]: r["count"] for r in PR.histogram(df, ["x"], bins=30).collect()}
    assert h[30] == 2 and sum(h.values()) == 31 and max(h) == 30


def test_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 6.0, 5.0)], "a double, b double, c double")
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in PR.corr_matrix(df).collect()}
    assert got[("a", "c")] is None and got[("a", "a")] == pytest.approx(1.0)
    assert got[("a", "b")] == pytest.approx(got[("b", "a")])


def test_duplicates_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    r = PR.duplicate_rows(df).first()
    assert (r["n_rows"], r["duplicate_rows"]) == (3, 1)


def test_null_report_sorted(spark):
    df = spark.createDataFrame([(None, None, 1), (1, None, 2)], "a int, b int, c int")
    rows = [(r["column"], r["n_null"]) for r in PR.null_report(df).collect()]
    assert rows == [("b", 2), ("a", 1)]


def test_kde_integrates_to_one(spark):
    import random
    rnd = random.Random(1)
    df = spark.createDataFrame([(rnd.gauss(0, 1),) for _ in range(500)], "x double")
    pts = sorted((r["x"], r["density"]) for r in PR.kde_curve(df, ["x"], grid=200).collect())
    area = sum((pts[i + 1][0] - pts[i][0]) * (pts[i][1] + pts[i + 1][1]) / 2 for i in range(len(pts) - 1))
    assert 0.9 < area < 1.0


def test_boxplot_whiskers(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 100]]
    df = spark.createDataFrame(rows, "c string, x double")
    r = PR.boxplot_stats(df, ["x"], "c").first()
    assert (r["q1"], r["median"], r["q3"]) == (2.0, 3.0, 4.0)
    assert r["whisker_hi"] == 4.0 and r["n_outliers"] == 1


def test_feature_store_appends_and_reads_newest(spark, tmp_path):
    g = get_or_create(str(tmp_path), "trip_features", 1, ["truck_id", "route_id", "departure_date"],
                      event_time="departure_date")
    b0 = spark.createDataFrame([("t1", "r1", 1, 10.0), ("t2", "r1", 1, 20.0)],
                               "truck_id string, route_id string, departure_date int, x double")
    b1 = spark.createDataFrame([("t1", "r1", 1, 11.0)], "truck_id string, route_id string, departure_date int, x double")
    written, read = round_trip_counts(g, b0)
    assert (written, read) == (2, 2)
    assert g.insert(b1) == 1
    got = {r["truck_id"]: r["x"] for r in g.read(spark).collect()}
    assert got == {"t1": 11.0, "t2": 20.0}
    assert g.read_all(spark).count() == 3


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 2), (2, "c", 1)], "k int, v string, batch_id int")
    assert {r["k"]: r["v"] for r in latest_per_key(df, ["k"]).collect()} == {1: "b", 2: "c"}


def test_value_counts_ignore_null(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "delay int")
    rows = {r["delay"]: (r["count"], r["share"]) for r in PR.value_counts(df, "delay").collect()}
    assert rows == {0: (1, 1 / 3), 1: (2, 2 / 3)}


def test_preview_is_a_limit(spark):
    df = spark.range(100)
    assert PR.preview(df).count() == 5 and PR.preview(df, 3).count() == 3


def test_approximate_quantile_switch(spark):
    from haulstat.operators.clean import fill_group_median
    df = spark.createDataFrame([(float(i), "g" if i % 2 else "h") for i in range(1, 101)] + [(None, "g")],
                               "x double, k string")
    exact = PR.describe(df, ["x"]).first()
    approx = PR.describe(df, ["x"], accuracy=10000).first()
    assert approx["count"] == exact["count"] and abs(approx["q50"] - exact["q50"]) <= 1.0
    filled = fill_group_median(df, "x", "k", accuracy=10000).where("x is null").count()
    assert filled == 0


def test_corr_of_many_columns_with_gaps(spark):
    """Twelve columns with nulls in different rows, large offsets, a constant, an empty one and an almost empty one: as pandas."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(8)
    base = rng.normal(size=(700, 9))
    data = pd.DataFrame(base @ rng.normal(size=(9, 9)) * rng.uniform(1e-3, 1e4, 9) + rng.uniform(-1e6, 1e6, 9), columns=[f"c{i}" for i in range(9)])
    data = data.mask(rng.random(data.shape) < 0.15)
    data["flat"], data["none"], data["one"] = 0.1, np.nan, np.where(np.arange(700) == 3, 1.0, np.nan)
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in data.columns))
    want = data.corr()
    scans = df.repartition(5)
    for r in PR.corr_matrix(scans).collect():
        w = want.loc[r["column_a"], r["column_b"]]
        assert r["corr"] is None if np.isnan(w) or "flat" in (r["column_a"], r["column_b"]) else r["corr"] == pytest.approx(w, abs=1e-8)
    assert PR.corr_matrix(df.limit(0)).where("corr IS NULL").count() == 144


KV = "k int, v string"


def test_two_writers_lose_no_batch(spark, tmp_path):
    """Writers that commit at the same time get numbers of their own; every batch is read back."""
    import threading

    errors = []

    def write(w):
        try:
            g = get_or_create(str(tmp_path), "f", 1, ["k"])
            for i in range(3):
                g.insert(spark.createDataFrame([(100 * w + i, f"{w}/{i}")], KV))
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(w,)) for w in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    g = get_or_create(str(tmp_path), "f", 1, ["k"])
    assert not errors and [e["number"] for e in g.commits(spark)] == list(range(12))
    assert sorted(r["v"] for r in g.read_all(spark).collect()) == sorted(f"{w}/{i}" for w in range(4) for i in range(3))


def test_snapshot_is_read_without_a_shuffle(spark, tmp_path):
    g = get_or_create(str(tmp_path), "f", 1, ["k"])
    g.insert(spark.range(2000).selectExpr("CAST(id AS INT) k", "'old' v"))
    g.insert(spark.range(0, 2000, 2).selectExpr("CAST(id AS INT) k", "'new' v"))
    before = sorted(map(tuple, g.read(spark).collect()))
    number = g.compact(spark, buckets=4)
    assert sorted(map(tuple, g.read(spark).collect())) == before and number == 2
    g.insert(spark.createDataFrame([(3, "last"), (5000, "added")], KV))
    out = g.read(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = g.read(spark)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = next(i for i, x in enumerate(lines) if "Bucketed: true" in x and "snapshot_" in x)
    depth = lines[at].index("FileScan")
    above = [x for x in lines[:at] if "Exchange" in x and x.index("Exchange") < depth]
    assert not above  # what is shuffled stands beside the snapshot, not above it
    got = dict(map(tuple, out.collect()))
    assert got[3] == "last" and got[5000] == "added" and got[4] == "new" and got[5] == "old" and len(got) == 2001
    assert [e["rows"] for e in g.commits(spark)] == [2000, 1000, 2000, 2]
    again = get_or_create(str(tmp_path), "f", 1, ["k"])
    spark.sql("DROP TABLE snapshot_" + g.commits(spark)[2]["data"].split("/")[1])  # as in a new session
    assert dict(map(tuple, again.read(spark).collect())) == got


def test_null_keys_are_refused_before_the_commit(spark, tmp_path):
    g = get_or_create(str(tmp_path), "f", 1, ["k"])
    g.insert(spark.createDataFrame([(1, "a")], KV))
    with pytest.raises(ValueError):
        g.insert(spark.createDataFrame([(2, "b"), (None, "c")], KV))
    with pytest.raises(KeyError):
        g.insert(spark.createDataFrame([("b",)], "v string"))
    (tmp_path / "f" / "v1" / "_commits" / "000000000001.json").write_text("{\"half")  # a writer that died
    assert g.insert(spark.createDataFrame([(3, "c")], KV)) == 2 and g.read(spark).count() == 2


@pytest.mark.parametrize("bits", [128, 64, 3, 0])
def test_duplicates_are_exact_where_fingerprints_meet(spark, bits):
    """Few bits force different rows onto one fingerprint; nulls in different places are different rows."""
    df = spark.range(3000).selectExpr("IF(id % 5 = 0, NULL, id % 400) a", "IF(id % 7 = 0, NULL, CAST(id % 3 AS STRING)) b").unionAll(
        spark.createDataFrame([(None, "1"), (1, None)], "a long, b string"))
    want = df.count() - df.distinct().count()
    r = PR.duplicate_rows(df, bits=bits).first()
    assert (r["n_rows"], r["duplicate_rows"]) == (3002, want)
    assert PR.duplicate_rows(df.limit(0)).first()["duplicate_rows"] in (None, 0)


def test_distinct_ids_from_bitmaps(spark):
    ids = spark.range(50_000).selectExpr("CAST(IF(id % 11 = 0, NULL, (id * 7919) % 40000 - 20000) AS BIGINT) k", "id % 3 AS day")
    want = ids.select("k").where("k IS NOT NULL").distinct().count()
    assert PR.distinct_ids(ids, "k").first()["n"] == want
    days = PR.id_bitmaps(ids, "k", ["day"])
    assert PR.merged_ids(days).first()["n"] == want and days.count() < 20
    plan = PR.distinct_ids(ids, "k")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan
    sparse = spark.range(100).selectExpr("xxhash64(id) k", "CAST(id AS STRING) s")
    out = PR.distinct_counts({"a": (ids, "k"), "b": (sparse, "k"), "c": (sparse, "s"), "d": (sparse.limit(0), "k")}).first()
    assert tuple(out) == (want, 100, 100, 0)


def test_load_lines_counts_in_one_pass(spark, tmp_path):
    from haulstat.sources.tables import load_lines, quarantined
    lines = ["r1,2019-02-01,700,12.0,1", "r1,not a date,800,NA,0", ",2019-02-02,900,3,", "r2,,100,1,0"]
    counts = load_lines(spark.createDataFrame([(x,) for x in lines], "line string"), "traffic", f"{tmp_path}/t")
    assert counts["rows"] == 4 and counts["unread:date"] == 1 and counts["null:date"] == 2
    assert counts["null:route_id"] == 1 and counts["null:no_of_vehicles"] == 1 and counts["null:accident"] == 1
    assert [r[0] for r in quarantined(spark, f"{tmp_path}/t").collect()] == [lines[1]]
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4


def test_kde_of_a_constant_column(spark):
    """A column with one value has no bandwidth: NaN at every point, beside columns with a curve; a single row has null."""
    df = spark.range(50).select(F.lit(1).alias("same"), F.lit(0.1).alias("tenth"), (F.col("id") % 7).cast("double").alias("x"))
    rows = PR.kde_curve(df, ["same", "tenth", "x"], grid=20).collect()
    flat = [r for r in rows if r["column"] != "x"]
    assert len(rows) == 60 and all(math.isnan(r["density"]) and math.isnan(r["count_density"]) for r in flat)
    assert {r["x"] for r in flat} == {1.0, 0.1}
    assert all(r["density"] > 0 for r in rows if r["column"] == "x")
    assert {r["density"] for r in PR.kde_curve(df.limit(1), ["same"], grid=20).collect()} == {None}


def test_describe_reads_its_rows_once_beside_the_sketch(spark, tmp_path):
    rows = [(float(i % 7) if i % 5 else None, i, None) for i in range(200)]
    spark.createDataFrame(rows, "told double, place int, never double").write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    out = PR.describe(df, ["never", "told", "place"])
    reads = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines()
             if "Relation [" in line and "told#" in line]
    assert len(reads) == 1  # the moments were a pass of their own
    got = {r["column"]: r for r in out.collect()}
    told = sorted(r[0] for r in rows if r[0] is not None)
    assert tuple(got["never"])[1:] == (0, *[None] * 7)
    assert (got["told"]["count"], got["told"]["min"], got["told"]["max"]) == (160, 0.0, 6.0)
    assert got["told"]["mean"] == pytest.approx(statistics.fmean(told))
    assert got["told"]["std"] == pytest.approx(statistics.stdev(told))
    assert [got["told"][q] for q in ("q25", "q50", "q75")] == pytest.approx(statistics.quantiles(told, n=4, method="inclusive"))
    assert (got["place"]["q25"], got["place"]["q50"], got["place"]["q75"]) == (49.75, 99.5, 149.25)
    assert [tuple(r)[:3] for r in PR.describe(df.limit(0), ["told", "place"]).collect()] == [("told", 0, None), ("place", 0, None)]


def test_quantiles_with_further_aggregates(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("b", None)], "g string, x double")
    got = exact_quantiles(df, ["g"], "x", [0.5], also=[F.max("__x").alias("top"), F.count("__x").alias("held")]).collect()
    assert sorted(map(tuple, got), key=repr) == [("a", 1, [5.0], 5.0, 1), (None, 2, [2.0], 3.0, 2)]
    with pytest.raises(ValueError):
        exact_quantiles(df, [], "x", [0.5], also=[F.max("__x").alias("top")])
