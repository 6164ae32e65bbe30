"""Missing-value tokens, integers written as 1.0, feature table rules, files per day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from haulstat.functions.columns import null_token
from haulstat.sources.feature_store import get_or_create, latest_per_key
from haulstat.sources.jdbc import load_all_from_jdbc
from haulstat.sources.sinks import write_features
from haulstat.sources.tables import load_table, parse_lines


def test_null_tokens_are_exact(spark):
    values = ["Na", "none", " NA ", "nA", "text", "#NA", "#N/A N/A", "-1.#QNAN", "1.#IND", "NA", "", "nan", "None", "null"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(null_token("v")).collect()]
    assert got == ["Na", "none", " NA ", "nA", "text"] + [None] * 9


def test_integers_written_as_doubles(spark, tmp_path):
    lines = ["r1,2019-02-01,700,12.0,1.0", "r1,2019-02-01,800.0,NA,0", "NA,bad,900,,1.5", "none,2019-02-02,0,3,"]
    (tmp_path / "t.csv").write_text("\n".join(["route_id,date,hour,no_of_vehicles,accident", *lines]))
    from_file = load_table(spark, "traffic", str(tmp_path / "t.csv"))
    got = [(r["route_id"], r["hour"], r["no_of_vehicles"], r["accident"]) for r in from_file.collect()]
    assert got == [("r1", 7, 12.0, 1), ("r1", 8, None, 0), (None, 9, None, None), ("none", 0, 3.0, None)]
    assert dict(from_file.dtypes)["accident"] == "int"
    from_lines = parse_lines(spark.createDataFrame([(x,) for x in lines], "line string"), "traffic")
    assert [(r["route_id"], r["no_of_vehicles"], r["accident"]) for r in from_lines.collect()] == [
        (a, c, d) for a, _, c, d in got]


def test_feature_rows_of_one_batch(spark, tmp_path):
    group = get_or_create(str(tmp_path), "f", 1, ["k"], event_time="t")
    day = dt.datetime(2019, 2, 1)
    df = spark.createDataFrame([(1, day, 5), (1, day + dt.timedelta(days=1), 1), (2, day, 3), (2, day, 4)],
                               "k long, t timestamp_ntz, v long")
    group.insert(df)
    assert sorted((r["k"], r["v"]) for r in group.read(spark).collect()) == [(1, 1), (2, 4)]
    group.insert(spark.createDataFrame([(2, day, 9), (3, day, 0)], df.schema))
    want = [(1, 1), (2, 9), (3, 0)]
    assert sorted((r["k"], r["v"]) for r in group.read(spark).collect()) == want
    snapshot = group.compact(spark)
    group.insert(spark.createDataFrame([(3, day, 7)], df.schema))
    assert sorted((r["k"], r["v"]) for r in group.read_from(spark, snapshot).collect()) == [(1, 1), (2, 9), (3, 7)]
    assert latest_per_key(df.withColumn("batch_id", F.lit(0)), ["k"]).count() == 2


def test_day_files_are_bounded(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).select("id", F.expr(
        "make_timestamp_ntz(2019, 2, CASE WHEN id % 10 = 0 THEN 2 ELSE 1 END, 7, 0, 0)").alias("departure_date"))
    write_features(df, str(tmp_path / "out"), max_records_per_file=300)
    files = {d: len(list((tmp_path / "out" / f"departure_day=2019-02-0{d}").glob("*.parquet"))) for d in (1, 2)}
    assert files[2] == 1 and files[1] <= 8
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000


def test_large_tables_need_partitioning(spark):
    with pytest.raises(ValueError, match="traffic"):
        load_all_from_jdbc(spark, {"mysql": {}, "postgres": {}})
