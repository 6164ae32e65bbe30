"""Raw tables through files: strict and lenient times, gaps, final features by day."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from haulstat.plans import queries as Q
from haulstat.plans.rawfiles import MEASURES, measured, raw_files
from haulstat.plans.train import load_reference_tables
from haulstat.sources.tables import SCHEMAS, load_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test data not present")


@pytest.fixture(scope="module")
def files(spark):
    return raw_files(spark, SF, Q._inputs(SF))


def test_files_are_written_once(spark, files):
    assert raw_files(spark, SF, Q._inputs(SF)) == files
    assert set(files) == set(SCHEMAS)


def test_headers_are_those_of_the_raw_tables(spark, files):
    for name, path in files.items():
        assert spark.read.option("header", True).csv(path).columns == [c.split()[0] for c in SCHEMAS[name].split(", ")]


def test_a_schedule_with_an_unreadable_time_fails(spark, tmp_path):
    (tmp_path / "s.csv").write_text("truck_id,route_id,departure_date,estimated_arrival,delay\n"
                                    "1,2,2019-01-01 07:00:00,2019-01-02 07:00:00,0\n1,2,soon,2019-01-02 07:00:00,0\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_table(spark, "truck_schedule", str(tmp_path / "s.csv")).collect()


def test_traffic_with_an_unreadable_date_loads(spark, tmp_path):
    (tmp_path / "t.csv").write_text("route_id,date,hour,no_of_vehicles,accident\n7,soon,300,5,0\n7,2019-01-01,300,,1\n")
    rows = load_table(spark, "traffic", str(tmp_path / "t.csv")).orderBy("accident").collect()
    assert [(r["date"] is None, r["hour"], r["no_of_vehicles"], r["timestamp"] is None) for r in rows] == [
        (True, 3, 5.0, True), (False, 3, None, False)]


def test_an_empty_file_gives_no_rows(spark, tmp_path):
    (tmp_path / "w.csv").write_text(",".join(c.split()[0] for c in SCHEMAS["routes_weather"].split(", ")) + "\n")
    assert load_table(spark, "routes_weather", str(tmp_path / "w.csv")).count() == 0


def test_reference_tables_hold_no_gaps_where_cleaned(spark, files):
    raw = spark.read.option("header", True).csv(files["drivers"])
    assert raw.where("gender = 'NA'").count() and raw.where("driving_style IS NULL").count()
    tables = load_reference_tables(spark, files)
    assert set(tables) == set(MEASURES)
    for name, cols in {"drivers": ["gender", "driving_style"], "trucks": ["fuel_type", "load_capacity_pounds"],
                       "traffic": ["no_of_vehicles"]}.items():
        assert tables[name].where(" OR ".join(f"{c} IS NULL" for c in cols)).count() == 0
    rows = measured(tables)
    per = {r["table_name"]: r["n"] for r in rows.where("measure IN ('gender', 'fuel_type', 'route_id', 'city_id')")
           .groupBy("table_name").agg(F.sum("n_rows").alias("n")).collect()}
    assert per == {name: tables[name].count() for name in MEASURES}


def test_a_day_of_the_final_features_reads_its_folder_alone(spark):
    out = Q.q_final_dataset(spark, SF)
    day = out.agg(F.min("departure_day")).first()[0]
    path = Q.kept_folder(spark, "final-features", Q._inputs(SF), "day", lambda p: pytest.fail("written again"))
    one = spark.read.parquet(path).where(F.col("departure_day") == F.lit(day.date()))
    assert {Path(f).parent.name for f in one.inputFiles()} >= {f"departure_day={day.date()}"}
    assert "PartitionFilters: [isnotnull(departure_day" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == out.where(F.col("departure_day") == day).count() > 0


def test_published_trips_keep_the_newest_batch(spark):
    rows = Q.q_published_trips(spark, SF).groupBy("is_weekend_departure", "batch_id").count().collect()
    assert {(r["is_weekend_departure"], r["batch_id"]) for r in rows} == {(0, 0), (1, 1)}


@pytest.mark.parametrize("name", ["truck_schedule", "routes_weather"])
def test_one_table_is_read_without_writing_the_others(spark, monkeypatch, name):
    from haulstat.plans import rawfiles
    from haulstat.sources.snapshots import drop_snapshots
    written, write = [], rawfiles.write_csv
    monkeypatch.setattr(rawfiles, "write_csv", lambda df, path: (written.append(path), write(df, path)))
    drop_snapshots(spark)
    query = {"truck_schedule": Q.q_file_schedule, "routes_weather": Q.q_file_routes_weather}[name]
    assert query(spark, SF).count() == rawfiles.raw_tables(spark, SF)[name].count() > 0
    assert [p.rsplit("/", 1)[1] for p in written] == [rawfiles.FILE_NAMES[name]]
