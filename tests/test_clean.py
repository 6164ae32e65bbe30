"""Null filling and load-time fixes."""

from haulstat.functions.columns import coerce_timestamp, normalize_hour, null_token, reading_timestamp
from haulstat.operators.clean import (
    clean_tables,
    fill_group_median,
    fill_median,
    fill_mode,
    remaining_nulls,
)
from tests.conftest import ts


def test_mode_tie_goes_to_smallest_and_all_null_stays_null(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", None), (3, "b", None), (4, "a", None), (5, None, None)],
                               "id int, c string, d string")
    out = {r["id"]: (r["c"], r["d"]) for r in fill_mode(df, ["c", "d"]).collect()}
    assert out[5] == ("a", None)


def test_median_fill(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 10.0), (4, None)], "id int, x double")
    out = {r["id"]: r["x"] for r in fill_median(df, ["x"]).collect()}
    assert out[4] == 2.0


def test_group_median_then_fallback_over_filled_column(spark):
    rows = [(1, "g1", 1.0), (2, "g1", 3.0), (3, "g1", None),      # group median 2
            (4, "g2", None), (5, "g2", None),                      # whole group null
            (6, None, 7.0), (7, None, None)]                       # null key: keeps own value / fallback
    df = spark.createDataFrame(rows, "id int, g string, x double")
    out = {r["id"]: r["x"] for r in fill_group_median(df, "x", "g").collect()}
    # fallback = median of the filled column over non-null keys: values 1, 3, 2 -> 2
    assert out[3] == 2.0 and out[4] == 2.0 and out[5] == 2.0
    assert out[6] == 7.0 and out[7] == 2.0


def test_remaining_nulls_after_cleaning(spark):
    drivers = spark.createDataFrame([("t1", "male", None), ("t2", None, "proactive"), ("t3", "male", "conservative")],
                                    "vehicle_no string, gender string, driving_style string")
    trucks = spark.createDataFrame([("t1", None, 10.0), ("t2", "gas", None), ("t3", "diesel", 30.0)],
                                   "truck_id string, fuel_type string, load_capacity_pounds double")
    traffic = spark.createDataFrame([("r1", 1.0), ("r1", None), ("r2", None)], "route_id string, no_of_vehicles double")
    out = clean_tables({"drivers": drivers, "trucks": trucks, "traffic": traffic})
    for name in ["drivers", "trucks", "traffic"]:
        assert remaining_nulls(out[name]).first()[0] == 0


def test_hour_normalisation_and_reading_time(spark):
    df = spark.createDataFrame([(0,), (100,), (2300,)], "h int")
    got = [r[0] for r in df.select(normalize_hour("h")).collect()]
    assert got == [0, 1, 23]
    d = spark.createDataFrame([(ts("2024-01-01 00:00:00"), 23)], "d timestamp_ntz, h int")
    assert d.select(reading_timestamp("d", "h")).first()[0] == ts("2024-01-01 23:00:00")


def test_lenient_parse_and_null_tokens(spark):
    df = spark.createDataFrame([("2024-01-02",), ("not a date",), ("NA",), ("nan",), ("",), ("x",)], "s string")
    parsed = [r[0] for r in df.select(coerce_timestamp("s")).collect()]
    assert parsed[0] == ts("2024-01-02 00:00:00") and parsed[1:5] == [None] * 4
    tokens = [r[0] for r in df.select(null_token("s")).collect()]
    assert tokens[2:] == [None, None, None, "x"]


def test_csv_bad_value_becomes_null_and_line_is_kept(spark, tmp_path):
    from haulstat.sources.tables import read_csv
    p = tmp_path / "t.csv"
    p.write_text("route_id,no_of_vehicles\nr1,10\nr2,NA\nr3,lots\n")
    rows = read_csv(spark, str(p), "route_id string, no_of_vehicles double", keep_corrupt=True).collect()
    got = {r["route_id"]: (r["no_of_vehicles"], r["_corrupt_record"]) for r in rows}
    assert got["r1"] == (10.0, None)
    assert got["r3"][0] is None and got["r3"][1] == "r3,lots"
    assert got["r2"][0] is None
