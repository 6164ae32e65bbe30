"""End to end on small domain tables: CSV load, cleaning, merge, features, train, save/load, score."""

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from haulstat.operators.clean import clean_tables, remaining_nulls
from haulstat.plans import train as TR
from haulstat.plans import trips as P
from haulstat.sources.sinks import write_csv, write_features
from haulstat.sources.tables import FILE_NAMES, load_all, table_shapes

W = ["temp", "wind_speed", "precip", "humidity", "visibility", "pressure",
     "chanceofrain", "chanceoffog", "chanceofsnow", "chanceofthunder"]


def _write(path, header, rows):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    rnd = random.Random(5)
    d = tmp_path_factory.mktemp("raw")
    trucks = [f"T{i}" for i in range(6)]
    routes = ["R1", "R2", "R3"]
    cities = ["C1", "C2", "C3", "C4"]
    base = dt.datetime(2019, 1, 1, 7, 0, 0)
    _write(d / FILE_NAMES["drivers"], ["driver_id", "name", "gender", "age", "experience", "driving_style",
                                       "ratings", "vehicle_no", "average_speed_mph"],
           [[f"D{i}", f"n{i}", ["male", "female", "NA"][i % 3], 30 + i, i, ["proactive", "conservative", ""][i % 3],
             5 + i % 4, t, 50 + i] for i, t in enumerate(trucks)])
    _write(d / FILE_NAMES["trucks"], ["truck_id", "truck_age", "load_capacity_pounds", "mileage_mpg", "fuel_type"],
           [[t, i, "" if i == 2 else 1000 * (i + 1), 10 + i, ["diesel", "gas", "NA"][i % 3]] for i, t in enumerate(trucks)])
    _write(d / FILE_NAMES["routes"], ["route_id", "origin_id", "destination_id", "distance", "average_hours"],
           [[r, cities[i], cities[i + 1], 100.0 * (i + 1), 2.0 * (i + 1)] for i, r in enumerate(routes)])
    traffic = []
    for r in routes:
        for day in range(12):
            for h in range(0, 2400, 300):
                date = (base + dt.timedelta(days=day)).strftime("%Y-%m-%d")
                if r == "R3" and day == 0 and h == 0:
                    date = "not a date"
                traffic.append([r, date, h, "" if rnd.random() < 0.1 else rnd.randrange(100), rnd.randrange(2)])
    _write(d / FILE_NAMES["traffic"], ["route_id", "date", "hour", "no_of_vehicles", "accident"], traffic)
    sched = []
    for i in range(60):
        dep = base + dt.timedelta(days=i % 10, microseconds=123 * i)
        sched.append([trucks[i % 6], routes[i % 3], dep.isoformat(sep=" "),
                      (dep + dt.timedelta(hours=4 + i % 20, microseconds=17)).isoformat(sep=" "), i % 2])
    _write(d / FILE_NAMES["truck_schedule"], ["truck_id", "route_id", "departure_date", "estimated_arrival", "delay"], sched)
    cw = []
    for c in cities:
        for day in range(12):
            for h in range(0, 2400, 600):
                cw.append([c, (base + dt.timedelta(days=day)).strftime("%Y-%m-%d"), h,
                           *[round(rnd.random() * 20, 2) for _ in range(6)], 0, 0, 0, 0])
    _write(d / FILE_NAMES["city_weather"], ["city_id", "date", "hour", *W], cw)
    rw = []
    for r in routes:
        for day in range(12):
            for h in range(0, 24, 6):
                rw.append([r, (base + dt.timedelta(days=day, hours=h - 7)).isoformat(sep=" "),
                           *[round(rnd.random() * 20, 2) for _ in range(6)], 0, 0, 0, 0])
    _write(d / FILE_NAMES["routes_weather"], ["route_id", "Date", *W], rw)
    return d


def test_load_clean_merge_feature_counts(spark, raw_dir):
    tables = load_all(spark, str(raw_dir))
    assert {r["table_name"]: r["n_rows"] for r in table_shapes(tables).collect()}["truck_schedule"] == 60
    assert tables["traffic"].where(F.col("date").isNull()).count() == 1   # lenient parse
    cleaned = clean_tables(tables)
    targeted = {"drivers": ["gender", "driving_style"], "trucks": ["fuel_type", "load_capacity_pounds"],
                "traffic": ["no_of_vehicles"]}
    for name, cols in targeted.items():
        assert remaining_nulls(cleaned[name], cols).first()[0] == 0
    full, matrix = P.build_final_dataset(cleaned)
    assert full.count() == 60
    assert len(full.columns) == 48
    assert len([c for c in matrix.columns if c != "delay"]) == 39


def test_train_save_load_score(spark, raw_dir, tmp_path):
    cleaned = clean_tables(load_all(spark, str(raw_dir)))
    full, _ = P.build_final_dataset(cleaned)
    models, art, metrics = TR.train_and_evaluate(full, num_trees=10, max_depth=4)
    rows = {r["model"]: r for r in TR.results_table(metrics).collect()}
    assert set(rows) == {"logistic_regression", "random_forest"}
    assert all(0.0 <= rows[m]["accuracy"] <= 1.0 for m in rows)
    assert all(0.0 <= r["train_accuracy"] <= 1.0 for r in metrics.collect())
    imp = TR.feature_importances(spark, models["random_forest"], art.feature_columns)
    assert imp.count() == 39
    assert abs(imp.agg(F.sum("importance")).first()[0] - 1.0) < 1e-9
    write_csv(imp, str(tmp_path / "importance"))
    write_features(full, str(tmp_path / "final"))
    group, batch = P.publish_features(full, str(tmp_path / "store"))
    assert batch == 0 and group.read(spark).count() == 60
    assert spark.read.parquet(str(tmp_path / "final")).count() == 60

    TR.save(models, art, str(tmp_path / "models"))
    model, art2 = TR.load(spark, str(tmp_path / "models"), "random_forest")
    assert art2.feature_columns == art.feature_columns
    new = cleaned["truck_schedule"].drop("delay").orderBy(F.desc("departure_date")).limit(5)
    p1 = TR.predict_delay(new, cleaned, models["random_forest"], art)
    p2 = TR.predict_delay(new, cleaned, model, art2)
    key = ["truck_id", "route_id", "departure_date"]
    a = sorted(tuple(r) for r in p1.orderBy(*key).collect())
    b = sorted(tuple(r) for r in p2.orderBy(*key).collect())
    assert a == b and len(a) == 5
    assert set(p1.columns) >= {"predicted_delay", "delay_probability", "predicted_delay_label"}

    # a batch with one fuel type only still yields the training layout
    one = new.limit(1)
    assert TR.predict_delay(one, cleaned, model, art2).count() == 1


def test_load_reference_tables(spark, raw_dir):
    tables = TR.load_reference_tables(spark, str(raw_dir))
    assert "truck_schedule" not in tables and set(tables) >= {"drivers", "trucks", "traffic", "routes"}
    assert remaining_nulls(tables["drivers"], ["gender", "driving_style"]).first()[0] == 0


def test_registered_training_fits_the_listed_forest(monkeypatch):
    """SURVEY T5: 300 trees of depth 10, on the planted label."""
    import inspect

    from haulstat.plans import queries as Q
    asked = {}

    class Fitted(Exception):
        pass

    def fit(*args, **kwargs):
        call = inspect.signature(TR.train_and_evaluate).bind(*args, **kwargs)
        call.apply_defaults()
        asked.update(call.arguments)
        raise Fitted

    class Trips:
        def withColumn(self, name, value):
            return name

    monkeypatch.setattr(Q, "kept_folder", lambda spark, name, paths, parameters, write: write(""))
    monkeypatch.setattr(Q, "trip_dataset", lambda spark, sf: None)
    monkeypatch.setattr(Q, "_planted", lambda day: day)
    monkeypatch.setattr(Q.F, "col", lambda c: c)
    monkeypatch.setattr(Q.P, "engineer_features", lambda full: Trips())
    monkeypatch.setattr(Q, "train_and_evaluate", fit)
    with pytest.raises(Fitted):
        Q._trained(None, "")
    assert (asked["num_trees"], asked["max_depth"], asked["full"]) == (300, 10, "delay")
    assert "random_forest" in asked["kinds"]


def test_wrong_models_miss_the_planted_label(spark):
    """The registered rows are exact only for a model that learned: not without the telling input, nor with other labels."""
    from haulstat.plans import queries as Q
    full = P.engineer_features(Q.trip_dataset(spark, "/root/testdata/sf0.001")).withColumn("delay", Q._planted(F.col(Q.PLANTED_INPUT)))
    fit = lambda df: {r["model"]: r for r in TR.train_and_evaluate(df, keys=["trip_id"], num_trees=20, max_depth=5)[2].collect()}
    right = fit(full)
    assert all(r["accuracy"] == r["roc_auc"] == r["train_accuracy"] == 1.0 for r in right.values())
    hidden = fit(full.drop(Q.PLANTED_INPUT, "is_weekend_departure"))
    other = fit(full.withColumn("delay", (F.col("trip_id") % 2).cast("int")))
    assert all(r["accuracy"] < 0.9 and r["roc_auc"] < 0.9 for found in (hidden, other) for r in found.values())


def test_trip_rows_are_rounded_like_the_sql(spark, monkeypatch):
    """4.1546875 lies below the tie in binary: SQL rounds it down, its decimal text would go up."""
    from haulstat.plans import queries as Q
    cols = [F.lit(4.1546875).alias(c) for c in Q.TRIP_NUMERIC]
    monkeypatch.setattr(Q, "trip_dataset", lambda spark, sf: spark.range(1).select(*cols))
    assert set(Q._rounded_trip_rows(spark, "").first()) == {4.154687}


def test_training_rows_keep_all_cores_busy_and_are_scored_once(spark, monkeypatch):
    day = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.col("trip_id").cast("int"))
    full = spark.range(60).toDF("trip_id").coalesce(1).select(
        "trip_id", *[F.lit(1).alias(c) for c in P.ID_COLUMNS if c not in ("departure_date", "estimated_arrival")],
        day.alias("departure_date"), day.alias("estimated_arrival"), *[F.lit("a").alias(c) for c in P.CATEGORICAL_COLUMNS],
        (F.col("trip_id") % 7).alias("x"), (F.col("trip_id") % 7 >= 3).cast("int").alias("delay"))
    cores = spark.sparkContext.defaultParallelism
    assert TR.even_parts(full) == cores
    monkeypatch.setattr(TR, "ROWS_PER_PART", 1)
    assert TR.even_parts(full) % cores == 0 and TR.even_parts(full) >= 60  # a row a part
    monkeypatch.undo()
    parts, keep = [], P.materialize
    monkeypatch.setattr(P, "materialize", lambda df: parts.append(df.rdd.getNumPartitions()) or keep(df))
    metrics = TR.train_and_evaluate(full, kinds=["random_forest"], num_trees=3, max_depth=2, keys=["trip_id"])[2]
    assert parts == [cores]
    files = metrics.inputFiles()  # the confusion counts read the stored scores, not the trees again
    assert files and all("scored-random_forest" in f for f in files)
