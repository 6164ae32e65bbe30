"""Flags, quantile threshold, calendar, one-hot, alignment and scaling."""

import math

import pytest
from pyspark.sql import functions as F

from haulstat.functions.columns import any_of, bad_weather, is_weekend, nan_to_null, weekday_mon0
from haulstat.operators.features import (
    align_columns,
    drop_columns,
    fit_categories,
    high_quantile_flag,
    one_hot,
    quantile_value,
    standardize_with,
)
from tests.conftest import ts


def test_weather_flag_thresholds_nulls_and_nan(spark):
    rows = [(1, 0.0, 3.0, 15.0), (2, 0.1, 3.0, 15.0), (3, 0.0, 2.9, 15.0), (4, 0.0, 3.0, 15.1),
            (5, None, None, None), (6, float("nan"), 3.0, 15.0)]
    df = spark.createDataFrame(rows, "id int, precip double, visibility double, wind_speed double")
    df = df.withColumn("precip", nan_to_null("precip"))
    got = {r["id"]: r["f"] for r in df.select("id", bad_weather("").alias("f")).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1, 5: 0, 6: 0}


def test_any_of(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (None, 0, 0)], "a int, b int, c int")
    assert [r[0] for r in df.select(any_of("a", "b", "c")).collect()] == [0, 1, 0]


def test_quantile_and_high_flag(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert quantile_value(df, "x", 0.75).first()[0] == 4.75
    flags = [r["hi"] for r in high_quantile_flag(df, "x", "hi").orderBy(F.col("x").asc_nulls_last()).collect()]
    assert flags == [0, 0, 0, 1, 0]


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(ts("2024-01-01 07:00:00"),), (ts("2024-01-07 07:00:00"),)], "d timestamp_ntz")
    got = df.select(weekday_mon0("d"), is_weekend("d")).collect()
    assert [tuple(r) for r in got] == [(0, 0), (6, 1)]


def test_one_hot_first_level_dropped_unseen_and_null_zero(spark):
    train = spark.createDataFrame([("diesel",), ("gas",), ("gas",)], "fuel_type string")
    cats = fit_categories(train, ["fuel_type"])
    assert cats == {"fuel_type": ["diesel", "gas"]}
    batch = spark.createDataFrame([("gas",), ("electric",), (None,), ("diesel",)], "fuel_type string")
    out = one_hot(batch, ["fuel_type"], categories=cats)
    assert out.columns == ["fuel_type_gas"]
    assert [r[0] for r in out.collect()] == [1, 0, 0, 0]


def test_refitting_on_single_category_batch_loses_the_level(spark):
    # scoring batch encoded on its own, then aligned to the training columns
    batch = spark.createDataFrame([(1, "gas"), (2, "gas")], "id int, fuel_type string")
    own = one_hot(batch, ["fuel_type"])                     # only level -> no column
    aligned = align_columns(own, ["id", "fuel_type_gas", "extra"])
    assert aligned.columns == ["id", "fuel_type_gas", "extra"]
    assert [tuple(r) for r in aligned.collect()] == [(1, 0, 0), (2, 0, 0)]


def test_align_keeps_nulls_of_present_columns(spark):
    df = spark.createDataFrame([(1, None, 5)], "a int, b int, dropme int")
    assert [tuple(r) for r in align_columns(df, ["b", "a", "c"]).collect()] == [(None, 1, 0)]


def test_standardize_population_std_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, k double")
    out = standardize_with(df, df, ["x", "k"]).collect()
    sd = math.sqrt(2 / 3)
    assert [r["x"] for r in out] == pytest.approx([-1 / sd, 0.0, 1 / sd])
    assert [r["k"] for r in out] == [0.0, 0.0, 0.0]


def test_drop_missing_column_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        drop_columns(df, ["b"])


def test_given_threshold_overrides_the_data(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (100.0,)], "x double")
    got = [r["hi"] for r in high_quantile_flag(df, "x", "hi", threshold=1.5).orderBy("x").collect()]
    assert got == [0, 1, 1]


def test_round_whole_is_round_without_text(spark):
    from haulstat.functions.columns import round_whole
    half, big = [n + 0.5 for n in range(-4, 4)], 2.0 ** 52
    odd = [None, 0.0, -0.0, -0.3, 0.49999999999999994, -0.49999999999999994, math.inf, -math.inf, math.nan, 1e300, 5e-324,
           9.3e18, big + 1, big - 0.5, 0.5 - big, 2 * big + 2, 4154687.5, 1.0000005 * 1e6]
    df = spark.createDataFrame([(x,) for x in odd + half], "x double")
    got = df.select(F.round("x", 0).cast("string").alias("a"), round_whole("x").cast("string").alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]  # as text: 0.0 is not -0.0


def test_results_are_not_rounded_through_text(spark):
    from haulstat.plans.queries import _round_doubles
    plan = _round_doubles(spark.range(3).select((F.col("id") / 7).alias("x")))._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan and "rint(" in plan.lower()


def test_many_columns_are_rounded_by_one_expression(spark):
    """Written out for each of 40 columns, the generated method would be too long to be compiled."""
    from haulstat.plans.queries import _r, _round_doubles
    odd = [None, 0.0, -0.3, 4.1546875, 2.5e-6, -2.5e-6, 1e300, math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "id int, x double").select(
        "id", *[(F.col("x") * (i + 1)).alias(f"c{i}") for i in range(40)], F.lit("t").alias("text"))
    got = _round_doubles(df)
    assert got.columns == df.columns
    want = df.select("id", *[_r(f"c{i}") for i in range(40)], "text")
    assert [tuple(map(str, r)) for r in got.orderBy("id").collect()] == [tuple(map(str, r)) for r in want.orderBy("id").collect()]
    assert got._jdf.queryExecution().optimizedPlan().toString().lower().count("rint(") < 10
