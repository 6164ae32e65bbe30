"""Registered queries: each runs one inventory operator over the bound test tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables. Floating results are rounded to 6 places so they compare equal
to the SQL oracle regardless of summation order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulstat.functions.columns import (
    bad_weather,
    coerce_timestamp,
    is_weekend,
    normalize_hour,
    reading_timestamp,
    round_whole,
    weekday_mon0,
)
from haulstat.operators import clean as C
from haulstat.operators import profile as PR
from haulstat.operators.asof import asof_nearest
from haulstat.operators import metrics as M
from haulstat.operators.lookup import join_on
from haulstat.operators.features import align_columns, fit_categories, high_quantile_flag, one_hot, standardize_with
from haulstat.operators.split import split_periods, time_split
from haulstat.sources.feature_store import FeatureGroup, get_or_create
from haulstat.sources.snapshots import kept_folder, snapshot, stored
from haulstat.sources.sinks import write_features
from haulstat.sources.tables import fixed_frame, load_all, load_lines, load_table, parse_lines, quarantined, table_shapes
from haulstat.plans import bindings as B
from haulstat.plans import trips as P
from haulstat.plans.rawfiles import measured, raw_file, raw_files
from haulstat.plans.train import (
    feature_importances,
    load,
    load_reference_tables,
    predict_delay,
    save,
    train_and_evaluate,
)

R = 6  # decimal places of every floating output


def _r(c: str, places: int = R) -> F.Column:
    """Round to ``places`` decimals the way the SQL side does: round(x * 10^p) / 10^p."""
    scale = float(10 ** places)
    return (round_whole(F.col(c) * F.lit(scale)) / F.lit(scale)).alias(c)


def _rounded(df: DataFrame, cols: Sequence[str], places: int = R) -> DataFrame:
    """``df`` with the double columns ``cols`` rounded as ``_r`` rounds them, all in one array.

    Dozens of roundings written out are one generated method too long for the JVM to compile, so it would be
    interpreted; over an array the rounding is there once.
    """
    cols = list(cols)
    if not cols:
        return df
    scale = F.lit(float(10 ** places))
    scaled = F.transform(F.array(*[F.col(c) for c in cols]), lambda x: x * scale)
    held = df.select(*[c for c in df.columns if c not in cols],
                     F.transform(scaled, lambda x: round_whole(x) / scale).alias("__rounded"))
    return held.select(*[F.get("__rounded", F.lit(cols.index(c))).alias(c) if c in cols else F.col(c) for c in df.columns])


def _city(spark: SparkSession, sf: str) -> DataFrame:
    """The derived city series feeds the width estimate and both lookups: computed once."""
    return P.materialize(B.city_series(spark, sf))


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The domain catalog bound onto the test tables."""
    city = _city(spark, sf)
    rd = B.readings(spark, sf)
    return {
        "truck_schedule": B.trips(spark, sf),
        "routes": B.routes(spark, sf),
        "traffic": rd,
        "routes_weather": rd,
        "city_weather": city,
        "drivers": B.drivers(spark, sf),
        "trucks": B.trucks(spark, sf),
    }


# ---------------------------------------------------------------- joins

def _plan(t: DataFrame) -> dict:
    width, bound = P.plan_windows(t, "departure_date", "estimated_arrival")
    return {"bucket_hours": width, "size_bound": bound}


def q_interval_traffic(spark: SparkSession, sf: str) -> DataFrame:
    t = B.trips(spark, sf).select("trip_id", "route_id", "departure_date", "estimated_arrival")
    out = P.add_traffic(t, B.readings(spark, sf), keys=["trip_id"], ts="ts", **_plan(t))
    return out.select("trip_id", _r("no_of_vehicles"), "accident")


def q_interval_weather(spark: SparkSession, sf: str) -> DataFrame:
    t = B.trips(spark, sf).select("trip_id", "route_id", "departure_date", "estimated_arrival")
    out = P.add_route_weather(t, B.readings(spark, sf), keys=["trip_id"], ts="ts", **_plan(t))
    return _rounded(out.select("trip_id", *B.WEATHER_COLS), B.WEATHER_COLS)


def q_asof_nearest(spark: SparkSession, sf: str) -> DataFrame:
    ev = B.table(spark, sf, "events")
    purchases = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = ev.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_event_id"), F.col("user_id").alias("view_user_id"),
        F.col("ts").alias("view_ts"))
    return asof_nearest(purchases, views, left_by="user_id", right_by="view_user_id",
                        left_on="ts", right_on="view_ts", payload=["view_event_id", "view_ts"],
                        tie="view_event_id")


def q_asof_two_sided(spark: SparkSession, sf: str) -> DataFrame:
    t = P.add_route_info(
        B.trips(spark, sf).select("trip_id", "route_id", "departure_date", "estimated_arrival"),
        B.routes(spark, sf).select("route_id", "origin_id", "destination_id"))
    out = P.add_city_weather(t, _city(spark, sf), ts="ts")
    cols = [p + c for p in ("origin_", "destination_") for c in B.WEATHER_COLS]
    return _rounded(out.select("trip_id", *cols), cols)


def q_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    t = P.add_route_info(B.trips(spark, sf), B.routes(spark, sf))
    return P.add_driver_and_truck(t, B.drivers(spark, sf), B.trucks(spark, sf))


TRIP_INPUTS = ("orders", "customer", "lineitem", "supplier", "nation", "region")


def _inputs(sf: str, names=TRIP_INPUTS) -> dict[str, str]:
    return {n: f"{sf}/{n}.parquet" for n in names}


def trip_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The merged trips, built once per session from these files and shared by all trip queries."""
    kw = dict(keys=["trip_id"], traffic_ts="ts", weather_ts="ts", city_ts="ts")
    return snapshot(spark, "trips", _inputs(sf), kw, lambda: P.build_trips(_tables(spark, sf), **kw))


def _round_doubles(df: DataFrame) -> DataFrame:
    return _rounded(df, [f.name for f in df.schema.fields if f.dataType.typeName() == "double"])


def q_trip_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(trip_dataset(spark, sf))


def q_trip_features(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(P.engineer_features(trip_dataset(spark, sf)))


def q_model_matrix(spark: SparkSession, sf: str) -> DataFrame:
    full = P.engineer_features(trip_dataset(spark, sf))
    return _round_doubles(P.model_matrix(full))


# ---------------------------------------------------------------- features

def q_bad_weather_flags(spark: SparkSession, sf: str) -> DataFrame:
    r = B.readings(spark, sf)
    return r.select("route_id", "ts", "precip", "visibility", "wind_speed",
                    bad_weather("").alias("bad_weather"))


def q_high_quantile_flag(spark: SparkSession, sf: str) -> DataFrame:
    r = B.readings(spark, sf).select("route_id", "ts", "no_of_vehicles")
    return high_quantile_flag(r, "no_of_vehicles", "high_traffic", q=0.75)


def q_flag_rates(spark: SparkSession, sf: str) -> DataFrame:
    f = P.engineer_features(trip_dataset(spark, sf))
    return f.agg(F.avg("any_bad_weather").alias("any_bad_weather_rate"), F.avg("high_traffic").alias("high_traffic_rate"),
                 F.avg("is_weekend_departure").alias("weekend_rate")).select(
        _r("any_bad_weather_rate"), _r("high_traffic_rate"), _r("weekend_rate"))


def q_calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    t = B.trips(spark, sf)
    return t.select("trip_id", weekday_mon0("departure_date").alias("departure_day_of_week"),
                    is_weekend("departure_date").alias("is_weekend_departure"))


def q_latest_trips(spark: SparkSession, sf: str) -> DataFrame:
    t = B.trips(spark, sf)
    return (t.orderBy(F.desc("departure_date"), F.desc("trip_id")).limit(5)
            .select("trip_id", "truck_id", "route_id", "departure_date", "estimated_arrival"))


def q_duration_profile(spark: SparkSession, sf: str) -> DataFrame:
    d = PR.duration_profile(B.trips(spark, sf), "departure_date", "estimated_arrival")
    return d.select("trips", _r("min_hours"), _r("mean_hours"), _r("max_hours"))


def q_daily_rate(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("departure_date").cast("timestamp_ntz")
    d = PR.rate_by(B.trips(spark, sf), day, "delay", name="day")
    return d.select("day", "trips", _r("delay_rate"))


# ---------------------------------------------------------------- load fixes

def q_normalize_hour(spark: SparkSession, sf: str) -> DataFrame:
    li = B.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", (F.col("l_linenumber") * 100).alias("raw_hour"))
    return li.select("l_orderkey", "l_linenumber", "raw_hour",
                     normalize_hour("raw_hour").alias("hour"),
                     reading_timestamp("l_shipdate", normalize_hour("raw_hour")).alias("reading_ts"))


def _date_text(spark: SparkSession, sf: str) -> DataFrame:
    li = B.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_orderkey") % 7 == 0, F.lit("not a date"))
                     .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("date_text"))


def q_parse_coerce(spark: SparkSession, sf: str) -> DataFrame:
    return _date_text(spark, sf).withColumn("date", coerce_timestamp("date_text"))


# ---------------------------------------------------------------- null filling

def _events_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    ev = B.table(spark, sf, "events")
    return ev.select("event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))


def _lineitem_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    li = B.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey",
                     F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
                     F.when((F.col("l_linenumber") == 1) | (F.col("l_suppkey") % 10 == 0), None)
                     .otherwise(F.col("l_quantity")).alias("l_quantity_g"),
                     F.when(F.col("l_orderkey") % 5 == 0, None).otherwise(F.col("l_discount")).alias("l_discount"),
                     F.when(F.col("l_returnflag") == "A", None).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
                     "l_shipdate")


def q_fill_mode(spark: SparkSession, sf: str) -> DataFrame:
    return C.fill_mode(_events_with_nulls(spark, sf), ["event_type"]).select("event_id", "event_type")


def q_fill_median(spark: SparkSession, sf: str) -> DataFrame:
    li = _lineitem_with_nulls(spark, sf).select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return C.fill_median(li, ["l_quantity"])


def q_fill_group_median(spark: SparkSession, sf: str) -> DataFrame:
    li = _lineitem_with_nulls(spark, sf).select("l_orderkey", "l_linenumber", "l_suppkey",
                                                F.col("l_quantity_g").alias("l_quantity"))
    return C.fill_group_median(li, "l_quantity", "l_suppkey")


def q_clean_tables(spark: SparkSession, sf: str) -> DataFrame:
    drivers = B.drivers(spark, sf).select(
        "vehicle_no",
        F.when(F.col("vehicle_no") % 7 == 0, None).otherwise(F.col("gender")).alias("gender"),
        F.when(F.col("vehicle_no") % 11 == 0, None).otherwise(F.col("driving_style")).alias("driving_style"))
    trucks = B.trucks(spark, sf).select(
        "truck_id",
        F.when(F.col("truck_id") % 13 == 0, None).otherwise(F.col("fuel_type")).alias("fuel_type"),
        F.when(F.col("truck_id") % 17 == 0, None).otherwise(F.col("load_capacity_pounds"))
        .alias("load_capacity_pounds"))
    cleaned = C.clean_tables({"drivers": drivers, "trucks": trucks})
    out = cleaned["drivers"].join(cleaned["trucks"], cleaned["drivers"]["vehicle_no"] == cleaned["trucks"]["truck_id"])
    return out.select("truck_id", "gender", "driving_style", "fuel_type", _r("load_capacity_pounds"))


# ---------------------------------------------------------------- profiling

def q_null_report(spark: SparkSession, sf: str) -> DataFrame:
    return PR.null_report(_lineitem_with_nulls(spark, sf))


def q_dup_rows(spark: SparkSession, sf: str) -> DataFrame:
    li = B.table(spark, sf, "lineitem")
    keys = PR.duplicate_rows(li, ["l_orderkey", "l_linenumber"]).select("duplicate_rows").scalar()
    return PR.duplicate_rows(li).withColumn("duplicate_keys", keys)


def q_table_profile(spark: SparkSession, sf: str) -> DataFrame:
    li = PR.table_size(B.table(spark, sf, "lineitem"), "lineitem", "l_suppkey")
    od = PR.table_size(B.table(spark, sf, "orders"), "orders", "o_custkey")
    cu = PR.table_size(B.table(spark, sf, "customer"), "customer", "c_nationkey")
    return li.unionByName(od).unionByName(cu)


def q_rows_per_key(spark: SparkSession, sf: str) -> DataFrame:
    r = PR.rows_per_key(B.readings(spark, sf), "route_id", "readings_per_route")
    t = B.trips(spark, sf)
    a = PR.rows_per_key(t, "route_id", "trips_per_route")
    b = PR.rows_per_key(t, "truck_id", "trips_per_truck")
    return r.unionByName(a).unionByName(b).select("series", "n_keys", "min_rows", _r("mean_rows"), "max_rows")


def q_key_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return PR.distinct_counts({
        "schedule_trucks": (B.trips(spark, sf), "truck_id"),
        "trucks": (B.trucks(spark, sf), "truck_id"),
        "drivers": (B.drivers(spark, sf), "vehicle_no"),
    })


NUM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax"]


def _round_cols(df: DataFrame, cols) -> DataFrame:
    return df.select(*[_r(c) if c in cols else F.col(c) for c in df.columns])


def q_describe(spark: SparkSession, sf: str) -> DataFrame:
    d = PR.describe(B.table(spark, sf, "lineitem"), NUM_COLS)
    d = d.withColumns({"mean": _r("mean", 4), "std": _r("std", 4)})
    return _round_cols(d, ["min", "q25", "q50", "q75", "max"])


def q_describe_dates(spark: SparkSession, sf: str) -> DataFrame:
    return PR.describe_dates(B.trips(spark, sf), ["departure_date", "estimated_arrival"])


def q_histogram(spark: SparkSession, sf: str) -> DataFrame:
    h = PR.histogram(B.table(spark, sf, "lineitem"), NUM_COLS, bins=30)
    return _round_cols(h, ["bin_lo", "bin_hi"])


def q_kde_curve(spark: SparkSession, sf: str) -> DataFrame:
    k = PR.kde_curve(B.table(spark, sf, "lineitem"), NUM_COLS, grid=200, bins=30)
    k = k.withColumn("count_density", _r("count_density", 4))
    return _round_cols(k, ["x", "density"])


def q_boxplot_stats(spark: SparkSession, sf: str) -> DataFrame:
    b = PR.boxplot_stats(B.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], "l_returnflag")
    return _round_cols(b, ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"])


def q_corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    li = B.table(spark, sf, "lineitem")
    return _round_cols(PR.corr_matrix(li, PR.numeric_columns(li)), ["corr"])


def q_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return PR.value_counts(B.trips(spark, sf), "delay").select("delay", "count", _r("share"))


def _trips_with_priority(spark: SparkSession, sf: str) -> DataFrame:
    o = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("trip_id"), "o_orderpriority")
    return B.trips(spark, sf).join(o, "trip_id", "left")


def q_rate_by_category(spark: SparkSession, sf: str) -> DataFrame:
    r = PR.rate_by(_trips_with_priority(spark, sf), "o_orderpriority", "delay")
    return r.orderBy(F.desc("delay_rate"), "o_orderpriority").select("o_orderpriority", "trips", _r("delay_rate"))


def q_top_routes_delay(spark: SparkSession, sf: str) -> DataFrame:
    r = PR.rate_by(B.trips(spark, sf), "route_id", "delay", min_count=5)
    return (r.orderBy(F.desc("delay_rate"), "route_id").limit(7)
            .select("route_id", "trips", _r("delay_rate")))


# ---------------------------------------------------------------- load path and trip exploration

def _traffic_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw traffic lines as a file holds them: gaps, integers written as 1.0, clock hours, unreadable dates."""
    li = B.table(spark, sf, "lineitem")
    date = F.when(F.col("l_orderkey") % 97 == 0, "not a date").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    vehicles = F.when(F.col("l_orderkey") % 5 == 0, "NA").when(F.col("l_orderkey") % 7 == 0, "").otherwise(
        F.col("l_quantity").cast("string"))
    accident = F.when(F.col("l_partkey") % 7 == 0, "").when(F.col("l_partkey") % 10 == 0, "1.0").otherwise("0")
    route = F.when(F.col("l_suppkey") % 11 == 0, "#NA").when(F.col("l_suppkey") % 13 == 0, "none").otherwise(
        F.col("l_suppkey").cast("string"))
    return li.select(F.concat_ws(",", route, date, (F.col("l_linenumber") % 24 * 100).cast("string"), vehicles,
                                 accident).alias("line"))


def _parsed_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return fixed_frame(parse_lines(_traffic_lines(spark, sf), "traffic"), "traffic")


def q_load_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed_traffic(spark, sf).withColumn("accident", F.col("accident").cast("double"))


def q_load_quality(spark: SparkSession, sf: str) -> DataFrame:
    """What one pass of parsing and writing the lines observed: rows, nulls, unreadable dates, and the lines set aside."""
    def write(path: str) -> None:
        counts = load_lines(_traffic_lines(spark, sf), "traffic", f"{path}/rows")
        spark.createDataFrame(sorted(counts.items()), "measure string, n long").write.parquet(f"{path}/counts")

    path = kept_folder(spark, "traffic-load", _inputs(sf, ("lineitem",)), "lines", write)
    aside = quarantined(spark, f"{path}/rows").agg(F.lit("quarantined").alias("measure"), F.count(F.lit(1)).alias("n"))
    return spark.read.parquet(f"{path}/counts").unionByName(aside)


def q_load_clean(spark: SparkSession, sf: str) -> DataFrame:
    parsed = stored(_parsed_traffic(spark, sf).select("route_id", "no_of_vehicles", "accident"), "parsed-traffic")
    cleaned = C.clean_tables({"traffic": parsed})["traffic"]  # the lines are parsed once for the several passes
    return cleaned.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("no_of_vehicles").alias("n_known"),
        F.sum("no_of_vehicles").alias("vehicles"), F.count("accident").alias("n_accident"),
        F.sum("accident").alias("accidents")).withColumn("vehicles", _r("vehicles"))


def q_remaining_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return C.remaining_nulls(_parsed_traffic(spark, sf))


def q_type_tally(spark: SparkSession, sf: str) -> DataFrame:
    return PR.type_report(B.table(spark, sf, "lineitem"))


TRIP_NUMERIC = ["distance", "average_hours", "no_of_vehicles", "accident", "temp", "wind_speed", "precip", "humidity",
                "visibility", "pressure", "origin_temp", "destination_temp", "ratings", "truck_age", "load_capacity_pounds"]


def _trip_rows(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """The merged trips' exploration columns."""
    return trip_dataset(spark, sf).select(*TRIP_NUMERIC, *more)


def _rounded_trip_rows(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Means of windows rounded first as SQL rounds doubles, so that a bin's edge or a fence is the same on both sides."""
    return _trip_rows(spark, sf, *more).select(*[_r(c) for c in TRIP_NUMERIC], *more)


def q_trip_describe(spark: SparkSession, sf: str) -> DataFrame:
    d = PR.describe(_trip_rows(spark, sf), TRIP_NUMERIC)
    return _round_cols(d.withColumns({"mean": _r("mean", 4), "std": _r("std", 4)}), ["min", "q25", "q50", "q75", "max"])


def q_trip_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _round_cols(PR.histogram(_rounded_trip_rows(spark, sf), TRIP_NUMERIC, bins=30), ["bin_lo", "bin_hi"])


def q_trip_kde(spark: SparkSession, sf: str) -> DataFrame:
    """The density curve over each of the histograms."""
    k = PR.kde_curve(_rounded_trip_rows(spark, sf), TRIP_NUMERIC, grid=200, bins=30)
    return _round_cols(k.withColumn("count_density", _r("count_density", 4)), ["x", "density"])


def q_trip_corr(spark: SparkSession, sf: str) -> DataFrame:
    return _round_cols(PR.corr_matrix(_trip_rows(spark, sf, "delay"), [*TRIP_NUMERIC, "delay"]), ["corr"])


def q_trip_boxplot(spark: SparkSession, sf: str) -> DataFrame:
    b = PR.boxplot_stats(_rounded_trip_rows(spark, sf, "delay"), TRIP_NUMERIC, "delay")
    return _round_cols(b, ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"])


def q_trip_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Delay rate by gender, driving style and fuel type of the merged trips."""
    rows = trip_dataset(spark, sf).select("gender", "driving_style", "fuel_type", "delay")
    out = None
    for c in ("gender", "driving_style", "fuel_type"):
        one = PR.rate_by(rows, c, "delay", name="value").withColumn("by", F.lit(c))
        out = one if out is None else out.unionByName(one)
    return out.select("by", "value", "trips", _r("delay_rate"))


#: Planted label: trips that depart from Thursday on (Monday 0). A model that learns finds it whole, whatever the other inputs.
PLANTED_INPUT, PLANTED_FROM = "departure_day_of_week", 3


def _planted(day: F.Column) -> F.Column:
    return (day >= PLANTED_FROM).cast("int")


def _trained(spark: SparkSession, sf: str) -> str:
    """Folder of both fitted models, their artifacts and their evaluation, fitted once and shared by the queries below."""
    def write(path: str) -> None:
        full = P.engineer_features(trip_dataset(spark, sf)).withColumn("delay", _planted(F.col(PLANTED_INPUT)))
        models, art, metrics = train_and_evaluate(full, keys=["trip_id"])
        save(models, art, path, spark)
        metrics.write.parquet(f"{path}/metrics")
        feature_importances(spark, models["random_forest"], art.feature_columns).write.parquet(f"{path}/importances")

    return kept_folder(spark, "delay-models", _inputs(sf), [PLANTED_INPUT, PLANTED_FROM], write)


def q_train_summary(spark: SparkSession, sf: str) -> DataFrame:
    """One row per model: confusion counts and rates on the later fifth of the trips, accuracy on the trained part."""
    rates = ["accuracy", "precision", "recall", "f1", "roc_auc", "train_accuracy"]
    m = spark.read.parquet(f"{_trained(spark, sf)}/metrics")
    return m.select("model", *[F.col(c).cast("long").alias(c) for c in ("tp", "fp", "fn", "tn")], *[_r(c) for c in rates])


def q_model_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """The forest's inputs: how many, their importances' sum, and the one that tells the label."""
    i = spark.read.parquet(f"{_trained(spark, sf)}/importances")
    top = F.max_by("feature", "importance")
    return i.agg(F.count(F.lit(1)).alias("n_inputs"), F.round(F.sum("importance"), 6).alias("importance_sum"),
                 top.alias("top_input"), (F.max("importance") > 0.5).alias("tells_most"))


def q_predict_recent(spark: SparkSession, sf: str) -> DataFrame:
    """The five latest trips through the saved forest, joined with their planted labels."""
    forest, art = load(spark, _trained(spark, sf), "random_forest")
    recent = B.trips(spark, sf).orderBy(F.desc("departure_date"), F.desc("trip_id")).limit(5)
    scored = predict_delay(P.new_trip_frame(recent), _tables(spark, sf), forest, art,
                           keep=("trip_id", "truck_id"), keys=["trip_id"], traffic_ts="ts", weather_ts="ts", city_ts="ts")
    actual = recent.select("trip_id", _planted(weekday_mon0("departure_date")).alias("delay"))
    return scored.join(actual.select("trip_id", M.value_map("delay", M.LABELS).alias("actual_label")), "trip_id").select(
        "trip_id", "truck_id", "predicted_delay_label", "actual_label")


# ---------------------------------------------------------------- model matrix

def _split_trips(spark: SparkSession, sf: str) -> DataFrame:
    return time_split(B.trips(spark, sf), "departure_date", ["trip_id"], test_size=0.2)


def q_time_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split_trips(spark, sf)


def q_time_split_one_day(spark: SparkSession, sf: str) -> DataFrame:
    """All trips leave on one day at one of three times: the cut falls inside a timestamp that a third of the rows share."""
    t = B.trips(spark, sf).withColumn("departure_date", F.expr(
        "make_timestamp_ntz(2019, 2, 1, CAST(7 + trip_id % 3 AS INT), 0, 0)"))
    return time_split(t, "departure_date", ["trip_id"], test_size=0.2)


def q_split_periods(spark: SparkSession, sf: str) -> DataFrame:
    return split_periods(_split_trips(spark, sf), "departure_date")


def _stored_split(spark: SparkSession, sf: str) -> DataFrame:
    """The split, computed once for the several passes that fit on its training rows."""
    return snapshot(spark, "split", _inputs(sf, ("orders", "customer")), 0.2,
                    lambda: _split_trips(spark, sf).select("trip_id", "split"))


def _split_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("trip_id"), "o_orderpriority",
                                            "o_totalprice", "o_orderstatus")
    return _stored_split(spark, sf).join(o, "trip_id", "inner")


def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    rows = _split_orders(spark, sf)
    cats = fit_categories(rows.where(F.col("split") == "train"), ["o_orderpriority"])
    return one_hot(rows.select("trip_id", "o_orderpriority"), ["o_orderpriority"], categories=cats)


def q_align_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = _split_orders(spark, sf)
    cats = fit_categories(rows.where(F.col("split") == "train"), ["o_orderpriority"])
    expected = ["trip_id", "o_totalprice", *[f"o_orderpriority_{v}" for v in cats["o_orderpriority"][1:]]]
    batch = rows.where((F.col("split") == "test") & (F.col("o_orderpriority") != "1-URGENT"))
    encoded = one_hot(batch.select("trip_id", "o_totalprice", "o_orderstatus", "o_orderpriority"),
                      ["o_orderpriority"])
    return align_columns(encoded, expected)


def q_standardize(spark: SparkSession, sf: str) -> DataFrame:
    rows = _split_orders(spark, sf).select("trip_id", "split", "o_totalprice")
    out = standardize_with(rows, rows.where(F.col("split") == "train"), ["o_totalprice"])
    return out.select("trip_id", "split", _r("o_totalprice"))


# ---------------------------------------------------------------- scoring and metrics

def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return M.predict_label(B.scores(spark, sf), "probability")


def q_label_map(spark: SparkSession, sf: str) -> DataFrame:
    return M.label_predictions(_scored(spark, sf)).select(
        "trip_id", "predicted_delay", "delay_probability", "predicted_delay_label")


def q_confusion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = M.confusion_metrics(_scored(spark, sf), "delay", "predicted_delay")
    return _round_cols(m, ["accuracy", "precision", "recall", "f1"])


def q_class_report(spark: SparkSession, sf: str) -> DataFrame:
    return _round_cols(M.class_report(_scored(spark, sf), "delay", "predicted_delay"),
                       ["precision", "recall", "f1"])


def q_roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return M.roc_auc(B.scores(spark, sf), "delay", "probability").select(_r("roc_auc"))


def q_pred_vs_actual(spark: SparkSession, sf: str) -> DataFrame:
    t = B.trips(spark, sf)
    recent = t.orderBy(F.desc("departure_date"), F.desc("trip_id")).limit(5)
    scores = B.scores(spark, sf).select("trip_id", "probability")
    preds = M.label_predictions(M.predict_label(recent.join(scores, "trip_id"), "probability"))
    preds = preds.select("truck_id", "route_id", "departure_date", "predicted_delay_label", "delay_probability")
    actual = recent.select("truck_id", "route_id", "departure_date",
                           M.value_map("delay", M.LABELS).alias("actual_label"))
    return join_on(preds, actual, ["truck_id", "route_id", "departure_date"])


# ---------------------------------------------------------------- feature store

def _published_orders(spark: SparkSession, sf: str) -> FeatureGroup:
    """A feature table with two inserted batches, a snapshot between them and a third batch: orders with changing prices."""
    def write(path: str) -> None:
        group = get_or_create(path, "orders", 1, ["o_orderkey"])
        o = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
        cols = ["o_orderkey", "o_custkey"]
        group.insert(o.select(*cols, "o_totalprice"))
        group.insert(o.where(F.col("o_orderstatus") == "O").select(*cols, (F.col("o_totalprice") * 1.1).alias("o_totalprice")))
        group.compact(spark)
        group.insert(o.where(F.col("o_orderkey") % 10 == 0).select(*cols, (F.col("o_totalprice") * 2).alias("o_totalprice")))

    return get_or_create(kept_folder(spark, "features", _inputs(sf, ("orders",)), "orders", write), "orders", 1, ["o_orderkey"])


def q_feature_store_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest row of every key, read from the snapshot and the batch after it."""
    latest = _published_orders(spark, sf).read(spark, with_batch=True)
    return latest.select("o_orderkey", "o_custkey", _r("o_totalprice"), F.col("batch_id").cast("int").alias("batch_id"))


def q_feature_store_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Round trip: per batch the rows that the write observed and the rows that are read back."""
    group = _published_orders(spark, sf)
    written = spark.createDataFrame([(e["number"], e["rows"]) for e in group.commits(spark) if e["kind"] == "batch"],
                                    "batch_id int, rows_written long")
    read = group.read_all(spark).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows_read"))
    return written.join(read, "batch_id", "left").select("batch_id", "rows_written", "rows_read")


def q_published_trips(spark: SparkSession, sf: str) -> DataFrame:
    """The trips' features published as a first batch, weekend trips again with another traffic flag: the newest rows."""
    def write(path: str) -> None:
        full = P.engineer_features(trip_dataset(spark, sf))
        P.publish_features(full, path, keys=["trip_id"])
        late = full.where(F.col("is_weekend_departure") == 1).withColumn("high_traffic", F.lit(1) - F.col("high_traffic"))
        P.publish_features(late, path, keys=["trip_id"])

    path = kept_folder(spark, "published-trips", _inputs(sf), "weekend", write)
    group = get_or_create(path, P.FEATURE_GROUP_NAME, P.FEATURE_GROUP_VERSION, ["trip_id"], "departure_date")
    latest = group.read(spark, with_batch=True).withColumn("batch_id", F.col("batch_id").cast("int"))
    return _round_doubles(latest)


# ---------------------------------------------------------------- files

def _files(spark: SparkSession, sf: str) -> dict[str, str]:
    return raw_files(spark, sf, _inputs(sf))


def _file(spark: SparkSession, sf: str, name: str) -> str:
    return raw_file(spark, sf, _inputs(sf), name)


def q_file_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and columns of the seven raw tables, read from their files."""
    return table_shapes(load_all(spark, _files(spark, sf)))


def q_file_schedule(spark: SparkSession, sf: str) -> DataFrame:
    """The schedule from its file: both times must be readable, else the load fails."""
    return load_table(spark, "truck_schedule", _file(spark, sf, "truck_schedule"))


def q_file_routes_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Route weather from its file, its date column renamed and read strictly."""
    return load_table(spark, "routes_weather", _file(spark, sf, "routes_weather"))


def q_file_city_weather(spark: SparkSession, sf: str) -> DataFrame:
    """City weather from its file: clock hours normalised, the reading's time from date and hour."""
    return _round_doubles(load_table(spark, "city_weather", _file(spark, sf, "city_weather")))


def q_reference_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All tables that new trips are joined with, read from their files and cleaned: rows and totals by category."""
    return measured(load_reference_tables(spark, _files(spark, sf))).withColumn("total", _r("total", 4))


def q_final_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The final features as written by departure day and read back."""
    path = kept_folder(spark, "final-features", _inputs(sf), "day",
                       lambda p: write_features(P.engineer_features(trip_dataset(spark, sf)), p))
    rows = spark.read.parquet(path)
    return _round_doubles(rows.withColumn("departure_day", F.col("departure_day").cast("timestamp_ntz")))


def q_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of the events in the order of their ids."""
    return PR.preview(B.table(spark, sf, "events").orderBy("event_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "interval_traffic": q_interval_traffic,
    "interval_weather": q_interval_weather,
    "asof_nearest": q_asof_nearest,
    "asof_two_sided": q_asof_two_sided,
    "lookup_join": q_lookup_join,
    "trip_dataset": q_trip_dataset,
    "trip_features": q_trip_features,
    "model_matrix": q_model_matrix,
    "bad_weather_flags": q_bad_weather_flags,
    "high_quantile_flag": q_high_quantile_flag,
    "flag_rates": q_flag_rates,
    "calendar_features": q_calendar_features,
    "latest_trips": q_latest_trips,
    "duration_profile": q_duration_profile,
    "daily_rate": q_daily_rate,
    "normalize_hour": q_normalize_hour,
    "parse_coerce": q_parse_coerce,
    "fill_mode": q_fill_mode,
    "fill_median": q_fill_median,
    "fill_group_median": q_fill_group_median,
    "clean_tables": q_clean_tables,
    "null_report": q_null_report,
    "dup_rows": q_dup_rows,
    "table_profile": q_table_profile,
    "rows_per_key": q_rows_per_key,
    "key_coverage": q_key_coverage,
    "describe": q_describe,
    "describe_dates": q_describe_dates,
    "histogram": q_histogram,
    "kde_curve": q_kde_curve,
    "boxplot_stats": q_boxplot_stats,
    "corr_matrix": q_corr_matrix,
    "value_counts": q_value_counts,
    "rate_by_category": q_rate_by_category,
    "top_routes_delay": q_top_routes_delay,
    "time_split": q_time_split,
    "time_split_one_day": q_time_split_one_day,
    "load_parse": q_load_parse,
    "load_quality": q_load_quality,
    "load_clean": q_load_clean,
    "remaining_nulls": q_remaining_nulls,
    "type_tally": q_type_tally,
    "trip_describe": q_trip_describe,
    "trip_histogram": q_trip_histogram,
    "trip_kde": q_trip_kde,
    "trip_corr": q_trip_corr,
    "trip_boxplot": q_trip_boxplot,
    "trip_rates": q_trip_rates,
    "train_summary": q_train_summary,
    "model_inputs": q_model_inputs,
    "predict_recent": q_predict_recent,
    "split_periods": q_split_periods,
    "one_hot": q_one_hot,
    "align_columns": q_align_columns,
    "standardize": q_standardize,
    "label_map": q_label_map,
    "confusion_metrics": q_confusion_metrics,
    "class_report": q_class_report,
    "roc_auc": q_roc_auc,
    "pred_vs_actual": q_pred_vs_actual,
    "feature_store_latest": q_feature_store_latest,
    "feature_store_counts": q_feature_store_counts,
    "published_trips": q_published_trips,
    "file_shapes": q_file_shapes,
    "file_schedule": q_file_schedule,
    "file_routes_weather": q_file_routes_weather,
    "file_city_weather": q_file_city_weather,
    "reference_tables": q_reference_tables,
    "final_dataset": q_final_dataset,
    "preview": q_preview,
}
