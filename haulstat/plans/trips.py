"""Trip-level plans: the merged trip dataset, its features and the model matrix.

Functions extend a lazy plan. Jobs run while a plan is built only where it
needs a measured value (bucket widths, quantile cut points, categories) or
where ``materialize`` stores rows that feed several consumers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulstat.functions.columns import any_of, bad_weather, is_weekend, weekday_mon0
from haulstat.operators.asof import asof_cuts, asof_matches, attach_matches
from haulstat.operators.features import drop_columns, high_quantile_flag, one_hot
from haulstat.operators.interval import attach_interval_aggregate, keys_unique, plan_windows, window_size_bound
from haulstat.operators.lookup import lookup
from haulstat.session import ensure_checkpoint_dir
from haulstat.sources.snapshots import stored
from haulstat.plans.bindings import (
    CATEGORICAL_COLUMNS,
    ID_COLUMNS,
    TRIP_KEYS,
    WEATHER_COLS,
    ZERO_SIGNAL_COLUMNS,
)


def add_route_info(trips: DataFrame, routes: DataFrame) -> DataFrame:
    return lookup(trips, routes, "route_id")


def add_traffic(trips: DataFrame, traffic: DataFrame, *, keys: Sequence[str] = TRIP_KEYS,
                ts: str = "timestamp", bucket_hours: int = 24,
                size_bound: tuple[int, int] | None = None, unique: bool | None = None) -> DataFrame:
    """Mean vehicles and any accident per trip window; route mean and 0 as fallbacks."""
    return attach_interval_aggregate(
        trips, traffic, by="route_id", start="departure_date", end="estimated_arrival", ts=ts,
        aggs={"no_of_vehicles": ("avg", "no_of_vehicles"), "accident": ("max", "accident")},
        keys=keys, fallback_mean=["no_of_vehicles"], constant_fill={"accident": 0},
        bucket_hours=bucket_hours, window_size_bound=size_bound, unique=unique)


def add_route_weather(trips: DataFrame, weather: DataFrame, *, keys: Sequence[str] = TRIP_KEYS,
                      ts: str = "date", cols: Sequence[str] = WEATHER_COLS,
                      bucket_hours: int = 24, size_bound: tuple[int, int] | None = None,
                      unique: bool | None = None) -> DataFrame:
    """Mean of every weather metric per trip window; each falls back to its route mean."""
    return attach_interval_aggregate(
        trips, weather, by="route_id", start="departure_date", end="estimated_arrival", ts=ts,
        aggs={c: ("avg", c) for c in cols}, keys=keys, fallback_mean=list(cols),
        bucket_hours=bucket_hours, window_size_bound=size_bound, unique=unique)


def add_city_weather(trips: DataFrame, city: DataFrame, *, city_key: str = "city_id",
                     ts: str = "timestamp", cols: Sequence[str] = WEATHER_COLS,
                     tie: str | None = None, num_buckets: int | None = None) -> DataFrame:
    """Origin weather nearest departure and destination weather nearest arrival, on the row.

    Both matches are found from the trips' different keys and times alone, stored, with cuts from one sample
    of all three sides; the trip rows then meet the two stored answers, which are broadcast if they are small.
    """
    sides = {"origin_": ("origin_id", "departure_date"), "destination_": ("destination_id", "estimated_arrival")}
    asked = {p: stored(trips.select(by, on).dropna().distinct(), "asked") for p, (by, on) in sides.items()}
    cuts = asof_cuts([*((asked[p], by, on) for p, (by, on) in sides.items()), (city, city_key, ts)], num_buckets)
    out = trips
    for prefix, (by, on) in sides.items():
        found = stored(asof_matches(asked[prefix], city, left_by=by, right_by=city_key, left_on=on, right_on=ts,
                                    payload=cols, tie=tie, cuts=cuts), "nearest")
        out = attach_matches(out, found, left_by=by, left_on=on, payload=cols, prefix=prefix)
    return out


def add_driver_and_truck(trips: DataFrame, drivers: DataFrame, trucks: DataFrame) -> DataFrame:
    out = lookup(trips, drivers, "truck_id", rename={"vehicle_no": "truck_id"})
    return lookup(out, trucks, "truck_id")


def build_trips(tables: Mapping[str, DataFrame], *, keys: Sequence[str] = TRIP_KEYS,
                traffic_ts: str = "timestamp", weather_ts: str = "date",
                city_ts: str = "timestamp", bucket_hours: float | str = "auto",
                checkpoint: bool = True) -> DataFrame:
    """One row per trip: routes, traffic, route weather, city weather, drivers and trucks.

    The schedule with its routes is stored and measured once: the mean window length sets
    the bucket width (``bucket_hours="auto"``), (rows, widest window) decides
    whether the window joins broadcast the windows' aggregates, and whether trips share ``keys``
    is counted for both window joins.
    With ``checkpoint`` the trip rows are stored again after the two window
    joins, so the as-of stage starts from stored rows: the plan stays small
    and a lost executor re-reads them instead of re-running the
    reading joins.
    """
    schedule = stored(add_route_info(tables["truck_schedule"], tables["routes"]), "schedule")
    if bucket_hours == "auto":
        bucket_hours, bound = plan_windows(schedule, "departure_date", "estimated_arrival")
    else:
        bound = window_size_bound(schedule, "departure_date", "estimated_arrival", bucket_hours)
    unique = keys_unique(schedule, keys)
    df = add_traffic(schedule, tables["traffic"], keys=keys, ts=traffic_ts, bucket_hours=bucket_hours,
                     size_bound=bound, unique=unique)
    df = add_route_weather(df, tables["routes_weather"], keys=keys, ts=weather_ts,
                           bucket_hours=bucket_hours, size_bound=bound, unique=unique)
    if checkpoint:
        df = stored(df, "trips-on-road")
    df = add_city_weather(df, tables["city_weather"], ts=city_ts)
    return add_driver_and_truck(df, tables["drivers"], tables["trucks"])


def add_weather_flags(df: DataFrame) -> DataFrame:
    return (df.withColumn("route_bad_weather", bad_weather(""))
            .withColumn("origin_bad_weather", bad_weather("origin_"))
            .withColumn("destination_bad_weather", bad_weather("destination_"))
            .withColumn("any_bad_weather", any_of("route_bad_weather", "origin_bad_weather",
                                                  "destination_bad_weather")))


def add_calendar(df: DataFrame, ts: str = "departure_date") -> DataFrame:
    return (df.withColumn("departure_day_of_week", weekday_mon0(ts))
            .withColumn("is_weekend_departure", is_weekend(ts)))


def engineer_features(df: DataFrame, *, traffic_threshold: float | None = None,
                      zero_signal: Sequence[str] = ZERO_SIGNAL_COLUMNS) -> DataFrame:
    """Drop zero-signal columns, add weather flags, high-traffic flag and calendar columns.

    ``traffic_threshold=None`` derives the 75th percentile from ``df`` itself;
    pass the training value when scoring so train and serve agree.
    """
    out = drop_columns(df, zero_signal)
    out = add_weather_flags(out)
    out = high_quantile_flag(out, "no_of_vehicles", "high_traffic", q=0.75,
                             threshold=traffic_threshold)
    return add_calendar(out)


def model_matrix(df: DataFrame, categories: Mapping[str, Sequence[str]] | None = None,
                 id_columns: Sequence[str] = ID_COLUMNS,
                 categorical: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Drop identifiers and one-hot encode the categorical columns (first level dropped)."""
    out = drop_columns(df, id_columns)
    return one_hot(out, list(categorical), categories=categories, drop_first=True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint directory and continue from it.

    Used where one result feeds several consumers (rows and a fitted statistic
    over the same rows): the merged trip set is computed once, and its lineage
    is cut, so a lost executor re-reads the checkpoint instead of re-running
    every join.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def build_final_dataset(tables: Mapping[str, DataFrame], **kwargs) -> tuple[DataFrame, DataFrame]:
    """Merged trips with features (ids kept) and the encoded model matrix."""
    full = engineer_features(materialize(build_trips(tables, **kwargs)))
    return full, model_matrix(full)


# Name and version of the published trip feature table.
FEATURE_GROUP_NAME = "truck_trip_features"
FEATURE_GROUP_VERSION = 1


def publish_features(full: DataFrame, root: str | None = None, *, name: str = FEATURE_GROUP_NAME,
                     version: int = FEATURE_GROUP_VERSION, keys: Sequence[str] = TRIP_KEYS):
    """Append the engineered trips as the next batch of the versioned feature table.

    Primary key: the trip keys; event time: departure. Returns (table, batch id).
    """
    from haulstat.sources.feature_store import default_root, get_or_create
    group = get_or_create(root or default_root(full.sparkSession), name, version, list(keys),
                          event_time="departure_date")
    return group, group.insert(full)


def new_trip_frame(trips: DataFrame) -> DataFrame:
    """Schedule rows without a label, as scoring receives them."""
    return trips.select(*[c for c in trips.columns if c != "delay"])
