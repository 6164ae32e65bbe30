"""The raw tables as files: written with a header from the test tables, and read back by the library's own loaders.

The files hold what raw files hold: missing values as ``NA`` or nothing, clock hours, times as text, ids as
text. They lie in the shared folder, once per table, session and input files: a table's files are written
when they are first asked for, so reading one table does not write the other six.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulstat.plans import bindings as B
from haulstat.sources.sinks import write_csv
from haulstat.sources.snapshots import kept_folder
from haulstat.sources.tables import FILE_NAMES, paths_under


def _time(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def raw_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The seven raw tables with their files' columns, on the test tables."""
    key = F.col("vehicle_no")
    readings = B.readings(spark, sf)
    metrics = [F.col(c) for c in B.WEATHER_COLS]
    return {
        "drivers": B.drivers(spark, sf).select(
            "driver_id", "name", F.when(key % 7 == 0, "NA").otherwise(F.col("gender")).alias("gender"),
            (key % 40 + 20).alias("age"), (key % 15).alias("experience"),
            F.when(key % 11 != 0, F.col("driving_style")).alias("driving_style"), "ratings", "vehicle_no",
            (key % 30 + 40).alias("average_speed_mph")),
        "trucks": B.trucks(spark, sf).select(
            "truck_id", "truck_age", F.when(F.col("truck_id") % 17 != 0, F.col("load_capacity_pounds")).alias("load_capacity_pounds"),
            (F.col("truck_id") % 20 + 5).alias("mileage_mpg"),
            F.when(F.col("truck_id") % 13 == 0, "NA").otherwise(F.col("fuel_type")).alias("fuel_type")),
        "routes": B.routes(spark, sf),
        "traffic": readings.select(
            "route_id", F.date_format("ts", "yyyy-MM-dd").alias("date"), (F.col("visibility").cast("int") * 100).alias("hour"),
            F.when(F.col("wind_speed") != 7, F.col("no_of_vehicles")).alias("no_of_vehicles"), "accident"),
        "truck_schedule": B.trips(spark, sf).select(
            "truck_id", "route_id", _time("departure_date").alias("departure_date"),
            _time("estimated_arrival").alias("estimated_arrival"), "delay"),
        "city_weather": B.city_series(spark, sf).select(
            "city_id", F.date_format("ts", "yyyy-MM-dd").alias("date"), ((F.col("city_id") % 24) * 100).alias("hour"), *metrics),
        "routes_weather": readings.select("route_id", _time("ts").alias("Date"), *metrics),
    }


def raw_file(spark: SparkSession, sf: str, inputs: Mapping[str, str], name: str) -> str:
    """Path of one raw table's CSV files."""
    return paths_under(kept_folder(spark, f"raw-{name}", inputs, "raw",
                                   lambda path: write_csv(raw_tables(spark, sf)[name], paths_under(path)[name])))[name]


def raw_files(spark: SparkSession, sf: str, inputs: Mapping[str, str]) -> dict[str, str]:
    """Paths of the seven raw tables' CSV files by table name."""
    return {name: raw_file(spark, sf, inputs, name) for name in FILE_NAMES}


#: Per cleaned table what it is counted by and, if any, the number that is added up.
MEASURES = {"drivers": [("gender", None), ("driving_style", None)],
            "trucks": [("fuel_type", "load_capacity_pounds")],
            "routes": [("route_id", "distance")],
            "traffic": [("route_id", "no_of_vehicles"), ("hour", "accident")],
            "city_weather": [("city_id", "pressure"), ("hour", "temp")],
            "routes_weather": [("route_id", "temp")]}


def measured(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and totals of every table by its categories: table_name, measure, value, n_rows, total."""
    out = None
    for name, measures in MEASURES.items():
        for by, add in measures:
            total = F.sum(F.col(add).cast("double")) if add else F.lit(None).cast("double")
            part = tables[name].groupBy(F.col(by).cast("string").alias("value")).agg(
                F.count(F.lit(1)).alias("n_rows"), total.alias("total")).select(
                F.lit(name).alias("table_name"), F.lit(by).alias("measure"), "value", "n_rows", "total")
            out = part if out is None else out.unionByName(part)
    return out
