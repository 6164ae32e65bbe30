"""Binding of the domain roles (trips, readings, routes, ...) onto the test tables.

Every role is a lazy DataFrame derived from the parquet tables, so the work of
each query grows with the scale factor. ``SQL`` holds the same derivations as
DuckDB SQL; the oracle queries are written on top of those CTEs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulstat.functions.columns import round_whole

# The ten weather metrics of a reading, in source order.
WEATHER_COLS = ["temp", "wind_speed", "precip", "humidity", "visibility",
                "pressure", "chanceofrain", "chanceoffog", "chanceofsnow", "chanceofthunder"]
# Metrics that carry no signal in the source data and are dropped.
ZERO_SIGNAL_COLUMNS = [
    "chanceofrain", "chanceoffog", "chanceofsnow", "chanceofthunder",
    "origin_chanceofrain", "origin_chanceoffog", "origin_chanceofsnow", "origin_chanceofthunder",
    "destination_chanceofrain", "destination_chanceoffog", "destination_chanceofsnow",
    "destination_chanceofthunder",
]
# Identifier and time columns kept for joins, dropped from the model matrix.
ID_COLUMNS = ["truck_id", "route_id", "driver_id", "name",
              "origin_id", "destination_id", "departure_date", "estimated_arrival"]
# Categorical inputs that are one-hot encoded.
CATEGORICAL_COLUMNS = ["gender", "driving_style", "fuel_type"]
TRIP_KEYS = ["truck_id", "route_id", "departure_date"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the trip schedule with its label."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
            .select(F.col("o_orderkey").alias("trip_id"),
                    F.col("o_custkey").alias("truck_id"),
                    F.col("c_nationkey").alias("route_id"),
                    F.col("o_orderdate").alias("departure_date"),
                    (F.col("o_orderdate")
                     + F.make_dt_interval(F.lit(1) + F.col("o_orderkey") % 3)).alias("estimated_arrival"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("delay")))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-route reading series: traffic and weather columns from line items.

    Metrics are integer-valued so sums are exact and means are bit-identical
    whatever the summation order (the oracle comparison depends on it).
    """
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(s, li["l_suppkey"] == s["s_suppkey"], "inner")
            .select(F.col("s_nationkey").alias("route_id"),
                    F.col("l_shipdate").alias("ts"),
                    F.col("l_quantity").alias("no_of_vehicles"),
                    (F.col("l_returnflag") == "R").cast("int").alias("accident"),
                    F.col("l_quantity").alias("temp"),
                    (F.col("l_partkey") % 30).cast("double").alias("wind_speed"),
                    round_whole(F.col("l_discount") * 100).alias("precip"),
                    round_whole(F.col("l_tax") * 100).alias("humidity"),
                    F.col("l_linenumber").cast("double").alias("visibility"),
                    (F.col("l_suppkey") % 50 + 990).cast("double").alias("pressure"),
                    F.lit(0.0).alias("chanceofrain"), F.lit(0.0).alias("chanceoffog"),
                    F.lit(0.0).alias("chanceofsnow"), F.lit(0.0).alias("chanceofthunder")))


def city_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per (city, day): the day's mean of every weather metric."""
    r = readings(spark, sf_dir)
    return (r.groupBy(F.col("route_id").alias("city_id"), F.col("ts"))
            .agg(*[F.avg(c).alias(c) for c in WEATHER_COLS]))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner")
            .select(F.col("n_nationkey").alias("route_id"),
                    F.col("n_nationkey").alias("origin_id"),
                    ((F.col("n_nationkey") + 7) % 25).alias("destination_id"),
                    ((F.col("n_nationkey") + 1) * 10).cast("double").alias("distance"),
                    ((F.col("r_regionkey") + 1) * 6).cast("double").alias("average_hours")))


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("vehicle_no"),
                    F.col("c_custkey").alias("driver_id"),
                    F.col("c_name").alias("name"),
                    F.when(F.col("c_custkey") % 3 == 0, "female").otherwise("male").alias("gender"),
                    F.col("c_mktsegment").alias("driving_style"),
                    F.col("c_acctbal").alias("ratings"))


def trucks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("truck_id"),
                    F.col("c_nationkey").cast("double").alias("truck_age"),
                    F.abs(F.col("c_acctbal")).alias("load_capacity_pounds"),
                    F.when(F.col("c_acctbal") >= 0, "diesel").otherwise("gas").alias("fuel_type"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score per trip for the metric queries, a distinct one for each: (o_orderkey * 7919 % 1000003) / 1000003."""
    t = trips(spark, sf_dir)
    return t.select("trip_id", "truck_id", "route_id", "departure_date", "delay",
                    ((F.col("trip_id") * 7919 % 1000003).cast("double") / 1000003).alias("probability"))


# DuckDB twins of the bindings above (CTE bodies).
SQL = {
    "trips": """
        SELECT o.o_orderkey AS trip_id, o.o_custkey AS truck_id, c.c_nationkey AS route_id,
               o.o_orderdate AS departure_date,
               o.o_orderdate + to_days(CAST(1 + o.o_orderkey % 3 AS INTEGER)) AS estimated_arrival,
               CAST(o.o_orderstatus = 'F' AS INTEGER) AS delay
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "readings": """
        SELECT s.s_nationkey AS route_id, l.l_shipdate AS ts, l.l_quantity AS no_of_vehicles,
               CAST(l.l_returnflag = 'R' AS INTEGER) AS accident,
               l.l_quantity AS temp, CAST(l.l_partkey % 30 AS DOUBLE) AS wind_speed,
               round(l.l_discount * 100) AS precip, round(l.l_tax * 100) AS humidity,
               CAST(l.l_linenumber AS DOUBLE) AS visibility,
               CAST(l.l_suppkey % 50 + 990 AS DOUBLE) AS pressure,
               0.0::DOUBLE AS chanceofrain, 0.0::DOUBLE AS chanceoffog,
               0.0::DOUBLE AS chanceofsnow, 0.0::DOUBLE AS chanceofthunder
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "city_series": """
        SELECT route_id AS city_id, ts, avg(temp) AS temp, avg(wind_speed) AS wind_speed,
               avg(precip) AS precip, avg(humidity) AS humidity, avg(visibility) AS visibility,
               avg(pressure) AS pressure, avg(chanceofrain) AS chanceofrain,
               avg(chanceoffog) AS chanceoffog, avg(chanceofsnow) AS chanceofsnow,
               avg(chanceofthunder) AS chanceofthunder
        FROM readings GROUP BY route_id, ts""",
    "routes": """
        SELECT n.n_nationkey AS route_id, n.n_nationkey AS origin_id,
               (n.n_nationkey + 7) % 25 AS destination_id,
               CAST((n.n_nationkey + 1) * 10 AS DOUBLE) AS distance,
               CAST((r.r_regionkey + 1) * 6 AS DOUBLE) AS average_hours
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "drivers": """
        SELECT c_custkey AS vehicle_no, c_custkey AS driver_id, c_name AS name,
               CASE WHEN c_custkey % 3 = 0 THEN 'female' ELSE 'male' END AS gender,
               c_mktsegment AS driving_style, c_acctbal AS ratings
        FROM customer""",
    "trucks": """
        SELECT c_custkey AS truck_id, CAST(c_nationkey AS DOUBLE) AS truck_age,
               abs(c_acctbal) AS load_capacity_pounds,
               CASE WHEN c_acctbal >= 0 THEN 'diesel' ELSE 'gas' END AS fuel_type
        FROM customer""",
    "scores": """
        SELECT trip_id, truck_id, route_id, departure_date, delay,
               CAST(trip_id * 7919 % 1000003 AS DOUBLE) / 1000003 AS probability
        FROM trips""",
}


def with_ctes(*names: str, extra: list[tuple[str, str]] | tuple = ()) -> str:
    """``WITH`` clause defining the named bindings (dependencies first), then ``extra``."""
    deps = {"city_series": ["readings"], "scores": ["trips"]}
    order: list[str] = []
    for n in names:
        for d in deps.get(n, []):
            if d not in order:
                order.append(d)
        if n not in order:
            order.append(n)
    parts = [f"{n} AS ({SQL[n]})" for n in order] + [f"{n} AS ({body})" for n, body in extra]
    return "WITH " + ",\n".join(parts) + "\n"
