"""Raw table loading: explicit schemas, missing-value tokens and the load-time fixes.

CSV is read with a declared schema (no inference pass over the data) in
PERMISSIVE mode; a value that does not fit its column becomes null and the
raw line is kept in ``_corrupt_record`` when ``keep_corrupt=True``. Integer
columns are read as doubles and cast if whole, because integers with gaps are
written as ``1.0``. ``parse_lines`` reads lines of text that are already in a
DataFrame in the same way.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulstat.functions.columns import (
    coerce_timestamp,
    nan_to_null,
    normalize_hour,
    null_token,
    reading_timestamp,
    strict_timestamp,
    whole_number,
)

_W = ("temp double, wind_speed double, precip double, humidity double, visibility double, "
      "pressure double, chanceofrain double, chanceoffog double, chanceofsnow double, "
      "chanceofthunder double")

# Column layout of each raw table (header names as in the files).
SCHEMAS = {
    "drivers": ("driver_id string, name string, gender string, age double, experience double, "
                "driving_style string, ratings double, vehicle_no string, average_speed_mph double"),
    "trucks": "truck_id string, truck_age double, load_capacity_pounds double, mileage_mpg double, fuel_type string",
    "routes": "route_id string, origin_id string, destination_id string, distance double, average_hours double",
    "traffic": "route_id string, date string, hour int, no_of_vehicles double, accident int",
    "truck_schedule": "truck_id string, route_id string, departure_date string, estimated_arrival string, delay int",
    "city_weather": f"city_id string, date string, hour int, {_W}",
    "routes_weather": f"route_id string, Date string, {_W}",
}

# File name of each raw table.
FILE_NAMES = {
    "drivers": "drivers_table.csv",
    "trucks": "trucks_table.csv",
    "routes": "routes_table.csv",
    "traffic": "traffic_table.csv",
    "truck_schedule": "truck_schedule_table.csv",
    "city_weather": "city_weather.csv",
    "routes_weather": "routes_weather.csv",
}


def paths_under(root: str) -> dict[str, str]:
    return {name: os.path.join(root, f) for name, f in FILE_NAMES.items()}


def read_csv(spark: SparkSession, path: str, schema: str, keep_corrupt: bool = False) -> DataFrame:
    """Header CSV with a declared schema; text tokens for missing values become null."""
    ddl = _read_as(f"{schema}, _corrupt_record string" if keep_corrupt else schema)
    reader = (spark.read.schema(ddl).option("header", True).option("mode", "PERMISSIVE")
              .option("nanValue", "NaN"))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
    return _typed(reader.csv(path), schema)


def _read_as(schema: str) -> T.StructType:
    """``schema`` with integer columns as doubles."""
    declared = T.StructType.fromDDL(schema)
    return T.StructType([T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.IntegerType) else f.dataType)
                         for f in declared.fields])


def _typed(df: DataFrame, schema: str) -> DataFrame:
    """Missing-value tokens to null, doubles that stand for integers to INT."""
    fixes = {}
    for f in T.StructType.fromDDL(schema).fields:
        if f.name == "_corrupt_record":
            continue
        if isinstance(f.dataType, T.StringType):
            fixes[f.name] = null_token(f.name)
        elif isinstance(f.dataType, T.IntegerType):
            fixes[f.name] = whole_number(nan_to_null(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            fixes[f.name] = nan_to_null(f.name)
    return df.withColumns(fixes) if fixes else df


def parse_lines(lines: DataFrame, name: str, line: str = "line") -> DataFrame:
    """Lines of text of raw table ``name`` (no header) parsed as ``read_csv`` parses files, fixes not yet applied."""
    record = F.from_csv(F.col(line), _read_as(SCHEMAS[name]).simpleString()[len("struct<"):-1].replace(":", " "),
                        {"mode": "PERMISSIVE", "nanValue": "NaN"})
    return _typed(lines.select(record.alias("__r")).select("__r.*"), SCHEMAS[name])


def _fix(name: str, df: DataFrame) -> DataFrame:
    if name == "traffic":
        df = df.withColumns({"date": coerce_timestamp("date"), "hour": normalize_hour("hour")})
        return df.withColumn("timestamp", reading_timestamp("date", "hour"))
    if name == "truck_schedule":
        return df.withColumns({"departure_date": strict_timestamp("departure_date"),
                               "estimated_arrival": strict_timestamp("estimated_arrival")})
    if name == "city_weather":
        df = df.withColumns({"date": strict_timestamp("date"), "hour": normalize_hour("hour")})
        return df.withColumn("timestamp", reading_timestamp("date", "hour"))
    if name == "routes_weather":
        return df.withColumnRenamed("Date", "date").withColumn("date", strict_timestamp("date"))
    return df


def load_table(spark: SparkSession, name: str, path: str, keep_corrupt: bool = False) -> DataFrame:
    """One raw table with its load-time fixes (timestamps parsed, hours normalised)."""
    return _fix(name, read_csv(spark, path, SCHEMAS[name], keep_corrupt))


def load_all(spark: SparkSession, paths: Mapping[str, str] | str) -> dict[str, DataFrame]:
    """Every raw table as a lazy DataFrame; ``paths`` is a root directory or name -> path."""
    if isinstance(paths, str):
        paths = paths_under(paths)
    return {name: load_table(spark, name, path) for name, path in paths.items()}


def fixed_frame(df: DataFrame, name: str) -> DataFrame:
    """Apply the load-time fixes of ``name`` to an already-read frame (e.g. from JDBC)."""
    return _fix(name, df)


#: Columns that a raw table's fixes read leniently: a text that cannot be read becomes null.
LENIENT = {"traffic": ("date",)}
UNREADABLE = "unreadable_line"


def load_lines(lines: DataFrame, name: str, path: str, line: str = "line") -> dict[str, int]:
    """Raw lines of table ``name`` parsed, fixed and written to ``path`` in one pass; the pass's quality counts.

    ``rows``, ``null:column`` and ``unread:column`` (a text that a lenient column could not read). A line with such
    a text keeps its row, as the fixes have it, and is quarantined beside it in the column ``unreadable_line``.
    """
    record = F.from_csv(F.col(line), _read_as(SCHEMAS[name]).simpleString()[len("struct<"):-1].replace(":", " "),
                        {"mode": "PERMISSIVE", "nanValue": "NaN"})
    raw = _typed(lines.select(F.col(line).alias("__line"), record.alias("__r")).select("__line", "__r.*"), SCHEMAS[name])
    texts = {c: f"__text_{c}" for c in LENIENT.get(name, ())}
    fixed = _fix(name, raw.withColumns({t: F.col(c) for c, t in texts.items()}))
    unread = {c: F.col(t).isNotNull() & F.col(c).isNull() for c, t in texts.items()}
    bad = F.lit(False)
    for v in unread.values():
        bad = bad | v
    flags = {f"__unread_{c}": v for c, v in unread.items()}
    out = fixed.withColumns(flags | {UNREADABLE: F.when(bad, F.col("__line"))})
    kept = [c for c in out.columns if not c.startswith("__")]
    seen = Observation()
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in kept if c != UNREADABLE]
    counts = [F.count_if(F.col(f"__unread_{c}")).alias(f"unread:{c}") for c in unread]
    out.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls, *counts).select(*kept).write.parquet(path)
    return {k: int(v or 0) for k, v in seen.get.items()}


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a loaded table that could not be read whole."""
    return spark.read.parquet(path).where(F.col(UNREADABLE).isNotNull()).select(UNREADABLE)


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: name, rows, columns (one count job per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
