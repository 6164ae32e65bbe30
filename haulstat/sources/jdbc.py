"""Relational sources over JDBC: whole-table reads, optionally split into parallel ranges.

Connection options (url, user, password, driver) come from the caller; nothing
is read from the environment here. With ``partition_column`` and bounds the
read is split into ``num_partitions`` range queries run by the executors, so a
large table is not pulled through one connection.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from haulstat.sources.tables import fixed_frame

# Friendly table name -> (database, source table name).
SOURCE_TABLES = {
    "drivers": ("mysql", "drivers_details"),
    "trucks": ("mysql", "truck_details"),
    "traffic": ("mysql", "traffic_details"),
    "truck_schedule": ("mysql", "truck_schedule_data"),
    "city_weather": ("mysql", "city_weather"),
    "routes": ("postgres", "routes_details"),
    "routes_weather": ("postgres", "routes_weather"),
}


def jdbc_options(options: Mapping[str, str], table: str, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    opts = dict(options)
    opts["dbtable"] = table
    opts.setdefault("fetchsize", str(fetch_size))
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_table(spark: SparkSession, options: Mapping[str, str], table: str, **kwargs) -> DataFrame:
    """A whole table over JDBC (``kwargs`` as in ``jdbc_options``)."""
    return spark.read.format("jdbc").options(**jdbc_options(options, table, **kwargs)).load()


LARGE = ("traffic", "city_weather", "routes_weather")


def load_all_from_jdbc(spark: SparkSession, databases: Mapping[str, Mapping[str, str]],
                       partitioning: Mapping[str, dict] | None = None) -> dict[str, DataFrame]:
    """The same catalog as ``tables.load_all`` read from two databases, with the same fixes.

    ``databases`` maps "mysql" / "postgres" to connection options;
    ``partitioning`` maps a friendly name to ``jdbc_options`` kwargs; the tables
    in ``LARGE`` must have it, or each would come through one connection and task.
    """
    partitioning = partitioning or {}
    missing = [n for n in LARGE if not partitioning.get(n, {}).get("partition_column")]
    if missing:
        raise ValueError(f"give a partition_column for {missing}")
    out = {}
    for name, (db, source) in SOURCE_TABLES.items():
        df = read_table(spark, databases[db], source, **partitioning.get(name, {}))
        out[name] = fixed_frame(df, name)
    return out
