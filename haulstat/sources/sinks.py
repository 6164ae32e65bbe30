"""Sinks: CSV reports and the partitioned final feature dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small report (e.g. feature importances) as header CSV."""
    df.write.mode(mode).option("header", True).csv(path)


def write_features(df: DataFrame, path: str, ts: str = "departure_date", mode: str = "overwrite",
                   max_records_per_file: int = 5_000_000) -> None:
    """The final feature dataset as Parquet partitioned by departure day (prunable by date).

    Rows are dealt by (day, salt), with as many salts as a day has files'
    worth of rows: a day writes about rows / ``max_records_per_file`` files, and a
    day with a large share of the rows is spread over that many tasks.
    """
    dated = df.withColumn("departure_day", F.to_date(F.col(ts)))
    salts = dated.groupBy("departure_day").agg(
        F.ceil(F.count(F.lit(1)) / max_records_per_file).cast("int").alias("__salts"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.coalesce("__salts", F.lit(1)))
    dealt = (dated.join(F.broadcast(salts), dated["departure_day"].eqNullSafe(salts["departure_day"]), "left")  # a row a day
             .select(dated["*"], salt.alias("__salt")).repartition("departure_day", "__salt").drop("__salt"))
    (dealt
       .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
       .partitionBy("departure_day").parquet(path))
