"""Null filling: mode, median, per-group median with fallback, constants, key means.

Fitted fill values are one-row aggregates used as scalar subqueries
(``DataFrame.scalar()``): Spark runs the aggregate once, merges subqueries over
the same input into one scan, and hands the value to every task, so the fact
table is never shuffled or joined for a global statistic. Per-group statistics
are a grouped aggregate joined back on the group key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulstat.operators.order import exact_quantiles
from haulstat.sources.snapshots import stored


def mode_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the most frequent non-null value of each column; ties go to the smallest."""
    return df.agg(*[F.mode(c, deterministic=True).alias(c) for c in cols])


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls with the column's mode (an all-null column stays null)."""
    fills = {c: mode_values(df, [c]).scalar() for c in cols}
    return df.withColumns({c: F.coalesce(F.col(c), fills[c]) for c in cols})


def median_values(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """One row: exact median of each column, or ``percentile_approx`` when ``accuracy`` is set."""
    if accuracy is not None:
        return df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in cols])
    cols = list(cols)
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                                           for c in cols])).alias("v")).select("v.*")
    got = exact_quantiles(values, ["column"], "x", [0.5])
    return got.agg(*[F.max(F.when(F.col("column") == c, F.col("qs")[0])).alias(c) for c in cols])


def fill_median(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Fill nulls with the column's median over the non-null values."""
    fills = {c: median_values(df, [c], accuracy).scalar() for c in cols}
    return df.withColumns({c: F.coalesce(F.col(c), fills[c]) for c in cols})


def fill_group_median(df: DataFrame, col: str, by: str, accuracy: int | None = None) -> DataFrame:
    """Fill nulls with the median of the row's group, then with the median of the filled column.

    The fallback median is taken after the group fill, over rows with a
    non-null group key, as the group fill is. Rows with a null key keep their
    own value; when it is null they take the fallback.

    The group medians and the groups' null counts are stored once (one row per
    group); the filled column is the known values plus, per group, its median as often as it has nulls.
    """
    known = df.where(F.col(by).isNotNull()).select(F.col(by).alias("__g"), F.col(col).cast("double").alias("__x"))
    if accuracy is None:
        medians = exact_quantiles(known, ["__g"], "__x", [0.5]).select("__g", F.col("qs")[0].alias("__gm"))
    else:
        medians = known.groupBy("__g").agg(F.percentile_approx("__x", 0.5, accuracy).alias("__gm"))
    gaps = known.groupBy("__g").agg(F.count_if(F.col("__x").isNull()).alias("__c"))
    groups = stored(gaps.join(medians, "__g"), "group-medians")
    filled = known.where(F.col("__x").isNotNull()).select("__x", F.lit(1).cast("long").alias("__c")).unionByName(
        groups.where("__c > 0").select(F.col("__gm").alias("__x"), "__c"))
    fallback = exact_quantiles(filled, [], "__x", [0.5], weight="__c").select(F.col("qs")[0]).scalar()
    return (df.join(groups.drop("__c"), F.col(by) == F.col("__g"), "left")
            .withColumn(col, F.coalesce(F.col(col), F.col("__gm"), fallback)).select(*df.columns))


def remaining_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: total number of null cells over the given columns (all by default)."""
    cols = list(cols or df.columns)
    total = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0).cast("long"))
    return df.agg(total.cast("long").alias("remaining_nulls"))


def clean_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Apply the standard cleaning set: drivers and trucks by mode/median, traffic by route median."""
    out = dict(tables)
    if "drivers" in out:
        out["drivers"] = fill_mode(out["drivers"], ["gender", "driving_style"])
    if "trucks" in out:
        out["trucks"] = fill_median(fill_mode(out["trucks"], ["fuel_type"]), ["load_capacity_pounds"])
    if "traffic" in out:
        out["traffic"] = fill_group_median(out["traffic"], "no_of_vehicles", "route_id")
    return out
