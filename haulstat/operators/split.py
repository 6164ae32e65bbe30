"""Time-ordered train/test split: the earliest ``int(n * (1 - test_size))`` rows train.

Only the boundary day needs a row-level order. Days before it are all train,
days after it all test; those rows are labelled from per-day counts (one row
per calendar day). The boundary day's rows get an exact distributed rank
(``ordered_rank``), so even a day holding a third of all rows is not one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulstat.operators.order import ordered_rank


def split_cutoff(n: int, test_size: float = 0.2) -> int:
    """Number of training rows, truncated as in ``int(n * (1 - test_size))``."""
    return int(n * (1 - test_size))


def time_split(df: DataFrame, ts: str, keys: Sequence[str], test_size: float = 0.2,
               out: str = "split") -> DataFrame:
    """``df`` plus ``out`` in {'train', 'test'}; ties in ``ts`` are ordered by ``keys``."""
    n = df.count()
    cutoff = split_cutoff(n, test_size)
    day = F.to_date(F.col(ts))
    days = (df.where(F.col(ts).isNotNull())
            .groupBy(day.alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
            .withColumn("__cum", F.sum("__n").over(
                Window.orderBy("__d").rowsBetween(Window.unboundedPreceding, 0))))
    boundary = days.where(F.col("__cum") >= cutoff).orderBy("__d").limit(1).first() if cutoff > 0 else None
    tagged = df.withColumn("__d", day)
    if cutoff <= 0:
        return tagged.withColumn(out, F.lit("test")).drop("__d")
    if boundary is None:
        # every timed row is train; rows without a time sort last, ordered by the keys
        timed = df.where(F.col(ts).isNotNull()).withColumn(out, F.lit("train"))
        missing = n - df.where(F.col(ts).isNotNull()).count()
        left = cutoff - (n - missing)
        untimed = ordered_rank(df.where(F.col(ts).isNull()), list(keys), out="__rk")
        untimed = untimed.withColumn(out, F.when(F.col("__rk") <= F.lit(left), "train")
                                     .otherwise("test")).drop("__rk")
        return timed.unionByName(untimed)
    bday = boundary["__d"]
    before = boundary["__cum"] - boundary["__n"]
    outside = (tagged.where(F.col("__d").isNull() | (F.col("__d") != F.lit(bday)))
               .withColumn(out, F.when(F.col("__d") < F.lit(bday), "train").otherwise("test")))
    inside = ordered_rank(tagged.where(F.col("__d") == F.lit(bday)), [ts, *keys], out="__rk")
    inside = (inside.withColumn(out, F.when(F.col("__rk") + F.lit(before) <= F.lit(cutoff), "train")
                                .otherwise("test")).drop("__rk"))
    return outside.unionByName(inside).drop("__d")


def split_periods(split: DataFrame, ts: str, out: str = "split") -> DataFrame:
    """Per split: first and last time and the number of rows (the printed train/test periods)."""
    return (split.groupBy(out)
            .agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("rows")))
