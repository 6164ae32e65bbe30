"""Feature operators: column drops, data-derived thresholds, one-hot, alignment, scaling.

Fitted parameters (thresholds, categories, means, deviations) come from
single-row aggregates. They are used as scalar subqueries (evaluated once,
value shipped to every task) or returned to the driver as a handful of
scalars; no data row is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulstat.functions.columns import flag
from haulstat.operators.order import exact_quantiles


def drop_columns(df: DataFrame, cols: Sequence[str], *, strict: bool = True) -> DataFrame:
    """Drop columns by name; a missing name is an error unless ``strict=False``."""
    missing = [c for c in cols if c not in df.columns]
    if missing and strict:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*[c for c in cols if c in df.columns])


def quantile_value(df: DataFrame, col: str, q: float, accuracy: int | None = None) -> DataFrame:
    """One row, column ``threshold``: linear-interpolated quantile of the non-null values."""
    if accuracy is not None:
        return df.agg(F.percentile_approx(col, q, accuracy).alias("threshold"))
    values = df.select(F.col(col).cast("double").alias("x"))
    return exact_quantiles(values, [], "x", [q]).select(F.col("qs")[0].alias("threshold"))


def high_quantile_flag(df: DataFrame, col: str, out: str, q: float = 0.75,
                       threshold: float | None = None, accuracy: int | None = None) -> DataFrame:
    """``out`` = 1 when ``col`` is above the threshold (null counts as 0).

    Without ``threshold`` the q-quantile of ``df[col]`` is a scalar subquery
    over ``df``, so ``df`` is neither shuffled nor joined for it.
    """
    if threshold is not None:
        return df.withColumn(out, flag(F.col(col) > F.lit(threshold)))
    t = quantile_value(df, col, q, accuracy).scalar()
    return df.withColumn(out, flag(F.col(col) > t))


def fit_categories(df: DataFrame, cols: Sequence[str], max_levels: int | None = None) -> dict[str, list]:
    """Sorted distinct non-null values of each categorical column.

    A distinct aggregate (partial per task, then shuffled by value); string
    columns share one job over (column, value) pairs, other types get one job
    each. The levels become column names, so they are returned to the driver;
    ``max_levels`` (off by default) makes a column with more of them an error.
    """
    cols = list(cols)
    cats: dict[str, list] = {c: [] for c in cols}
    strings = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    if strings:
        pairs = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))
                                               for c in strings])).alias("p"))
                 .select("p.*").where(F.col("v").isNotNull()).distinct())
        for r in sorted(pairs.collect(), key=lambda r: r["v"]):
            cats[r["c"]].append(r["v"])
    for c in cols:
        if c not in strings:
            cats[c] = sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().collect())
    for c, values in cats.items():
        if max_levels is not None and len(values) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels; not a categorical column")
    return cats


def one_hot(df: DataFrame, cols: Sequence[str], categories: Mapping[str, Sequence[str]] | None = None,
            drop_first: bool = True) -> DataFrame:
    """Replace each column by 0/1 indicator columns ``{col}_{value}``.

    Levels are the fitted ``categories`` (sorted distinct values by default);
    with ``drop_first`` the first level is the baseline and gets no column.
    Null and unseen values give all zeros.
    """
    cats = dict(categories) if categories is not None else fit_categories(df, cols)
    keep = [c for c in df.columns if c not in cols]
    indicators = []
    for c in cols:
        levels = list(cats.get(c, []))
        for v in (levels[1:] if drop_first else levels):
            indicators.append(flag(F.col(c) == F.lit(v)).alias(f"{c}_{v}"))
    return df.select(*[F.col(k) for k in keep], *indicators)


def align_columns(df: DataFrame, expected: Sequence[str], fill_value=0) -> DataFrame:
    """Exactly the ``expected`` columns in that order; absent ones filled with a constant."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill_value).alias(c) for c in expected])


@dataclass
class Scaler:
    """Fitted standardisation: population mean and standard deviation per column."""

    columns: list[str]
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)

    def transform(self, df: DataFrame, fill_mean: bool = False) -> DataFrame:
        """Scaled columns; with ``fill_mean`` a null becomes the training mean (0 once scaled), as models need."""
        scaled = {}
        for c in self.columns:
            m = self.means[c]
            s = self.stds[c]
            s = 1.0 if (s is None or s == 0.0) else s
            x = (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
            scaled[c] = F.coalesce(x, F.lit(0.0)) if fill_mean else x
        return df.withColumns(scaled)


def scaler_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``{c}_mean`` and ``{c}_std`` (population) for each column."""
    exprs = []
    for c in cols:
        exprs.append(F.avg(F.col(c).cast("double")).alias(f"{c}_mean"))
        exprs.append(F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_std"))
    return df.agg(*exprs)


def standardize_with(df: DataFrame, fit_rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scale ``cols`` by the population mean / deviation of ``fit_rows`` (zero deviation acts as 1).

    All statistics are one aggregate row over ``fit_rows``, a single scalar subquery.
    """
    names = [f"{c}_{k}" for c in cols for k in ("mean", "std")]
    stats = scaler_stats(fit_rows, cols).select(F.struct(*names)).scalar()
    out = {}
    for c in cols:
        std = stats[f"{c}_std"]
        std = F.when(std.isNull() | (std == 0), F.lit(1.0)).otherwise(std)
        out[c] = (F.col(c).cast("double") - stats[f"{c}_mean"]) / std
    return df.withColumns(out)


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    row = scaler_stats(df, cols).first()
    return Scaler(list(cols), {c: row[f"{c}_mean"] for c in cols}, {c: row[f"{c}_std"] for c in cols})
