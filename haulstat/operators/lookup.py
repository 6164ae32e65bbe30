"""Equi lookups of dimension rows onto fact rows.

Dimension joins are plain left joins; the physical strategy is left to the
optimizer. With adaptive execution on, a dimension whose shuffle output is
measured under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` becomes a
broadcast at run time, and a large one stays a sort-merge join, so no size is
assumed here. Keys compare with SQL equality: null keys never match.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, dim: DataFrame, on: str | Sequence[str], *,
           rename: Mapping[str, str] | None = None, how: str = "left") -> DataFrame:
    """Attach ``dim`` columns to ``left`` by key; ``rename`` maps dim names to left names first."""
    if rename:
        for old, new in rename.items():
            dim = dim.withColumnRenamed(old, new)
    keys = [on] if isinstance(on, str) else list(on)
    overlap = [c for c in dim.columns if c in left.columns and c not in keys]
    if overlap:
        raise ValueError(f"lookup would duplicate columns {overlap}")
    return left.join(dim, keys, how)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on several equally named keys (e.g. predictions with actual outcomes)."""
    return left.join(right, list(keys), how)


def key_is_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-row check: number of keys that appear more than once (0 means a safe lookup)."""
    return (dim.groupBy(*keys).count().where(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("duplicate_keys")))
