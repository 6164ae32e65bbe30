"""Nearest as-of join: attach to each left row the reading of the same key closest in time.

Semantics (nearest, no tolerance by default):

* backward candidate = the reading at or before the left time; among readings
  with the same time the one with the largest ``tie`` value;
* forward candidate = the first reading strictly after the left time (smallest
  ``tie`` among equal times); an exact match is always found backward;
* the backward candidate wins when its gap is not larger than the forward gap;
* the chosen reading's payload is attached as is, nulls included;
* left rows with a null key or null time are kept with a null payload.

Plan shape. The answer depends on key and time alone, so only these are
matched, each (key, time) once; the left rows are joined to the answers at the end, in a join
that Spark may split at a hot key.

1. Both sides are reduced to one row per (key, time): the readings' last and first
   payload by ``tie``, and whether a left row asks for it. This is partial before the
   shuffle, so any number of equal times of a hub are one row of each task.
2. (key, time) is cut into buckets by literals from a bounded sample of both sides (see
   ``order``): a hot key gets as many cuts as it has rows for, down to single times,
   while many cold keys share one bucket. No width has to fit all keys.
3. Inside (key, bucket) one sort by time serves both directions: the last reading up to
   a row, and the next one after it.
4. Each (key, bucket) is reduced to its first and last reading; over these few rows of a
   key the same two windows give what lies in earlier and in later buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulstat.operators.order import bucket_of, buckets_for, cut_points

ORDER = ["__k", "__t"]


def _keyed(df: DataFrame, by: str, on: str, *more: Column, key_type=None) -> DataFrame:
    key = F.col(by) if key_type is None else F.col(by).cast(key_type)
    return df.where(F.col(by).isNotNull() & F.col(on).isNotNull()).select(key.alias("__k"), F.col(on).alias("__t"), *more)


def asof_cuts(sides: Sequence[tuple[DataFrame, str, str]], num_buckets: int | None = None) -> list[Column]:
    """Cut points of (key, time) over all ``sides`` (table, key column, time column); the first side's key type counts."""
    kind = sides[0][0].schema[sides[0][1]].dataType
    rows = None
    for df, by, on in sides:
        part = _keyed(df, by, on, key_type=kind)
        rows = part if rows is None else rows.unionByName(part)
    return cut_points(rows, ORDER, buckets_for(rows, num_buckets))


def asof_matches(left: DataFrame, right: DataFrame, *, left_by: str, right_by: str, left_on: str, right_on: str,
                 payload: Sequence[str], tie: str | None = None, tolerance_us: int | None = None,
                 num_buckets: int | None = None, cuts: Sequence[Column] | None = None) -> DataFrame:
    """``__k``, ``__t`` of every (key, time) that ``left`` asks for, and ``__p``, the nearest reading's payload (struct or null)."""
    kind = left.schema[left_by].dataType
    if cuts is None:
        cuts = asof_cuts([(left, left_by, left_on), (right, right_by, right_on)], num_buckets)
    held = F.struct(*[F.col(c) for c in payload])
    r = _keyed(right, right_by, right_on, (F.col(tie) if tie else held).alias("__tie"), held.alias("__p"),
               F.lit(False).alias("__asked"), key_type=kind)
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in r.schema.fields}
    asked = _keyed(left, left_by, left_on, none["__tie"], none["__p"], F.lit(True).alias("__asked"))
    at = r.unionByName(asked).withColumn("__b", bucket_of(ORDER, cuts))
    reading = ~F.col("__asked")  # the aggregates below skip the rows that only ask
    ordered = F.when(reading, F.struct("__tie", "__p"))
    one = at.groupBy("__k", "__b", "__t").agg(
        F.max_by("__p", ordered).alias("__last"), F.min_by("__p", ordered).alias("__first"),
        F.count_if(reading).alias("__n"), F.max("__asked").alias("__asked"))
    there = F.col("__n") > 0
    one = one.select("__k", "__b", "__t", "__asked",
                     F.when(there, F.struct(F.col("__t").alias("t"), F.col("__last").alias("p"))).alias("__last"),
                     F.when(there, F.struct(F.col("__t").alias("t"), F.col("__first").alias("p"))).alias("__first"))

    near = Window.partitionBy("__k", "__b").orderBy("__t")
    upto = near.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = one.select("__k", "__b", "__t", "__asked", "__last", "__first",
                      F.last("__last", ignorenulls=True).over(upto).alias("__back"),
                      F.expr("lead(__first, 1) IGNORE NULLS OVER (PARTITION BY __k, __b ORDER BY __t)").alias("__next"))

    # what lies in other buckets of the key: one row per (key, bucket)
    ends = one.groupBy("__k", "__b").agg(
        F.max_by("__last", F.when(F.col("__last").isNotNull(), F.col("__t"))).alias("l"),
        F.min_by("__first", F.when(F.col("__first").isNotNull(), F.col("__t"))).alias("f"),
        F.max("__asked").alias("__ask"))
    over = "OVER (PARTITION BY __k ORDER BY __b)"
    carry = (ends.select("__k", "__b", "__ask", F.expr(f"lag(l, 1) IGNORE NULLS {over}").alias("__cb"),
                         F.expr(f"lead(f, 1) IGNORE NULLS {over}").alias("__cf")).where("__ask").drop("__ask"))
    joined = fine.where("__asked").join(carry, ["__k", "__b"], "left")
    back, after = F.coalesce("__back", "__cb"), F.coalesce("__next", "__cf")
    gap = {n: F.abs(F.timestamp_diff("MICROSECOND", x["t"], F.col("__t"))) for n, x in (("b", back), ("f", after))}
    chosen = F.when(back.isNull(), after).when(after.isNull() | (gap["b"] <= gap["f"]), back).otherwise(after)
    out = joined.select("__k", "__t", chosen.alias("__c"))
    if tolerance_us is not None:
        off = F.abs(F.timestamp_diff("MICROSECOND", F.col("__c.t"), F.col("__t")))
        out = out.withColumn("__c", F.when(off <= F.lit(tolerance_us), F.col("__c")))
    return out.select("__k", "__t", F.col("__c.p").alias("__p"))


def attach_matches(left: DataFrame, matches: DataFrame, *, left_by: str, left_on: str, payload: Sequence[str],
                   prefix: str = "") -> DataFrame:
    """``left`` with ``prefix + payload`` columns of its (key, time)'s match; every row stays, once."""
    clash = [prefix + c for c in payload if prefix + c in left.columns]
    if clash:
        raise ValueError(f"as-of output columns already on the left: {clash}")
    found = left.join(matches, (left[left_by] == matches["__k"]) & (left[left_on] == matches["__t"]), "left")
    return found.select(*[left[c] for c in left.columns], *[F.col("__p").getField(c).alias(prefix + c) for c in payload])


def asof_nearest(left: DataFrame, right: DataFrame, *, left_by: str, right_by: str,
                 left_on: str, right_on: str, payload: Sequence[str], prefix: str = "",
                 tie: str | None = None, tolerance_us: int | None = None,
                 num_buckets: int | None = None) -> DataFrame:
    """Left rows with ``prefix + payload`` columns from the nearest right row.

    ``tie`` orders right rows that share a time (defaults to the payload
    itself, so the choice never depends on row order). ``tolerance_us`` drops
    a match farther than that many microseconds. ``num_buckets`` (by default the
    number of shuffle partitions) only changes task sizes.
    """
    payload = list(payload)
    matches = asof_matches(left, right, left_by=left_by, right_by=right_by, left_on=left_on, right_on=right_on,
                           payload=payload, tie=tie, tolerance_us=tolerance_us, num_buckets=num_buckets)
    return attach_matches(left, matches, left_by=left_by, left_on=left_on, payload=payload, prefix=prefix)
