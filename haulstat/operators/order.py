"""Global order statistics without a single-task window.

``Window.orderBy(...)`` with no partition moves every row into one task. Here
rows are first dealt into buckets of the order: *cut points* are taken once
from a bounded hash sample of the sort key and put into the plan as literals,
so a row's bucket is a plain expression of its own values. Every branch of a
plan, every retry and every rerun therefore agrees on the buckets. Ranks and
prefix sums are then a total per bucket (one row each) plus a window inside
the bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulstat.sources.snapshots import stored

SAMPLE_PER_BUCKET = 100


def _literal(value, kind: T.DataType) -> Column:
    """``value`` as a literal of exactly ``kind`` (timestamps through text, so no time zone enters)."""
    if value is not None and isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        value = value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    return F.lit(value).cast(kind)


def cut_points(df: DataFrame, order: Sequence[str], buckets: int) -> list[Column]:
    """At most ``buckets - 1`` ascending literals (structs of ``order``) that split the rows about evenly.

    They come from the rows with the smallest hashes of the sort key, about
    ``SAMPLE_PER_BUCKET`` of them for each bucket: a bounded, repeatable sample.
    """
    n = df.count()
    if n == 0 or buckets < 2:
        return []
    keys = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    u = F.pmod(F.xxhash64(*keys.columns), F.lit(1 << 40))
    share = min(1.0, buckets * SAMPLE_PER_BUCKET / n)
    rows = (keys.where(u < F.lit(int(share * (1 << 40)))).distinct()
            .orderBy(*keys.columns).collect())
    kinds = [f.dataType for f in keys.schema.fields]
    picked = sorted({len(rows) * i // buckets for i in range(1, buckets)} - {0}) if rows else []
    return [F.struct(*[_literal(v, k).alias(f"k{i}") for i, (v, k) in enumerate(zip(rows[at], kinds))])
            for at in picked]


def bucket_of(order: Sequence[str], cuts: Sequence[Column]) -> Column:
    """Number of cut points that are not above the row's key: a comparison tree over the literals."""
    if not cuts:  # one bucket, yet a value of the row: a constant would turn joins on it into nested loops
        return F.pmod(F.hash(*order), F.lit(1))
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < cuts[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))


def buckets_for(df: DataFrame, num_buckets: int | None) -> int:
    return num_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ordered_rank(df: DataFrame, order: Sequence[str], out: str = "rank",
                 num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1-based position of each row in the ascending order of the columns ``order``.

    ``order`` must be a total order (append a unique key to break ties) for
    the rank to be deterministic; nulls come first.
    """
    cuts = cut_points(df, order, buckets_for(df, num_partitions))
    placed = df.withColumn("__b", bucket_of(order, cuts))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
               .select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")))
    inside = F.row_number().over(Window.partitionBy("__b").orderBy(*order))
    return (placed.withColumn("__r", inside).join(F.broadcast(offsets), "__b")  # one row per bucket
            .withColumn(out, (F.col("__off") + F.col("__r")).cast("long"))
            .drop("__b", "__off", "__r"))


SKETCH = 20_000  # accuracy of the quantile sketch: its ranks are off by at most a SKETCH-th of the rows
INF = float("inf")


def _ranks(n: Column, qs: Sequence[float]) -> list[Column]:
    """The two 0-based ranks between which each quantile lies."""
    pos = [F.lit(float(q)) * (n - 1) for q in qs]
    return [f(p).cast("long") for p in pos for f in (F.floor, F.ceil)]


def _interpolated(qs: Sequence[float]) -> Column:
    """The quantiles from ``n`` and the values ``__v0``, ``__v1`` ... at their ranks."""
    values = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("n") - 1)
        lo, hi = F.col(f"__v{2 * i}").cast("double"), F.col(f"__v{2 * i + 1}").cast("double")
        values.append(F.when(F.floor(pos) == F.ceil(pos), lo)
                      .otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi))
    return F.array(*values).alias("qs")


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, qs: Sequence[float],
                    num_buckets: int | None = None, weight: str | None = None, also: Sequence[Column] = ()) -> DataFrame:
    """Per group of ``by`` (columns): count ``n`` and ``qs``, the linear-interpolated quantiles of the non-null values.

    Two passes. The first is a mergeable sketch per group (partial per task); its
    brackets hold each wanted quantile for sure, as wide as the sketch may be off. The second
    counts exactly: rows below, between and above the brackets as one number each, rows inside a
    bracket (about four SKETCH-ths of the rows for each quantile) by their value. Ranks are running
    sums over these few rows, so neither a hot group nor a whole column is shuffled or meets in one task.

    ``also`` are further aggregates of a group's non-null values, named by alias, over the column ``__x`` (the value as
    a double): they are taken in the first pass and returned beside. They need ``by`` and no ``weight``.

    ``weight`` names a column that says how often a row counts; such tables are counts already
    and are dealt by value (see ``_weighted_quantiles``).
    """
    by = list(by)
    if also and (weight is not None or not by):
        raise ValueError("also needs by and no weight")
    if weight is not None:
        return _weighted_quantiles(df, by, value, qs, num_buckets, weight)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__x"))
    off = 2.0 / SKETCH
    probs = [min(max(p, 0.0), 1.0) for q in qs for p in (q - off, q + off)]
    sketch = rows.groupBy(*by).agg(F.percentile_approx("__x", probs, SKETCH).alias("__p"), *also)

    def on(*sides: str) -> Column:
        same = [F.col(f"{sides[0]}.{c}").eqNullSafe(F.col(f"{sides[1]}.{c}")) for c in by]
        return reduce(Column.__and__, same)

    if by:  # the brackets' ends as plain numbers, so that a row carries no array
        ends = [F.get("__p", F.lit(i)).alias(f"__p{i}") for i in range(len(probs))]
        sketch = stored(sketch.select(*sketch.columns, *ends).drop("__p"), "quantile-brackets")
        held = [f"__p{i}" for i in range(len(probs))]
        rows = rows.alias("l").join(sketch.select(*by, *held).alias("r"), on("l", "r")).select(
            *[F.col(f"l.{c}").alias(c) for c in by], "__x", *held)
        end = [F.col(c) for c in held]
    else:  # one row of a few numbers
        end = [F.lit(float(v)) for v in sketch.first()["__p"] or [0.0] * len(probs)]
    x = F.col("__x")
    low = [F.lit(-INF) if q - off <= 0 else end[2 * j] for j, q in enumerate(qs)]
    high = [F.lit(INF) if q + off >= 1 else end[2 * j + 1] for j, q in enumerate(qs)]
    inside = F.lit(False)
    for a, b in zip(low, high):
        inside = inside | ((x >= a) & (x <= b))
    cell = sum(((x >= a).cast("int") + (x > b).cast("int") for a, b in zip(low, high)), F.lit(0))  # rises with x
    counted = (rows.groupBy(*by, cell.alias("__cell"), F.when(inside, x).alias("__in"))
               .agg(F.count(F.lit(1)).alias("__c"), F.min(x).alias("__lo"), F.max(x).alias("__hi")))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = group.orderBy("__cell", "__lo").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumns({"__end": F.sum("__c").over(upto), "n": F.sum("__c").over(group)})
    start = F.col("__end") - F.col("__c")
    at = []
    for i, r in enumerate(_ranks(F.col("n"), qs)):
        # outside a bracket only the first and the last value are known: a rank next to a bracket
        v = F.coalesce("__in", F.when(r == start, F.col("__lo")).when(r == F.col("__end") - 1, F.col("__hi")))
        at.append(F.min(F.when((start <= r) & (r < F.col("__end")), v)).alias(f"__v{i}"))
    got = placed.groupBy(*by).agg(F.max("n").alias("n"), *at).where("n > 0").select(*by, "n", _interpolated(qs))
    if not also:
        return got
    more = [c for c in sketch.columns if c not in by and c not in held]
    return got.alias("l").join(sketch.select(*by, *more).alias("r"), on("l", "r")).select("l.*", *[F.col(f"r.{c}") for c in more])


def _weighted_quantiles(df: DataFrame, by: list[str], value: str, qs: Sequence[float], num_buckets: int | None,
                        weight: str) -> DataFrame:
    """``exact_quantiles`` of a table of counts: stored once by (group, value), dealt to (group, value bucket).

    Only the buckets that hold a wanted rank are looked into.
    """
    counted = stored(df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__x"))
                     .agg(F.sum(weight).alias("__c")), "quantile-counts")
    cuts = cut_points(counted, ["__x"], buckets_for(df, num_buckets))
    counted = counted.withColumn("__b", bucket_of(["__x"], cuts))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = whole.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = (counted.groupBy(*by, "__b").agg(F.sum("__c").alias("__s"))
                  .withColumn("__off", F.coalesce(F.sum("__s").over(before), F.lit(0)))
                  .withColumn("__n", F.sum("__s").over(whole)))
    wanted = F.lit(False)
    for r in _ranks(F.col("__n"), qs):
        wanted = wanted | ((r >= F.col("__off")) & (r < F.col("__off") + F.col("__s")))
    held = per_bucket.where(wanted).drop("__s")
    on = F.col("l.__b") == F.col("r.__b")
    for c in by:
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    found = counted.alias("l").join(held.alias("r"), on).select(
        *[F.col(f"l.{c}").alias(c) for c in by], "l.__b", "__x", "__c", "__off", "__n")
    upto = Window.partitionBy(*by, "__b").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("__end", F.col("__off") + F.sum("__c").over(upto))
    at = [F.min(F.when((F.col("__end") > r) & (F.col("__end") - F.col("__c") <= r), F.col("__x"))).alias(f"__v{i}")
          for i, r in enumerate(_ranks(F.col("__n"), qs))]
    return found.groupBy(*by).agg(F.max("__n").alias("n"), *at).select(*by, "n", _interpolated(qs))
