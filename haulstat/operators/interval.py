"""Key + time-interval join with aggregation (trip windows over reading series).

Each left row owns a closed window ``[start, end]`` on one series key. Readings
of that key whose time falls inside the window are aggregated per ``keys``.

Plan shape, chosen for very large tables on both sides: work grows with rows, not with pairs of them.

* Readings are reduced once to mergeable sums, counts, maxima and minima per (key, time), partial
  before the shuffle, and stored. Windows are reduced to the different (key, start, end).
* Time is cut into buckets, a fraction of the mean window. A window is the rest of its first
  bucket from its start on, its last bucket up to its end, and the whole buckets between.
* The two cut buckets are running aggregates inside (key, bucket), one forwards and one
  backwards, read at the starts and ends that are asked for. No running sum goes beyond a
  bucket and no large sums are subtracted, so no digits are lost; maxima work alike.
* The whole buckets are covered by at most two blocks of each level, found by arithmetic on
  the window, over a table of (key, level, block) for blocks of 1, 2, 4, 8 ... buckets.
* A window shorter than a bucket uses a finer width, a 16th, a 256th ... of the bucket: the widest
  that is not longer than the window. So every window spans two buckets of its width, and meets
  a number of summary rows that grows with the logarithm of its length, however many readings and
  windows share a bucket. Readings are summarised for the widths that some window needs.
* Where windows and readings that share a cut bucket are no more pairs than there are rows (counted
  first), the cut buckets are joined with the raw readings in place of running aggregates, in a
  join that splits a skewed (key, bucket) at run time.
* The different windows' aggregates are found once. Where no two left rows share ``keys`` (``keys_unique``, one
  narrow count), each row meets its window's finished aggregates by (key, start, end) and is not
  shuffled by ``keys``; else the rows' keys and bounds meet them and merge per ``keys``.
* The mean of a key over all time (fallback) is summed from the table of (key, time) and stored, so
  that few means are broadcast.
* size check: when the caller passes a proven bound on the left side
  (``window_size_bound``, one aggregate over the schedule) whose estimated bytes
  fit the session's ``spark.sql.autoBroadcastJoinThreshold``, the windows' aggregates are
  broadcast. Above the bound, or without one, the optimizer goes by the stored table's size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulstat.functions.columns import time_bucket
from haulstat.sources.snapshots import stored

#: Mergeable parts of each aggregate function.
_PARTS = {"avg": ("sum", "n"), "mean": ("sum", "n"), "max": ("max",), "min": ("min",), "sum": ("sum",), "count": ("n",)}
_OF_ROWS = {"sum": F.sum, "n": F.count, "max": F.max, "min": F.min}
_OF_PARTS = {"sum": F.sum, "n": F.sum, "max": F.max, "min": F.min}


def _parts(aggs: Mapping[str, tuple[str, str]]) -> list[tuple[str, str]]:
    """(part, column) of all aggregates, each once."""
    for name, (fn, _) in aggs.items():
        if fn not in _PARTS:
            raise ValueError(f"unsupported aggregate {fn!r} for {name!r}")
    return sorted({(p, col) for fn, col in aggs.values() for p in _PARTS[fn]})


def _name(part: str, col: str) -> str:
    return f"__{part}_{col}"


def _finished(fn: str, col: str, mean_type) -> Column:
    """The aggregate from its merged parts."""
    if fn in ("avg", "mean"):
        n = F.col(_name("n", col))
        return F.when(n > 0, (F.col(_name("sum", col)) / n)).cast(mean_type)
    return F.coalesce(F.col(_name("n", col)), F.lit(0).cast("long")) if fn == "count" else F.col(_name(_PARTS[fn][0], col))


#: Levels of the two cut buckets beside the blocks' levels from 0 on.
UPTO, FROM = -1, -2
EXPLODED_ROW_BYTES = 64  # keys, series key, two bounds and row overhead


MIN_BUCKET_HOURS = 1 / 60
MAX_BUCKET_HOURS = 24 * 30
BUCKETS_PER_WINDOW = 8


def plan_windows(left: DataFrame, start: str, end: str) -> tuple[float, tuple[int, int]]:
    """Bucket width and size bound for a schedule, from one aggregate.

    The width is a ``BUCKETS_PER_WINDOW``-th of the mean window length (clamped to [1 minute, 30
    days], whole hours from an hour up). The bound is (rows, widest window in buckets) for the
    broadcast decision and the number of levels.
    """
    hours = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(3.6e9)
    ok = F.col(end) >= F.col(start)
    row = left.agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(ok, hours)).alias("avg"),
                   F.max(F.when(ok, hours)).alias("max"), _lengths(start, end), *_row_bytes(left)).first()
    width = min(max(float(row["avg"] or 24.0) / BUCKETS_PER_WINDOW, MIN_BUCKET_HOURS), MAX_BUCKET_HOURS)
    width = float(int(width)) if width >= 1 else width
    widest = int((row["max"] or 0.0) // width) + 2
    return width, WindowBound.of(int(row["n"]), widest, _measured_bytes(row), row["lengths"])


def _row_bytes(left: DataFrame) -> list:
    """Aggregates: mean bytes of each string column (any of them may be a key)."""
    return [F.avg(F.octet_length(f.name)).alias(f"__w{i}") for i, f in enumerate(left.schema.fields)
            if f.dataType.simpleString() == "string"]


def _measured_bytes(row) -> int:
    """Bytes of one exploded window row: the fixed part, every other column at 8, strings as measured."""
    widths = [v for k, v in row.asDict().items() if k.startswith("__w")]
    return EXPLODED_ROW_BYTES + int(sum(16 + 2 * (v or 0.0) for v in widths))


def _lengths(start: str, end: str) -> Column:
    """Aggregate: the binary digits that the valid windows' lengths in microseconds have."""
    micros = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))
    return F.collect_set(F.when(micros >= 0, F.length(F.bin(micros)))).alias("lengths")


class WindowBound(tuple):
    """(rows, widest window in buckets) of a schedule, the measured ``row_bytes`` of one row and the windows' ``lengths``."""

    row_bytes = EXPLODED_ROW_BYTES
    lengths: Sequence[int] | None = None

    @classmethod
    def of(cls, rows: int, widest: int, row_bytes: int, lengths: Sequence[int] | None = None) -> WindowBound:
        bound = cls((rows, widest))
        bound.row_bytes, bound.lengths = row_bytes, lengths
        return bound


def window_size_bound(left: DataFrame, start: str, end: str, bucket_hours: float = 24) -> WindowBound:
    """(rows, widest window in buckets) of a schedule: one aggregate, a few numbers to the driver.

    ``rows`` bounds the different windows; ``widest`` tells how many levels the summaries need.
    """
    span = time_bucket(end, bucket_hours) - time_bucket(start, bucket_hours) + 1
    row = left.agg(F.count(F.lit(1)).alias("n"), F.max(span).alias("w"), _lengths(start, end), *_row_bytes(left)).first()
    return WindowBound.of(int(row["n"]), int(row["w"] or 0), _measured_bytes(row), row["lengths"])


def broadcast_limit_rows(spark, row_bytes: int = EXPLODED_ROW_BYTES) -> int:
    """Window rows that fit the session's broadcast threshold (0 when disabled)."""
    from haulstat.session import broadcast_threshold_bytes
    return broadcast_threshold_bytes(spark) // row_bytes


def _use_broadcast(spark, bound: tuple[int, int] | None, broadcast_max_rows: int | None, parts_bytes: int) -> bool:
    if bound is None:
        return False
    row_bytes = getattr(bound, "row_bytes", EXPLODED_ROW_BYTES) + parts_bytes
    cap = broadcast_limit_rows(spark, row_bytes) if broadcast_max_rows is None else broadcast_max_rows
    return bound[0] <= cap


FINER = 16  # a width is so many times the next finer one


def bucket_widths(bucket_hours: float) -> list[int]:
    """Microseconds of a bucket, and of the finer buckets for shorter windows, down to one."""
    widths = [max(int(round(bucket_hours * 3600)), 1) * 1_000_000]
    while widths[-1] > 1:
        widths.append(max(widths[-1] // FINER, 1))
    return widths


def _width_of(length: Column, widths: Sequence[int]) -> Column:
    """Position of the widest width that is not above the window's length (the last one for a length of 0)."""
    return sum(((length < w).cast("int") for w in widths[:-1]), F.lit(0))


def widths_used(lengths: Sequence[int], widths: Sequence[int]) -> list[int]:
    """Positions of the widths that windows with so many binary digits need."""
    place = lambda n: sum(n < w for w in widths[:-1])
    return sorted({i for d in lengths for i in range(place((1 << d) - 1), place(1 << (d - 1) if d > 1 else 0) + 1)})


def _bucket(micros: Column, width: Column) -> Column:
    return F.call_function("div", micros - F.pmod(micros, width), width)


def _micros(c: str, zoned: bool) -> Column:
    """Microseconds of a time; ``zoned`` if both sides hold instants, else by the calendar fields."""
    if zoned:
        return F.unix_micros(c)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c).cast("timestamp_ntz"))


def _windows(left: DataFrame, *, by: str, start: str, end: str, zoned: bool, keys: Sequence[str] = ()) -> DataFrame:
    """The valid windows: ``keys``, series key, start and end in microseconds."""
    return (left.where(F.col(by).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start)))
            .select(*keys, F.col(by).alias("__lk"), _micros(start, zoned).alias("__s"), _micros(end, zoned).alias("__e")))


def _prepared_readings(readings: DataFrame, by: str, ts: str, value_cols: Sequence[str], zoned: bool, key_type) -> DataFrame:
    """Readings with a key: series key as the windows have it, microseconds (or null) and values."""
    return readings.where(F.col(by).isNotNull()).select(
        F.col(by).cast(key_type).alias("__k"), _micros(ts, zoned).alias("__t"), *value_cols)


def time_summaries(readings: DataFrame, parts: Sequence[tuple[str, str]]) -> DataFrame:
    """Mergeable parts and the number of readings per (key, time), stored.

    Readings with a null time have a row of their own and count in the key's mean only.
    """
    return stored(readings.groupBy("__k", "__t").agg(F.count(F.lit(1)).alias("__rows"),
                                                     *[_OF_ROWS[p](c).alias(_name(p, c)) for p, c in parts]), "times")


class _Merge:
    """Merges parts of ``table`` (and its number of readings) in an aggregate or over a window, each in its own type."""

    def __init__(self, table: DataFrame, parts: Sequence[tuple[str, str]]):
        self.of = {"__rows": F.sum} | {_name(p, c): _OF_PARTS[p] for p, c in parts}
        self.types = {n: table.schema[n].dataType for n in self.of}

    def __call__(self, window: WindowSpec | None = None) -> list[Column]:
        found = {n: f(n) if window is None else f(n).over(window) for n, f in self.of.items()}
        return [c.cast(self.types[n]).alias(n) for n, c in found.items()]


def edge_summaries(held: DataFrame, asked: DataFrame, merge: _Merge) -> DataFrame:
    """Per (key, width, time) asked for: level ``UPTO``, its bucket up to the time, and ``FROM``, its bucket from the time on.

    Each time is one row of its bucket, however many readings and windows share it; running aggregates go
    over these rows, once in either direction.
    """
    at = (held.withColumn("__asked", F.lit(False)).unionByName(asked.withColumn("__asked", F.lit(True)), allowMissingColumns=True)
          .groupBy("__k", "__w", "__b", "__t").agg(*merge(), F.max("__asked").alias("__asked")))
    inside = Window.partitionBy("__k", "__w", "__b")
    so_far = [inside.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.col("__t").asc(), F.col("__t").desc())]
    both = at.select("__k", "__w", "__t", "__asked", *[F.struct(F.lit(level).alias("__level"), *merge(w)).alias(f"__x{level}")
                                                       for level, w in zip((UPTO, FROM), so_far)])
    return (both.where("__asked").select("__k", "__w", F.col("__t").alias("__at"), F.explode(F.array(f"__x{UPTO}", f"__x{FROM}")).alias("__x"))
            .select("__k", "__w", "__at", "__x.*"))


def block_summaries(held: DataFrame, merge: _Merge, levels: int) -> DataFrame:
    """Parts per (key, width, level, block): block j of level i are the buckets [j * 2^i, (j + 1) * 2^i)."""
    buckets = held.groupBy("__k", "__w", "__b").agg(*merge())
    at = buckets.select("__k", "__w", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("__level"), "__b", *merge.of)
    return at.groupBy("__k", "__w", "__level", F.call_function("shiftright", "__b", F.col("__level")).alias("__at")).agg(*merge())


def covering_blocks(first: Column, last: Column, levels: int) -> Column:
    """Array of (level, block): disjoint blocks, at most two a level, that cover the buckets first .. last exactly.

    Level by level the range [l, r) still to be covered shrinks to whole blocks of the next level; an odd
    left end and an odd right end are covered by a block of this level.
    """
    def at(i: Column) -> Column:
        left = F.call_function("shiftright", first + F.call_function("shiftleft", F.lit(1).cast("long"), i) - 1, i)
        right = F.call_function("shiftright", last + 1, i)
        return F.array(
            F.struct(i.alias("level"), left.alias("block"), ((left < right) & (left % 2 != 0)).alias("use")),
            F.struct(i.alias("level"), (right - 1).alias("block"), ((left < right) & (right % 2 != 0)).alias("use")))

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))
    return F.filter(every, lambda x: x["use"])


def few_pairs(windows: DataFrame, times: DataFrame, width: int) -> bool:
    """Whether windows and readings that share a cut bucket are no more pairs than there are windows and readings."""
    at = {n: _bucket(F.col(n), F.lit(width)) for n in ("__s", "__e", "__t")}
    cut = (windows.select("__lk", F.explode(F.array_distinct(F.array(at["__s"], at["__e"]))).alias("__lb"))
           .groupBy("__lk", "__lb").agg(F.count(F.lit(1)).alias("__n")))
    held = times.where(F.col("__t").isNotNull()).groupBy("__k", at["__t"].alias("__b")).agg(F.sum("__rows").alias("__rows"))
    pairs = cut.join(held, (cut["__lk"] == held["__k"]) & (cut["__lb"] == held["__b"])).agg(
        F.sum(F.col("__n").cast("double") * F.col("__rows"))).first()[0]
    return (pairs or 0) <= windows.count() + (times.agg(F.sum("__rows")).first()[0] or 0)


def _met_readings(w: DataFrame, readings: DataFrame, merge: _Merge, parts: Sequence[tuple[str, str]], width: int) -> DataFrame:
    """Parts of every reading inside a cut bucket of a window and inside the window; the join splits a hot (key, bucket)."""
    cut = w.select("__lk", "__s", "__e", F.explode(F.array_distinct(F.array("__lo", "__hi"))).alias("__lb"))
    raw = readings.where(F.col("__t").isNotNull()).withColumn("__b", _bucket(F.col("__t"), F.lit(width)))
    one = {_name(p, c): F.col(c).isNotNull().cast("long") if p == "n" else F.col(c) for p, c in parts} | {"__rows": F.lit(1)}
    return cut.join(raw, (cut["__lk"] == raw["__k"]) & (cut["__lb"] == raw["__b"]) & F.col("__t").between(F.col("__s"), F.col("__e"))
                    ).select("__lk", "__s", "__e", *[one[n].cast(t).alias(n) for n, t in merge.types.items()])


def _met_pieces(w: DataFrame, pieces: DataFrame, needed: Column, merge: _Merge) -> DataFrame:
    """Parts of every piece (level, at) that a window needs."""
    needs = w.select("__lk", "__s", "__e", F.col("__w").alias("__lw"), F.explode(needed).alias("__x"))
    pieces = pieces.where(F.col("__rows") > 0)
    return needs.join(pieces, (needs["__lk"] == pieces["__k"]) & (needs["__lw"] == pieces["__w"])
                      & (F.col("__x.level") == pieces["__level"]) & (F.col("__x.at") == pieces["__at"])
                      ).select("__lk", "__s", "__e", *merge.of)


def window_parts(windows: DataFrame, readings: DataFrame, times: DataFrame, merge: _Merge, parts: Sequence[tuple[str, str]], *,
                 bucket_hours: float, widest: int, lengths: Sequence[int]) -> DataFrame:
    """Merged parts per different window that holds a reading: its cut buckets and its whole buckets' blocks.

    Where the pairs of windows and readings in cut buckets are no more than the rows (``few_pairs``), these are
    joined as they are; else the cut buckets are read from running aggregates, and the result is stored.
    """
    widths = bucket_widths(bucket_hours)
    windows = stored(windows.distinct(), "windows")
    few = few_pairs(windows, times, widths[0])
    used = [0] if few else widths_used(lengths, widths)
    levels = max((widest - 2).bit_length() if widest > 2 and 0 in used else 0, 5 if any(used) else 0)
    width = F.get(F.array(*[F.lit(w).cast("long") for w in widths]), F.col("__w"))
    w = (windows.withColumn("__w", F.lit(0) if few else _width_of(F.col("__e") - F.col("__s"), widths))
         .withColumns({"__lo": _bucket(F.col("__s"), width), "__hi": _bucket(F.col("__e"), width)}))
    held = (times.where(F.col("__t").isNotNull()).withColumn("__w", F.explode(F.array(*[F.lit(i) for i in used]).cast("array<int>")))
            .withColumn("__b", _bucket(F.col("__t"), width)))
    if few:
        met = _met_readings(w, readings, merge, parts, widths[0])
    else:
        asked = w.select(F.col("__lk").alias("__k"), "__w", F.explode(F.array(
            F.struct(F.col("__lo").alias("__b"), F.col("__s").alias("__t")),
            F.struct(F.col("__hi").alias("__b"), F.col("__e").alias("__t")))).alias("__x")).select("__k", "__w", "__x.*").distinct()
        upto = F.struct(F.lit(UPTO).alias("level"), F.col("__e").alias("at"))
        both = F.array(upto, F.struct(F.lit(FROM).alias("level"), F.col("__s").alias("at")))
        met = _met_pieces(w, edge_summaries(held, asked, merge), F.when(F.col("__lo") < F.col("__hi"), both).otherwise(F.array(upto)), merge)
    if levels:
        whole = F.transform(covering_blocks(F.col("__lo") + 1, F.col("__hi") - 1, levels),
                            lambda x: F.struct(x["level"].alias("level"), x["block"].alias("at")))
        met = met.unionByName(_met_pieces(w, block_summaries(held, merge, levels), whole, merge))
    found = met.groupBy("__lk", "__s", "__e").agg(*merge())
    return found if few else stored(found, "window-parts")


def keys_unique(left: DataFrame, keys: Sequence[str]) -> bool:
    """Whether no two rows share ``keys``; rows with a null key, which never match, do not count."""
    held = left.select(*keys).dropna()
    return held.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").isEmpty()


def _found(left: DataFrame, readings: DataFrame, *, by: str, start: str, end: str, ts: str,
           aggs: Mapping[str, tuple[str, str]], readings_by: str | None, bucket_hours: float, bound: tuple[int, int] | None,
           broadcast_max_rows: int | None) -> tuple[DataFrame, DataFrame, _Merge, dict, dict]:
    """Parts per different window, the stored (key, time) table, its merge, the means' types, how windows are read."""
    parts = _parts(aggs)
    cols = {f.name: f.dataType for f in [*left.select(start, end).schema.fields, *readings.select(ts).schema.fields]}
    zoned = all(isinstance(t, T.TimestampType) for t in cols.values())
    r = _prepared_readings(readings, readings_by or by, ts, sorted({c for _, c in parts}), zoned, left.schema[by].dataType)
    times = time_summaries(r, parts)
    merge = _Merge(times, parts)
    measured = bound or window_size_bound(left, start, end, bucket_hours)
    lengths = getattr(measured, "lengths", None)
    if lengths is None:
        lengths = left.agg(_lengths(start, end)).first()["lengths"]
    at = dict(by=by, start=start, end=end, zoned=zoned)
    found = window_parts(_windows(left, **at), r, times, merge, parts, bucket_hours=bucket_hours, widest=measured[1], lengths=lengths)
    if _use_broadcast(left.sparkSession, bound, broadcast_max_rows, 8 * (3 + len(merge.of))):
        found = F.broadcast(found)
    means = {f.name: f.dataType for f in r.limit(0).agg(
        *[F.avg(c).alias(c) for fn, c in set(aggs.values()) if fn in ("avg", "mean")] or [F.count(F.lit(1))]).schema.fields}
    return found, times, merge, means, at


def _all_finished(parts: DataFrame, on: Sequence[str], aggs: Mapping[str, tuple[str, str]], means: Mapping) -> DataFrame:
    return parts.select(*on, *[_finished(fn, c, means.get(c)).alias(n) for n, (fn, c) in aggs.items()])


def _per_keys(base: DataFrame, found: DataFrame, merge: _Merge, keys: Sequence[str], at: Mapping) -> DataFrame:
    """Parts per ``keys`` of all rows that share them."""
    return _windows(base, keys=keys, **at).join(found, ["__lk", "__s", "__e"]).groupBy(*keys).agg(*merge())


def interval_aggregate(left: DataFrame, readings: DataFrame, *, by: str, start: str, end: str,
                       ts: str, aggs: Mapping[str, tuple[str, str]], keys: Sequence[str],
                       readings_by: str | None = None, bucket_hours: float = 24,
                       window_size_bound: tuple[int, int] | None = None,
                       broadcast_max_rows: int | None = None) -> DataFrame:
    """One row per distinct ``keys`` value that has at least one reading in its window.

    ``aggs`` maps output name to ``(function, reading column)``; functions are
    avg/mean, max, min, sum, count. Windows are closed at both ends. Left rows
    with a null key, a null bound or ``end < start`` have no readings.
    Left rows sharing ``keys`` pool their readings (a reading counts once per
    row whose window holds it), which matches grouping the pairs by ``keys``.
    """
    found, _, merge, means, at = _found(left, readings, by=by, start=start, end=end, ts=ts, aggs=aggs, readings_by=readings_by,
                                        bucket_hours=bucket_hours, bound=window_size_bound, broadcast_max_rows=broadcast_max_rows)
    return _all_finished(_per_keys(left, found, merge, list(keys), at), list(keys), aggs, means)


def attach_interval_aggregate(left: DataFrame, readings: DataFrame, *, by: str, start: str,
                              end: str, ts: str, aggs: Mapping[str, tuple[str, str]],
                              keys: Sequence[str], readings_by: str | None = None,
                              fallback_mean: Sequence[str] = (),
                              constant_fill: Mapping[str, object] | None = None,
                              bucket_hours: float = 24,
                              window_size_bound: tuple[int, int] | None = None,
                              broadcast_max_rows: int | None = None, unique: bool | None = None) -> DataFrame:
    """Left rows with their window aggregates joined back on ``keys``.

    Columns listed in ``fallback_mean`` fall back, when the window had no
    reading, to the mean of the named reading column over the whole key
    (each column on its own); ``constant_fill`` fills the rest with constants.
    A key without readings at all keeps null for its fallback columns. ``unique`` is a caller's own
    ``keys_unique``; it is counted if not given.

    Plan: the different windows' aggregates are found first (from the left rows' keys and times alone).
    If no two rows share ``keys``, each row is joined to its window's aggregates. Else the left rows are
    shuffled once by ``keys``; the aggregate and the join-back are both partitioned by them. The fallback
    means are summed from the stored (key, time) table.
    """
    keys = list(keys)
    out_cols = list(aggs.keys())
    clash = [c for c in out_cols if c in left.columns]
    base = left.drop(*clash) if clash else left
    found, times, merge, means, at = _found(left, readings, by=by, start=start, end=end, ts=ts, aggs=aggs, readings_by=readings_by,
                                            bucket_hours=bucket_hours, bound=window_size_bound,
                                            broadcast_max_rows=broadcast_max_rows)
    if keys_unique(left, keys) if unique is None else unique:
        whole = F.lit(True)
        for k in keys:
            whole = whole & base[k].isNotNull()
        done = _all_finished(found, ["__lk", "__s", "__e"], aggs, means)
        if _use_broadcast(left.sparkSession, window_size_bound, broadcast_max_rows, 8 * (3 + len(merge.of))):
            done = F.broadcast(done)
        result = base.join(done, whole & (base[by] == done["__lk"]) & (_micros(start, at["zoned"]) == done["__s"])
                           & (_micros(end, at["zoned"]) == done["__e"]), "left").drop("__lk", "__s", "__e")
    else:
        base = base.repartition(*keys)
        result = base.join(_all_finished(_per_keys(base, found, merge, keys, at), keys, aggs, means), keys, "left")
    if fallback_mean:
        src = {name: aggs[name][1] for name in fallback_mean}
        merged = times.groupBy(F.col("__k").alias("__fk")).agg(*merge())
        fb = stored(merged.select("__fk", *[_finished("avg", c, means[c]).alias(f"__fb_{n}") for n, c in src.items()]), "key-means")
        result = result.join(fb, result[by] == fb["__fk"], "left")
        for name in fallback_mean:
            result = result.withColumn(name, F.coalesce(F.col(name), F.col(f"__fb_{name}")))
        result = result.drop("__fk", *[f"__fb_{n}" for n in fallback_mean])
    for name, value in (constant_fill or {}).items():
        result = result.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return result.select(*base.columns, *out_cols)
