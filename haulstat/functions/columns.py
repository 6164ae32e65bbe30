"""Column-level helpers: every function takes and returns ``Column`` expressions.

They compile to built-in Catalyst expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for a missing value, matched exactly (case and blanks count).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
               "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_hour(hour: Column | str) -> Column:
    """Clock-style hour (0, 100, ..., 2300) to 0..23 by floor division."""
    return F.floor(_c(hour) / 100).cast("int")


def reading_timestamp(date: Column | str, hour: Column | str) -> Column:
    """A reading's timestamp from its calendar date plus a whole hour (0..23)."""
    return _c(date) + F.make_dt_interval(F.lit(0), _c(hour).cast("int"))


def coerce_timestamp(text: Column | str) -> Column:
    """Lenient parse: unparseable text becomes null instead of failing the job."""
    return _c(text).try_cast("timestamp_ntz")


def strict_timestamp(text: Column | str) -> Column:
    """Strict parse: under ANSI mode a bad value fails the query."""
    return _c(text).cast("timestamp_ntz")


def null_token(c: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """String value, or null when it is one of the missing-value tokens."""
    col = _c(c)
    return F.when(col.isin(*tokens), F.lit(None)).otherwise(col)


def whole_number(c: Column | str) -> Column:
    """A double that holds a whole number (``1.0``, as integers with gaps are written) as INT, else null."""
    col = _c(c)
    fits = (col == F.floor(col)) & (F.abs(col) <= F.lit(2147483647.0))
    return F.when(fits, col).cast("int")


def nan_to_null(c: Column | str) -> Column:
    """NaN to null, so comparisons and averages follow SQL null rules."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def flag(cond: Column) -> Column:
    """Boolean condition to 0/1 where an unknown (null) comparison counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def bad_weather(prefix: str = "", precip_gt: float = 0.0, visibility_lt: float = 3.0,
                wind_gt: float = 15.0) -> Column:
    """1 when precipitation, poor visibility or wind passes its threshold, else 0."""
    p = F.col(f"{prefix}precip")
    v = F.col(f"{prefix}visibility")
    w = F.col(f"{prefix}wind_speed")
    return (flag(p > precip_gt).bitwiseOR(flag(v < visibility_lt)).bitwiseOR(flag(w > wind_gt))).cast("int")


def any_of(*flags: Column | str) -> Column:
    """1 when any of the 0/1 flags is 1."""
    return F.greatest(*[flag(_c(f) == 1) for f in flags]).cast("int")


def weekday_mon0(ts: Column | str) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts))


def is_weekend(ts: Column | str) -> Column:
    return weekday_mon0(ts).isin(5, 6).cast("int")


def value_map(c: Column | str, mapping: Mapping) -> Column:
    """Map values through a dict; unmapped values become null."""
    items = list(mapping.items())
    expr = None
    for k, v in items:
        expr = F.when(_c(c) == F.lit(k), F.lit(v)) if expr is None else expr.when(_c(c) == F.lit(k), F.lit(v))
    return expr if expr is not None else F.lit(None)



def round_whole(c: Column | str) -> Column:
    """A double rounded to a whole number, halves away from zero, as ``F.round(c, 0)`` gives it.

    ``F.round`` goes through the value's text; this is plain arithmetic: ``rint`` takes halves to the even
    neighbour, and a half that went towards zero (an exact difference) is put one further out.
    """
    x = _c(c)
    out = F.signum(x)
    return F.rint(x) + F.when((x - F.rint(x)) * out == 0.5, out).otherwise(F.lit(0.0))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed hours with sub-second precision kept."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(3.6e9)


def time_bucket(ts: Column | str, bucket_hours: float) -> Column:
    """Integer bucket of ``bucket_hours`` width (fractions allowed, down to a second).

    Computed from the calendar fields, so it is zone-free on TIMESTAMP_NTZ.
    """
    t = _c(ts)
    width = max(int(round(bucket_hours * 3600)), 1)
    if width % 3600 == 0:
        hours = F.unix_date(F.to_date(t)).cast("long") * 24 + F.hour(t)
        return F.floor(hours / F.lit(width // 3600)).cast("long")
    secs = (F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600
            + F.minute(t) * 60 + F.floor(F.second(t)))
    return F.floor(secs / F.lit(width)).cast("long")
