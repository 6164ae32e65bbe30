"""DuckDB SQL twins of the registered queries (the independent correctness oracle).

Written as plain SQL over the pre-registered test tables: joins with range
predicates, ASOF joins, window functions and grouped aggregates. The binding
CTEs come from ``bindings.SQL`` so both sides read the same derived inputs.
"""

from __future__ import annotations

from haulstat.plans.bindings import WEATHER_COLS, with_ctes

R = 6
_W = WEATHER_COLS


def _rnd(expr: str, name: str, places: int = R) -> str:
    return f"round(({expr}) * 1e{places}) / 1e{places} AS {name}"


# ---------------------------------------------------------------- fragments

def _interval_ctes(trips: str = "trips") -> list[tuple[str, str]]:
    """Per-trip window aggregates and per-route fallbacks over ``readings``."""
    wcols = ", ".join(f"avg(r.{c}) AS {c}" for c in _W)
    fcols = ", ".join(f"avg({c}) AS {c}" for c in _W)
    return [
        ("hits", f"""
            SELECT t.trip_id, avg(r.no_of_vehicles) AS no_of_vehicles, max(r.accident) AS accident,
                   {wcols}
            FROM {trips} t JOIN readings r
              ON r.route_id = t.route_id AND r.ts >= t.departure_date AND r.ts <= t.estimated_arrival
            GROUP BY t.trip_id"""),
        ("route_fb", f"""
            SELECT route_id, avg(no_of_vehicles) AS no_of_vehicles, {fcols}
            FROM readings GROUP BY route_id"""),
    ]


def _asof_ctes(left: str, key: str, t: str, prefix: str) -> list[tuple[str, str]]:
    """Nearest city reading for each left row (city series times are unique per city)."""
    sel = ", ".join(f"c.{c} AS {c}" for c in _W)
    pick = ", ".join(
        f"CASE WHEN b.ts IS NULL THEN f.{c} WHEN f.ts IS NULL THEN b.{c} "
        f"WHEN date_diff('microsecond', b.ts, l.{t}) <= date_diff('microsecond', l.{t}, f.ts) "
        f"THEN b.{c} ELSE f.{c} END AS {prefix}{c}" for c in _W)
    return [
        (f"{prefix}b", f"""
            SELECT l.trip_id, c.ts, {sel} FROM {left} l
            ASOF LEFT JOIN city_series c ON l.{key} = c.city_id AND c.ts <= l.{t}"""),
        (f"{prefix}f", f"""
            SELECT l.trip_id, c.ts, {sel} FROM {left} l
            ASOF LEFT JOIN city_series c ON l.{key} = c.city_id AND c.ts > l.{t}"""),
        (f"{prefix}pick", f"""
            SELECT l.trip_id, {pick} FROM {left} l
            JOIN {prefix}b b ON b.trip_id = l.trip_id JOIN {prefix}f f ON f.trip_id = l.trip_id"""),
    ]


def _trip_dataset_ctes(more: list[tuple[str, str]] | tuple = ()) -> str:
    extra = [
        ("tr", """SELECT t.*, r.origin_id, r.destination_id, r.distance, r.average_hours
                  FROM trips t LEFT JOIN routes r ON t.route_id = r.route_id"""),
        *_interval_ctes("tr"),
        *_asof_ctes("tr", "origin_id", "departure_date", "origin_"),
        *_asof_ctes("tr", "destination_id", "estimated_arrival", "destination_"),
        ("ds", f"""
            SELECT tr.*,
                   coalesce(h.no_of_vehicles, fb.no_of_vehicles) AS no_of_vehicles,
                   coalesce(h.accident, 0) AS accident,
                   {", ".join(f"coalesce(h.{c}, fb.{c}) AS {c}" for c in _W)},
                   {", ".join(f"o.origin_{c}" for c in _W)},
                   {", ".join(f"d.destination_{c}" for c in _W)},
                   dr.driver_id, dr.name, dr.gender, dr.driving_style, dr.ratings,
                   tk.truck_age, tk.load_capacity_pounds, tk.fuel_type
            FROM tr
            LEFT JOIN hits h ON h.trip_id = tr.trip_id
            LEFT JOIN route_fb fb ON fb.route_id = tr.route_id
            LEFT JOIN origin_pick o ON o.trip_id = tr.trip_id
            LEFT JOIN destination_pick d ON d.trip_id = tr.trip_id
            LEFT JOIN drivers dr ON dr.vehicle_no = tr.truck_id
            LEFT JOIN trucks tk ON tk.truck_id = tr.truck_id"""),
        *more,
    ]
    return with_ctes("trips", "readings", "city_series", "routes", "drivers", "trucks", extra=extra)


_DS_DOUBLES = (["distance", "average_hours", "no_of_vehicles", *_W]
               + [f"origin_{c}" for c in _W] + [f"destination_{c}" for c in _W]
               + ["ratings", "truck_age", "load_capacity_pounds"])
_DS_OTHER = ["trip_id", "truck_id", "route_id", "departure_date", "estimated_arrival", "delay",
             "origin_id", "destination_id", "accident", "driver_id", "name", "gender",
             "driving_style", "fuel_type"]
_ZERO = {f"{p}{c}" for p in ("", "origin_", "destination_")
         for c in ("chanceofrain", "chanceoffog", "chanceofsnow", "chanceofthunder")}


def _bad(prefix: str) -> str:
    return (f"CAST(coalesce({prefix}precip > 0, false) OR coalesce({prefix}visibility < 3, false)"
            f" OR coalesce({prefix}wind_speed > 15, false) AS INTEGER)")


def _features_select(src: str) -> str:
    doubles = [c for c in _DS_DOUBLES if c not in _ZERO]
    return f"""
        SELECT {", ".join(_DS_OTHER)}, {", ".join(_rnd(c, c) for c in doubles)},
               {_bad("")} AS route_bad_weather, {_bad("origin_")} AS origin_bad_weather,
               {_bad("destination_")} AS destination_bad_weather,
               CAST({_bad("")} + {_bad("origin_")} + {_bad("destination_")} > 0 AS INTEGER) AS any_bad_weather,
               CAST(coalesce(no_of_vehicles > (SELECT quantile_cont(no_of_vehicles, 0.75) FROM {src}), false)
                    AS INTEGER) AS high_traffic,
               CAST(isodow(departure_date) - 1 AS INTEGER) AS departure_day_of_week,
               CAST(isodow(departure_date) IN (6, 7) AS INTEGER) AS is_weekend_departure
        FROM {src}"""


# ---------------------------------------------------------------- queries

SQL: dict[str, str] = {}

SQL["interval_traffic"] = with_ctes("trips", "readings", extra=_interval_ctes()) + f"""
SELECT t.trip_id, {_rnd("coalesce(h.no_of_vehicles, fb.no_of_vehicles)", "no_of_vehicles")},
       coalesce(h.accident, 0) AS accident
FROM trips t LEFT JOIN hits h ON h.trip_id = t.trip_id
LEFT JOIN route_fb fb ON fb.route_id = t.route_id"""

SQL["interval_weather"] = with_ctes("trips", "readings", extra=_interval_ctes()) + f"""
SELECT t.trip_id, {", ".join(_rnd(f"coalesce(h.{c}, fb.{c})", c) for c in _W)}
FROM trips t LEFT JOIN hits h ON h.trip_id = t.trip_id
LEFT JOIN route_fb fb ON fb.route_id = t.route_id"""

SQL["asof_nearest"] = """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS view_event_id, user_id AS view_user_id, ts AS view_ts
      FROM events WHERE event_type = 'view'),
b AS (SELECT * FROM (
        SELECT p.event_id, v.view_event_id, v.view_ts,
               row_number() OVER (PARTITION BY p.event_id ORDER BY v.view_ts DESC, v.view_event_id DESC) AS rn
        FROM p JOIN v ON v.view_user_id = p.user_id AND v.view_ts <= p.ts) WHERE rn = 1),
f AS (SELECT * FROM (
        SELECT p.event_id, v.view_event_id, v.view_ts,
               row_number() OVER (PARTITION BY p.event_id ORDER BY v.view_ts ASC, v.view_event_id ASC) AS rn
        FROM p JOIN v ON v.view_user_id = p.user_id AND v.view_ts > p.ts) WHERE rn = 1),
c AS (SELECT p.event_id,
        CASE WHEN b.view_ts IS NULL THEN 'f' WHEN f.view_ts IS NULL THEN 'b'
             WHEN date_diff('microsecond', b.view_ts, p.ts) <= date_diff('microsecond', p.ts, f.view_ts)
             THEN 'b' ELSE 'f' END AS side
      FROM p LEFT JOIN b ON b.event_id = p.event_id LEFT JOIN f ON f.event_id = p.event_id)
SELECT p.event_id, p.user_id, p.ts,
       CASE WHEN c.side = 'b' THEN b.view_event_id ELSE f.view_event_id END AS view_event_id,
       CASE WHEN c.side = 'b' THEN b.view_ts ELSE f.view_ts END AS view_ts
FROM p JOIN c ON c.event_id = p.event_id
LEFT JOIN b ON b.event_id = p.event_id LEFT JOIN f ON f.event_id = p.event_id"""

SQL["asof_two_sided"] = with_ctes(
    "trips", "readings", "city_series", "routes",
    extra=[("tr", """SELECT t.trip_id, t.departure_date, t.estimated_arrival, r.origin_id, r.destination_id
                     FROM trips t LEFT JOIN routes r ON t.route_id = r.route_id"""),
           *_asof_ctes("tr", "origin_id", "departure_date", "origin_"),
           *_asof_ctes("tr", "destination_id", "estimated_arrival", "destination_")]) + f"""
SELECT tr.trip_id, {", ".join(_rnd(f"o.origin_{c}", f"origin_{c}") for c in _W)},
       {", ".join(_rnd(f"d.destination_{c}", f"destination_{c}") for c in _W)}
FROM tr JOIN origin_pick o ON o.trip_id = tr.trip_id JOIN destination_pick d ON d.trip_id = tr.trip_id"""

SQL["lookup_join"] = with_ctes("trips", "routes", "drivers", "trucks") + """
SELECT t.*, r.origin_id, r.destination_id, r.distance, r.average_hours,
       d.driver_id, d.name, d.gender, d.driving_style, d.ratings,
       k.truck_age, k.load_capacity_pounds, k.fuel_type
FROM trips t LEFT JOIN routes r ON t.route_id = r.route_id
LEFT JOIN drivers d ON d.vehicle_no = t.truck_id
LEFT JOIN trucks k ON k.truck_id = t.truck_id"""

SQL["trip_dataset"] = _trip_dataset_ctes() + f"""
SELECT {", ".join(_DS_OTHER)}, {", ".join(_rnd(c, c) for c in _DS_DOUBLES)} FROM ds"""

SQL["trip_features"] = _trip_dataset_ctes() + _features_select("ds")


# levels after the first of each categorical column, as fitted on the trip rows
_DUMMIES = {"gender": ["male"],
            "driving_style": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
            "fuel_type": ["gas"]}
_ID_COLS = {"truck_id", "route_id", "driver_id", "name", "origin_id", "destination_id",
            "departure_date", "estimated_arrival"}
_MATRIX_KEEP = (["trip_id", "delay", "accident"]
                + [c for c in _DS_DOUBLES if c not in _ZERO]
                + ["route_bad_weather", "origin_bad_weather", "destination_bad_weather", "any_bad_weather",
                   "high_traffic", "departure_day_of_week", "is_weekend_departure"])

SQL["model_matrix"] = _trip_dataset_ctes([("feat", _features_select("ds"))]) + """
SELECT """ + ", ".join(_MATRIX_KEEP) + ", " + ", ".join(
    f"CAST(coalesce({c} = '{v}', false) AS INTEGER) AS {c}_{v}" for c, vs in _DUMMIES.items() for v in vs) + """
FROM feat"""

# ---------------------------------------------------------------- features

SQL["bad_weather_flags"] = with_ctes("readings") + f"""
SELECT route_id, ts, precip, visibility, wind_speed, {_bad("")} AS bad_weather FROM readings"""

SQL["high_quantile_flag"] = with_ctes("readings") + """
SELECT route_id, ts, no_of_vehicles,
       CAST(coalesce(no_of_vehicles > (SELECT quantile_cont(no_of_vehicles, 0.75) FROM readings), false)
            AS INTEGER) AS high_traffic
FROM readings"""

SQL["flag_rates"] = _trip_dataset_ctes([("feat", _features_select("ds"))]) + f"""
SELECT {_rnd("avg(any_bad_weather)", "any_bad_weather_rate")}, {_rnd("avg(high_traffic)", "high_traffic_rate")},
       {_rnd("avg(is_weekend_departure)", "weekend_rate")}
FROM feat"""

SQL["calendar_features"] = with_ctes("trips") + """
SELECT trip_id, CAST(isodow(departure_date) - 1 AS INTEGER) AS departure_day_of_week,
       CAST(isodow(departure_date) IN (6, 7) AS INTEGER) AS is_weekend_departure
FROM trips"""

SQL["latest_trips"] = with_ctes("trips") + """
SELECT trip_id, truck_id, route_id, departure_date, estimated_arrival
FROM trips ORDER BY departure_date DESC, trip_id DESC LIMIT 5"""

SQL["duration_profile"] = with_ctes("trips") + f"""
SELECT count(*) AS trips, {_rnd("min(h)", "min_hours")}, {_rnd("avg(h)", "mean_hours")},
       {_rnd("max(h)", "max_hours")}
FROM (SELECT date_diff('microsecond', departure_date, estimated_arrival) / 3.6e9 AS h FROM trips)"""

SQL["daily_rate"] = with_ctes("trips") + f"""
SELECT CAST(CAST(departure_date AS DATE) AS TIMESTAMP) AS day, count(*) AS trips, {_rnd("avg(delay)", "delay_rate")}
FROM trips WHERE departure_date IS NOT NULL GROUP BY 1"""

# ---------------------------------------------------------------- load fixes

SQL["normalize_hour"] = """
SELECT l_orderkey, l_linenumber, l_linenumber * 100 AS raw_hour,
       CAST(floor(l_linenumber * 100 / 100) AS INTEGER) AS hour,
       l_shipdate + to_hours(CAST(floor(l_linenumber * 100 / 100) AS INTEGER)) AS reading_ts
FROM lineitem"""

SQL["parse_coerce"] = """
SELECT l_orderkey, l_linenumber, date_text, TRY_CAST(date_text AS TIMESTAMP) AS date
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_orderkey % 7 = 0 THEN 'not a date'
                  ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS date_text
      FROM lineitem)"""

# ---------------------------------------------------------------- null filling

_EVENTS_NULLS = "SELECT event_id, user_id, nullif(event_type, 'error') AS event_type FROM events"
_LINEITEM_NULLS = """
    SELECT l_orderkey, l_linenumber, l_suppkey,
           CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS l_quantity,
           CASE WHEN l_linenumber = 1 OR l_suppkey % 10 = 0 THEN NULL ELSE l_quantity END AS l_quantity_g,
           CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount END AS l_discount,
           CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_returnflag END AS l_returnflag,
           l_shipdate
    FROM lineitem"""
_LI_NULL_COLS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_quantity_g",
                 "l_discount", "l_returnflag", "l_shipdate"]

SQL["fill_mode"] = f"""
WITH e AS ({_EVENTS_NULLS}),
m AS (SELECT event_type FROM e WHERE event_type IS NOT NULL
      GROUP BY event_type ORDER BY count(*) DESC, event_type ASC LIMIT 1)
SELECT event_id, coalesce(e.event_type, (SELECT event_type FROM m)) AS event_type FROM e"""

SQL["fill_median"] = f"""
WITH li AS ({_LINEITEM_NULLS})
SELECT l_orderkey, l_linenumber, l_suppkey,
       coalesce(l_quantity, (SELECT median(l_quantity) FROM li)) AS l_quantity
FROM li"""

SQL["fill_group_median"] = f"""
WITH li AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity_g AS l_quantity FROM ({_LINEITEM_NULLS})),
g AS (SELECT l_suppkey, median(l_quantity) AS gm FROM li WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey),
s1 AS (SELECT li.l_orderkey, li.l_linenumber, li.l_suppkey, coalesce(li.l_quantity, g.gm) AS l_quantity
       FROM li LEFT JOIN g ON g.l_suppkey = li.l_suppkey)
SELECT l_orderkey, l_linenumber, l_suppkey,
       coalesce(l_quantity, (SELECT median(l_quantity) FROM s1 WHERE l_suppkey IS NOT NULL)) AS l_quantity
FROM s1"""

def _mode(table: str, col: str) -> str:
    return (f"(SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} ASC LIMIT 1)")


SQL["clean_tables"] = with_ctes("drivers", "trucks", extra=[
    ("d", """SELECT vehicle_no,
                    CASE WHEN vehicle_no % 7 = 0 THEN NULL ELSE gender END AS gender,
                    CASE WHEN vehicle_no % 11 = 0 THEN NULL ELSE driving_style END AS driving_style
             FROM drivers"""),
    ("t", """SELECT truck_id,
                    CASE WHEN truck_id % 13 = 0 THEN NULL ELSE fuel_type END AS fuel_type,
                    CASE WHEN truck_id % 17 = 0 THEN NULL ELSE load_capacity_pounds END AS load_capacity_pounds
             FROM trucks""")]) + f"""
SELECT t.truck_id, coalesce(d.gender, {_mode("d", "gender")}) AS gender,
       coalesce(d.driving_style, {_mode("d", "driving_style")}) AS driving_style,
       coalesce(t.fuel_type, {_mode("t", "fuel_type")}) AS fuel_type,
       {_rnd("coalesce(t.load_capacity_pounds, (SELECT median(load_capacity_pounds) FROM t))", "load_capacity_pounds")}
FROM d JOIN t ON d.vehicle_no = t.truck_id"""

# ---------------------------------------------------------------- profiling

SQL["null_report"] = f"""
WITH li AS ({_LINEITEM_NULLS})
SELECT * FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null, count({c}) AS non_null FROM li"
    for c in _LI_NULL_COLS) + """
) WHERE n_null > 0 ORDER BY n_null DESC, 1"""

SQL["dup_rows"] = """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
       (SELECT CAST(sum(n - 1) AS BIGINT)
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)) AS duplicate_keys
FROM (SELECT *, count(*) AS n FROM lineitem GROUP BY ALL)"""

SQL["table_profile"] = """
SELECT 'lineitem' AS table_name, count(*) AS n_rows, 11 AS n_cols, count(DISTINCT l_suppkey) AS n_keys FROM lineitem
UNION ALL
SELECT 'orders', count(*), 6, count(DISTINCT o_custkey) FROM orders
UNION ALL
SELECT 'customer', count(*), 5, count(DISTINCT c_nationkey) FROM customer"""


def _per_key(name: str, src: str, key: str) -> str:
    return (f"SELECT '{name}' AS series, count(*) AS n_keys, min(n) AS min_rows, "
            f"{_rnd('avg(n)', 'mean_rows')}, max(n) AS max_rows "
            f"FROM (SELECT {key}, count(*) AS n FROM {src} WHERE {key} IS NOT NULL GROUP BY {key})")


SQL["rows_per_key"] = with_ctes("trips", "readings") + "\nUNION ALL\n".join([
    _per_key("readings_per_route", "readings", "route_id"),
    _per_key("trips_per_route", "trips", "route_id"),
    _per_key("trips_per_truck", "trips", "truck_id")])

SQL["key_coverage"] = with_ctes("trips", "drivers", "trucks") + """
SELECT (SELECT count(DISTINCT truck_id) FROM trips) AS schedule_trucks,
       (SELECT count(DISTINCT truck_id) FROM trucks) AS trucks,
       (SELECT count(DISTINCT vehicle_no) FROM drivers) AS drivers"""

_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]

SQL["describe"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {_rnd(f"avg({c})", "mean", 4)},
       {_rnd(f"stddev_samp({c})", "std", 4)}, {_rnd(f"min({c})", "min")},
       {_rnd(f"quantile_cont({c}, 0.25)", "q25")}, {_rnd(f"quantile_cont({c}, 0.5)", "q50")},
       {_rnd(f"quantile_cont({c}, 0.75)", "q75")}, {_rnd(f"max({c})", "max")}
FROM lineitem""" for c in _NUM)

SQL["describe_dates"] = with_ctes("trips") + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count,
       make_timestamp(CAST(floor(avg(epoch_us({c}))) AS BIGINT)) AS mean,
       min({c}) AS min,
       make_timestamp(CAST(floor(quantile_cont(epoch_us({c}), 0.25)) AS BIGINT)) AS q25,
       make_timestamp(CAST(floor(quantile_cont(epoch_us({c}), 0.5)) AS BIGINT)) AS q50,
       make_timestamp(CAST(floor(quantile_cont(epoch_us({c}), 0.75)) AS BIGINT)) AS q75,
       max({c}) AS max
FROM trips""" for c in ["departure_date", "estimated_arrival"])

SQL["histogram"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", every.bin, {_rnd("every.lo + (every.bin - 1) * (every.hi - every.lo) / 30", "bin_lo")},
       {_rnd("every.lo + every.bin * (every.hi - every.lo) / 30", "bin_hi")}, count(held.bin) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin, lo, hi
      FROM (SELECT min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi FROM lineitem),
           range(1, 31) WHERE range = 1 OR hi > lo) AS every
LEFT JOIN (SELECT CAST(CASE WHEN hi - lo = 0 THEN 1
                       ELSE least(floor((x - lo) * (30.0::DOUBLE / (hi - lo))) + 1, 30) END AS INTEGER) AS bin,
             lo, hi
      FROM (SELECT CAST({c} AS DOUBLE) AS x FROM lineitem WHERE {c} IS NOT NULL),
           (SELECT min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi FROM lineitem)) AS held USING (bin)
GROUP BY every.bin, every.lo, every.hi""" for c in _NUM)

SQL["kde_curve"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", point, {_rnd("lo + point * (hi - lo) / 199.0::DOUBLE", "x")},
       {_rnd("s / (n * bw * sqrt(2 * pi()))", "density")},
       {_rnd("s / (n * bw * sqrt(2 * pi())) * n * (hi - lo) / 30.0::DOUBLE", "count_density", 4)}
FROM (SELECT CAST(g.point AS INTEGER) AS point, p.lo, p.hi, p.n, p.bw,
             sum(exp(-0.5 * ((p.lo + g.point * ((p.hi - p.lo) / 199.0::DOUBLE) - d.x) / p.bw)
                           * ((p.lo + g.point * ((p.hi - p.lo) / 199.0::DOUBLE) - d.x) / p.bw))) AS s
      FROM (SELECT CAST({c} AS DOUBLE) AS x FROM lineitem WHERE {c} IS NOT NULL) d,
           (SELECT lo, hi, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw
            FROM (SELECT min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi,
                         stddev_samp(CAST({c} AS DOUBLE)) AS sd, count({c}) AS n FROM lineitem)) p,
           (SELECT range AS point FROM range(200)) g
      GROUP BY g.point, p.lo, p.hi, p.n, p.bw)""" for c in _NUM)

SQL["boxplot_stats"] = f"""
WITH long AS (
  SELECT l_returnflag AS class, 'l_quantity' AS "column", CAST(l_quantity AS DOUBLE) AS x FROM lineitem
  UNION ALL
  SELECT l_returnflag, 'l_extendedprice', CAST(l_extendedprice AS DOUBLE) FROM lineitem),
q AS (SELECT "column", class, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3
      FROM long WHERE x IS NOT NULL GROUP BY "column", class),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f."column", f.class, {_rnd("f.q1", "q1")}, {_rnd("f.median", "median")}, {_rnd("f.q3", "q3")},
       {_rnd("f.iqr", "iqr")},
       {_rnd("min(l.x) FILTER (WHERE l.x >= f.lo AND l.x <= f.hi)", "whisker_lo")},
       {_rnd("max(l.x) FILTER (WHERE l.x >= f.lo AND l.x <= f.hi)", "whisker_hi")},
       count(*) FILTER (WHERE NOT (l.x >= f.lo AND l.x <= f.hi)) AS n_outliers, count(*) AS n
FROM long l JOIN f ON f."column" = l."column" AND f.class = l.class
WHERE l.x IS NOT NULL
GROUP BY f."column", f.class, f.q1, f.median, f.q3, f.iqr"""

_LI_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_discount", "l_tax"]
SQL["corr_matrix"] = "\nUNION ALL\n".join(
    f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
       {_rnd(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))", "corr")} FROM lineitem"""
    for a in _LI_NUMERIC for b in _LI_NUMERIC)

SQL["value_counts"] = with_ctes("trips") + f"""
SELECT delay, count(*) AS count,
       {_rnd("count(*) / (SELECT count(*) FROM trips WHERE delay IS NOT NULL)", "share")}
FROM trips WHERE delay IS NOT NULL GROUP BY delay ORDER BY delay"""

SQL["rate_by_category"] = with_ctes("trips") + f"""
SELECT o.o_orderpriority, count(*) AS trips, {_rnd("avg(t.delay)", "delay_rate")}
FROM trips t LEFT JOIN orders o ON o.o_orderkey = t.trip_id
WHERE o.o_orderpriority IS NOT NULL GROUP BY o.o_orderpriority ORDER BY avg(t.delay) DESC, 1"""

SQL["top_routes_delay"] = with_ctes("trips") + f"""
SELECT route_id, count(*) AS trips, {_rnd("avg(delay)", "delay_rate")}
FROM trips WHERE route_id IS NOT NULL GROUP BY route_id HAVING count(*) >= 5
ORDER BY avg(delay) DESC, route_id LIMIT 7"""


# ---------------------------------------------------------------- model matrix

_SPLIT = """split AS (
    SELECT trip_id,
           CASE WHEN row_number() OVER (ORDER BY departure_date, trip_id)
                     <= (SELECT CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) FROM trips)
                THEN 'train' ELSE 'test' END AS split
    FROM trips),
so AS (SELECT s.trip_id, s.split, o.o_orderpriority, o.o_totalprice, o.o_orderstatus
       FROM split s JOIN orders o ON o.o_orderkey = s.trip_id)"""

SQL["time_split"] = with_ctes("trips") + ", " + _SPLIT + """
SELECT t.*, s.split FROM trips t JOIN split s ON s.trip_id = t.trip_id"""

SQL["time_split_one_day"] = with_ctes("trips", extra=[
    ("day", """SELECT * REPLACE (make_timestamp(2019, 2, 1, 7 + trip_id % 3, 0, 0.0) AS departure_date) FROM trips""")]) + """
SELECT *, CASE WHEN row_number() OVER (ORDER BY departure_date, trip_id)
                    <= (SELECT CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) FROM trips)
               THEN 'train' ELSE 'test' END AS split
FROM day"""

# ---------------------------------------------------------------- load path and trip exploration

_TRAFFIC = """
WITH traffic AS (
  SELECT CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN 'none' ELSE CAST(l_suppkey AS VARCHAR) END AS route_id,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE date_trunc('day', l_shipdate)::TIMESTAMP END AS date,
         CAST(l_linenumber % 24 AS INTEGER) AS hour,
         CASE WHEN l_orderkey % 5 = 0 OR l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS no_of_vehicles,
         CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(l_partkey % 10 = 0 AS INTEGER) END AS accident
  FROM lineitem)
"""

SQL["load_parse"] = _TRAFFIC + """
SELECT * REPLACE (CAST(accident AS DOUBLE) AS accident), date + to_hours(hour) AS timestamp FROM traffic"""

_PARSED = ["route_id", "date", "hour", "no_of_vehicles", "accident"]
SQL["load_quality"] = _TRAFFIC + "\nUNION ALL\n".join([
    "SELECT 'rows' AS measure, count(*) AS n FROM traffic",
    *[f"SELECT 'null:{c}', count(*) - count({c}) FROM traffic" for c in _PARSED],
    "SELECT 'null:timestamp', count(*) - count(date + to_hours(hour)) FROM traffic",
    "SELECT 'unread:date', count(*) FROM lineitem WHERE l_orderkey % 97 = 0",
    "SELECT 'quarantined', count(*) FROM lineitem WHERE l_orderkey % 97 = 0"])

SQL["load_clean"] = _TRAFFIC + f"""
, g AS (SELECT route_id, median(no_of_vehicles) AS gm FROM traffic WHERE route_id IS NOT NULL GROUP BY 1),
f AS (SELECT t.*, coalesce(no_of_vehicles, gm) AS v1 FROM traffic t LEFT JOIN g USING (route_id)),
c AS (SELECT *, coalesce(v1, (SELECT median(v1) FROM f WHERE route_id IS NOT NULL)) AS v FROM f)
SELECT route_id, count(*) AS n_rows, count(v) AS n_known, {_rnd("sum(v)", "vehicles")}, count(accident) AS n_accident,
       CAST(sum(accident) AS BIGINT) AS accidents FROM c GROUP BY 1"""

SQL["remaining_nulls"] = _TRAFFIC + """
SELECT count(*) * 6 - count(route_id) - count(date) - count(hour) - count(no_of_vehicles) - count(accident)
       - count(date + to_hours(hour)) AS remaining_nulls FROM traffic"""

SQL["type_tally"] = """
SELECT 'bigint' AS data_type, 3 AS n_columns, count(l_orderkey) + count(l_partkey) + count(l_suppkey) AS non_null FROM lineitem
UNION ALL SELECT 'double', 4, count(l_quantity) + count(l_extendedprice) + count(l_discount) + count(l_tax) FROM lineitem
UNION ALL SELECT 'int', 1, count(l_linenumber) FROM lineitem
UNION ALL SELECT 'string', 2, count(l_returnflag) + count(l_linestatus) FROM lineitem
UNION ALL SELECT 'timestamp_ntz', 1, count(l_shipdate) FROM lineitem"""

_TRIP_NUM = ["distance", "average_hours", "no_of_vehicles", "accident", "temp", "wind_speed", "precip", "humidity",
             "visibility", "pressure", "origin_temp", "destination_temp", "ratings", "truck_age", "load_capacity_pounds"]

SQL["trip_describe"] = _trip_dataset_ctes() + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {_rnd(f"avg({c})", "mean", 4)},
       {_rnd(f"stddev_samp({c})", "std", 4)}, {_rnd(f"CAST(min({c}) AS DOUBLE)", "min")},
       {_rnd(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", "q25")}, {_rnd(f"quantile_cont(CAST({c} AS DOUBLE), 0.5)", "q50")},
       {_rnd(f"quantile_cont(CAST({c} AS DOUBLE), 0.75)", "q75")}, {_rnd(f"CAST(max({c}) AS DOUBLE)", "max")}
FROM ds""" for c in _TRIP_NUM)

SQL["trip_histogram"] = _trip_dataset_ctes() + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", every.bin, {_rnd("every.lo + (every.bin - 1) * (every.hi - every.lo) / 30", "bin_lo")},
       {_rnd("every.lo + every.bin * (every.hi - every.lo) / 30", "bin_hi")}, count(held.bin) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin, lo, hi
      FROM (SELECT min(round(CAST({c} AS DOUBLE), 6)) AS lo, max(round(CAST({c} AS DOUBLE), 6)) AS hi FROM ds),
           range(1, 31) WHERE range = 1 OR hi > lo) AS every
LEFT JOIN (SELECT CAST(CASE WHEN hi - lo = 0 THEN 1
                       ELSE least(floor((x - lo) * (30.0::DOUBLE / (hi - lo))) + 1, 30) END AS INTEGER) AS bin
      FROM (SELECT round(CAST({c} AS DOUBLE), 6) AS x FROM ds WHERE {c} IS NOT NULL),
           (SELECT min(round(CAST({c} AS DOUBLE), 6)) AS lo, max(round(CAST({c} AS DOUBLE), 6)) AS hi FROM ds)) AS held USING (bin)
GROUP BY every.bin, every.lo, every.hi""" for c in _TRIP_NUM)

SQL["trip_kde"] = _trip_dataset_ctes() + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", point, {_rnd("lo + point * (hi - lo) / 199.0::DOUBLE", "x")},
       {_rnd("s / (n * bw * sqrt(2 * pi()))", "density")},
       {_rnd("s / (n * bw * sqrt(2 * pi())) * n * (hi - lo) / 30.0::DOUBLE", "count_density", 4)}
FROM (SELECT CAST(g.point AS INTEGER) AS point, p.lo, p.hi, p.n, p.bw,
             sum(d.w * exp(-0.5 * pow((p.lo + g.point * ((p.hi - p.lo) / 199.0::DOUBLE) - d.x) / p.bw, 2))) AS s
      FROM (SELECT round(CAST({c} AS DOUBLE), 6) AS x, count(*) AS w FROM ds WHERE {c} IS NOT NULL GROUP BY 1) d,
           (SELECT lo, hi, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw
            FROM (SELECT min(round(CAST({c} AS DOUBLE), 6)) AS lo, max(round(CAST({c} AS DOUBLE), 6)) AS hi,
                         stddev_samp(round(CAST({c} AS DOUBLE), 6)) AS sd, count({c}) AS n FROM ds)) p,
           (SELECT range AS point FROM range(200)) g
      GROUP BY g.point, p.lo, p.hi, p.n, p.bw)""" for c in _TRIP_NUM)

SQL["trip_corr"] = _trip_dataset_ctes() + "\nUNION ALL\n".join(
    f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
       {_rnd(f"CASE WHEN stddev_samp(CASE WHEN {b} IS NOT NULL THEN {a} END) * stddev_samp(CASE WHEN {a} IS NOT NULL THEN {b} END) = 0 THEN NULL ELSE corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) END", "corr")} FROM ds"""
    for a in [*_TRIP_NUM, "delay"] for b in [*_TRIP_NUM, "delay"])

SQL["trip_boxplot"] = _trip_dataset_ctes([("long", "\nUNION ALL\n".join(
    f"SELECT delay AS class, '{c}' AS \"column\", round(CAST({c} AS DOUBLE), 6) AS x FROM ds" for c in _TRIP_NUM)),
    ("q", """SELECT "column", class, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
                    quantile_cont(x, 0.75) AS q3 FROM long WHERE x IS NOT NULL GROUP BY "column", class"""),
    ("f", "SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q")]) + f"""
SELECT f."column", f.class, {_rnd("f.q1", "q1")}, {_rnd("f.median", "median")}, {_rnd("f.q3", "q3")},
       {_rnd("f.iqr", "iqr")},
       {_rnd("min(l.x) FILTER (WHERE l.x >= f.lo AND l.x <= f.hi)", "whisker_lo")},
       {_rnd("max(l.x) FILTER (WHERE l.x >= f.lo AND l.x <= f.hi)", "whisker_hi")},
       count(*) FILTER (WHERE NOT (l.x >= f.lo AND l.x <= f.hi)) AS n_outliers, count(*) AS n
FROM long l JOIN f ON f."column" = l."column" AND f.class = l.class
WHERE l.x IS NOT NULL
GROUP BY f."column", f.class, f.q1, f.median, f.q3, f.iqr"""

SQL["trip_rates"] = _trip_dataset_ctes() + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "by", {c} AS value, count(*) AS trips, {_rnd("avg(delay)", "delay_rate")}
FROM ds WHERE {c} IS NOT NULL GROUP BY {c}""" for c in ["gender", "driving_style", "fuel_type"])

# the planted label tells the classes apart by one input, so a model that learned makes no mistake
SQL["train_summary"] = with_ctes("trips") + ", " + _SPLIT + """,
test AS (SELECT count(*) FILTER (WHERE isodow(t.departure_date) > 3) AS p, count(*) FILTER (WHERE isodow(t.departure_date) <= 3) AS n
         FROM trips t JOIN split s ON s.trip_id = t.trip_id WHERE s.split = 'test')
SELECT model, p AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn, n AS tn, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS precision,
       1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, 1.0::DOUBLE AS roc_auc, 1.0::DOUBLE AS train_accuracy
FROM test, (VALUES ('logistic_regression'), ('random_forest')) AS models(model)"""

SQL["model_inputs"] = f"""
SELECT {len([c for c in _MATRIX_KEEP if c not in ("trip_id", "delay")]) + sum(len(v) for v in _DUMMIES.values())}::BIGINT AS n_inputs,
       1.0::DOUBLE AS importance_sum, 'departure_day_of_week' AS top_input, true AS tells_most"""

SQL["predict_recent"] = with_ctes("trips") + """
SELECT trip_id, truck_id, CASE WHEN isodow(departure_date) > 3 THEN 'Delayed' ELSE 'On Time' END AS predicted_delay_label,
       CASE WHEN isodow(departure_date) > 3 THEN 'Delayed' ELSE 'On Time' END AS actual_label
FROM trips ORDER BY departure_date DESC, trip_id DESC LIMIT 5"""

SQL["split_periods"] = with_ctes("trips") + ", " + _SPLIT + """
SELECT s.split, min(t.departure_date) AS first, max(t.departure_date) AS last, count(*) AS rows
FROM split s JOIN trips t ON t.trip_id = s.trip_id GROUP BY s.split"""

# the four levels after the first, as fitted on the training rows
_LEVELS = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

SQL["one_hot"] = with_ctes("trips") + ", " + _SPLIT + """
SELECT trip_id, """ + ", ".join(
    f"CAST(coalesce(o_orderpriority = '{v}', false) AS INTEGER) AS \"o_orderpriority_{v}\"" for v in _LEVELS) + """
FROM so"""

SQL["align_columns"] = with_ctes("trips") + ", " + _SPLIT + """
SELECT trip_id, o_totalprice, 0 AS "o_orderpriority_2-HIGH", """ + ", ".join(
    f"CAST(coalesce(o_orderpriority = '{v}', false) AS INTEGER) AS \"o_orderpriority_{v}\"" for v in _LEVELS[1:]) + """
FROM so WHERE split = 'test' AND o_orderpriority <> '1-URGENT'"""

SQL["standardize"] = with_ctes("trips") + ", " + _SPLIT + f"""
SELECT trip_id, split,
       {_rnd("(o_totalprice - (SELECT avg(o_totalprice) FROM so WHERE split = 'train')) / "
             "(SELECT CASE WHEN coalesce(stddev_pop(o_totalprice), 0) = 0 THEN 1 ELSE stddev_pop(o_totalprice) END "
             "FROM so WHERE split = 'train')", "o_totalprice")}
FROM so"""

# ---------------------------------------------------------------- scoring and metrics

_SCORED = """scored AS (SELECT *, CAST(probability >= 0.5 AS INTEGER) AS predicted_delay FROM scores)"""


def _lbl(c: str) -> str:
    return f"CASE WHEN {c} = 0 THEN 'On Time' WHEN {c} = 1 THEN 'Delayed' END"


SQL["label_map"] = with_ctes("scores") + ", " + _SCORED + f"""
SELECT trip_id, predicted_delay, round_even(probability, 3) AS delay_probability,
       {_lbl("predicted_delay")} AS predicted_delay_label
FROM scored"""

_COUNTS = """counts AS (
    SELECT count(*) FILTER (WHERE delay = 1 AND predicted_delay = 1) AS tp,
           count(*) FILTER (WHERE delay = 0 AND predicted_delay = 1) AS fp,
           count(*) FILTER (WHERE delay = 1 AND predicted_delay = 0) AS fn,
           count(*) FILTER (WHERE delay = 0 AND predicted_delay = 0) AS tn
    FROM scored)"""


def _div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


SQL["confusion_metrics"] = with_ctes("scores") + ", " + _SCORED + ", " + _COUNTS + f"""
SELECT tp, fp, fn, tn, {_rnd(_div("tp + tn", "tp + fp + fn + tn"), "accuracy")},
       {_rnd(_div("tp", "tp + fp"), "precision")}, {_rnd(_div("tp", "tp + fn"), "recall")},
       {_rnd(_div("2 * tp", "2 * tp + fp + fn"), "f1")}
FROM counts"""

SQL["class_report"] = with_ctes("scores") + ", " + _SCORED + ", " + _COUNTS + f""",
per AS (
    SELECT '0' AS class, {_div("tn", "tn + fn")} AS precision, {_div("tn", "tn + fp")} AS recall,
           {_div("2 * tn", "2 * tn + fn + fp")} AS f1, CAST(tn + fp AS BIGINT) AS support FROM counts
    UNION ALL
    SELECT '1', {_div("tp", "tp + fp")}, {_div("tp", "tp + fn")}, {_div("2 * tp", "2 * tp + fp + fn")},
           CAST(tp + fn AS BIGINT) FROM counts),
allr AS (
    SELECT * FROM per
    UNION ALL
    SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per
    UNION ALL
    SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
           sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per)
SELECT class, {_rnd("precision", "precision")}, {_rnd("recall", "recall")}, {_rnd("f1", "f1")}, support
FROM allr"""

SQL["roc_auc"] = with_ctes("scores") + f""",
s AS (SELECT probability AS s, count(*) FILTER (WHERE delay = 1) AS pos, count(*) FILTER (WHERE delay <> 1) AS neg
      FROM scores WHERE probability IS NOT NULL AND delay IS NOT NULL GROUP BY probability),
c AS (SELECT s, pos, neg,
             coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM s)
SELECT {_rnd("sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + neg / 2.0)) / "
             "(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))", "roc_auc")}
FROM c"""

SQL["pred_vs_actual"] = with_ctes("trips", "scores") + f""",
recent AS (SELECT * FROM trips ORDER BY departure_date DESC, trip_id DESC LIMIT 5),
preds AS (SELECT r.truck_id, r.route_id, r.departure_date,
                 {_lbl("CAST(s.probability >= 0.5 AS INTEGER)")} AS predicted_delay_label,
                 round_even(s.probability, 3) AS delay_probability
          FROM recent r JOIN scores s ON s.trip_id = r.trip_id),
actual AS (SELECT truck_id, route_id, departure_date, {_lbl("delay")} AS actual_label FROM recent)
SELECT p.truck_id, p.route_id, p.departure_date, p.predicted_delay_label, p.delay_probability, a.actual_label
FROM preds p JOIN actual a
  ON a.truck_id = p.truck_id AND a.route_id = p.route_id AND a.departure_date = p.departure_date"""

# ---------------------------------------------------------------- feature store

# commits 0 and 1 are batches, 2 the snapshot, 3 a batch
SQL["feature_store_latest"] = f"""
WITH b AS (
    SELECT o_orderkey, o_custkey, o_totalprice, 0 AS batch_id FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice * 1.1::DOUBLE, 1 FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice * 2, 3 FROM orders WHERE o_orderkey % 10 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY batch_id DESC) AS rn FROM b)
SELECT o_orderkey, o_custkey, {_rnd("o_totalprice", "o_totalprice")}, batch_id FROM r WHERE rn = 1"""

SQL["feature_store_counts"] = """
SELECT batch_id, n AS rows_written, n AS rows_read FROM (
    SELECT 0 AS batch_id, count(*) AS n FROM orders
    UNION ALL SELECT 1, count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 3, count(*) FROM orders WHERE o_orderkey % 10 = 0)"""

SQL["published_trips"] = f"""
WITH f AS ({SQL["trip_features"]})
SELECT * REPLACE (CASE WHEN is_weekend_departure = 1 THEN 1 - high_traffic ELSE high_traffic END AS high_traffic),
       CAST(is_weekend_departure = 1 AS INTEGER) AS batch_id FROM f"""

# ---------------------------------------------------------------- files

SQL["file_shapes"] = with_ctes("trips", "readings", "city_series", "routes") + """
SELECT 'drivers' AS table_name, count(*) AS n_rows, 9 AS n_cols FROM customer
UNION ALL SELECT 'trucks', count(*), 5 FROM customer
UNION ALL SELECT 'routes', count(*), 5 FROM routes
UNION ALL SELECT 'traffic', count(*), 6 FROM readings
UNION ALL SELECT 'truck_schedule', count(*), 5 FROM trips
UNION ALL SELECT 'city_weather', count(*), 14 FROM city_series
UNION ALL SELECT 'routes_weather', count(*), 12 FROM readings"""

SQL["file_schedule"] = with_ctes("trips") + """
SELECT CAST(truck_id AS VARCHAR) AS truck_id, CAST(route_id AS VARCHAR) AS route_id, departure_date, estimated_arrival, delay
FROM trips"""

SQL["file_routes_weather"] = with_ctes("readings") + f"""
SELECT CAST(route_id AS VARCHAR) AS route_id, ts AS date, {", ".join(_W)} FROM readings"""

SQL["file_city_weather"] = with_ctes("city_series") + f"""
SELECT CAST(city_id AS VARCHAR) AS city_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, CAST(city_id % 24 AS INTEGER) AS hour,
       {", ".join(_rnd(c, c) for c in _W)},
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(CAST(city_id % 24 AS INTEGER)) AS timestamp
FROM city_series"""


def _measure(table: str, by: str, add: str | None = None, src: str | None = None) -> str:
    total = f"round(sum(CAST({add} AS DOUBLE)) * 1e4) / 1e4" if add else "CAST(NULL AS DOUBLE)"
    return (f"SELECT '{table}' AS table_name, '{by}' AS measure, CAST({by} AS VARCHAR) AS value, count(*) AS n_rows, "
            f"{total} AS total FROM {src or table} GROUP BY {by}")


SQL["reference_tables"] = with_ctes("drivers", "trucks", "routes", "readings", "city_series", extra=[
    ("d0", """SELECT CASE WHEN vehicle_no % 7 <> 0 THEN gender END AS gender,
                     CASE WHEN vehicle_no % 11 <> 0 THEN driving_style END AS driving_style FROM drivers"""),
    ("d", f"""SELECT coalesce(gender, {_mode("d0", "gender")}) AS gender,
                     coalesce(driving_style, {_mode("d0", "driving_style")}) AS driving_style FROM d0"""),
    ("t0", """SELECT CASE WHEN truck_id % 13 <> 0 THEN fuel_type END AS fuel_type,
                     CASE WHEN truck_id % 17 <> 0 THEN load_capacity_pounds END AS load_capacity_pounds FROM trucks"""),
    ("t", f"""SELECT coalesce(fuel_type, {_mode("t0", "fuel_type")}) AS fuel_type,
                     coalesce(load_capacity_pounds, (SELECT median(load_capacity_pounds) FROM t0)) AS load_capacity_pounds
              FROM t0"""),
    ("v0", """SELECT route_id, CAST(visibility AS INTEGER) AS hour, accident,
                     CASE WHEN wind_speed <> 7 THEN no_of_vehicles END AS no_of_vehicles FROM readings"""),
    ("vm", "SELECT route_id, median(no_of_vehicles) AS m FROM v0 GROUP BY 1"),
    ("v", """SELECT route_id, hour, accident, coalesce(no_of_vehicles, m) AS no_of_vehicles
             FROM v0 JOIN vm USING (route_id)"""),
    ("c", "SELECT city_id, CAST(city_id % 24 AS INTEGER) AS hour, pressure, temp FROM city_series")]) + "\nUNION ALL\n".join([
        _measure("drivers", "gender", src="d"), _measure("drivers", "driving_style", src="d"),
        _measure("trucks", "fuel_type", "load_capacity_pounds", "t"), _measure("routes", "route_id", "distance"),
        _measure("traffic", "route_id", "no_of_vehicles", "v"), _measure("traffic", "hour", "accident", "v"),
        _measure("city_weather", "city_id", "pressure", "c"), _measure("city_weather", "hour", "temp", "c"),
        _measure("routes_weather", "route_id", "temp", "readings")])

SQL["final_dataset"] = f"""
WITH f AS ({SQL["trip_features"]})
SELECT *, CAST(CAST(departure_date AS DATE) AS TIMESTAMP) AS departure_day FROM f"""

SQL["preview"] = "SELECT * FROM events ORDER BY event_id LIMIT 5"
