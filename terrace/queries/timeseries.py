"""Windows, gap filling, range and as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.skew import group_values
from terrace.operators.temporal import asof_join, fill_gaps, level_join, range_join, valid_to
from terrace.plans.reports import lap_trace as trace_of
from terrace.plans.reports import sector_times as sectors_of
from terrace.plans.reports import stint_panel as panel_of
from terrace.plans.reports import weather_at_laps as weather_of
from terrace.queries.base import query, stamp, table
from terrace.sources.buckets import write_bucketed
from terrace.sources.places import new_dir

_WINDOWS = """
WITH s AS (
  SELECT user_id, event_id AS window_id, ts AS start_ts,
         coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), ts + INTERVAL 7 DAY) AS valid_to
  FROM events WHERE event_type = 'signup')
"""


def _windows(events: DataFrame) -> DataFrame:
    """A window opens at each signup of a user and closes at the next one, or after a week."""
    signups = events.filter("event_type = 'signup'").select(
        "user_id",
        F.col("event_id").alias("window_id"),
        F.col("ts").alias("start_ts"),
        (F.col("ts") + F.expr("INTERVAL 7 DAYS")).alias("week_later"),
    )
    return valid_to(signups, ["user_id"], "start_ts", "start_ts", "week_later").drop("week_later")


@query(
    _WINDOWS
    + """
SELECT e.event_id, e.user_id, s.window_id,
       strftime(s.valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to
FROM events e LEFT JOIN s
  ON e.user_id = s.user_id AND e.ts >= s.start_ts AND e.ts < s.valid_to
"""
)
def range_join_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    windows = _windows(events)
    joined = range_join(
        events.select("event_id", "user_id", "ts"), windows, ["user_id"], "ts", "start_ts", "valid_to"
    )
    return joined.select("event_id", "user_id", "window_id", stamp("valid_to").alias("valid_to"))


@query(
    """
WITH s AS (
  SELECT user_id, event_id AS window_id, ts AS start_ts,
         ts + to_microseconds(CAST(round(value * 3600) AS BIGINT) * 1000000) AS end_ts
  FROM events WHERE event_type = 'purchase')
SELECT e.event_id, e.user_id, s.window_id
FROM events e LEFT JOIN s
  ON e.user_id = s.user_id AND e.ts >= s.start_ts AND e.ts < s.end_ts
"""
)
def range_join_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping windows: a purchase stays open one hour per unit of its value."""
    events = table(spark, sf_dir, "events")
    seconds = F.round(F.col("value") * 3600).cast("bigint")
    windows = events.filter("event_type = 'purchase'").select(
        "user_id",
        F.col("event_id").alias("window_id"),
        F.col("ts").alias("start_ts"),
        (F.col("ts") + F.make_dt_interval(secs=seconds)).alias("end_ts"),
    )
    joined = range_join(
        events.select("event_id", "user_id", "ts"), windows, ["user_id"], "ts", "start_ts", "end_ts"
    )
    return joined.select("event_id", "user_id", "window_id")


@query(
    _WINDOWS
    + """
SELECT e.event_id, e.user_id,
       CASE WHEN e.ts < s.valid_to THEN s.window_id END AS window_id,
       CASE WHEN e.ts < s.valid_to THEN strftime(s.valid_to, '%Y-%m-%d %H:%M:%S.%f') END AS valid_to
FROM events e ASOF LEFT JOIN s ON e.user_id = s.user_id AND e.ts >= s.start_ts
"""
)
def asof_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    joined = asof_join(
        events.select("event_id", "user_id", "ts"),
        _windows(events),
        ["user_id"],
        "ts",
        "start_ts",
        "valid_to",
    )
    return joined.select("event_id", "user_id", "window_id", stamp("valid_to").alias("valid_to"))


def _intervals(orders: DataFrame) -> DataFrame:
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("double")
    key = F.col("o_orderkey")
    return orders.select(
        "o_custkey",
        "o_orderkey",
        F.when(key % 3 != 0, day).alias("start_at"),
        F.when(key % 5 != 0, day + key % 7).alias("end_at"),
        F.when(key % 11 != 0, (key % 7).cast("double")).alias("length"),
    )


@query(
    """
WITH o AS (
  SELECT o_custkey, o_orderkey,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS d
  FROM orders),
i AS (
  SELECT o_custkey, o_orderkey,
         CASE WHEN o_orderkey % 3 <> 0 THEN d END AS s,
         CASE WHEN o_orderkey % 5 <> 0 THEN d + o_orderkey % 7 END AS e,
         CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 7 AS DOUBLE) END AS n
  FROM o),
w AS (
  SELECT *, lag(e) OVER k AS prev_end, lead(s) OVER k AS next_start
  FROM i WINDOW k AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, o_orderkey, n AS length,
       coalesce(s, prev_end, e - n) AS start_at,
       coalesce(e, next_start, s + n) AS end_at,
       s IS NULL AND coalesce(s, prev_end, e - n) IS NOT NULL AS is_start_at_estimated,
       e IS NULL AND coalesce(e, next_start, s + n) IS NOT NULL AS is_end_at_estimated
FROM w
"""
)
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _intervals(table(spark, sf_dir, "orders"))
    return fill_gaps(rows, ["o_custkey"], "o_orderkey", "start_at", "end_at", "length")


@query(
    """
SELECT l_orderkey, l_linenumber, max_line,
       l_linenumber = max_line AS is_last_line,
       CASE WHEN l_linenumber = max_line THEN l_extendedprice END AS last_price
FROM (SELECT *, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS max_line FROM lineitem)
"""
)
def max_flag_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group's maximum on every row, a flag against it, and a measure only where it holds."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    last = F.col("l_linenumber") == F.col("max_line")
    return group_values(lines, ["l_orderkey"], {"max_line": ("max", "l_linenumber")}).select(
        "l_orderkey",
        "l_linenumber",
        "max_line",
        last.alias("is_last_line"),
        F.when(last, F.col("l_extendedprice")).alias("last_price"),
    )


_LAPS = """
WITH e AS (SELECT *, epoch_us(ts) / 1e6 AS t FROM events),
laps AS (
  SELECT user_id, event_id, t AS lap_start_time,
         lead(t) OVER (PARTITION BY user_id ORDER BY ts) AS lap_end_time,
         row_number() OVER (PARTITION BY user_id ORDER BY ts) AS lap_number,
         value AS lap_time
  FROM e WHERE event_type = 'signup')
"""


def _seconds(c: str):
    return F.unix_micros(F.col(c).cast("timestamp")) / 1e6


def _laps(events: DataFrame) -> DataFrame:
    """Gold-shaped laps: the signups of a user, numbered by their order in time."""
    signups = events.filter("event_type = 'signup'").select(
        F.col("user_id").alias("session_key"),
        F.lit(1).alias("permanent_number"),
        F.col("event_id").alias("lap_number"),
        _seconds("ts").alias("lap_start_time"),
        F.col("value").alias("lap_time"),
    )
    keys = ["session_key", "permanent_number"]
    return valid_to(signups, keys, "lap_start_time", "lap_start_time", name="lap_end_time")


@query(
    _LAPS
    + """
SELECT e.event_id, e.t - l.lap_start_time AS into_lap, e.value AS speed, e.event_type AS gear
FROM e JOIN laps l ON e.user_id = l.user_id AND e.t >= l.lap_start_time
  AND (l.lap_end_time IS NULL OR e.t < l.lap_end_time)
WHERE l.user_id = 7 AND l.event_id = (SELECT max(event_id) FROM laps WHERE user_id = 7)
"""
)
def lap_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of one lap (the last one of user 7), in time order."""
    events = table(spark, sf_dir, "events")
    samples = events.select(
        "event_id",
        F.col("user_id").alias("session_key"),
        F.lit(1).alias("permanent_number"),
        _seconds("ts").alias("session_time"),
        F.col("value").alias("speed"),
        F.col("event_type").alias("gear"),
    )
    on = ["session_key", "permanent_number"]
    laps = _laps(events).select(*on, "lap_number", "lap_start_time")
    # Only the session asked for goes into the join.
    asked = F.col("session_key") == 7
    gold = asof_join(samples.filter(asked), laps.filter(asked), on, "session_time", "lap_start_time")
    mine = events.filter("user_id = 7 AND event_type = 'signup'")
    lap = mine.agg(F.max("event_id")).scalar()
    into = (F.col("session_time") - F.col("lap_start_time")).alias("into_lap")
    return trace_of(gold, 7, 1, lap, ["event_id", into, "speed", "gear"])


@query(
    """
SELECT CAST(year(l_shipdate) AS INTEGER) AS season, l_returnflag AS compound, l_linestatus = 'F' AS fresh_tyre,
       count(*) AS laps, min(l_linenumber) AS first_lap, max(l_linenumber) AS last_lap,
       min(l_quantity) AS best_lap_time, max(l_quantity) AS worst_lap_time
FROM lineitem GROUP BY ALL
"""
)
def stint_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laps per stint: how many, which, and the best and worst of them."""
    laps = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("season"),
        F.col("l_returnflag").alias("compound"),
        (F.col("l_linestatus") == "F").alias("fresh_tyre"),
        F.col("l_linenumber").alias("lap_number"),
        F.col("l_quantity").alias("lap_time"),
    )
    return panel_of(laps, ["season", "compound", "fresh_tyre"])


@query(
    """
SELECT l_linenumber AS lap_number, l_quantity AS lap_time, l_discount AS sector_1_time, l_tax AS sector_2_time,
       l_extendedprice AS sector_3_time
FROM lineitem
WHERE l_suppkey = 1 AND l_partkey = (SELECT max(l_partkey) FROM lineitem WHERE l_suppkey = 1)
"""
)
def sector_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap and sector times of one driver (the last part) in one session (the supplier)."""
    lines = table(spark, sf_dir, "lineitem")
    laps = lines.select(
        F.col("l_suppkey").alias("session_key"),
        F.col("l_partkey").alias("permanent_number"),
        F.col("l_linenumber").alias("lap_number"),
        F.col("l_quantity").alias("lap_time"),
        F.col("l_discount").alias("sector_1_time"),
        F.col("l_tax").alias("sector_2_time"),
        F.col("l_extendedprice").alias("sector_3_time"),
    )
    driver = lines.filter("l_suppkey = 1").agg(F.max("l_partkey")).scalar()
    return sectors_of(laps, 1, driver)


@query(
    _LAPS
    + """
SELECT l.user_id AS session_key, l.event_id AS lap_number, w.value AS air_temp, w.event_id AS weather_id
FROM laps l ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'view') w
  ON l.user_id = w.user_id AND l.lap_start_time >= w.t
"""
)
def weather_at_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather sample that was current when each lap began."""
    events = table(spark, sf_dir, "events")
    weather = events.filter("event_type = 'view'").select(
        F.col("user_id").alias("session_key"),
        _seconds("ts").alias("session_time"),
        F.col("value").alias("air_temp"),
        F.col("event_id").alias("weather_id"),
    )
    laps = _laps(events).select("session_key", "lap_number", "lap_start_time")
    return weather_of(laps, weather).select("session_key", "lap_number", "air_temp", "weather_id")


_MIXED = """
WITH w AS (
  SELECT user_id, event_id AS window_id, ts AS start_ts,
         ts + to_microseconds((10 ^ (event_id % 8))::BIGINT * 100000) AS end_ts
  FROM events WHERE event_type <> 'view')
"""


@query(
    _MIXED
    + """
SELECT e.event_id, e.user_id, w.window_id FROM events e LEFT JOIN w
  ON e.user_id = w.user_id AND e.ts >= w.start_ts AND e.ts < w.end_ts
"""
)
def range_join_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows from a tenth of a second to eleven days: events find those of all lengths."""
    events = table(spark, sf_dir, "events")
    power = F.pow(F.lit(10), F.col("event_id") % 8).cast("bigint")
    windows = events.filter("event_type <> 'view'").select(
        "user_id", F.col("event_id").alias("window_id"), F.col("ts").alias("start_ts"), (power * 100_000).alias("length")
    )
    end = F.col("start_ts") + F.make_dt_interval(secs=(F.col("length") / 1_000_000).cast("decimal(18,6)"))
    windows = windows.withColumn("end_ts", end).drop("length")
    joined = level_join(events.select("event_id", "user_id", "ts"), windows, ["user_id"], "ts", "start_ts", "end_ts")
    return joined.select("event_id", "user_id", "window_id")


BUCKETS = 16


@query(
    """
WITH o AS (
  SELECT o_custkey, o_orderkey,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS d
  FROM orders),
i AS (
  SELECT o_custkey, o_orderkey,
         CASE WHEN o_orderkey % 3 <> 0 THEN d END AS s,
         CASE WHEN o_orderkey % 5 <> 0 THEN d + o_orderkey % 7 END AS e,
         CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 7 AS DOUBLE) END AS n
  FROM o),
w AS (
  SELECT *, lag(e) OVER k AS prev_end, lead(s) OVER k AS next_start
  FROM i WINDOW k AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, c_mktsegment, o_orderkey, n AS length,
       coalesce(s, prev_end, e - n) AS start_at,
       coalesce(e, next_start, s + n) AS end_at,
       s IS NULL AND coalesce(s, prev_end, e - n) IS NOT NULL AS is_start_at_estimated,
       e IS NULL AND coalesce(e, next_start, s + n) IS NOT NULL AS is_end_at_estimated
FROM w JOIN customer ON c_custkey = o_custkey
"""
)
def bucketed_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals and customers in buckets by customer: gaps are filled and customers joined
    without a shuffle."""
    intervals = write_bucketed(_intervals(table(spark, sf_dir, "orders")), new_dir(spark, "intervals"), ["o_custkey"], BUCKETS)
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    customers = write_bucketed(customers, new_dir(spark, "customers"), ["o_custkey"], BUCKETS)
    filled = fill_gaps(intervals, ["o_custkey"], "o_orderkey", "start_at", "end_at", "length")
    return filled.join(customers, "o_custkey")
