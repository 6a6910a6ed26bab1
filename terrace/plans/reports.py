"""Report queries over the gold layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.temporal import asof_join

# The traces shown for a lap.
TRACE = ("speed", "throttle", "brake", "rpm", "n_gear", "drs", "x", "y", "z")


def lap_trace(
    telemetry: DataFrame,
    session_key: int,
    permanent_number: int,
    lap_number: int | Column,
    columns: Sequence[str | Column] = ("session_time", "distance", *TRACE),
) -> DataFrame:
    """All samples of one lap in time order."""
    lap = (
        (F.col("session_key") == session_key)
        & (F.col("permanent_number") == permanent_number)
        & (F.col("lap_number") == lap_number)
    )
    return telemetry.filter(lap).orderBy("session_time").select(*columns)


def sector_times(
    laps: DataFrame, session_key: int, permanent_number: int | Column
) -> DataFrame:
    """Sector times of every lap of one driver in one session."""
    mine = (F.col("session_key") == session_key) & (F.col("permanent_number") == permanent_number)
    return (
        laps.filter(mine)
        .orderBy("lap_number")
        .select("lap_number", "lap_time", "sector_1_time", "sector_2_time", "sector_3_time")
    )


def stint_panel(laps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Lap count, first and last lap, best and worst lap time per stint."""
    return laps.groupBy(*by).agg(
        F.count(F.lit(1)).alias("laps"),
        F.min("lap_number").alias("first_lap"),
        F.max("lap_number").alias("last_lap"),
        F.min("lap_time").alias("best_lap_time"),
        F.max("lap_time").alias("worst_lap_time"),
    )


def weather_at_laps(laps: DataFrame, weather: DataFrame) -> DataFrame:
    """Every lap with the latest weather sample at or before its start."""
    samples = weather.withColumnRenamed("session_time", "weather_time")
    return asof_join(laps, samples, ["session_key"], "lap_start_time", "weather_time")
