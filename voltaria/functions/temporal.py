"""Calendar features of a timestamp column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaria.config import OFF_PEAK_HOURS, PEAK_HOURS
from voltaria.functions.scalar import in_hour_ranges, parse_timestamp


def hour(ts: Column) -> Column:
    return F.hour(ts)


def weekday(ts: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(ts)


def weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def peak_period(ts: Column, ranges: list[tuple[int, int]] = PEAK_HOURS) -> Column:
    return in_hour_ranges(F.hour(ts), ranges)


def off_peak_period(ts: Column, ranges: list[tuple[int, int]] = OFF_PEAK_HOURS) -> Column:
    return in_hour_ranges(F.hour(ts), ranges)


def time_slot(ts: Column) -> Column:
    """Part of day; the cuts at 6, 12, 17 and 21 h are this package's choice."""
    h = F.hour(ts)
    return (
        F.when((h >= 6) & (h < 12), "morning")
        .when((h >= 12) & (h < 17), "afternoon")
        .when((h >= 17) & (h < 21), "evening")
        .otherwise("night")
    )


def hour_angle(hour: Column) -> Column:
    return hour.cast("double") * F.lit(2.0 * math.pi) / F.lit(24.0)


def weekday_share(ts: Column) -> Column:
    """Weekday scaled to [0, 1]."""
    return F.weekday(ts).cast("double") / F.lit(6.0)


def add_temporal_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """hour, weekday, weekend, peak_period and off_peak_period of column ``ts``."""
    if ts not in df.columns:
        raise KeyError(f"column '{ts}' not found; have {df.columns}")
    if isinstance(df.schema[ts].dataType, T.StringType):
        df = df.withColumn(ts, parse_timestamp(F.col(ts)))
    at = F.col(ts)
    return df.withColumns(
        {
            "hour": hour(at),
            "weekday": weekday(at),
            "weekend": weekend(at),
            "peak_period": F.coalesce(peak_period(at), F.lit(False)),
            "off_peak_period": F.coalesce(off_peak_period(at), F.lit(False)),
        }
    )


def add_calendar_extras(df: DataFrame, ts: str = "ts") -> DataFrame:
    """time_slot and month."""
    return df.withColumns({"time_slot": time_slot(F.col(ts)), "month": F.month(ts)})


def add_cyclic_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """hour_sin, hour_cos and the scaled weekday."""
    angle = hour_angle(F.hour(ts))
    return df.withColumns(
        {"hour_sin": F.sin(angle), "hour_cos": F.cos(angle), "weekday_norm": weekday_share(F.col(ts))}
    )
