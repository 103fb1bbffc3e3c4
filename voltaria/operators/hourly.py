"""Hourly resampling of sessions and panels, and their unified series."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaria.operators.ordered import Series, interpolated, windowed

PANEL_METRICS = ("occupancy", "volume", "duration", "price")


def truncated(unit: str, ts: str) -> Column:
    return F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")


def with_empty_steps(df: DataFrame, ts: str = "ts", step: str = "1 hour") -> DataFrame:
    """Add a row for every step between the first and the last one, nulls elsewhere.

    ``df`` has one row per step at most. Each row emits the empty steps up to the next one, so the
    input is read once.
    """
    length = F.expr(f"INTERVAL {step}")
    ahead = windowed(df, Series(by=(ts,), bounded=True), {"_next": lambda w: F.lead(ts).over(w)}, ahead=1)
    steps = F.sequence(F.col(ts), F.coalesce(F.col("_next") - length, F.col(ts)), length)
    spread = ahead.withColumn("_step", F.explode(steps))
    values = [F.when(F.col("_step") == F.col(ts), F.col(c)).alias(c) for c in df.columns if c != ts]
    return spread.select(F.col("_step").alias(ts), *values)


def hourly_sessions(sessions: DataFrame) -> DataFrame:
    """Mean kWh, session count and mean hours per hour; an empty hour has count 0 and null means."""
    grouped = sessions.groupBy(truncated("hour", "connectionTime").alias("ts")).agg(
        F.avg("kWhDelivered").alias("acn_mean_kWh"),
        F.count("kWhDelivered").alias("acn_session_count"),
        F.avg("session_duration_hours").alias("acn_mean_session_hours"),
    )
    return with_empty_steps(grouped).withColumn("acn_session_count", F.coalesce("acn_session_count", F.lit(0)))


def step_means(panel: DataFrame, metrics: Iterable[str] = PANEL_METRICS) -> DataFrame:
    """Mean over the nodes per step, for every metric in one pass; nulls are skipped."""
    have = [m for m in metrics if m in panel.columns]
    return panel.groupBy("ts").agg(*[F.avg(m).alias(f"urbanev_mean_{m}") for m in have])


def hourly_panel_means(panel: DataFrame, metrics: Iterable[str] = PANEL_METRICS) -> DataFrame:
    """Hourly mean of the per-step means: a step counts once, however many nodes it has."""
    means = step_means(panel, metrics)
    names = [c for c in means.columns if c != "ts"]
    hourly = means.groupBy(truncated("hour", "ts").alias("ts")).agg(*[F.avg(c).alias(c) for c in names])
    return with_empty_steps(hourly)


def unified_hourly(sessions: DataFrame, panel: DataFrame, metrics: Iterable[str] = PANEL_METRICS) -> DataFrame:
    """Full outer join of both hourly series, gaps interpolated by row position.

    The input of the interpolation has one row per hour, not one per session or panel row.
    """
    joined = hourly_sessions(sessions).join(hourly_panel_means(panel, metrics), "ts", "full_outer")
    numbers = [c for c in joined.columns if c != "ts"]
    typed = joined.withColumns({c: F.col(c).cast("double") for c in numbers})
    return interpolated(typed, Series(by=("ts",), bounded=True), numbers)


def utilization_histogram(panel: DataFrame, utilization: str = "utilization_rate", width: float = 0.2) -> DataFrame:
    """``(bin, rows)`` over [0, 1] in equal bins; 1.0 belongs to the last one."""
    bins = round(1 / width)
    index = F.least(F.floor(F.col(utilization) * bins), F.lit(bins - 1)).cast("int")
    return panel.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
