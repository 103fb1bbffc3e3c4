"""Demand features: utilization, charging duration, revenue, and their lags and rolling statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from voltaria.config import DEFAULT_LAGS, DEFAULT_WINDOWS
from voltaria.functions.scalar import clip, hours_between, ratio
from voltaria.operators.ordered import Rolling, Series, windowed


def utilization_rate(occupancy: Column, capacity: Column) -> Column:
    """Occupied share of the capacity in [0, 1]; 0 where either is missing or the capacity is 0."""
    return clip(F.coalesce(ratio(occupancy, capacity), F.lit(0.0)), 0.0, 1.0)


def revenue(volume: Column, price: Column) -> Column:
    return F.coalesce(volume * price, F.lit(0.0))


def revenue_per_kwh(revenue: Column, volume: Column) -> Column:
    return ratio(revenue, volume)


def charging_duration_hours(df: DataFrame, fallback: bool = False) -> Column:
    """Hours from plug-in to the end of charging, null when negative.

    The end is ``doneChargingTime`` if the table has that column, else ``disconnectTime``. With
    ``fallback`` a row without an end of charging uses its own ``disconnectTime``.
    """
    if "connectionTime" not in df.columns:
        raise KeyError("'connectionTime' column is required")
    ends = [c for c in ("doneChargingTime", "disconnectTime") if c in df.columns]
    if not ends:
        raise KeyError("need 'doneChargingTime' or 'disconnectTime'")
    end = F.coalesce(*[F.col(c) for c in ends]) if fallback else F.col(ends[0])
    hours = hours_between(F.col("connectionTime"), end)
    return F.when(hours >= 0, hours)


def lag_columns(columns: Iterable[str], lags: Iterable[int]) -> dict[str, Callable[[WindowSpec], Column]]:
    return {
        f"{c}_lag_{k}": (lambda w, c=c, k=k: F.lag(c, k).over(w)) for c in columns for k in lags
    }


def rolling_columns(
    df: DataFrame, columns: Iterable[str], windows: Iterable[int]
) -> tuple[dict[str, Callable[[WindowSpec], Column]], list[dict[str, Callable[[WindowSpec], Column]]]]:
    """``{c}_rolling_mean_{n}`` and ``{c}_rolling_std_{n}``, and the steps that must be made before them."""
    columns, windows = tuple(columns), tuple(windows)
    kinds = dict(df.dtypes)
    # Other types, such as decimals, keep the type that Spark gives their mean.
    merged = Rolling([c for c in columns if kinds[c] in ("double", "float", "int")], windows)
    made: dict[str, Callable[[WindowSpec], Column]] = {}
    for c in columns:
        for n in windows:
            if c in merged.columns:
                made[f"{c}_rolling_mean_{n}"] = lambda w, c=c, n=n: merged.mean(c, n)
                made[f"{c}_rolling_std_{n}"] = lambda w, c=c, n=n: merged.deviation(c, n)
            else:
                made[f"{c}_rolling_mean_{n}"] = lambda w, c=c, n=n: F.avg(c).over(w.rowsBetween(1 - n, 0))
                made[f"{c}_rolling_std_{n}"] = lambda w, c=c, n=n: F.stddev_samp(c).over(w.rowsBetween(1 - n, 0))
    return made, merged.steps


def add_lags(df: DataFrame, series: Series, columns: Iterable[str], lags: Iterable[int] = DEFAULT_LAGS) -> DataFrame:
    """``{c}_lag_{k}`` per column and lag; columns the table lacks are skipped."""
    lags = tuple(lags)
    return windowed(df, series, lag_columns([c for c in columns if c in df.columns], lags), back=max(lags))


def add_rolling(
    df: DataFrame, series: Series, columns: Iterable[str], windows: Iterable[int] = DEFAULT_WINDOWS
) -> DataFrame:
    """``{c}_rolling_mean_{n}`` and ``{c}_rolling_std_{n}`` over the last n rows, the current one included."""
    windows = tuple(windows)
    made, first = rolling_columns(df, [c for c in columns if c in df.columns], windows)
    return windowed(df, series, made, back=max(windows) - 1, first=first)


def add_future_targets(df: DataFrame, series: Series, columns: Iterable[str], horizon: int = 1) -> DataFrame:
    """``future_{c}``: the value ``horizon`` rows ahead, null at the end of each series."""
    made = {f"future_{c}": (lambda w, c=c: F.lead(c, horizon).over(w)) for c in columns}
    return windowed(df, series, made, ahead=horizon)


def add_row_demand(df: DataFrame) -> DataFrame:
    """The row-local demand features for which the table has the inputs."""
    have = set(df.columns)
    out = df
    if {"occupancy", "capacity"} <= have:
        out = out.withColumn("utilization_rate", utilization_rate(F.col("occupancy"), F.col("capacity")))
    if "connectionTime" in have:
        out = out.withColumn("charging_duration_hours", charging_duration_hours(df))
    if {"volume", "price"} <= have:
        out = out.withColumn("revenue", revenue(F.col("volume"), F.col("price")))
        out = out.withColumn("revenue_per_kwh", revenue_per_kwh(F.col("revenue"), F.col("volume")))
    return out


def add_demand_features(
    df: DataFrame,
    series: Series,
    lags: Iterable[int] = DEFAULT_LAGS,
    windows: Iterable[int] = DEFAULT_WINDOWS,
) -> DataFrame:
    """Row-local features, then every lag and rolling statistic in one window pass (one shuffle, one sort)."""
    out = add_row_demand(df)
    targets = [c for c in ("utilization_rate", "volume", "price", "revenue") if c in out.columns]
    if not targets:
        return out
    lags, windows = tuple(lags), tuple(windows)
    rolled, first = rolling_columns(out, targets, windows)
    return windowed(out, series, {**lag_columns(targets, lags), **rolled}, back=max(max(lags), max(windows) - 1), first=first)
