"""Cleaning: session cleaning, missing-value strategies, outliers, scaling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaria.functions.scalar import hours_between
from voltaria.operators.ordered import Series, filled, interpolated, quantiles

STRATEGIES = ("interpolate", "ffill", "bfill", "median", "mean", "drop")
UNKNOWN = "UNKNOWN"


def interpolate_energy(df: DataFrame, series: Series) -> DataFrame:
    """kWh on the straight line between known sessions, not below 0."""
    return interpolated(df, series, ["kWhDelivered"]).withColumn(
        "kWhDelivered", F.when(F.col("kWhDelivered").isNotNull(), F.greatest("kWhDelivered", F.lit(0.0)))
    )


def fill_times(df: DataFrame, series: Series) -> DataFrame:
    """Carry the last known connection, disconnection and end-of-charge times forward."""
    return filled(df, series, [c for c in ("connectionTime", "disconnectTime", "doneChargingTime") if c in df.columns])


def drop_untimed(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[c for c in ("connectionTime", "disconnectTime") if c in df.columns])


def name_unknown_ids(df: DataFrame) -> DataFrame:
    ids = [c for c in ("stationID", "siteID") if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in ids})


def add_session_hours(df: DataFrame) -> DataFrame:
    return df.withColumn("session_duration_hours", hours_between(F.col("connectionTime"), F.col("disconnectTime")))


def keep_plausible(df: DataFrame, max_hours: float = 48.0, max_kwh: float | None = None) -> DataFrame:
    """Sessions of 0 to ``max_hours``, both ends included, and optionally of at most ``max_kwh``."""
    kept = df.where(F.col("session_duration_hours").between(0.0, max_hours))
    return kept if max_kwh is None else kept.where(F.col("kWhDelivered") <= max_kwh)


def clean_sessions(df: DataFrame, series: Series, max_hours: float = 48.0) -> DataFrame:
    """Fill energy and times, drop untimed rows, name unknown ids, drop copies, keep plausible durations."""
    return (
        df.transform(interpolate_energy, series)
        .transform(fill_times, series)
        .transform(drop_untimed)
        .transform(name_unknown_ids)
        .dropDuplicates()
        .transform(add_session_hours)
        .transform(keep_plausible, max_hours)
    )


def _numeric(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))]


def handle_missing(
    df: DataFrame, strategy: str = "interpolate", columns: Iterable[str] | None = None, series: Series | None = None
) -> DataFrame:
    """Fill or drop nulls. Row-order strategies need a series; median and mean touch numeric columns only."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown missing-value strategy {strategy!r}; choose from {STRATEGIES}")
    names = list(columns) if columns is not None else list(df.columns)
    if strategy == "drop":
        return df.dropna(subset=names)
    if strategy in ("median", "mean"):
        numeric = _numeric(df, names)
        if not numeric:
            return df
        if strategy == "median":
            medians = quantiles(df, numeric, [0.5])
            fills = {c: medians[c][0] for c in numeric}
        else:
            means = df.agg(F.struct(*[F.avg(c).alias(c) for c in numeric]).alias("m")).scalar()
            fills = {c: means[c] for c in numeric}
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), fills[c]) for c in numeric})
    if series is None:
        raise ValueError(f"strategy {strategy!r} depends on row order: pass a series")
    free = [c for c in names if c not in (*series.keys, *series.by)]
    if strategy == "interpolate":
        return interpolated(df, series, _numeric(df, free))
    return filled(df, series, free, backward=strategy == "bfill")


def flag_outliers(df: DataFrame, columns: Iterable[str], method: str = "iqr", threshold: float = 1.5) -> DataFrame:
    """Add ``is_outlier``: any column beyond the quartile fences, or beyond the z-score cut.

    A z-score threshold of 2 or less means 3. No row is removed.
    """
    names = _numeric(df, columns)
    if method not in ("iqr", "zscore"):
        raise ValueError(f"unknown outlier method {method!r}")
    flag = F.lit(False)
    if method == "iqr" and names:
        quartiles = quantiles(df, names, [0.25, 0.75])
        for c in names:
            low, high = quartiles[c][0], quartiles[c][1]
            margin = (high - low) * F.lit(float(threshold))
            flag = flag | F.coalesce((F.col(c) < low - margin) | (F.col(c) > high + margin), F.lit(False))
    elif names:
        cut = threshold if threshold > 2.0 else 3.0
        stats = df.agg(
            F.struct(*[f(c).alias(f"{c}_{k}") for c in names for k, f in (("avg", F.avg), ("std", F.stddev_samp))]).alias("s")
        ).scalar()
        for c in names:
            z = F.try_divide(F.col(c) - stats[f"{c}_avg"], stats[f"{c}_std"])
            flag = flag | F.coalesce(F.abs(z) > cut, F.lit(False))
    return df.withColumn("is_outlier", flag)


def outliers_only(flagged: DataFrame) -> DataFrame:
    return flagged.where("is_outlier")


def fit_scaler(df: DataFrame, columns: Iterable[str], method: str = "minmax") -> DataFrame:
    """``(column, shift, scale)``, one row per column; a constant column gets scale 1."""
    names = [c for c in columns if c in df.columns]
    if method == "minmax":
        shift, spread = F.min, lambda c: F.max(c) - F.min(c)
    elif method == "standard":
        shift, spread = F.avg, F.stddev_pop
    else:
        raise ValueError(f"unknown normalize method {method!r}")
    fitted = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), shift(c).cast("double").alias("shift"), spread(c).cast("double").alias("spread")).alias(c)
            for c in names
        ]
    )
    rows = fitted.select(F.inline(F.array(*[F.col(c) for c in names])))
    return rows.select("column", "shift", F.when(F.col("spread") == 0, 1.0).otherwise(F.col("spread")).alias("scale"))


def _params(fitted: DataFrame, columns: Iterable[str]) -> dict:
    packed = fitted.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("shift", "scale")))).alias("p")).scalar()
    return {c: packed[c] for c in columns}


def normalize(df: DataFrame, columns: Iterable[str], fitted: DataFrame) -> DataFrame:
    """Apply fitted parameters; nulls pass through."""
    names = [c for c in columns if c in df.columns]
    params = _params(fitted, names)
    return df.withColumns({c: F.try_divide(F.col(c) - params[c]["shift"], params[c]["scale"]) for c in names})


def inverse_normalize(df: DataFrame, columns: Iterable[str], fitted: DataFrame) -> DataFrame:
    """Undo :func:`normalize`; a column without fitted parameters is left as it is."""
    names = [c for c in columns if c in df.columns]
    params = _params(fitted, names)
    restored = {c: F.col(c) * params[c]["scale"] + params[c]["shift"] for c in names}
    return df.withColumns({c: F.when(params[c].isNull(), F.col(c)).otherwise(v) for c, v in restored.items()})


def session_summary(df: DataFrame, column: str = "kWhDelivered") -> DataFrame:
    """``(statistic, value)``: rows, columns and the describe figures of one numeric column."""
    q = quantiles(df, [column], [0.25, 0.5, 0.75])
    figures = df.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.lit(float(len(df.columns))).alias("columns"),
        F.count(column).cast("double").alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    ).withColumns({"25%": q[column][0], "50%": q[column][1], "75%": q[column][2]})
    return figures.unpivot([], figures.columns, "statistic", "value")


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)
