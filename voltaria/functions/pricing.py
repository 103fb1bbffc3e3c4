"""Pricing features: changes, elasticity and price level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaria.functions.scalar import ratio
from voltaria.operators.ordered import Series, filled, windowed


def price_level(price: Column, baseline: float = 15.0) -> Column:
    return F.when(price < baseline, "discount").when(price > baseline, "surge").otherwise("normal")


def _change(now: str, before: str) -> Column:
    """Relative change; null from a zero base."""
    return ratio(F.col(now), F.col(before)) - F.lit(1.0)


def add_price_change(df: DataFrame, series: Series) -> DataFrame:
    """``price_change``: difference to the previous row."""
    return windowed(df, series, {"price_change": lambda w: F.col("price") - F.lag("price").over(w)}, back=1)


def add_pct_change(df: DataFrame, series: Series, column: str, name: str, periods: int = 1) -> DataFrame:
    """Relative change over ``periods`` rows; nulls take the last known value first."""
    padded = filled(df, series, {"_now": F.col(column)})
    made = windowed(padded, series, {"_before": lambda w: F.lag("_now", periods).over(w)}, back=periods)
    return made.withColumn(name, _change("_now", "_before")).drop("_now", "_before")


def elasticity(volume: Column, volume_before: Column, price: Column, price_before: Column) -> Column:
    """Relative volume change over relative price change.

    Null without a price change or without both changes. A price that starts at 0 is an unbounded
    change, so a bounded volume change over it gives 0.
    """
    volume_change = ratio(volume, volume_before) - F.lit(1.0)
    unbounded = (price_before == 0) & (price != 0)
    return F.when(unbounded, F.when(volume_change.isNotNull(), F.lit(0.0))).otherwise(
        ratio(volume_change, ratio(price, price_before) - F.lit(1.0))
    )


def add_demand_elasticity(df: DataFrame, series: Series, periods: int = 12) -> DataFrame:
    """``demand_elasticity`` over ``periods`` rows, both columns padded first."""
    padded = filled(df, series, {"_v": F.col("volume"), "_p": F.col("price")})
    lagged = windowed(
        padded,
        series,
        {"_v0": lambda w: F.lag("_v", periods).over(w), "_p0": lambda w: F.lag("_p", periods).over(w)},
        back=periods,
    )
    value = elasticity(F.col("_v"), F.col("_v0"), F.col("_p"), F.col("_p0"))
    return lagged.withColumn("demand_elasticity", value).drop("_v", "_p", "_v0", "_p0")


def add_pricing_features(df: DataFrame, series: Series, baseline: float = 15.0, periods: int = 12) -> DataFrame:
    """price_change, price_pct_change, price_level and, with a volume column, demand_elasticity.

    One padding pass and one lag pass share the same shuffle and sort.
    """
    if "price" not in df.columns:
        return df
    has_volume = "volume" in df.columns
    pads = {"_p": F.col("price"), **({"_v": F.col("volume")} if has_volume else {})}
    lags = {
        "price_change": lambda w: F.col("price") - F.lag("price").over(w),
        "_p1": lambda w: F.lag("_p").over(w),
    }
    if has_volume:
        lags["_v0"] = lambda w: F.lag("_v", periods).over(w)
        lags["_p0"] = lambda w: F.lag("_p", periods).over(w)
    out = windowed(filled(df, series, pads), series, lags, back=max(1, periods))
    out = out.withColumns(
        {"price_pct_change": _change("_p", "_p1"), "price_level": price_level(F.col("price"), baseline)}
    )
    if has_volume:
        out = out.withColumn("demand_elasticity", elasticity(F.col("_v"), F.col("_v0"), F.col("_p"), F.col("_p0")))
    return out.drop("_p", "_p1", "_v", "_v0", "_p0")
