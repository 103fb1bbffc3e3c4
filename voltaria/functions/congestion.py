"""Congestion features: queue, density, a weighted score and a binary label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaria.config import CONGESTION_WEIGHTS
from voltaria.functions.demand import utilization_rate
from voltaria.functions.scalar import clip, ratio


def queue_length_proxy(occupancy: Column, capacity: Column) -> Column:
    return clip(occupancy - capacity, low=0.0)


def occupancy_density(occupancy: Column, area: Column) -> Column:
    return ratio(occupancy, area)


def congestion_label(utilization: Column, threshold: float = 0.8) -> Column:
    """1 above the threshold, else 0; a missing utilization is not congested."""
    return F.coalesce((utilization > threshold).cast("int"), F.lit(0))


def score_bounds(df: DataFrame, parts: Mapping[str, Column]) -> DataFrame:
    """One row with a struct of the least and largest value of each part."""
    ends = [f(c).alias(f"{name}_{kind}") for name, c in parts.items() for kind, f in (("min", F.min), ("max", F.max))]
    return df.agg(F.struct(*ends).alias("b"))


def congestion_score(
    df: DataFrame, parts: Mapping[str, str], weights: Mapping[str, float] = CONGESTION_WEIGHTS, held: Column | None = None
) -> Column:
    """Weighted sum of the min-max scaled parts in [0, 1].

    ``parts`` maps each weight's name to its column. The bounds are a column ``held`` by the rows, or else one
    scalar subquery over ``df``: a single row, whatever the size of the table.
    """
    zeroed = {name: F.coalesce(F.col(c), F.lit(0.0)) for name, c in parts.items()}
    bounds = score_bounds(df, zeroed).scalar() if held is None else held
    total = F.lit(0.0)
    for name, value in zeroed.items():
        low, high = bounds[f"{name}_min"], bounds[f"{name}_max"]
        scaled = F.when(high == low, F.lit(0.0)).otherwise(F.try_divide(value - low, high - low))
        total = total + F.lit(float(weights.get(name, CONGESTION_WEIGHTS[name]))) * scaled
    return clip(total, 0.0, 1.0)


def add_congestion_features(df: DataFrame, weights: Mapping[str, float] = CONGESTION_WEIGHTS, threshold: float = 0.8) -> DataFrame:
    """utilization_rate, queue_length_proxy, occupancy_density, congestion_score, congestion_label.

    A table without an area gets density 0; one without occupancy or capacity comes back unchanged.
    """
    if not {"occupancy", "capacity"} <= set(df.columns):
        return df
    occupancy, capacity = F.col("occupancy"), F.col("capacity")
    density = occupancy_density(occupancy, F.col("area")) if "area" in df.columns else F.lit(0.0)
    base = df.withColumns(
        {
            "utilization_rate": utilization_rate(occupancy, capacity),
            "queue_length_proxy": queue_length_proxy(occupancy, capacity),
            "occupancy_density": density,
        }
    )
    parts = {"utilization": "utilization_rate", "queue_proxy": "queue_length_proxy", "occupancy_density": "occupancy_density"}
    # One column for the subquery: each use of a scalar subquery would be planned on its own.
    bounds = score_bounds(base, {name: F.coalesce(F.col(c), F.lit(0.0)) for name, c in parts.items()})
    held = base.withColumn("_bounds", bounds.scalar())
    score = congestion_score(held, parts, weights, F.col("_bounds"))
    return held.withColumns(
        {"congestion_score": score, "congestion_label": congestion_label(F.col("utilization_rate"), threshold)}
    ).drop("_bounds")
