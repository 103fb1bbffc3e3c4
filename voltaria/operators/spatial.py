"""Neighbour features over an edge list, in the long form only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaria.operators.edges import met
from voltaria.session import broadcast_if_small

SPATIAL_COLUMNS = ("occupancy", "volume", "price", "utilization_rate")


def node_weights(edges: DataFrame) -> DataFrame:
    """Per node: number of neighbours and the sum of the inverse distances (0 or null distance: no weight)."""
    return edges.groupBy(F.col("src").alias("node_id")).agg(
        F.count(F.lit(1)).alias("degree"), F.sum(_inverse(F.col("dist"))).alias("weight")
    )


def _inverse(dist: Column) -> Column:
    return F.when(dist > 0, F.try_divide(F.lit(1.0), dist)).otherwise(F.lit(0.0))


def add_spatial_lags(
    panel: DataFrame, edges: DataFrame, columns: Iterable[str] = SPATIAL_COLUMNS, missing: str = "zero"
) -> DataFrame:
    """``{c}_spatial_lag`` (mean over neighbours) and ``{c}_spatial_lag_w`` (weighted by 1 / distance).

    ``missing="zero"`` counts an absent neighbour as 0 and keeps the full degree, right for counts;
    ``missing="skip"`` averages the neighbours that are present, right for prices and rates. A node
    without neighbours gets 0. All columns go through one edge join and one aggregation, whose partial
    step combines the contributions of a step before they are shuffled. Nodes with very many edges are dealt into chunks.
    """
    if missing not in ("zero", "skip"):
        raise ValueError(f"missing must be 'zero' or 'skip', not {missing!r}")
    names = [c for c in columns if c in panel.columns]
    if not names:
        return panel
    values = panel.select("ts", F.col("node_id").alias("dst"), *names)
    inverse = _inverse(F.col("dist"))

    def parts(c: str) -> list[Column]:
        present = F.col(c).isNotNull()
        return [
            F.sum(c).alias(f"{c}__sum"),
            F.sum(F.col(c) * inverse).alias(f"{c}__wsum"),
            F.count(c).alias(f"{c}__n"),
            F.sum(F.when(present, inverse)).alias(f"{c}__w"),
        ]

    around = (
        met(values, edges, "dst")
        .groupBy("ts", F.col("src").alias("node_id"))
        .agg(*[p for c in names for p in parts(c)])
    )
    joined = panel.join(around, ["ts", "node_id"], "left")
    if missing == "zero":
        joined = joined.join(broadcast_if_small(node_weights(edges)), "node_id", "left")

    def mean(total: str, by: Column) -> Column:
        return F.coalesce(F.try_divide(F.col(total), by.cast("double")), F.lit(0.0))

    made: dict[str, Column] = {}
    for c in names:
        plain, weighted = (F.col("degree"), F.col("weight")) if missing == "zero" else (F.col(f"{c}__n"), F.col(f"{c}__w"))
        made[f"{c}_spatial_lag"] = mean(f"{c}__sum", plain)
        made[f"{c}_spatial_lag_w"] = mean(f"{c}__wsum", weighted)
    return joined.select(*[F.col(c) for c in panel.columns], *[v.alias(n) for n, v in made.items()])


def station_capacity(info: DataFrame) -> DataFrame:
    """``(node_id, station_capacity)`` from the charger count of the dimension."""
    if "count" not in info.columns:
        raise KeyError(f"'count' column not found; have {info.columns}")
    return info.select("node_id", F.col("count").cast("double").alias("station_capacity"))


def neighbor_correlation(panel: DataFrame, edges: DataFrame, column: str = "volume") -> DataFrame:
    """``(src, dst, correlation)`` of two linked nodes' series over their common steps, each pair once.

    A series that does not change over these steps has no correlation: null.
    """
    pairs = edges.where(F.col("src") < F.col("dst")).select("src", "dst")
    left = panel.select("ts", F.col("node_id").alias("src"), F.col(column).alias("x"))
    right = panel.select("ts", F.col("node_id").alias("dst"), F.col(column).alias("y"))
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    spread = F.stddev_pop(F.when(both, F.col("x"))) * F.stddev_pop(F.when(both, F.col("y")))
    return (
        met(left, pairs, "src").join(right, ["ts", "dst"]).groupBy("src", "dst").agg(F.try_divide(F.covar_pop("x", "y"), spread).alias("correlation"))
    )
