"""End-to-end flows: panel to decisions, decisions to scenarios, scenarios to monitored KPIs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaria.config import TariffConfig
from voltaria.operators import tariff as X
from voltaria.operators.ordered import Series, windowed
from voltaria.session import broadcast_if_small


def decision_rows(panel: DataFrame, dimension: DataFrame | Mapping[str, Column], series: Series, station: str = "station_id") -> DataFrame:
    """Policy input: panel rows with the station's kind and a last-value demand forecast.

    The kind (``fast_count``, ``count``, ``cbd_flag``) is a table to join or expressions over the panel.

    ``fast_ratio`` is the share of fast chargers and ``cbd_flag`` 1 for a central station.
    """
    forecast = windowed(panel, series, {"predicted_demand": lambda w: F.coalesce(F.lag("volume").over(w), F.col("volume"))}, back=1)

    def kind(fast: Column, count: Column, central: Column) -> dict[str, Column]:
        return {"fast_ratio": F.try_divide(fast.cast("double"), count.cast("double")), "cbd_flag": central.cast("double")}

    if isinstance(dimension, Mapping):
        rows = forecast.withColumns(kind(dimension["fast_count"], dimension["count"], dimension["cbd_flag"]))
    else:
        made = kind(F.col("fast_count"), F.col("count"), F.col("cbd_flag"))
        table = dimension.select(station, *[c.alias(n) for n, c in made.items()])
        rows = forecast.join(broadcast_if_small(table, one_row_per_key=True), station)
    return rows.select(
        "ts",
        station,
        "occupancy",
        "capacity",
        "predicted_demand",
        F.col("price").alias("current_price"),
        F.hour("ts").cast("double").alias("hour"),
        "fast_ratio",
        "cbd_flag",
        "volume",
    )


def episode_kpis(decided: DataFrame, by: Iterable[str], config: TariffConfig = TariffConfig()) -> DataFrame:
    """One monitored episode per group: gain, utilization and congestion."""
    crowded = F.avg((F.col("utilization") > config.surge_threshold).cast("double")).alias("congestion_rate")
    return X.evaluate_policy(decided, by, [crowded]).select(
        *by, "revenue_gain_pct", F.col("mean_utilization").alias("utilization_rate"), "congestion_rate"
    )
