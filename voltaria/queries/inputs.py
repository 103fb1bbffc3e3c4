"""Inputs that several registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.functions.demand import add_row_demand
from voltaria.operators import monitor as K
from voltaria.operators import tariff as X
from voltaria.plans.tariff_flow import decision_rows
from voltaria.sources import driver_views as V


def station_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Station panel with utilization and revenue."""
    return add_row_demand(V.station_panel(spark, sf))


def hourly_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly panel with utilization and revenue."""
    return add_row_demand(V.hourly_panel(spark, sf))


def weekly_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return decision_rows(V.station_panel(spark, sf), V.station_dim(spark, sf), V.STATION_SERIES)


def hourly_decisions(spark: SparkSession, sf: str) -> DataFrame:
    station = F.col("station_id")
    attributes = {"fast_count": station % 3, "count": F.lit(3), "cbd_flag": station % 5 == 0}
    return decision_rows(V.hourly_panel(spark, sf), attributes, V.STATION_SERIES)


def weekly_decided(spark: SparkSession, sf: str) -> DataFrame:
    return X.rule_actions(weekly_decisions(spark, sf))


def hourly_decided(spark: SparkSession, sf: str) -> DataFrame:
    return X.rule_actions(hourly_decisions(spark, sf))


def episodes(spark: SparkSession, sf: str) -> DataFrame:
    """One monitored episode per station and week, from the decided rows."""
    decided = weekly_decided(spark, sf)
    raw = decided.select(
        "ts",
        "station_id",
        F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 604800).alias("episode"),
        (F.col("revenue_gain") * 100.0).alias("revenue_gain_pct"),
        F.col("utilization").alias("utilization_rate"),
        (F.col("utilization") > 0.8).cast("double").alias("congestion_rate"),
        F.col("utilization").alias("mean_utilization"),
    )
    return K.episode_metrics(raw, ["ts", "station_id"]).select("ts", "station_id", "episode", *K.TRACKED)


def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    """``(station_id, seq, metric, value)``."""
    return K.long_metrics(episodes(spark, sf), ["station_id"])
