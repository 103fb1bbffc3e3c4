"""Explicit schemas of the domain tables; nothing is inferred on read. Column names are fixed values of the files."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _REAL, _INT, _TIME = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()

SESSIONS = _struct(
    ("connectionTime", _TIME),
    ("disconnectTime", _TIME),
    ("doneChargingTime", _TIME),
    ("kWhDelivered", _REAL),
    ("stationID", _TEXT),
    ("siteID", _TEXT),
)

DISTRICTS = _struct(
    ("num", _INT),
    ("grid", _TEXT),
    ("count", _INT),
    ("fast_count", _INT),
    ("slow_count", _INT),
    ("area", _REAL),
    ("lon", _REAL),
    ("la", _REAL),
    ("CBD", _REAL),
    ("dynamic_pricing", _INT),
)

TIME_PARTS = _struct(*((part, _INT) for part in ("month", "day", "year", "hour", "minute", "second")))

AGENT_METRICS = _struct(
    ("timestamp", _TIME),
    ("agent_name", _TEXT),
    ("metric_name", _TEXT),
    ("metric_value", _REAL),
    ("metadata", _TEXT),
)

PRICING_DECISIONS = _struct(
    ("timestamp", _TIME),
    ("station_id", _TEXT),
    ("utilization", _REAL),
    ("baseline_price", _REAL),
    ("optimized_price", _REAL),
    ("price_delta", _REAL),
    ("revenue_old", _REAL),
    ("revenue_new", _REAL),
    ("revenue_gain_pct", _REAL),
    ("decision_source", _TEXT),
)

MODEL_PERFORMANCE = _struct(
    ("timestamp", _TIME),
    ("model_name", _TEXT),
    ("dataset_split", _TEXT),
    ("metric_name", _TEXT),
    ("metric_value", _REAL),
    ("hyperparams", _TEXT),
)

EPISODE_METRICS = _struct(
    ("timestamp", _TIME),
    ("episode", T.LongType()),
    ("revenue_gain_pct", _REAL),
    ("utilization_rate", _REAL),
    ("congestion_rate", _REAL),
    ("wait_time_proxy", _REAL),
    ("pricing_efficiency_score", _REAL),
    ("extra_json", _TEXT),
)
