"""Raw tables to the stored processed tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from voltaria.config import DEFAULT_LAGS, DEFAULT_WINDOWS
from voltaria.functions.congestion import add_congestion_features
from voltaria.functions.demand import add_demand_features
from voltaria.functions.pricing import add_pricing_features
from voltaria.functions.temporal import add_temporal_features
from voltaria.operators.clean import clean_sessions
from voltaria.operators.ordered import Series
from voltaria.sources.panel import write_by_date


def panel_features(
    panel: DataFrame,
    series: Series,
    lags: Iterable[int] = DEFAULT_LAGS,
    windows: Iterable[int] = DEFAULT_WINDOWS,
) -> DataFrame:
    """Temporal, congestion, pricing and demand features of a panel; the row-order ones share one sort."""
    return (
        panel.transform(add_temporal_features)
        .transform(add_congestion_features)
        .transform(add_pricing_features, series)
        .transform(add_demand_features, series, lags, windows)
    )


def write_processed(sessions: DataFrame, session_series: Series, panel: DataFrame, panel_series: Series, root: str) -> dict[str, str]:
    """Write the cleaned sessions, the panel and its features by day; returns their paths."""
    paths = {name: f"{root}/{name}" for name in ("sessions", "panel", "features")}
    write_by_date(clean_sessions(sessions, session_series), paths["sessions"], "connectionTime", "overwrite")
    write_by_date(panel, paths["panel"], "ts", "overwrite")
    # The features start from the stored panel, not from what led to it.
    stored = panel.sparkSession.read.parquet(paths["panel"]).drop("date")
    write_by_date(panel_features(stored, panel_series), paths["features"], "ts", "overwrite")
    return paths
