"""Reporting tables: each is one aggregation over decided rows, sessions or predictions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaria.config import OFF_PEAK_HOURS, PEAK_HOURS, TariffConfig
from voltaria.functions.scalar import in_hour_ranges, ratio
from voltaria.operators.ordered import Series, quantiles, running_sum, windowed
from voltaria.session import broadcast_if_small


def kpi_summary(decided: DataFrame, region: str = "region", config: TariffConfig = TariffConfig()) -> DataFrame:
    """Revenue, load and efficiency figures per region and, with a null region, in total."""
    surge, low = F.col("utilization") > config.surge_threshold, F.col("utilization") < config.off_peak_threshold
    grouped = decided.rollup(region).agg(
        F.sum("revenue_new").alias("dynamic_revenue"),
        F.sum("revenue_baseline").alias("fixed_revenue"),
        F.avg("utilization").alias("mean_utilization"),
        F.avg(surge.cast("double")).alias("congestion_rate"),
        F.avg(low.cast("double")).alias("off_peak_rate"),
        F.sum("new_volume").alias("energy"),
    )
    gain = ratio(F.col("dynamic_revenue") - F.col("fixed_revenue"), F.col("fixed_revenue")) * 100.0
    return grouped.withColumns(
        {
            "revenue_gain_pct": gain,
            "pricing_efficiency": ratio(F.col("dynamic_revenue"), F.col("energy")),
            "wait_time_proxy": F.col("congestion_rate") * F.col("mean_utilization") * 10.0,
        }
    )


def cumulative_revenue(decided: DataFrame, ts: str = "ts") -> DataFrame:
    """Running fixed and dynamic revenue per day; the running sum sees one row per day."""
    daily = decided.groupBy(F.to_date(ts).alias("day")).agg(
        F.sum("revenue_baseline").alias("fixed"), F.sum("revenue_new").alias("dynamic")
    )
    return running_sum(
        daily, Series(by=("day",), bounded=True), {"fixed_total": F.col("fixed"), "dynamic_total": F.col("dynamic")}
    ).select("day", "fixed_total", "dynamic_total")


def tariff_band(utilization: Column, config: TariffConfig = TariffConfig()) -> Column:
    return (
        F.when(utilization > config.surge_threshold, "surge")
        .when(utilization < config.off_peak_threshold, "discount")
        .otherwise("normal")
    )


def utilization_by_hour(panel: DataFrame, ts: str = "ts") -> DataFrame:
    hourly = panel.groupBy(F.hour(ts).alias("hour")).agg(F.avg("utilization_rate").alias("mean_utilization"))
    return hourly.withColumn("band", tariff_band(F.round("mean_utilization", 9)))


def congestion_bands(panel: DataFrame) -> DataFrame:
    """Rows and share below 50 %, from 50 to 80 % and above 80 % utilization."""
    u = F.col("utilization_rate")
    band = F.when(u < 0.5, "below 50").when(u <= 0.8, "50 to 80").otherwise("above 80")
    total = panel.agg(F.count(F.lit(1))).scalar()
    counted = panel.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("share", ratio(F.col("rows"), total))


def latest_model_metrics(log: DataFrame, order: Iterable[str]) -> DataFrame:
    """Newest value per model and metric; ``order`` is unique within a model and metric."""
    return log.groupBy("model_name", "metric_name").agg(F.max_by("metric_value", F.struct(*order)).alias("metric_value"))


def forecast_with_interval(predictions: DataFrame, actuals: DataFrame, on: list[str], low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Actual, prediction and an interval from the residual quantiles of the whole table."""
    return with_interval(predictions.join(actuals, on), on, low, high)


def with_interval(rows: DataFrame, on: list[str], low: float = 0.05, high: float = 0.95) -> DataFrame:
    """:func:`forecast_with_interval` of rows that hold both ``actual`` and ``prediction``."""
    joined = rows.withColumn("residual", F.col("actual") - F.col("prediction"))
    q = quantiles(joined, ["residual"], [low, high])["residual"]
    return joined.select(
        *on, "actual", "prediction", (F.col("prediction") + q[0]).alias("lower"), (F.col("prediction") + q[1]).alias("upper")
    )


def weekday_hour_heatmap(panel: DataFrame, value: str = "volume", ts: str = "ts") -> DataFrame:
    """Mean value per weekday (rows) and hour (24 columns, named h00 to h23)."""
    keyed = panel.select(F.weekday(ts).alias("weekday"), F.hour(ts).alias("hour"), value)
    pivoted = keyed.groupBy("weekday").pivot("hour", list(range(24))).agg(F.avg(value))
    return pivoted.withColumnsRenamed({str(h): f"h{h:02d}" for h in range(24)})


def station_hour_congestion(panel: DataFrame, station: str = "station_id", ts: str = "ts") -> DataFrame:
    return panel.groupBy(station, F.hour(ts).alias("hour")).agg(
        F.avg("utilization_rate").alias("mean_utilization"),
        F.avg((F.col("utilization_rate") > 0.8).cast("double")).alias("congestion_rate"),
    )


def congestion_alerts(
    predictions: DataFrame, now: Column, hours: int = 4, threshold: float = 0.8, limit: int | None = None, station: str = "station_id", current: str | None = None
) -> DataFrame:
    """The likely congestions of the next hours with the advised action, the likeliest first; all, or the first ``limit``.

    The action is graded by probability; ``current`` names a column with the current utilization.
    """
    until = now + F.expr(f"INTERVAL {hours} HOURS")
    grade = F.when(F.col("probability") > 0.93, "surge +30%").when(F.col("probability") > 0.9, "surge +20%")
    action = grade.when(F.col("probability") > 0.84, "surge +10%").otherwise("monitor")
    now_at = [current] if current else []
    alerts = (
        predictions.where((F.col("ts") > now) & (F.col("ts") <= until) & (F.col("probability") > threshold))
        .select("ts", station, "probability", *now_at, action.alias("action"))
        .orderBy(F.desc("probability"), "ts", station)
    )
    return alerts if limit is None else alerts.limit(limit)


def price_over_time(decided: DataFrame, ts: str = "ts", config: TariffConfig = TariffConfig()) -> DataFrame:
    """Volume-weighted dynamic price per step beside the fixed one."""
    weighted = ratio(F.sum("revenue_new"), F.sum("new_volume"))
    return decided.groupBy(ts).agg(F.lit(config.baseline_price).alias("fixed_price"), weighted.alias("dynamic_price"))


def station_tariffs(decided: DataFrame, station: str = "station_id", ts: str = "ts") -> DataFrame:
    """The newest decision per station."""
    newest = F.max_by(F.struct("utilization", "current_price", "new_price", "name"), F.col(ts)).alias("row")
    return decided.groupBy(station).agg(F.max(ts).alias(ts), newest).select(station, ts, "row.*")


def revenue_by_hour(decided: DataFrame, ts: str = "ts") -> DataFrame:
    return decided.groupBy(F.hour(ts).alias("hour")).agg(
        F.sum("revenue_baseline").alias("fixed_revenue"), F.sum("revenue_new").alias("dynamic_revenue")
    )


def full_comparison(decided: DataFrame, ts: str = "ts", config: TariffConfig = TariffConfig()) -> DataFrame:
    """Ten figures as ``(metric, fixed, dynamic)``: one aggregation, then one row per figure."""
    h = F.hour(ts)
    peak, off = in_hour_ranges(h, PEAK_HOURS), in_hour_ranges(h, OFF_PEAK_HOURS)
    crowded = F.avg((F.col("utilization") > config.surge_threshold).cast("double"))
    load = F.avg("utilization")
    rows = F.count(F.lit(1)).cast("double")

    def both(name: str, fixed: Column, dynamic: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), fixed.cast("double").alias("fixed"), dynamic.cast("double").alias("dynamic"))

    base, new = F.col("revenue_baseline"), F.col("revenue_new")
    figures = F.array(
        both("total_revenue", F.sum(base), F.sum(new)),
        both("mean_price", F.lit(config.baseline_price), ratio(F.sum(new), F.sum("new_volume"))),
        both("peak_revenue", F.sum(F.when(peak, base)), F.sum(F.when(peak, new))),
        both("off_peak_revenue", F.sum(F.when(off, base)), F.sum(F.when(off, new))),
        both("mean_utilization", load, load),
        both("congestion_rate", crowded, crowded),
        both("wait_time_proxy", crowded * load * 10.0, crowded * load * 10.0),
        both("sessions", F.sum("occupancy"), F.sum("occupancy")),
        both("energy", F.sum("volume"), F.sum("new_volume")),
        both("revenue_per_session", ratio(F.sum(base), F.sum("occupancy")), ratio(F.sum(new), F.sum("occupancy"))),
    )
    return decided.agg(figures.alias("f"), rows.alias("_rows")).select(F.inline("f"))


def revenue_waterfall(decided: DataFrame, config: TariffConfig = TariffConfig()) -> DataFrame:
    """Revenue difference by tariff band; the bands add up to the total difference."""
    return decided.groupBy(tariff_band(F.col("utilization"), config).alias("band")).agg(
        F.sum(F.col("revenue_new") - F.col("revenue_baseline")).alias("revenue_delta"), F.count(F.lit(1)).alias("rows")
    )


def kpi_trend(metrics: DataFrame, series: Series, window: int = 10) -> DataFrame:
    """Each value beside the rolling mean of its series."""
    return windowed(
        metrics, series, {"rolling_mean": lambda w: F.avg("value").over(w.rowsBetween(1 - window, 0))}, back=window - 1
    )


def drift_table(drifts: DataFrame, keys: list[str]) -> DataFrame:
    """Current value, historical mean, z-score and status per metric."""
    status = F.when(F.col("drifted"), "drift").otherwise("stable")
    return drifts.select(*keys, F.col("latest").alias("current"), "historical_mean", "z_score", status.alias("status"))


def demand_response(changes: DataFrame, width: float = 0.05) -> DataFrame:
    """Mean volume change and mean elasticity per bucket of price change.

    ``price_pct`` and ``volume_pct`` are relative changes; buckets beyond +-30 % are open.
    """
    edge = round(0.3 / width)
    bucket = F.least(F.greatest(F.floor(F.round(F.col("price_pct"), 9) / width), F.lit(-edge - 1)), F.lit(edge)).cast("int")
    known = changes.where(F.col("price_pct").isNotNull() & F.col("volume_pct").isNotNull())
    return known.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("volume_pct").alias("mean_volume_pct"),
        F.avg(ratio(F.col("volume_pct"), F.col("price_pct"))).alias("mean_elasticity"),
    )


def loglog_elasticity(panel: DataFrame, by: str) -> DataFrame:
    """Slope of log volume over log price per group."""
    usable = panel.where((F.col("volume") > 0) & (F.col("price") > 0))
    return usable.groupBy(by).agg(F.regr_slope(F.ln("volume"), F.ln("price")).alias("elasticity"))


def map_table(panel: DataFrame, dimension: DataFrame, view: str = "utilization", station: str = "station_id") -> DataFrame:
    """One row per station with its dimension columns, the value and the bubble size of the chosen view (needs ``count``)."""
    chargers = F.col("count").cast("double")
    # What each view shows and how its bubbles are sized.
    views = {
        "utilization": (F.avg("utilization_rate"), chargers * 3.0),
        "revenue": (F.sum("revenue"), F.col("value") / 500.0),
        "congestion": (F.avg((F.col("utilization_rate") > 0.8).cast("double")), F.col("value") * 50.0),
        "capacity": (F.first(F.lit(0.0)), chargers * 2.0),
    }
    if view not in views:
        raise ValueError(f"unknown view {view!r}; choose from {tuple(views)}")
    value, size = views[view]
    rows = panel.groupBy(station).agg(value.alias("value")).join(broadcast_if_small(dimension, one_row_per_key=True), station)
    return (rows.withColumn("value", chargers) if view == "capacity" else rows).withColumn("size", size)


def top_districts(panel: DataFrame, value: str, node: str = "node_id", n: int = 10) -> DataFrame:
    """The n nodes with the highest mean value; a top-n with the id as tie-break."""
    ranked = panel.groupBy(node).agg(F.avg(value).alias("value")).withColumn("value", F.round("value", 6))
    return ranked.orderBy(F.desc("value"), node).limit(n)


def segment_compare(panel: DataFrame, segment: Column, name: str = "segment") -> DataFrame:
    return panel.groupBy(segment.alias(name)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("utilization_rate").alias("mean_utilization"),
        F.sum("volume").alias("volume"),
        F.sum("revenue").alias("revenue"),
    )


def off_peak_share(panel: DataFrame, ts: str = "ts", value: str = "volume") -> DataFrame:
    """Off-peak share of each day's volume."""
    off = in_hour_ranges(F.hour(ts), OFF_PEAK_HOURS)
    return panel.groupBy(F.to_date(ts).alias("day")).agg(
        ratio(F.coalesce(F.sum(F.when(off, F.col(value))), F.lit(0.0)), F.sum(value)).alias("off_peak_share")
    )


