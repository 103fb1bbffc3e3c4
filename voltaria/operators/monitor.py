"""KPI monitoring: episode tracking, history, drift, feedback and retraining."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaria.config import MonitorConfig
from voltaria.operators.ordered import Rolling, Series, in_one_go, running_sum, windowed

# The tracked metrics.
TRACKED = ("revenue_gain_pct", "utilization_rate", "congestion_rate", "wait_time_proxy", "pricing_efficiency_score")


def episode_metrics(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """Episode rows with the missing figures derived and unknown columns packed as JSON text.

    Efficiency is gain / (congestion + 1); wait is congestion x utilization x 10, with congestion in
    place of a missing utilization.
    """
    kept = [*keys, "timestamp", "episode"]
    known = {*TRACKED, *kept}
    have = set(df.columns)
    extras = [c for c in df.columns if c not in known]

    def of(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("double")

    congestion = of("congestion_rate")
    load = F.coalesce(of("mean_utilization"), congestion)
    return df.select(
        *[c for c in kept if c in have],
        of("revenue_gain_pct").alias("revenue_gain_pct"),
        of("utilization_rate").alias("utilization_rate"),
        congestion.alias("congestion_rate"),
        F.coalesce(of("wait_time_proxy"), congestion * load * 10.0).alias("wait_time_proxy"),
        F.coalesce(of("pricing_efficiency_score"), of("revenue_gain_pct") / (congestion + 1.0)).alias(
            "pricing_efficiency_score"
        ),
        (F.to_json(F.struct(*extras)) if extras else F.lit(None).cast("string")).alias("extra_json"),
    )


def require_metric(metric: str) -> None:
    if metric not in TRACKED:
        raise ValueError(f"unknown metric {metric!r}; choose from {TRACKED}")


def long_metrics(episodes: DataFrame, keys: Iterable[str] = (), seq: str = "episode") -> DataFrame:
    """``(keys..., seq, metric, value)`` of the tracked metrics."""
    have = [m for m in TRACKED if m in episodes.columns]
    return episodes.select(*keys, F.col(seq).alias("seq"), *have).unpivot([*keys, "seq"], have, "metric", "value")


def history(episodes: DataFrame, metric: str, n: int = 100, seq: str = "episode") -> DataFrame:
    """The newest ``n`` values of a metric, oldest first; a top-n and not a full sort."""
    require_metric(metric)
    stamp = ["timestamp"] if "timestamp" in episodes.columns else []
    return episodes.select(seq, *stamp, metric).orderBy(F.desc(seq)).limit(n).orderBy(seq)


def newest(metrics: DataFrame, keys: list[str], window: int) -> DataFrame:
    """The newest rows of each group, numbered from the newest; Spark prunes by rank before the shuffle."""
    recent = Window.partitionBy(*keys).orderBy(F.desc("seq"))
    return metrics.withColumn("_age", F.row_number().over(recent)).where(F.col("_age") <= window)


def drift(metrics: DataFrame, keys: Iterable[str] = ("metric",), config: MonitorConfig = MonitorConfig()) -> DataFrame:
    """Per group: recent and historical mean, z-score, ``drifted`` and the latest known value.

    Of the newest ``window`` rows, the latest quarter of the known values is compared with the rest
    (population std). Too few rows, too few values or a flat history is no drift. All steps share the
    shuffle of the first, which carries at most ``window`` rows per group and task.
    """
    by = list(keys)
    last = newest(metrics, by, config.window)
    group = Window.partitionBy(*by)
    known = F.col("value").isNotNull()
    size = F.greatest(F.floor(F.count("value").over(group) / 4), F.lit(1))
    recent = known & (F.count("value").over(group.orderBy("_age").rowsBetween(Window.unboundedPreceding, 0)) <= size)
    stats = last.withColumn("_recent", recent).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("values"),
        F.max_by(F.when(known, F.col("value")), F.when(known, F.col("seq"))).alias("latest"),
        F.avg(F.when(F.col("_recent"), F.col("value"))).alias("recent_mean"),
        F.avg(F.when(~F.col("_recent"), F.col("value"))).alias("historical_mean"),
        F.stddev_pop(F.when(~F.col("_recent"), F.col("value"))).alias("historical_std"),
    )
    enough = (F.col("rows") >= config.window // 2) & (F.col("values") >= config.min_values)
    moving = F.col("historical_std") >= config.min_std
    z = F.when(
        enough & moving, F.try_divide(F.abs(F.col("recent_mean") - F.col("historical_mean")), F.col("historical_std"))
    )
    return stats.withColumn("z_score", z).withColumn("drifted", F.coalesce(F.col("z_score") > config.z_threshold, F.lit(False)))


def feedback(current: DataFrame, target: DataFrame, config: MonitorConfig = MonitorConfig()) -> DataFrame:
    """``(metric, current, target, gap, recommendation, weight)`` per target; a missing current value is 0."""
    now = current.select("metric", F.col("value").alias("current"))
    goal = target.select("metric", F.col("value").alias("target"))
    joined = goal.join(now, "metric", "left").withColumn("current", F.coalesce("current", F.lit(0.0)))
    weight = F.lit(config.default_weight)
    for name, value in config.weights.items():
        weight = F.when(F.col("metric") == name, F.lit(value)).otherwise(weight)
    gap = F.col("target") - F.col("current")
    advice = (
        F.when((F.col("metric") == "revenue_gain_pct") & (gap > 0), "raise_revenue_gain")
        .when((F.col("metric") == "congestion_rate") & (F.col("current") > F.col("target")), "reduce_congestion")
        .when((F.col("metric") == "utilization_rate") & (gap > 0.05), "improve_utilization")
    )
    return joined.select("metric", "current", "target", gap.alias("gap"), advice.alias("recommendation"), weight.alias("weight"))


def feedback_score(gaps: DataFrame) -> DataFrame:
    """``overall_score``: 100 less the weighted absolute gaps, not below 0."""
    lost = F.sum(F.abs(F.col("gap")) * F.col("weight"))
    return gaps.agg(F.greatest(F.lit(100.0) - lost, F.lit(0.0)).alias("overall_score"))


def latest_values(metrics: DataFrame, keys: Iterable[str] = ("metric",)) -> DataFrame:
    """The newest known value per group."""
    known = metrics.where(F.col("value").isNotNull())
    return known.groupBy(*keys).agg(F.max_by("value", "seq").alias("value"))


def should_retrain(
    metrics: DataFrame, keys: Iterable[str] = (), config: MonitorConfig = MonitorConfig()
) -> DataFrame:
    """Per group: ``drifted`` on any metric, ``gain_low``, ``congestion_high`` and their union ``retrain``."""
    by = list(keys)
    drifts = drift(metrics, [*by, "metric"], config)
    low = (F.col("metric") == "revenue_gain_pct") & (F.col("latest") < config.min_revenue_gain)
    high = (F.col("metric") == "congestion_rate") & (F.col("latest") > config.max_congestion_rate)
    checks = drifts.groupBy(*by).agg(
        F.bool_or("drifted").alias("drifted"),
        F.coalesce(F.bool_or(low), F.lit(False)).alias("gain_low"),
        F.coalesce(F.bool_or(high), F.lit(False)).alias("congestion_high"),
    )
    return checks.withColumn("retrain", F.col("drifted") | F.col("gain_low") | F.col("congestion_high"))


def metric_summary(metrics: DataFrame, keys: Iterable[str] = ("metric",), window: int | None = 100) -> DataFrame:
    """count, mean, sample std, min, max and latest of the newest values of each group."""
    by = list(keys)
    kept = metrics if window is None else newest(metrics, by, window)
    known = kept.where(F.col("value").isNotNull())
    return known.groupBy(*by).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.max_by("value", "seq").alias("latest"),
    )


def z_runs(metrics: DataFrame, series: Series, threshold: float = 2.0, longer_than: int = 10, window: int = 100) -> DataFrame:
    """Runs of consecutive rows whose z-score against the preceding ``window`` rows exceeds the threshold.

    Gaps and islands: a row opens a new run where the flag differs from the row before, the running sum
    of openings numbers the runs, and runs of flagged rows longer than ``longer_than`` are returned.
    """
    keys = list(series.keys)
    past = Rolling(["value"], [window], behind=1)

    def numbered(rows: DataFrame, series: Series) -> DataFrame:
        means = {"_mean": lambda w: past.mean("value", window), "_std": lambda w: past.deviation("value", window, 0)}
        scored = windowed(rows, series, means, back=window, first=past.steps)
        z = F.abs(F.try_divide(F.round(F.col("value") - F.col("_mean"), 9), F.round(F.col("_std"), 9)))
        flagged = scored.withColumn("_high", F.coalesce(z > threshold, F.lit(False))).drop("value", "_mean", "_std")
        opened = windowed(
            flagged,
            series,
            {"_open": lambda w: (F.col("_high") != F.coalesce(F.lag("_high").over(w), F.lit(False))).cast("int")},
            back=1,
        )
        return running_sum(opened, series, {"_run": F.col("_open")}).where("_high")

    runs = in_one_go(metrics, series, numbered)
    return (
        runs.groupBy(*keys, "_run")
        .agg(F.count(F.lit(1)).alias("length"), F.min(series.by[0]).alias("start"), F.max(series.by[0]).alias("end"))
        .where(F.col("length") > longer_than)
        .drop("_run")
    )
