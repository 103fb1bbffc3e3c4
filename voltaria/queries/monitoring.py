"""Queries over KPI monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.config import MonitorConfig
from voltaria.operators import monitor as K
from voltaria.operators.ordered import Series
from voltaria.queries.inputs import episodes, metric_rows, weekly_decided
from voltaria.queries.registry import R, query, rounded, settle
from voltaria.queries.views_sql import with_views

KEYS = ["station_id", "metric"]

_DRIFT = """(SELECT station_id, metric, rows, "values", recent_mean, historical_mean, historical_std,
    CASE WHEN rows >= 50 AND "values" >= 8 AND historical_std >= 1e-8 THEN abs(recent_mean - historical_mean) / historical_std END AS z
  FROM (SELECT station_id, metric, count(*) AS rows, count(value) AS "values",
      avg(CASE WHEN k <= size THEN value END) AS recent_mean, avg(CASE WHEN k > size THEN value END) AS historical_mean,
      stddev_pop(CASE WHEN k > size THEN value END) AS historical_std
    FROM (SELECT *, greatest(count(value) OVER (PARTITION BY station_id, metric) // 4, 1) AS size,
        row_number() OVER (PARTITION BY station_id, metric, value IS NULL ORDER BY age) AS k
      FROM (SELECT *, row_number() OVER (PARTITION BY station_id, metric ORDER BY seq DESC) AS age FROM metrics) WHERE age <= 100)
    GROUP BY 1, 2))"""


@query("episode_metrics", with_views("SELECT * FROM episodes", "episodes"))
def episode_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return episodes(spark, sf)


@query(
    "episode_extras",
    with_views(
        """SELECT episode, congestion_rate, congestion_rate * congestion_rate * 10.0::DOUBLE AS wait_time_proxy,
          '{"station_id":' || station_id || '}' AS extra_json FROM episodes""",
        "episodes",
    ),
)
def episode_extras(spark: SparkSession, sf: str) -> DataFrame:
    """Without a utilization the congestion stands in for it; unknown columns become JSON text."""
    raw = episodes(spark, sf).select("episode", "station_id", "congestion_rate")
    return K.episode_metrics(raw).select("episode", "congestion_rate", "wait_time_proxy", "extra_json")


@query(
    "metric_history",
    with_views(
        "SELECT episode, revenue_gain_pct FROM (SELECT * FROM e ORDER BY episode DESC LIMIT 100)", "weekly_decided"
    ).replace(
        "\nSELECT episode",
        f""",
        e AS (SELECT CAST(epoch_us(ts) // 604800000000 AS BIGINT) AS episode, {R('avg(revenue_gain) * 100', 6)} AS revenue_gain_pct
          FROM weekly_decided GROUP BY 1)
        SELECT episode""",
        1,
    ),
)
def metric_history(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 100 weekly gains over all stations, oldest first."""
    week = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 604800).alias("episode")
    weekly = weekly_decided(spark, sf).groupBy(week).agg((F.avg("revenue_gain") * 100.0).alias("revenue_gain_pct"))
    return rounded(K.history(weekly, "revenue_gain_pct", 100), 6)


@query(
    "metric_drift",
    with_views(
        f"""SELECT station_id, metric, rows, "values", {R('recent_mean', 6)} AS recent_mean, {R('historical_mean', 6)} AS historical_mean,
          {R('historical_std', 5)} AS historical_std, {R('z', 5)} AS z_score, coalesce(z > 2.0::DOUBLE, false) AS drifted FROM {_DRIFT}""",
        "metrics",
    ),
)
def metric_drift(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(K.drift(metric_rows(spark, sf), KEYS).drop("latest"), 6, historical_std=5, z_score=5)


_TARGETS = {
    "revenue_gain_pct": 18.5,
    "utilization_rate": 0.75,
    "congestion_rate": 0.1,
    "wait_time_proxy": 1.0,
    "pricing_efficiency_score": 15.0,
}
_GAPS = f"""(SELECT t.metric, coalesce(c.current, 0) AS current, t.target, t.target - coalesce(c.current, 0) AS gap, t.weight
  FROM (VALUES {', '.join(f"('{m}', {v}::DOUBLE, {MonitorConfig().weights[m]}::DOUBLE)" for m, v in _TARGETS.items())}) t(metric, target, weight)
  LEFT JOIN (SELECT metric, avg(value) AS current FROM metrics GROUP BY 1) c ON t.metric = c.metric)"""


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    current = metric_rows(spark, sf).groupBy("metric").agg(F.avg("value").alias("value"))
    target = spark.createDataFrame(list(_TARGETS.items()), "metric string, value double")
    return K.feedback(current, target)


@query(
    "feedback_gaps",
    with_views(
        f"""SELECT metric, {R('current', 6)} AS current, target, {R('gap', 6)} AS gap, weight,
          CASE WHEN metric = 'revenue_gain_pct' AND gap > 0 THEN 'raise_revenue_gain'
            WHEN metric = 'congestion_rate' AND current > target THEN 'reduce_congestion'
            WHEN metric = 'utilization_rate' AND gap > 0.05 THEN 'improve_utilization' END AS recommendation FROM {_GAPS}""",
        "metrics",
    ),
)
def feedback_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return _gaps(spark, sf).withColumns({c: settle(c, 6) for c in ("current", "gap")})


@query("feedback_score", with_views(f"SELECT {R('greatest(100 - sum(abs(gap) * weight), 0)', 6)} AS overall_score FROM {_GAPS}", "metrics"))
def feedback_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(K.feedback_score(_gaps(spark, sf)), 6)


@query(
    "retrain_decisions",
    with_views(
        f"""SELECT d.station_id, bool_or(coalesce(z > 2.0::DOUBLE, false)) AS drifted,
          coalesce(bool_or(d.metric = 'revenue_gain_pct' AND latest < -5), false) AS gain_low,
          coalesce(bool_or(d.metric = 'congestion_rate' AND latest > 0.3), false) AS congestion_high,
          bool_or(coalesce(z > 2.0::DOUBLE, false)) OR coalesce(bool_or(d.metric = 'revenue_gain_pct' AND latest < -5), false)
            OR coalesce(bool_or(d.metric = 'congestion_rate' AND latest > 0.3), false) AS retrain
        FROM {_DRIFT} d LEFT JOIN (SELECT station_id, metric, arg_max(value, seq) AS latest FROM metrics GROUP BY 1, 2) l
          ON d.station_id = l.station_id AND d.metric = l.metric GROUP BY 1""",
        "metrics",
    ),
)
def retrain_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return K.should_retrain(metric_rows(spark, sf), ["station_id"])


@query(
    "metric_summary",
    with_views(
        f"""SELECT station_id, metric, count(value) AS "count", {R('avg(value)', 6)} AS mean, {R('stddev_samp(value)', 5)} AS std,
          {R('min(value)')} AS min, {R('max(value)')} AS max, {R('arg_max(value, seq)')} AS latest
        FROM (SELECT *, row_number() OVER (PARTITION BY station_id, metric ORDER BY seq DESC) AS age FROM metrics) WHERE age <= 100 GROUP BY 1, 2""",
        "metrics",
    ),
)
def metric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(K.metric_summary(metric_rows(spark, sf), KEYS), mean=6, std=5)


_FRAME = "(PARTITION BY station_id, metric ORDER BY seq ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
_LONG_FRAME = "(PARTITION BY station_id, metric ORDER BY seq ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING)"


@query(
    "metric_z_runs_documented",
    with_views(
        f"""SELECT station_id, metric, count(*) AS length, min(seq) AS start, max(seq) AS "end" FROM (
          SELECT *, sum(CASE WHEN high <> coalesce(before, false) THEN 1 ELSE 0 END) OVER (PARTITION BY station_id, metric ORDER BY seq) AS run FROM (
            SELECT *, lag(high) OVER (PARTITION BY station_id, metric ORDER BY seq) AS before FROM (
              SELECT station_id, metric, seq, coalesce(abs(round(value - m, 9) / nullif(round(s, 9), 0)) > 2.0::DOUBLE, false) AS high
              FROM (SELECT *, avg(value) OVER {_LONG_FRAME} AS m, stddev_pop(value) OVER {_LONG_FRAME} AS s FROM metrics))))
        WHERE high GROUP BY station_id, metric, run HAVING count(*) > 10""",
        "metrics",
    ),
)
def metric_z_runs_documented(spark: SparkSession, sf: str) -> DataFrame:
    """The rule as documented: more than 10 rows in turn beyond two standard deviations of the 100 rows before."""
    return K.z_runs(metric_rows(spark, sf), Series(keys=tuple(KEYS), by=("seq",)))


@query(
    "metric_z_runs",
    with_views(
        f"""SELECT station_id, metric, count(*) AS length, min(seq) AS start, max(seq) AS "end" FROM (
          SELECT *, sum(CASE WHEN high <> coalesce(before, false) THEN 1 ELSE 0 END) OVER (PARTITION BY station_id, metric ORDER BY seq) AS run FROM (
            SELECT *, lag(high) OVER (PARTITION BY station_id, metric ORDER BY seq) AS before FROM (
              SELECT station_id, metric, seq, coalesce(abs(round(value - m, 9) / nullif(round(s, 9), 0)) > 1.0::DOUBLE, false) AS high
              FROM (SELECT *, avg(value) OVER {_FRAME} AS m, stddev_pop(value) OVER {_FRAME} AS s FROM metrics))))
        WHERE high GROUP BY station_id, metric, run HAVING count(*) > 2""",
        "metrics",
    ),
)
def metric_z_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of at least three weeks beyond one standard deviation of the 20 weeks before."""
    return K.z_runs(metric_rows(spark, sf), Series(keys=tuple(KEYS), by=("seq",)), 1.0, 2, 20)
