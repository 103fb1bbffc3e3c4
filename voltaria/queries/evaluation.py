"""Queries over the evaluation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.functions.congestion import congestion_label
from voltaria.functions.scalar import hours_between
from voltaria.operators import clean as C
from voltaria.operators import metrics as M
from voltaria.operators.ordered import windowed
from voltaria.queries.inputs import station_rows, weekly_decided
from voltaria.queries.registry import R, query, rounded
from voltaria.queries.views_sql import clip_util, with_views
from voltaria.sources import driver_views as V

_NEXT_LABEL = f"""(SELECT label, score, CASE WHEN score > 0.8::DOUBLE THEN 1 ELSE 0 END AS predicted FROM (
    SELECT CASE WHEN u > 0.8::DOUBLE THEN 1 ELSE 0 END AS label, lag(u) OVER (PARTITION BY station_id ORDER BY ts) AS score
    FROM (SELECT ts, station_id, {clip_util()} AS u FROM station_panel)) WHERE score IS NOT NULL)"""


def next_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Congestion label with last week's utilization as the score and its label as the prediction."""
    rows = station_rows(spark, sf).select("ts", "station_id", "utilization_rate")
    scored = windowed(rows, V.STATION_SERIES, {"score": lambda w: F.lag("utilization_rate").over(w)}, back=1)
    return scored.where(F.col("score").isNotNull()).select(
        congestion_label(F.col("utilization_rate")).alias("label"), "score", congestion_label(F.col("score")).alias("predicted")
    )


@query(
    "regression_metrics",
    with_views(
        f"""SELECT count(*) AS rows, {R('sqrt(avg((y - p) * (y - p)))', 6)} AS rmse, {R('avg(abs(y - p))', 6)} AS mae,
          {R('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 6)} AS r2, {R('avg(abs((y - p) / nullif(y, 0))) * 100', 6)} AS mape
        FROM (SELECT volume AS y, lag(volume) OVER (PARTITION BY station_id ORDER BY ts) AS p FROM station_panel) WHERE p IS NOT NULL""",
        "station_panel",
    ),
)
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.station_panel(spark, sf).select("ts", "station_id", F.col("volume").alias("y"))
    naive = windowed(panel, V.STATION_SERIES, {"p": lambda w: F.lag("y").over(w)}, back=1)
    return rounded(M.regression_metrics(naive.where(F.col("p").isNotNull()), "y", "p"), 6)


@query(
    "classification_metrics",
    with_views(
        f"""SELECT tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
          coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
        FROM (SELECT count(CASE WHEN label = 1 AND predicted = 1 THEN 1 END) AS tp, count(CASE WHEN label = 0 AND predicted = 1 THEN 1 END) AS fp,
          count(CASE WHEN label = 1 AND predicted = 0 THEN 1 END) AS fn, count(CASE WHEN label = 0 AND predicted = 0 THEN 1 END) AS tn
          FROM {_NEXT_LABEL})""",
        "station_panel",
    ),
)
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return M.classification_metrics(next_labels(spark, sf), "label", "predicted")


_EVENT_LABEL = "(SELECT CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS label, value AS score FROM events)"


def _event_labels(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type").isin("purchase", "signup").cast("int")
    return V.table(spark, sf, "events").select(kind.alias("label"), F.col("value").alias("score"))


def _auc_sql(source: str) -> str:
    return f"""SELECT CAST(sum(CAST(neg AS DECIMAL(38,0)) * (2 * tp - pos)) AS DOUBLE) / (2.0::DOUBLE * max(p) * max(n)) AS auc
      FROM (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
        FROM (SELECT score, count(CASE WHEN label = 1 THEN 1 END) AS pos, count(CASE WHEN label <> 1 THEN 1 END) AS neg
          FROM {source} GROUP BY score))"""


@query("roc_auc", _auc_sql(_EVENT_LABEL))
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    """Many distinct scores."""
    return M.roc_auc(_event_labels(spark, sf), "label", "score")


@query("roc_auc_ties", with_views(_auc_sql(_NEXT_LABEL), "station_panel"))
def roc_auc_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Few distinct scores, each with many rows."""
    return M.roc_auc(next_labels(spark, sf), "label", "score")


@query(
    "roc_curve",
    f"""SELECT score AS threshold, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr
      FROM (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
        FROM (SELECT score, count(CASE WHEN label = 1 THEN 1 END) AS pos, count(CASE WHEN label <> 1 THEN 1 END) AS neg
          FROM {_EVENT_LABEL} GROUP BY score) WINDOW w AS (ORDER BY score DESC))""",
)
def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return M.roc_curve(_event_labels(spark, sf), "label", "score")


@query(
    "confusion_matrix",
    with_views(f"SELECT label AS actual, predicted, count(*) AS rows FROM {_NEXT_LABEL} GROUP BY 1, 2", "station_panel"),
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion_matrix(next_labels(spark, sf), "label", "predicted")


@query(
    "station_kpis",
    with_views(
        f"""SELECT station_id, {R("CASE WHEN o = 0 THEN CASE WHEN n > 0 THEN CAST('inf' AS DOUBLE) ELSE 0 END ELSE (n - o) / o * 100 END", 6)} AS revenue_gain_pct,
          {R('CASE WHEN e <= 0 THEN 0 ELSE n / e END', 6)} AS pricing_efficiency,
          {R("CASE WHEN b <= 0 THEN CASE WHEN a > 0 THEN CAST('inf' AS DOUBLE) ELSE 0 END ELSE (a - b) / b * 100 END", 6)} AS off_peak_uplift
        FROM (SELECT station_id, sum(revenue_new) AS n, sum(revenue_baseline) AS o, sum(new_volume) AS e,
          count(CASE WHEN utilization < 0.3 AND ts < TIMESTAMP '1998-06-01' THEN 1 END) AS b,
          count(CASE WHEN utilization < 0.3 AND ts >= TIMESTAMP '1998-06-01' THEN 1 END) AS a
          FROM weekly_decided GROUP BY 1)""",
        "weekly_decided",
    ),
)
def station_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue gain, revenue per kWh and growth of the low-load weeks between two halves, per station."""
    low = F.col("utilization") < 0.3
    early = F.col("ts") < F.lit("1998-06-01").cast("timestamp_ntz")
    total = weekly_decided(spark, sf).groupBy("station_id").agg(
        F.sum("revenue_new").alias("n"),
        F.sum("revenue_baseline").alias("o"),
        F.sum("new_volume").alias("e"),
        F.count_if(low & early).alias("b"),
        F.count_if(low & ~early).alias("a"),
    )
    kpis = total.select(
        "station_id",
        M.gain_pct(F.col("n"), F.col("o")).alias("revenue_gain_pct"),
        M.revenue_per_unit(F.col("n"), F.col("e")).alias("pricing_efficiency"),
        M.uplift_pct(F.col("b"), F.col("a")).alias("off_peak_uplift"),
    )
    return rounded(kpis, 6)


@query(
    "site_time_share",
    with_views(
        f"""SELECT siteID, {R('CASE WHEN t <= 0 THEN 0 ELSE least(greatest(c / t, 0), 1) END')} AS utilization
        FROM (SELECT siteID, sum(session_duration_hours) AS c,
          count(DISTINCT stationID) * ((epoch_us(max(disconnectTime)) - epoch_us(min(connectionTime))) / 3.6e9) AS t
          FROM clean_sessions GROUP BY 1)""",
        "clean_sessions",
    ),
)
def site_time_share(spark: SparkSession, sf: str) -> DataFrame:
    """Charging hours over the hours all stations of a site were there."""
    sessions = C.clean_sessions(V.sessions(spark, sf), V.SESSION_SERIES)
    # Two steps instead of a distinct count: the first collapses each station of a site map-side.
    stations = sessions.groupBy("siteID", "stationID").agg(
        F.sum("session_duration_hours").alias("c"), F.min("connectionTime").alias("first"), F.max("disconnectTime").alias("last")
    )
    sites = stations.groupBy("siteID").agg(
        F.sum("c").alias("c"), (F.count(F.lit(1)) * hours_between(F.min("first"), F.max("last"))).alias("t")
    )
    return rounded(sites.select("siteID", M.time_share(F.col("c"), F.col("t")).alias("utilization")))
