"""Queries over the reporting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.functions.congestion import congestion_label
from voltaria.operators import monitor as K
from voltaria.operators.ordered import Series, windowed
from voltaria.plans import marts as M
from voltaria.queries.inputs import hourly_decided, hourly_rows, metric_rows, station_rows, weekly_decided
from voltaria.queries.monitoring import _DRIFT, KEYS
from voltaria.queries.registry import R, query, rounded, settle
from voltaria.queries.views_sql import clip_util, with_views
from voltaria.session import broadcast_if_small
from voltaria.sources import driver_views as V

_OFF = "(hour(ts) >= 22 OR hour(ts) < 7)"
_PEAK = "((hour(ts) >= 7 AND hour(ts) < 10) OR (hour(ts) >= 17 AND hour(ts) < 21))"
_BAND = "CASE WHEN {0} > 0.8::DOUBLE THEN 'surge' WHEN {0} < 0.3::DOUBLE THEN 'discount' ELSE 'normal' END"


def _share(test: str) -> str:
    return f"avg(CASE WHEN {test} THEN 1.0::DOUBLE ELSE 0 END)"


_CROWDED = _share("utilization > 0.8::DOUBLE")


@query(
    "kpi_summary",
    with_views(
        f"""SELECT region, {R('sum(revenue_new)', 3)} AS dynamic_revenue, {R('sum(revenue_baseline)', 3)} AS fixed_revenue,
          {R('avg(utilization)')} AS mean_utilization, {R(_CROWDED)} AS congestion_rate, {R(_share('utilization < 0.3::DOUBLE'))} AS off_peak_rate,
          {R('sum(new_volume)', 3)} AS energy, {R('(sum(revenue_new) - sum(revenue_baseline)) / sum(revenue_baseline) * 100', 6)} AS revenue_gain_pct,
          {R('sum(revenue_new) / sum(new_volume)', 6)} AS pricing_efficiency, {R(f'{_CROWDED} * avg(utilization) * 10')} AS wait_time_proxy
        FROM weekly_decided JOIN station_dim USING (station_id) GROUP BY ROLLUP (region)""",
        "weekly_decided",
        "station_dim",
    ),
)
def kpi_summary(spark: SparkSession, sf: str) -> DataFrame:
    region = V.station_dim(spark, sf).select("station_id", "region")
    made = M.kpi_summary(weekly_decided(spark, sf).join(broadcast_if_small(region, one_row_per_key=True), "station_id"))
    return rounded(made, dynamic_revenue=3, fixed_revenue=3, energy=3, revenue_gain_pct=6, pricing_efficiency=6)


@query(
    "cumulative_revenue",
    with_views(
        f"""SELECT day, {R('sum(f) OVER (ORDER BY day)', 2)} AS fixed_total, {R('sum(d) OVER (ORDER BY day)', 2)} AS dynamic_total
        FROM (SELECT CAST(ts AS DATE) AS day, sum(revenue_baseline) AS f, sum(revenue_new) AS d FROM weekly_decided GROUP BY 1)""",
        "weekly_decided",
    ),
)
def cumulative_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.cumulative_revenue(weekly_decided(spark, sf)), 2)


@query(
    "utilization_by_hour",
    with_views(
        f"""SELECT CAST(hour AS INTEGER) AS hour, {R('u')} AS mean_utilization, {_BAND.format('round(u, 9)')} AS band
        FROM (SELECT hour(ts) AS hour, avg({clip_util()}) AS u FROM hourly_panel GROUP BY 1)""",
        "hourly_panel",
    ),
)
def utilization_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.utilization_by_hour(hourly_rows(spark, sf)))


@query(
    "congestion_bands",
    with_views(
        f"""SELECT band, count(*) AS rows, count(*) / (SELECT count(*) FROM station_panel) AS share
        FROM (SELECT CASE WHEN u < 0.5 THEN 'below 50' WHEN u <= 0.8::DOUBLE THEN '50 to 80' ELSE 'above 80' END AS band
          FROM (SELECT {clip_util()} AS u FROM station_panel)) GROUP BY 1""",
        "station_panel",
    ),
)
def congestion_bands(spark: SparkSession, sf: str) -> DataFrame:
    return M.congestion_bands(station_rows(spark, sf))


@query(
    "latest_metrics",
    with_views(
        "SELECT CAST(station_id AS VARCHAR) AS model_name, metric AS metric_name, arg_max(value, seq) AS metric_value FROM metrics GROUP BY 1, 2",
        "metrics",
    ),
)
def latest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    log = metric_rows(spark, sf).select(
        F.col("station_id").cast("string").alias("model_name"),
        F.col("metric").alias("metric_name"),
        F.col("value").alias("metric_value"),
        "seq",
    )
    return M.latest_model_metrics(log, ["seq"])


@query(
    "forecast_interval",
    with_views(
        f"""SELECT ts, station_id, actual, prediction, {R('prediction + lo', 6)} AS lower, {R('prediction + hi', 6)} AS upper
        FROM f, (SELECT quantile_cont(actual - prediction, 0.05) AS lo, quantile_cont(actual - prediction, 0.95) AS hi FROM f)""",
        "station_panel",
    ).replace(
        "\nSELECT ts, station_id, actual",
        """,
        f AS (SELECT * FROM (SELECT ts, station_id, volume AS actual, lag(volume) OVER (PARTITION BY station_id ORDER BY ts) AS prediction
          FROM station_panel) WHERE prediction IS NOT NULL)
        SELECT ts, station_id, actual""",
        1,
    ),
)
def forecast_interval(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.station_panel(spark, sf).select("ts", "station_id", "volume")
    shifted = windowed(panel, V.STATION_SERIES, {"prediction": lambda w: F.lag("volume").over(w)}, back=1)
    rows = shifted.where(F.col("prediction").isNotNull()).withColumnRenamed("volume", "actual")
    made = M.with_interval(rows, ["ts", "station_id"])
    return made.withColumns({c: settle(c, 6) for c in ("lower", "upper")})


@query(
    "weekday_hour_heatmap",
    with_views(
        "SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, "
        + ", ".join(f"{R(f'avg(CASE WHEN hour(ts) = {h} THEN volume END)', 6)} AS h{h:02d}" for h in range(24))
        + " FROM hourly_panel GROUP BY 1",
        "hourly_panel",
    ),
)
def weekday_hour_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.weekday_hour_heatmap(V.hourly_panel(spark, sf)), 6)


@query(
    "station_hour_congestion",
    with_views(
        f"""SELECT station_id, CAST(hour(ts) AS INTEGER) AS hour, {R(f'avg({clip_util()})')} AS mean_utilization,
          {R(_share(f'{clip_util()} > 0.8::DOUBLE'))} AS congestion_rate FROM hourly_panel GROUP BY 1, 2""",
        "hourly_panel",
    ),
)
def station_hour_congestion(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.station_hour_congestion(hourly_rows(spark, sf)))


_NOW = "2024-01-20 12:00:00"


@query(
    "congestion_alerts",
    with_views(
        f"""SELECT ts, station_id, probability, probability AS current_utilization, CASE WHEN probability > 0.93 THEN 'surge +30%'
          WHEN probability > 0.9 THEN 'surge +20%' WHEN probability > 0.84 THEN 'surge +10%' ELSE 'monitor' END AS action
        FROM (SELECT ts, station_id, lag({clip_util()}) OVER (PARTITION BY station_id ORDER BY ts) AS probability FROM hourly_panel)
        WHERE ts > TIMESTAMP '{_NOW}' AND ts <= TIMESTAMP '{_NOW}' + INTERVAL 4 HOURS AND probability > 0.8
        ORDER BY probability DESC, ts, station_id""",
        "hourly_panel",
    ),
)
def congestion_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The last known utilization as the probability."""
    rows = hourly_rows(spark, sf).select("ts", "station_id", "utilization_rate")
    scored = windowed(rows, V.STATION_SERIES, {"probability": lambda w: F.lag("utilization_rate").over(w)}, back=1)
    scored = scored.withColumn("current_utilization", F.col("probability"))
    return M.congestion_alerts(scored, F.lit(_NOW).cast("timestamp_ntz"), current="current_utilization")


@query(
    "price_over_time",
    with_views(
        f"SELECT ts, 15.0::DOUBLE AS fixed_price, {R('sum(revenue_new) / sum(new_volume)', 6)} AS dynamic_price FROM weekly_decided GROUP BY ts",
        "weekly_decided",
    ),
)
def price_over_time(spark: SparkSession, sf: str) -> DataFrame:
    made = M.price_over_time(weekly_decided(spark, sf))
    return made.withColumn("dynamic_price", settle("dynamic_price", 6))


@query(
    "station_tariffs",
    with_views(
        """SELECT station_id, ts, utilization, current_price, new_price, name FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC) AS rn
        FROM weekly_decided) WHERE rn = 1""",
        "weekly_decided",
    ),
)
def station_tariffs(spark: SparkSession, sf: str) -> DataFrame:
    return M.station_tariffs(weekly_decided(spark, sf))


@query(
    "revenue_by_hour",
    with_views(
        f"SELECT CAST(hour(ts) AS INTEGER) AS hour, {R('sum(revenue_baseline)', 3)} AS fixed_revenue, {R('sum(revenue_new)', 3)} AS dynamic_revenue FROM hourly_decided GROUP BY 1",
        "hourly_decided",
    ),
)
def revenue_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.revenue_by_hour(hourly_decided(spark, sf)), 3)


_FIGURES = {
    "total_revenue": ("sum(revenue_baseline)", "sum(revenue_new)"),
    "mean_price": ("max(15.0::DOUBLE)", "sum(revenue_new) / sum(new_volume)"),
    "peak_revenue": (f"sum(CASE WHEN {_PEAK} THEN revenue_baseline END)", f"sum(CASE WHEN {_PEAK} THEN revenue_new END)"),
    "off_peak_revenue": (f"sum(CASE WHEN {_OFF} THEN revenue_baseline END)", f"sum(CASE WHEN {_OFF} THEN revenue_new END)"),
    "mean_utilization": ("avg(utilization)", "avg(utilization)"),
    "congestion_rate": (_CROWDED, _CROWDED),
    "wait_time_proxy": (f"{_CROWDED} * avg(utilization) * 10", f"{_CROWDED} * avg(utilization) * 10"),
    "sessions": ("sum(occupancy)", "sum(occupancy)"),
    "energy": ("sum(volume)", "sum(new_volume)"),
    "revenue_per_session": ("sum(revenue_baseline) / sum(occupancy)", "sum(revenue_new) / sum(occupancy)"),
}


@query(
    "full_comparison",
    with_views(
        " UNION ALL ".join(
            f"SELECT '{n}' AS metric, {R(a, 3)} AS fixed, {R(b, 3)} AS dynamic FROM hourly_decided" for n, (a, b) in _FIGURES.items()
        ),
        "hourly_decided",
    ),
)
def full_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.full_comparison(hourly_decided(spark, sf)), 3)


@query(
    "revenue_waterfall",
    with_views(
        f"SELECT {_BAND.format('utilization')} AS band, {R('sum(revenue_new - revenue_baseline)', 3)} AS revenue_delta, count(*) AS rows FROM weekly_decided GROUP BY 1",
        "weekly_decided",
    ),
)
def revenue_waterfall(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.revenue_waterfall(weekly_decided(spark, sf)), 3)


@query(
    "kpi_trend",
    with_views(
        f"""SELECT station_id, seq, metric, value, {R('avg(value) OVER (PARTITION BY station_id, metric ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)', 6)} AS rolling_mean
        FROM metrics""",
        "metrics",
    ),
)
def kpi_trend(spark: SparkSession, sf: str) -> DataFrame:
    made = M.kpi_trend(metric_rows(spark, sf), Series(keys=tuple(KEYS), by=("seq",)))
    return made.withColumn("rolling_mean", settle("rolling_mean", 6))


@query(
    "drift_table",
    with_views(
        f"""SELECT d.station_id, d.metric, l.latest AS current, {R('historical_mean', 6)} AS historical_mean, {R('z', 5)} AS z_score,
          CASE WHEN coalesce(z > 2.0::DOUBLE, false) THEN 'drift' ELSE 'stable' END AS status
        FROM {_DRIFT} d LEFT JOIN (SELECT station_id, metric, arg_max(value, seq) AS latest FROM metrics GROUP BY 1, 2) l
          ON d.station_id = l.station_id AND d.metric = l.metric""",
        "metrics",
    ),
)
def drift_table(spark: SparkSession, sf: str) -> DataFrame:
    made = M.drift_table(K.drift(metric_rows(spark, sf), KEYS), KEYS)
    return made.withColumns({"historical_mean": settle("historical_mean", 6), "z_score": settle("z_score", 5)})


@query(
    "demand_response",
    with_views(
        f"""SELECT CAST(least(greatest(floor(round(pp, 9) / 0.05), -7), 6) AS INTEGER) AS bucket, count(*) AS rows,
          {R('avg(vp)', 6)} AS mean_volume_pct, {R('avg(vp / nullif(pp, 0))', 4)} AS mean_elasticity
        FROM (SELECT price / lag(price) OVER w - 1.0::DOUBLE AS pp, volume / lag(volume) OVER w - 1.0::DOUBLE AS vp FROM station_panel
          WINDOW w AS (PARTITION BY station_id ORDER BY ts)) WHERE pp IS NOT NULL AND vp IS NOT NULL GROUP BY 1""",
        "station_panel",
    ),
)
def demand_response(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.station_panel(spark, sf).select("ts", "station_id", "price", "volume")
    lagged = windowed(
        panel, V.STATION_SERIES, {"p": lambda w: F.lag("price").over(w), "v": lambda w: F.lag("volume").over(w)}, back=1
    )
    changes = lagged.select(
        (F.try_divide("price", "p") - 1.0).alias("price_pct"), (F.try_divide("volume", "v") - 1.0).alias("volume_pct")
    )
    return rounded(M.demand_response(changes), 6, mean_elasticity=4)


@query(
    "loglog_elasticity",
    with_views(
        f"SELECT station_id, {R('regr_slope(ln(volume), ln(price))', 6)} AS elasticity FROM station_panel WHERE volume > 0 AND price > 0 GROUP BY 1",
        "station_panel",
    ),
)
def loglog_elasticity(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.loglog_elasticity(V.station_panel(spark, sf), "station_id"), 6)


_MAP = {
    "utilization": (f"avg({clip_util()})", "chargers * 3"),
    "revenue": ("sum(coalesce(volume * price, 0))", "value / 500"),
    "congestion": (f"avg(CASE WHEN {clip_util()} > 0.8::DOUBLE THEN 1.0::DOUBLE ELSE 0 END)", "value * 50"),
    "capacity": ("count(*)", "chargers * 2"),
}


def _map_sql(view: str) -> str:
    value, size = _MAP[view]
    shown = "chargers" if view == "capacity" else "value"
    return with_views(
        f"""SELECT station_id, node_id, region, "count", {R(shown, 4)} AS value, {R(size, 4)} AS size
        FROM (SELECT *, CAST("count" AS DOUBLE) AS chargers FROM (SELECT station_id, {value} AS value FROM station_panel GROUP BY 1) JOIN station_dim USING (station_id))""",
        "station_panel",
        "station_dim",
    )


def _map_table(spark: SparkSession, sf: str, view: str) -> DataFrame:
    dim = V.station_dim(spark, sf).select("station_id", "node_id", "region", "count")
    return rounded(M.map_table(station_rows(spark, sf), dim, view), 4)


@query("map_table", _map_sql("utilization"))
def map_table(spark: SparkSession, sf: str) -> DataFrame:
    return _map_table(spark, sf, "utilization")


@query("map_table_revenue", _map_sql("revenue"))
def map_table_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return _map_table(spark, sf, "revenue")


@query("map_table_congestion", _map_sql("congestion"))
def map_table_congestion(spark: SparkSession, sf: str) -> DataFrame:
    return _map_table(spark, sf, "congestion")


@query("map_table_capacity", _map_sql("capacity"))
def map_table_capacity(spark: SparkSession, sf: str) -> DataFrame:
    return _map_table(spark, sf, "capacity")


_TOP = """SELECT node_id, value FROM (SELECT node_id, round(avg({0}), 6) AS value
    FROM (SELECT *, {1} AS utilization_rate FROM station_panel JOIN station_dim USING (station_id)) GROUP BY 1)
  ORDER BY value DESC, node_id LIMIT 10"""


@query("top_utilization", with_views(_TOP.format("utilization_rate", clip_util()), "station_panel", "station_dim"))
def top_utilization(spark: SparkSession, sf: str) -> DataFrame:
    node = V.station_dim(spark, sf).select("station_id", "node_id")
    return M.top_districts(station_rows(spark, sf).join(broadcast_if_small(node, one_row_per_key=True), "station_id"), "utilization_rate")


@query(
    "top_congestion",
    with_views(
        _TOP.format("CASE WHEN utilization_rate > 0.8::DOUBLE THEN 1.0::DOUBLE ELSE 0 END", clip_util()), "station_panel", "station_dim"
    ),
)
def top_congestion(spark: SparkSession, sf: str) -> DataFrame:
    node = V.station_dim(spark, sf).select("station_id", "node_id")
    rows = station_rows(spark, sf).join(broadcast_if_small(node, one_row_per_key=True), "station_id")
    labelled = rows.withColumn("congestion_label", congestion_label(F.col("utilization_rate")).cast("double"))
    return M.top_districts(labelled, "congestion_label")


def _segments(name: str, test: str) -> str:
    return with_views(
        f"""SELECT {test} AS {name}, count(*) AS rows, {R(f'avg({clip_util()})')} AS mean_utilization, sum(volume) AS volume,
          {R('sum(volume * price)', 3)} AS revenue FROM station_panel JOIN station_dim USING (station_id) GROUP BY 1""",
        "station_panel",
        "station_dim",
    )


def _segmented(spark: SparkSession, sf: str, name: str, test) -> DataFrame:
    dim = V.station_dim(spark, sf).select("station_id", "cbd_flag", "dynamic_pricing", "fast_count", "count")
    made = M.segment_compare(station_rows(spark, sf).join(broadcast_if_small(dim, one_row_per_key=True), "station_id"), test, name)
    return rounded(made, revenue=3)


@query("central_segments", _segments("central", "cbd_flag"))
def central_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _segmented(spark, sf, "central", F.col("cbd_flag"))


@query("dynamic_segments", _segments("dynamic", "dynamic_pricing"))
def dynamic_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _segmented(spark, sf, "dynamic", F.col("dynamic_pricing"))


@query("fast_segments", _segments("mostly_fast", 'fast_count / "count" > 0.4'))
def fast_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _segmented(spark, sf, "mostly_fast", F.try_divide("fast_count", "count") > 0.4)


@query(
    "off_peak_share",
    with_views(
        f"SELECT CAST(ts AS DATE) AS day, {R(f'coalesce(sum(CASE WHEN {_OFF} THEN volume END), 0) / sum(volume)')} AS off_peak_share FROM hourly_panel GROUP BY 1",
        "hourly_panel",
    ),
)
def off_peak_share(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.off_peak_share(V.hourly_panel(spark, sf)))
