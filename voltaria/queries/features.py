"""Queries over the temporal, demand, congestion and pricing features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.functions import congestion as N
from voltaria.functions import demand as D
from voltaria.functions import pricing as P
from voltaria.functions import temporal as T
from voltaria.queries.inputs import weekly_decisions
from voltaria.queries.registry import R, query, rounded, settle
from voltaria.queries.views_sql import clip_util, with_views
from voltaria.session import broadcast_if_small
from voltaria.sources import driver_views as V

_PEAK = "(h >= 7 AND h < 10) OR (h >= 17 AND h < 21)"
_OFF = "(h >= 22 AND h < 24) OR (h >= 0 AND h < 7)"


@query(
    "temporal_features",
    f"""SELECT event_id, ts, CAST(h AS INTEGER) AS hour, CAST(d AS INTEGER) AS weekday, d >= 5 AS weekend,
      {_PEAK} AS peak_period, {_OFF} AS off_peak_period
    FROM (SELECT event_id, ts, hour(ts) AS h, isodow(ts) - 1 AS d FROM events)""",
)
def temporal_features(spark: SparkSession, sf: str) -> DataFrame:
    return T.add_temporal_features(V.table(spark, sf, "events").select("event_id", "ts"))


@query(
    "calendar_extras",
    """SELECT event_id, CAST(month(ts) AS INTEGER) AS month,
      CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'morning' WHEN hour(ts) BETWEEN 12 AND 16 THEN 'afternoon'
        WHEN hour(ts) BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS time_slot FROM events""",
)
def calendar_extras(spark: SparkSession, sf: str) -> DataFrame:
    return T.add_calendar_extras(V.table(spark, sf, "events").select("event_id", "ts")).drop("ts")


@query(
    "cyclic_time",
    f"""SELECT event_id, {R('sin(2 * pi() * hour(ts) / 24)')} AS hour_sin, {R('cos(2 * pi() * hour(ts) / 24)')} AS hour_cos,
      {R('(isodow(ts) - 1) / 6.0::DOUBLE')} AS weekday_norm FROM events""",
)
def cyclic_time(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.add_cyclic_time(V.table(spark, sf, "events").select("event_id", "ts")).drop("ts"))


@query(
    "demand_row_features",
    with_views(
        f"""SELECT ts, station_id, {clip_util()} AS utilization_rate, coalesce(volume * price, 0) AS revenue,
          coalesce(volume * price, 0) / nullif(volume, 0) AS revenue_per_kwh FROM station_panel""",
        "station_panel",
    ),
)
def demand_row_features(spark: SparkSession, sf: str) -> DataFrame:
    return D.add_row_demand(V.station_panel(spark, sf)).select(
        "ts", "station_id", "utilization_rate", "revenue", "revenue_per_kwh"
    )


_DURATION = """SELECT sessionID, CASE WHEN h >= 0 THEN h END AS charging_duration_hours
  FROM (SELECT sessionID, (epoch_us({end}) - epoch_us(connectionTime)) / 3.6e9 AS h FROM sessions)"""


@query("charging_duration", with_views(_DURATION.format(end="doneChargingTime"), "sessions"))
def charging_duration(spark: SparkSession, sf: str) -> DataFrame:
    df = V.sessions(spark, sf)
    return df.select("sessionID", D.charging_duration_hours(df).alias("charging_duration_hours"))


@query("charging_duration_fallback", with_views(_DURATION.format(end="coalesce(doneChargingTime, disconnectTime)"), "sessions"))
def charging_duration_fallback(spark: SparkSession, sf: str) -> DataFrame:
    df = V.sessions(spark, sf)
    return df.select("sessionID", D.charging_duration_hours(df, fallback=True).alias("charging_duration_hours"))


def _demand_sql() -> str:
    columns = ["utilization_rate", "volume", "price", "revenue"]
    made = [f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in columns for k in (1, 3, 6, 12)]
    for c in columns:
        for n in (12, 36, 288):
            frame = f"(PARTITION BY station_id ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
            made.append(f"{R(f'avg({c}) OVER {frame}', 6)} AS {c}_rolling_mean_{n}")
            made.append(f"{R(f'stddev_samp({c}) OVER {frame}', 5)} AS {c}_rolling_std_{n}")
    return with_views(
        f"""SELECT ts, station_id, occupancy, capacity, volume, price, utilization_rate, revenue, revenue_per_kwh, {', '.join(made)}
        FROM (SELECT *, {clip_util()} AS utilization_rate, coalesce(volume * price, 0) AS revenue,
          coalesce(volume * price, 0) / nullif(volume, 0) AS revenue_per_kwh FROM station_panel)
        WINDOW w AS (PARTITION BY station_id ORDER BY ts)""",
        "station_panel",
    )


@query("demand_features", _demand_sql())
def demand_features(spark: SparkSession, sf: str) -> DataFrame:
    made = D.add_demand_features(V.station_panel(spark, sf), V.STATION_SERIES)
    rolling = {c: 5 if "_std_" in c else 6 for c in made.columns if "_rolling_" in c}
    return made.withColumns({c: settle(c, d) for c, d in rolling.items()})


@query(
    "congestion_features",
    with_views(
        f"""SELECT ts, station_id, occupancy, capacity, area, utilization_rate, queue_length_proxy, occupancy_density,
          {R('''least(greatest(0.5::DOUBLE * (utilization_rate - u0) / nullif(u1 - u0, 0)
            + 0.3::DOUBLE * (queue_length_proxy - q0) / nullif(q1 - q0, 0)
            + 0.2::DOUBLE * (coalesce(occupancy_density, 0) - d0) / nullif(d1 - d0, 0), 0), 1)''')} AS congestion_score,
          CASE WHEN utilization_rate > 0.8::DOUBLE THEN 1 ELSE 0 END AS congestion_label
        FROM (SELECT ts, station_id, occupancy, capacity, area, {clip_util()} AS utilization_rate,
            greatest(occupancy - capacity, 0.0::DOUBLE) AS queue_length_proxy, occupancy / nullif(area, 0) AS occupancy_density,
            min({clip_util()}) OVER () AS u0, max({clip_util()}) OVER () AS u1,
            min(greatest(occupancy - capacity, 0)) OVER () AS q0, max(greatest(occupancy - capacity, 0)) OVER () AS q1,
            min(coalesce(occupancy / nullif(area, 0), 0)) OVER () AS d0, max(coalesce(occupancy / nullif(area, 0), 0)) OVER () AS d1
          FROM station_panel JOIN station_dim USING (station_id))""",
        "station_panel",
        "station_dim",
    ),
)
def congestion_features(spark: SparkSession, sf: str) -> DataFrame:
    area = V.station_dim(spark, sf).select("station_id", "area")
    panel = V.station_panel(spark, sf).select("ts", "station_id", "occupancy", "capacity").join(broadcast_if_small(area, one_row_per_key=True), "station_id")
    made = N.add_congestion_features(panel)
    return made.withColumn("congestion_score", settle("congestion_score"))


@query(
    "congestion_labels",
    with_views(
        f"SELECT station_id, congestion_label, count(*) AS rows FROM (SELECT station_id, CASE WHEN {clip_util()} > 0.8::DOUBLE THEN 1 ELSE 0 END AS congestion_label FROM hourly_panel) GROUP BY 1, 2",
        "hourly_panel",
    ),
)
def congestion_labels(spark: SparkSession, sf: str) -> DataFrame:
    util = D.utilization_rate(F.col("occupancy"), F.col("capacity"))
    labelled = V.hourly_panel(spark, sf).select("station_id", N.congestion_label(util).alias("congestion_label"))
    return labelled.groupBy("station_id", "congestion_label").agg(F.count(F.lit(1)).alias("rows"))


_PCT = "{0} / nullif({1}, 0) - 1.0::DOUBLE"


@query(
    "pricing_features",
    with_views(
        f"""SELECT ts, station_id, price, volume, price - p1 AS price_change, {_PCT.format('price', 'p1')} AS price_pct_change,
          CASE WHEN price < 15 THEN 'discount' WHEN price > 15 THEN 'surge' ELSE 'normal' END AS price_level,
          CASE WHEN p12 = 0 AND price <> 0 THEN CASE WHEN v12 <> 0 THEN 0.0::DOUBLE END
            ELSE ({_PCT.format('volume', 'v12')}) / nullif({_PCT.format('price', 'p12')}, 0) END AS demand_elasticity
        FROM (SELECT *, lag(price) OVER w AS p1, lag(price, 12) OVER w AS p12, lag(volume, 12) OVER w AS v12
          FROM station_panel WINDOW w AS (PARTITION BY station_id ORDER BY ts))""",
        "station_panel",
    ),
)
def pricing_features(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.station_panel(spark, sf).select("ts", "station_id", "price", "volume")
    return P.add_pricing_features(panel, V.STATION_SERIES)


@query(
    "price_changes",
    with_views(
        "SELECT ts, station_id, price - lag(price) OVER (PARTITION BY station_id ORDER BY ts) AS price_change FROM hourly_panel",
        "hourly_panel",
    ),
)
def price_changes(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.hourly_panel(spark, sf).select("ts", "station_id", "price")
    return P.add_price_change(panel, V.STATION_SERIES).drop("price")


_FILL = "last_value({} IGNORE NULLS) OVER (PARTITION BY stationID ORDER BY sessionID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(
    "padded_pct_change",
    with_views(
        f"""SELECT sessionID, k / nullif(lag(k, 3) OVER (PARTITION BY stationID ORDER BY sessionID), 0) - 1.0::DOUBLE AS energy_pct
        FROM (SELECT sessionID, stationID, {_FILL.format('kWhDelivered')} AS k FROM sessions)""",
        "sessions",
    ),
)
def padded_pct_change(spark: SparkSession, sf: str) -> DataFrame:
    """Change of a column with gaps: the last known value stands in for a missing one."""
    df = V.sessions(spark, sf).select("sessionID", "stationID", "kWhDelivered")
    return P.add_pct_change(df, V.SESSION_SERIES, "kWhDelivered", "energy_pct", 3).select("sessionID", "energy_pct")


@query(
    "demand_elasticity",
    with_views(
        f"""SELECT ts, station_id, ({_PCT.format('volume', 'v')}) / nullif({_PCT.format('price', 'p')}, 0) AS demand_elasticity
        FROM (SELECT *, lag(price, 6) OVER w AS p, lag(volume, 6) OVER w AS v FROM hourly_panel
          WINDOW w AS (PARTITION BY station_id ORDER BY ts))""",
        "hourly_panel",
    ),
)
def demand_elasticity(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.hourly_panel(spark, sf).select("ts", "station_id", "price", "volume")
    return P.add_demand_elasticity(panel, V.STATION_SERIES, 6).select("ts", "station_id", "demand_elasticity")


@query("policy_inputs", with_views("SELECT * FROM weekly_rows", "weekly_rows"))
def policy_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return weekly_decisions(spark, sf)
