"""Queries over cleaning, ordered series and resampling."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.functions import demand as D
from voltaria.operators import clean as C
from voltaria.operators import hourly as H
from voltaria.operators import learn as ML
from voltaria.operators.ordered import Series, position
from voltaria.queries.inputs import station_rows
from voltaria.queries.registry import R, query, rounded
from voltaria.queries.views_sql import clip_util, interpolate, with_views
from voltaria.sources import driver_views as V

_SESSIONS = V.SESSION_SERIES


@query("session_energy_interpolated", with_views("SELECT sessionID, kWhDelivered FROM energy_filled", "energy_filled"))
def session_energy_interpolated(spark: SparkSession, sf: str) -> DataFrame:
    return C.interpolate_energy(V.sessions(spark, sf), _SESSIONS).select("sessionID", "kWhDelivered")


@query(
    "session_times_filled",
    with_views(
        """SELECT sessionID,
          last_value(connectionTime IGNORE NULLS) OVER w AS connectionTime,
          last_value(disconnectTime IGNORE NULLS) OVER w AS disconnectTime,
          last_value(doneChargingTime IGNORE NULLS) OVER w AS doneChargingTime
        FROM sessions WINDOW w AS (PARTITION BY stationID ORDER BY sessionID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "sessions",
    ),
)
def session_times_filled(spark: SparkSession, sf: str) -> DataFrame:
    return C.fill_times(V.sessions(spark, sf), _SESSIONS).select(
        "sessionID", "connectionTime", "disconnectTime", "doneChargingTime"
    )


@query("sessions_clean", with_views("SELECT * FROM clean_sessions", "clean_sessions"))
def sessions_clean(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_sessions(V.sessions(spark, sf), _SESSIONS)


@query(
    "sessions_clean_strict",
    with_views("SELECT * FROM clean_sessions WHERE session_duration_hours <= 24 AND kWhDelivered <= 200", "clean_sessions"),
)
def sessions_clean_strict(spark: SparkSession, sf: str) -> DataFrame:
    return C.keep_plausible(C.clean_sessions(V.sessions(spark, sf), _SESSIONS), 24.0, 200.0)


@query("session_copies_dropped", "SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS day FROM events")
def session_copies_dropped(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "events").select("event_type", "user_id", F.to_date("ts").alias("day")).dropDuplicates()


_KWH = "SELECT sessionID, {} AS kWhDelivered FROM sessions"


def _missing(spark: SparkSession, sf: str, strategy: str, series: Series | None = None) -> DataFrame:
    df = V.sessions(spark, sf)
    return C.handle_missing(df, strategy, ["kWhDelivered"], series or _SESSIONS).select("sessionID", "kWhDelivered")


@query(
    "missing_interpolate",
    with_views(
        "SELECT * FROM " + interpolate("sessions", "stationID", "sessionID", "kWhDelivered", "sessionID"), "sessions"
    ),
)
def missing_interpolate(spark: SparkSession, sf: str) -> DataFrame:
    return _missing(spark, sf, "interpolate")


@query(
    "missing_ffill",
    with_views(
        _KWH.format("last_value(kWhDelivered IGNORE NULLS) OVER w")
        + " WINDOW w AS (PARTITION BY stationID ORDER BY sessionID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "sessions",
    ),
)
def missing_ffill(spark: SparkSession, sf: str) -> DataFrame:
    return _missing(spark, sf, "ffill")


@query(
    "missing_bfill",
    with_views(
        _KWH.format("first_value(kWhDelivered IGNORE NULLS) OVER w")
        + " WINDOW w AS (PARTITION BY stationID ORDER BY sessionID ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
        "sessions",
    ),
)
def missing_bfill(spark: SparkSession, sf: str) -> DataFrame:
    return _missing(spark, sf, "bfill")


@query(
    "missing_median",
    with_views(
        "SELECT sessionID, " + R("coalesce(kWhDelivered, (SELECT quantile_cont(kWhDelivered, 0.5) FROM sessions))")
        + " AS kWhDelivered FROM sessions",
        "sessions",
    ),
)
def missing_median(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_missing(spark, sf, "median"))


@query(
    "missing_mean",
    with_views(
        "SELECT sessionID, " + R("coalesce(kWhDelivered, (SELECT avg(kWhDelivered) FROM sessions))")
        + " AS kWhDelivered FROM sessions",
        "sessions",
    ),
)
def missing_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_missing(spark, sf, "mean"))


@query("missing_drop", with_views(_KWH.format("kWhDelivered") + " WHERE kWhDelivered IS NOT NULL", "sessions"))
def missing_drop(spark: SparkSession, sf: str) -> DataFrame:
    return _missing(spark, sf, "drop")


@query(
    "outliers_iqr",
    """SELECT event_id, value, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS is_outlier
    FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)""",
)
def outliers_iqr(spark: SparkSession, sf: str) -> DataFrame:
    return C.flag_outliers(V.table(spark, sf, "events"), ["value"], "iqr").select("event_id", "value", "is_outlier")


@query(
    "outliers_zscore",
    """SELECT event_id, value, abs((value - m) / s) > 3.0 AS is_outlier
    FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)""",
)
def outliers_zscore(spark: SparkSession, sf: str) -> DataFrame:
    """The default threshold of 1.5 means 3 for z-scores."""
    return C.flag_outliers(V.table(spark, sf, "events"), ["value"], "zscore").select("event_id", "value", "is_outlier")


@query(
    "outlier_rows",
    with_views(
        """SELECT ts, station_id, volume, price FROM station_panel,
        (SELECT quantile_cont(volume, 0.25) AS v1, quantile_cont(volume, 0.75) AS v3,
          quantile_cont(price, 0.25) AS p1, quantile_cont(price, 0.75) AS p3 FROM station_panel)
        WHERE volume < v1 - 1.5 * (v3 - v1) OR volume > v3 + 1.5 * (v3 - v1)
          OR price < p1 - 1.5 * (p3 - p1) OR price > p3 + 1.5 * (p3 - p1)""",
        "station_panel",
    ),
)
def outlier_rows(spark: SparkSession, sf: str) -> DataFrame:
    flagged = C.flag_outliers(V.station_panel(spark, sf), ["volume", "price"], "iqr")
    return C.outliers_only(flagged).select("ts", "station_id", "volume", "price")


def _scaled_sql(shift: str, scale: str) -> str:
    return f"""SELECT sessionID, {R('(kWhDelivered - a) / CASE WHEN b = 0 THEN 1 ELSE b END')} AS kWhDelivered
      FROM sessions, (SELECT {shift} AS a, {scale} AS b FROM sessions)"""


def _scaled(spark: SparkSession, sf: str, method: str) -> DataFrame:
    df = V.sessions(spark, sf).select("sessionID", "kWhDelivered")
    return rounded(C.normalize(df, ["kWhDelivered"], C.fit_scaler(df, ["kWhDelivered"], method)))


@query("normalize_minmax", with_views(_scaled_sql("min(kWhDelivered)", "max(kWhDelivered) - min(kWhDelivered)"), "sessions"))
def normalize_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, "minmax")


@query("normalize_standard", with_views(_scaled_sql("avg(kWhDelivered)", "stddev_pop(kWhDelivered)"), "sessions"))
def normalize_standard(spark: SparkSession, sf: str) -> DataFrame:
    return _scaled(spark, sf, "standard")


@query("inverse_normalize", with_views("SELECT sessionID, " + R("kWhDelivered") + " AS kWhDelivered FROM sessions", "sessions"))
def inverse_normalize(spark: SparkSession, sf: str) -> DataFrame:
    df = V.sessions(spark, sf).select("sessionID", "kWhDelivered")
    fitted = C.fit_scaler(df, ["kWhDelivered"], "standard")
    return rounded(C.inverse_normalize(C.normalize(df, ["kWhDelivered"], fitted), ["kWhDelivered"], fitted))


@query("row_positions", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM events")
def row_positions(spark: SparkSession, sf: str) -> DataFrame:
    return position(V.table(spark, sf, "events").select("event_id", "ts"), Series(by=("ts", "event_id"))).drop("ts")


# The same queries with every key cut into slices: what a large table takes is held against the same SQL.
_CUT = {"task_rows": 400, "task_bytes": 0}


@query("row_positions_split", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM events")
def row_positions_split(spark: SparkSession, sf: str) -> DataFrame:
    series = Series(by=("ts", "event_id"), **_CUT)
    return position(V.table(spark, sf, "events").select("event_id", "ts"), series).drop("ts")


@query(
    "missing_interpolate_split",
    with_views("SELECT * FROM " + interpolate("sessions", "stationID", "sessionID", "kWhDelivered", "sessionID"), "sessions"),
)
def missing_interpolate_split(spark: SparkSession, sf: str) -> DataFrame:
    return _missing(spark, sf, "interpolate", replace(_SESSIONS, **_CUT))


@query(
    "missing_bfill_split",
    with_views(
        _KWH.format("first_value(kWhDelivered IGNORE NULLS) OVER w")
        + " WINDOW w AS (PARTITION BY stationID ORDER BY sessionID ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
        "sessions",
    ),
)
def missing_bfill_split(spark: SparkSession, sf: str) -> DataFrame:
    return _missing(spark, sf, "bfill", replace(_SESSIONS, **_CUT))


@query("sessions_clean_split", with_views("SELECT * FROM clean_sessions", "clean_sessions"))
def sessions_clean_split(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_sessions(V.sessions(spark, sf), replace(_SESSIONS, **_CUT))


@query(
    "chronological_split",
    with_views(
        """SELECT ts, station_id, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
        FROM (SELECT ts, station_id, row_number() OVER (ORDER BY ts, station_id) AS rn, count(*) OVER () AS n FROM station_panel)""",
        "station_panel",
    ),
)
def chronological_split(spark: SparkSession, sf: str) -> DataFrame:
    return ML.chronological_split(V.station_panel(spark, sf).select("ts", "station_id"), ("ts", "station_id"))


_BY = "(PARTITION BY station_id ORDER BY ts)"


def _lags_sql(lags: tuple[int, ...], columns: tuple[str, ...]) -> str:
    made = ", ".join(f"lag({c}, {k}) OVER {_BY} AS {c}_lag_{k}" for c in columns for k in lags)
    return f"SELECT ts, station_id, {made} FROM station_panel"


def _rolling_sql(windows: tuple[int, ...], columns: tuple[str, ...]) -> str:
    made = []
    for c in columns:
        for n in windows:
            frame = f"(PARTITION BY station_id ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
            made.append(f"{R(f'avg({c}) OVER {frame}')} AS {c}_rolling_mean_{n}")
            made.append(f"{R(f'stddev_samp({c}) OVER {frame}', 6)} AS {c}_rolling_std_{n}")
    return f"SELECT ts, station_id, {', '.join(made)} FROM station_panel"


@query("panel_lags", with_views(_lags_sql((1, 3, 6, 12), ("volume", "price")), "station_panel"))
def panel_lags(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.station_panel(spark, sf).select("ts", "station_id", "volume", "price")
    return D.add_lags(panel, V.STATION_SERIES, ["volume", "price", "absent"]).drop("volume", "price")


@query("panel_lags_configured", with_views(_lags_sql((1, 2, 3, 6, 12, 24, 48), ("occupancy",)), "station_panel"))
def panel_lags_configured(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.station_panel(spark, sf).select("ts", "station_id", "occupancy")
    return D.add_lags(panel, V.STATION_SERIES, ["occupancy"], (1, 2, 3, 6, 12, 24, 48)).drop("occupancy")


@query("panel_rolling", with_views(_rolling_sql((12, 36, 288), ("volume",)), "station_panel"))
def panel_rolling(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.station_panel(spark, sf).select("ts", "station_id", "volume")
    return rounded(D.add_rolling(panel, V.STATION_SERIES, ["volume"]).drop("volume"))


@query("panel_rolling_configured", with_views(_rolling_sql((3, 6, 12, 24), ("price", "volume")), "station_panel"))
def panel_rolling_configured(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.station_panel(spark, sf).select("ts", "station_id", "price", "volume")
    return rounded(D.add_rolling(panel, V.STATION_SERIES, ["price", "volume"], (3, 6, 12, 24)).drop("price", "volume"))


@query(
    "future_targets",
    with_views(
        f"SELECT ts, station_id, lead(volume, 4) OVER {_BY} AS future_volume, lead(occupancy, 4) OVER {_BY} AS future_occupancy FROM station_panel",
        "station_panel",
    ),
)
def future_targets(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.station_panel(spark, sf)
    made = D.add_future_targets(panel, V.STATION_SERIES, ["volume", "occupancy"], 4)
    return made.select("ts", "station_id", "future_volume", "future_occupancy")


_SPINE = "(SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM {})"
_HOURLY_SESSIONS = """(SELECT CAST(date_trunc('hour', connectionTime) AS TIMESTAMP) AS ts, avg(kWhDelivered) AS mk,
    count(kWhDelivered) AS n, avg(session_duration_hours) AS mh FROM clean_sessions GROUP BY 1)"""
_HOURLY_PANEL = """(SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, avg(o) AS o, avg(v) AS v, avg(d) AS d, avg(p) AS p
    FROM (SELECT ts, avg(occupancy) AS o, avg(volume) AS v, avg(duration) AS d, avg(price) AS p FROM hourly_panel GROUP BY ts) GROUP BY 1)"""


@query(
    "hourly_sessions",
    with_views(
        f"""SELECT s.ts, {R('mk')} AS acn_mean_kWh, coalesce(n, 0) AS acn_session_count, {R('mh')} AS acn_mean_session_hours
        FROM {_SPINE.format(_HOURLY_SESSIONS)} s LEFT JOIN {_HOURLY_SESSIONS} h ON s.ts = h.ts""",
        "clean_sessions",
    ),
)
def hourly_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(H.hourly_sessions(C.clean_sessions(V.sessions(spark, sf), _SESSIONS)))


@query(
    "panel_step_means",
    with_views(
        f"SELECT ts, {R('avg(occupancy)')} AS urbanev_mean_occupancy, {R('avg(volume)')} AS urbanev_mean_volume, "
        f"{R('avg(price)')} AS urbanev_mean_price FROM station_panel GROUP BY ts",
        "station_panel",
    ),
)
def panel_step_means(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(H.step_means(V.station_panel(spark, sf)))


_MEANS = {"o": "occupancy", "v": "volume", "d": "duration", "p": "price"}


@query(
    "hourly_panel_means",
    with_views(
        f"SELECT s.ts, {', '.join(f'{R(k)} AS urbanev_mean_{n}' for k, n in _MEANS.items())} "
        f"FROM {_SPINE.format(_HOURLY_PANEL)} s LEFT JOIN {_HOURLY_PANEL} h ON s.ts = h.ts",
        "hourly_panel",
    ),
)
def hourly_panel_means(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(H.hourly_panel_means(V.hourly_panel(spark, sf)))


_UNIFIED = {
    "acn_mean_kWh": "mk",
    "acn_session_count": "CAST(coalesce(n, 0) AS DOUBLE)",
    "acn_mean_session_hours": "mh",
    **{f"urbanev_mean_{n}": k for k, n in _MEANS.items()},
}


def _unified_sql() -> str:
    left = f"""(SELECT s.ts, mk, CASE WHEN s.ts IS NOT NULL THEN coalesce(n, 0) END AS n, mh
      FROM {_SPINE.format(_HOURLY_SESSIONS)} s LEFT JOIN {_HOURLY_SESSIONS} h ON s.ts = h.ts)"""
    right = f"(SELECT s.ts, o, v, d, p FROM {_SPINE.format(_HOURLY_PANEL)} s LEFT JOIN {_HOURLY_PANEL} h ON s.ts = h.ts)"
    joined = f"""unified AS MATERIALIZED (SELECT coalesce(a.ts, b.ts) AS ts, mk AS acn_mean_kWh, CAST(n AS DOUBLE) AS acn_session_count,
      mh AS acn_mean_session_hours, o AS urbanev_mean_occupancy, v AS urbanev_mean_volume, d AS urbanev_mean_duration,
      p AS urbanev_mean_price FROM {left} a FULL OUTER JOIN {right} b ON a.ts = b.ts)"""
    columns = list(_UNIFIED)
    parts = [f"{interpolate('unified', '', 'ts', c, 'ts')} x{i}" for i, c in enumerate(columns)]
    body = f"SELECT ts, {', '.join(f'{R(c)} AS {c}' for c in columns)} FROM {parts[0]}"
    body += "".join(f" JOIN {p} USING (ts)" for p in parts[1:])
    views = with_views("", "clean_sessions", "hourly_panel").rstrip()
    return f"{views},\n{joined}\n{body}"


@query("unified_hourly", _unified_sql())
def unified_hourly(spark: SparkSession, sf: str) -> DataFrame:
    sessions = C.clean_sessions(V.sessions(spark, sf), _SESSIONS)
    return rounded(H.unified_hourly(sessions, V.hourly_panel(spark, sf)))


@query(
    "utilization_histogram",
    with_views(
        f"SELECT CAST(least(floor({clip_util()} * 5), 4) AS INTEGER) AS bin, count(*) AS rows FROM station_panel GROUP BY 1",
        "station_panel",
    ),
)
def utilization_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return H.utilization_histogram(station_rows(spark, sf))
