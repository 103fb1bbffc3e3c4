"""Queries over the scans, sinks and quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.operators import clean as C
from voltaria.operators import quality as Q
from voltaria.operators import tariff as X
from voltaria.plans.preprocess import write_processed
from voltaria.queries.inputs import hourly_decided
from voltaria.queries.registry import R, query, rounded
from voltaria.queries.views_sql import with_views
from voltaria.schemas import AGENT_METRICS, PRICING_DECISIONS, SESSIONS
from voltaria.session import scratch_path, stage
from voltaria.sources import driver_views as V
from voltaria.sources import metric_log as L
from voltaria.sources import panel as P
from voltaria.sources.dated_log import DatedLog
from voltaria.sources.sessions import coerce_sessions, read_sessions

_FIELDS = "connectionTime, disconnectTime, doneChargingTime, kWhDelivered, stationID, siteID"


@query("session_view", with_views(f"SELECT sessionID, {_FIELDS} FROM sessions", "sessions"))
def session_view(spark: SparkSession, sf: str) -> DataFrame:
    return V.sessions(spark, sf)


@query("station_panel_view", with_views("SELECT * FROM station_panel", "station_panel"))
def station_panel_view(spark: SparkSession, sf: str) -> DataFrame:
    return V.station_panel(spark, sf)


@query("district_panel_view", with_views("SELECT * FROM district_panel", "district_panel"))
def district_panel_view(spark: SparkSession, sf: str) -> DataFrame:
    return V.district_panel(spark, sf)


@query(
    "session_text_coercion",
    with_views(
        f"""SELECT sessionID, CASE WHEN stationID IS NOT NULL THEN connectionTime END AS connectionTime,
          CASE WHEN siteID <> '3' THEN kWhDelivered END AS kWhDelivered, siteID FROM sessions""",
        "sessions",
    ),
)
def session_text_coercion(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions as text, some of it unusable: bad values become null."""
    text = V.sessions(spark, sf).select(
        "sessionID",
        F.when(F.col("stationID").isNotNull(), F.col("connectionTime").cast("string")).otherwise("not a time").alias(
            "connectionTime"
        ),
        F.when(F.col("siteID") != "3", F.col("kWhDelivered").cast("string")).otherwise("NaN").alias("kWhDelivered"),
        "siteID",
    )
    return coerce_sessions(text).select("sessionID", "connectionTime", "kWhDelivered", "siteID")


@query("session_csv_source", with_views(f"SELECT {_FIELDS} FROM sessions", "sessions"))
def session_csv_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sessions-csv")
    V.sessions(spark, sf).select(*SESSIONS.fieldNames()).write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ).csv(path)
    return read_sessions(spark, path, "csv")


@query(
    "session_null_profile",
    with_views(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM sessions"
            for c in ["sessionID", *SESSIONS.fieldNames()]
        ),
        "sessions",
    ),
)
def session_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return Q.null_profile(V.sessions(spark, sf))


_STATS = {
    "rows": "CAST(count(*) AS DOUBLE)",
    "columns": "max(7.0::DOUBLE)",
    "count": "CAST(count(kWhDelivered) AS DOUBLE)",
    "mean": "avg(kWhDelivered)",
    "std": "stddev_samp(kWhDelivered)",
    "min": "min(kWhDelivered)",
    "max": "max(kWhDelivered)",
    "25%": "quantile_cont(kWhDelivered, 0.25)",
    "50%": "quantile_cont(kWhDelivered, 0.5)",
    "75%": "quantile_cont(kWhDelivered, 0.75)",
}


@query(
    "session_summary",
    with_views(
        " UNION ALL ".join(f"SELECT '{n}' AS statistic, {R(e, 6)} AS value FROM sessions" for n, e in _STATS.items()),
        "sessions",
    ),
)
def session_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.session_summary(V.sessions(spark, sf)), 6)


@query(
    "time_index_from_parts",
    "SELECT DISTINCT l_shipdate AS ts FROM lineitem",
)
def time_index_from_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Ship dates taken apart into calendar columns and built again."""
    parts = V.table(spark, sf, "lineitem").select("l_shipdate").distinct()
    pieces = {p: getattr(F, p)("l_shipdate") for p in ("year", "month", "hour", "minute", "second")}
    return P.time_index(parts.withColumns({**pieces, "day": F.dayofmonth("l_shipdate")})).select("ts")


_GRID = """SELECT t.ts, CAST(n.n_nationkey AS VARCHAR) AS station_id, d.occupancy AS value
  FROM (SELECT DISTINCT ts FROM district_panel) t CROSS JOIN nation n
  LEFT JOIN district_panel d ON d.ts = t.ts AND d.node_id = n.n_nationkey"""


def _wide_districts(spark: SparkSession, sf: str) -> DataFrame:
    return V.district_panel(spark, sf).groupBy("ts").pivot("node_id", list(range(25))).agg(F.max("occupancy"))


@query("panel_wide_to_long", with_views(_GRID, "district_panel"))
def panel_wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    return P.to_long(_wide_districts(spark, sf))


@query("panel_wide_csv_source", with_views(_GRID, "district_panel"))
def panel_wide_csv_source(spark: SparkSession, sf: str) -> DataFrame:
    """Wide files written in time order, the calendar columns in a file of their own, joined by row number."""
    series, clock = _wide_csv(spark, sf)
    return P.to_long(P.read_wide_series(spark, series, P.read_time_index(spark, clock)))


@query("panel_lines_source", with_views(_GRID, "district_panel"))
def panel_lines_source(spark: SparkSession, sf: str) -> DataFrame:
    """The same files read line by line, without a column per node."""
    series, clock = _wide_csv(spark, sf)
    return P.read_long_series(spark, series, P.read_time_index(spark, clock)).drop("row")


def _wide_csv(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Paths of a wide series file and of its calendar columns."""
    # Both files come from one stored table, so they hold the same rows in the same order.
    stored = scratch_path(spark, "wide")
    _wide_districts(spark, sf).orderBy("ts").write.parquet(stored)
    wide = spark.read.parquet(stored).orderBy("ts")
    parts = {p: getattr(F, p)("ts") for p in ("month", "year", "hour", "minute", "second")}
    series, clock = scratch_path(spark, "wide-csv"), scratch_path(spark, "time-csv")
    wide.drop("ts").withColumn("unnamed: 0", F.lit(1)).write.option("header", True).csv(series)
    wide.select(*[c.alias(n) for n, c in parts.items()], F.dayofmonth("ts").alias("day")).write.option("header", True).csv(clock)
    return series, clock


@query(
    "edge_matrix_source",
    with_views("SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst, dist FROM edges", "edges"),
)
def edge_matrix_source(spark: SparkSession, sf: str) -> DataFrame:
    """Adjacency and distance matrices written as CSV and read back as an edge list."""
    nodes = V.table(spark, sf, "nation").select(F.col("n_nationkey").alias("src"))
    full = nodes.join(V.edges(spark, sf), "src", "left")
    paths = {}
    for name, value in (("adj", F.count("dist")), ("dist", F.max("dist"))):
        paths[name] = scratch_path(spark, name)
        matrix = full.groupBy("src").pivot("dst", list(range(25))).agg(value).na.fill(0).orderBy("src")
        matrix.withColumnRenamed("src", "node_id").write.option("header", True).csv(paths[name])
    return P.read_edges(spark, paths["adj"], paths["dist"])


_DISTRICTS_SQL = """SELECT n_nationkey AS num, n_name AS grid, CAST(count(s_suppkey) AS INTEGER) AS "count",
    CAST(count(CASE WHEN s_suppkey % 3 = 0 THEN 1 END) AS INTEGER) AS fast_count,
    CAST(count(CASE WHEN s_suppkey % 3 <> 0 THEN 1 END) AS INTEGER) AS slow_count,
    CAST(n_nationkey % 5 AS DOUBLE) AS area, CAST(n_nationkey AS DOUBLE) AS lon, CAST(n_regionkey AS DOUBLE) AS la,
    CAST(n_regionkey - 1 AS DOUBLE) AS CBD, CAST(n_nationkey % 3 AS INTEGER) AS dynamic_pricing
  FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY n_nationkey, n_name, n_regionkey"""


def _districts(spark: SparkSession, sf: str) -> DataFrame:
    fast = F.col("s_suppkey") % 3 == 0
    counted = (
        V.table(spark, sf, "supplier")
        .groupBy("s_nationkey")
        .agg(F.count(F.lit(1)).alias("c"), F.count_if(fast).alias("f"), F.count_if(~fast).alias("s"))
    )
    joined = V.table(spark, sf, "nation").join(counted, F.col("n_nationkey") == F.col("s_nationkey"), "left").na.fill(0)
    key = F.col("n_nationkey")
    return joined.select(
        key.alias("num"),
        F.col("n_name").alias("grid"),
        F.col("c").cast("int").alias("count"),
        F.col("f").cast("int").alias("fast_count"),
        F.col("s").cast("int").alias("slow_count"),
        (key % 5).cast("double").alias("area"),
        key.cast("double").alias("lon"),
        F.col("n_regionkey").cast("double").alias("la"),
        (F.col("n_regionkey") - 1).cast("double").alias("CBD"),
        (key % 3).cast("int").alias("dynamic_pricing"),
    )


@query("district_source", _DISTRICTS_SQL)
def district_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "districts")
    _districts(spark, sf).write.option("header", True).csv(path)
    return P.read_districts(spark, path)


@query(
    "panel_dated_sink",
    with_views(
        f"SELECT CAST(ts AS DATE) AS day, count(*) AS n, {R('sum(volume)', 4)} AS volume FROM hourly_panel WHERE ts >= DATE '2024-01-10' GROUP BY 1",
        "hourly_panel",
    ),
)
def panel_dated_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The panel written by day and read back with partition pruning."""
    path = scratch_path(spark, "panel")
    P.write_by_date(V.hourly_panel(spark, sf), path)
    recent = spark.read.parquet(path).where(F.col("date") >= F.lit("2024-01-10").cast("date"))
    counted = recent.groupBy(F.col("date").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))
    return rounded(counted, 4)


_RECORDS = """SELECT ts AS "timestamp", CAST(station_id AS VARCHAR) AS station_id, utilization,
    current_price AS baseline_price, new_price AS optimized_price, new_price - current_price AS price_delta,
    revenue_baseline AS revenue_old, revenue_new, revenue_gain * 100.0::DOUBLE AS revenue_gain_pct,
    'rule' AS decision_source FROM hourly_decided"""


@query("pricing_decision_log", with_views(_RECORDS, "hourly_decided"))
def pricing_decision_log(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions appended to the log in two batches and read back whole."""
    path = scratch_path(spark, "decisions")
    records = X.decision_records(hourly_decided(spark, sf), "rule")
    half = F.col("timestamp") < F.lit("2024-01-12").cast("timestamp_ntz")
    L.append_log(records.where(half), path, PRICING_DECISIONS)
    L.append_log(records.where(~half), path, PRICING_DECISIONS)
    return L.read_log(spark, path, PRICING_DECISIONS, limit=None)


@query(
    "pricing_decisions_newest",
    with_views(
        f"SELECT * FROM ({_RECORDS}) WHERE decision_source = 'rule' ORDER BY \"timestamp\" DESC, station_id DESC LIMIT 500",
        "hourly_decided",
    ),
)
def pricing_decisions_newest(spark: SparkSession, sf: str) -> DataFrame:
    records = L.conform(X.decision_records(hourly_decided(spark, sf), "rule"), PRICING_DECISIONS)
    return L.newest(records, {"decision_source": "rule"}, 500, ("station_id",))


def _decision_log(spark: SparkSession, sf: str) -> DatedLog:
    """All decisions in one append by half years, the second of them repeated."""
    log = DatedLog(scratch_path(spark, "decisions"), PRICING_DECISIONS)
    records = stage(X.decision_records(hourly_decided(spark, sf), "rule"), "records")
    late = F.dayofmonth("timestamp") > 15
    for batch, rows in (("first", records.where(~late)), ("second", records.where(late)), ("second", records.where(late))):
        log.append(rows, batch)
    return log


@query(
    "decision_log_newest_dates",
    with_views(
        f"SELECT * FROM ({_RECORDS}) WHERE decision_source = 'rule' ORDER BY \"timestamp\" DESC, station_id DESC LIMIT 500",
        "hourly_decided",
    ),
)
def decision_log_newest_dates(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 500 decisions, read from the dates that hold them."""
    return _decision_log(spark, sf).newest(spark, {"decision_source": "rule"}, 500, ("station_id",))


@query(
    "decision_log_repeated",
    with_views(
        f"""SELECT CAST("timestamp" AS DATE) AS date, CASE WHEN day("timestamp") > 15 THEN 'second' ELSE 'first' END AS batch, count(*) AS rows
        FROM ({_RECORDS}) GROUP BY 1, 2""",
        "hourly_decided",
    ),
)
def decision_log_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per date and append; the repeated append counts once, in the manifest and in the rows."""
    log = _decision_log(spark, sf)
    held = log.read(spark).groupBy(F.to_date("timestamp").alias("date")).agg(F.count("*").alias("n"))
    return log.manifest(spark).join(held, "date").where("rows = n").drop("n")


_RULES_SQL = {
    "connection_time_missing": "connectionTime IS NULL",
    "disconnect_time_missing": "disconnectTime IS NULL",
    "energy_missing": "kWhDelivered IS NULL",
    "energy_negative": "kWhDelivered < 0",
    "station_missing": "stationID IS NULL",
    "site_missing": "siteID IS NULL",
    "disconnect_before_connection": "disconnectTime < connectionTime",
}


def _counts_sql(rules: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, count(CASE WHEN {c} THEN 1 END) AS failures FROM {source}" for n, c in rules.items())


@query("session_rule_counts", with_views(_counts_sql(_RULES_SQL, "sessions"), "sessions"))
def session_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Q.rule_counts(Q.trimmed(V.sessions(spark, sf)), Q.session_rules())


_ANY = " OR ".join(f"coalesce({c}, false)" for c in _RULES_SQL.values())


@query(
    "session_validation_report",
    with_views(
        f"""SELECT count(*) AS total, count(CASE WHEN NOT ({_ANY}) THEN 1 END) AS valid,
          count(CASE WHEN {_ANY} THEN 1 END) AS invalid FROM sessions""",
        "sessions",
    ),
)
def session_validation_report(spark: SparkSession, sf: str) -> DataFrame:
    return Q.validation_report(V.sessions(spark, sf), Q.session_rules())


@query(
    "session_first_errors",
    with_views(
        "SELECT sessionID, error FROM ("
        + " UNION ALL ".join(
            f"SELECT sessionID, '{n}' AS error, {i} AS rank FROM sessions WHERE {c}" for i, (n, c) in enumerate(_RULES_SQL.items())
        )
        + ") ORDER BY sessionID, rank LIMIT 20",
        "sessions",
    ),
)
def session_first_errors(spark: SparkSession, sf: str) -> DataFrame:
    return Q.first_errors(V.sessions(spark, sf), Q.session_rules(), ["sessionID"])


_DISTRICT_RULES = {
    **{f"{c}_negative": f'"{c}" IS NULL OR "{c}" < 0' for c in ("num", "count", "fast_count", "slow_count")},
    "area_not_positive": "area IS NULL OR area <= 0",
    "cbd_negative": "CBD IS NULL OR CBD < 0",
    "dynamic_pricing_not_a_flag": "dynamic_pricing IS NULL OR dynamic_pricing NOT BETWEEN 0 AND 1",
}


@query("district_rule_counts", _counts_sql(_DISTRICT_RULES, f"({_DISTRICTS_SQL})"))
def district_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Q.rule_counts(_districts(spark, sf), Q.district_rules())


@query(
    "panel_grid_checks",
    with_views(
        """SELECT 'steps' AS "check", CAST(357 AS BIGINT) AS expected, count(DISTINCT ts) AS actual, count(DISTINCT ts) = 357 AS ok FROM station_panel
        UNION ALL SELECT 'nodes', 100, count(DISTINCT station_id), count(DISTINCT station_id) = 100 FROM station_panel
        UNION ALL SELECT 'off_spacing', 0, count(CASE WHEN gap <> 604800 THEN 1 END), count(CASE WHEN gap <> 604800 THEN 1 END) = 0
          FROM (SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY station_id ORDER BY ts))) // 1000000 AS gap FROM station_panel)""",
        "station_panel",
    ),
)
def panel_grid_checks(spark: SparkSession, sf: str) -> DataFrame:
    return Q.grid_checks(V.station_panel(spark, sf), "station_id", 357, 100, 604800)


@query(
    "panel_grid_derived",
    with_views(
        """SELECT * FROM (WITH gaps AS (SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY station_id ORDER BY ts))) // 1000000 AS gap FROM station_panel),
          common AS (SELECT gap FROM gaps WHERE gap IS NOT NULL GROUP BY gap ORDER BY count(*) DESC, gap LIMIT 1),
          facts AS (SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 // (SELECT gap FROM common) + 1 AS steps, count(DISTINCT ts) AS held,
            count(DISTINCT station_id) AS nodes FROM station_panel),
          off AS (SELECT count(CASE WHEN gap <> (SELECT gap FROM common) THEN 1 END) AS n FROM gaps)
        SELECT 'steps' AS "check", CAST(steps AS BIGINT) AS expected, held AS actual, steps = held AS ok FROM facts
        UNION ALL SELECT 'nodes', (SELECT count(DISTINCT s_suppkey) FROM supplier), nodes, nodes = (SELECT count(DISTINCT s_suppkey) FROM supplier) FROM facts
        UNION ALL SELECT 'off_spacing', 0, n, n = 0 FROM off)""",
        "station_panel",
    ),
)
def panel_grid_derived(spark: SparkSession, sf: str) -> DataFrame:
    """The grid checks at any size of the tables."""
    stations = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station_id"))
    return Q.derived_grid_checks(V.station_panel(spark, sf), "station_id", stations)


@query(
    "price_rule_counts",
    "SELECT 'price_out_of_bounds' AS rule, count(CASE WHEN price NOT BETWEEN 5 AND 30 THEN 1 END) AS failures "
    "FROM (SELECT l_extendedprice / l_quantity / 100 AS price FROM lineitem)",
)
def price_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Line prices outside the bounds, before any clipping."""
    price = F.try_divide("l_extendedprice", "l_quantity") / F.lit(100.0)
    return Q.rule_counts(V.table(spark, sf, "lineitem").select(price.alias("price")), Q.price_rules())


@query(
    "processed_tables",
    with_views(
        """SELECT 'sessions' AS name, CAST(connectionTime AS DATE) AS day, count(*) AS n FROM clean_sessions GROUP BY 2
        UNION ALL SELECT 'panel', CAST(ts AS DATE), count(*) FROM hourly_panel GROUP BY 2
        UNION ALL SELECT 'features', CAST(ts AS DATE), count(*) FROM hourly_panel GROUP BY 2""",
        "clean_sessions",
        "hourly_panel",
    ),
)
def processed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned sessions, panel and features written by day; rows per stored day."""
    paths = write_processed(
        V.sessions(spark, sf), V.SESSION_SERIES, V.hourly_panel(spark, sf), V.STATION_SERIES, scratch_path(spark, "processed")
    )
    out = None
    for name, path in paths.items():
        days = spark.read.parquet(path).groupBy(F.col("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
        named = days.select(F.lit(name).alias("name"), "day", "n")
        out = named if out is None else out.unionByName(named)
    return out


@query(
    "station_source",
    with_views(
        """SELECT CAST(station_id AS VARCHAR) AS station_id, region, CAST("count" AS VARCHAR) AS "count" FROM station_dim""",
        "station_dim",
    ),
)
def station_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stations")
    V.station_dim(spark, sf).select("station_id", "region", "count").write.option("header", True).csv(path)
    return P.read_stations(spark, path)


@query(
    "agent_metric_log",
    with_views(
        """SELECT ts AS "timestamp", 'tariff' AS agent_name, 'utilization' AS metric_name, utilization AS metric_value,
          '{"station":' || station_id || ',"action":"' || name || '"}' AS metadata FROM hourly_decided""",
        "hourly_decided",
    ),
)
def agent_metric_log(spark: SparkSession, sf: str) -> DataFrame:
    """A metric per decision with its context as JSON text, appended and read back."""
    path = scratch_path(spark, "agent-metrics")
    rows = hourly_decided(spark, sf).select(
        F.col("ts").alias("timestamp"),
        F.lit("tariff").alias("agent_name"),
        F.lit("utilization").alias("metric_name"),
        F.col("utilization").alias("metric_value"),
        F.to_json(F.struct(F.col("station_id").alias("station"), F.col("name").alias("action"))).alias("metadata"),
    )
    L.append_log(rows, path, AGENT_METRICS)
    return L.read_log(spark, path, AGENT_METRICS, {"agent_name": "tariff"}, limit=None)
