"""Queries that run a stream to its end and return what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.queries.inputs import metric_rows
from voltaria.queries.monitoring import _DRIFT, KEYS
from voltaria.queries.registry import R, query, rounded
from voltaria.queries.views_sql import with_views
from voltaria.session import scratch_path
from voltaria.sources import driver_views as V
from voltaria.streaming.drift_watch import DriftWatch
from voltaria.streaming.hourly_kpis import WindowTable, start_append, windowed_kpis


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = V.table(spark, sf, "events").schema
    # The glob names one file: a stream source lists a directory or a pattern.
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    return stream.select(F.col("ts").alias("connectionTime"), F.col("value").alias("kWhDelivered"))


def _run(spark: SparkSession, kpis: DataFrame) -> DataFrame:
    root = scratch_path(spark, "stream")
    start_append(kpis, f"{root}/out", f"{root}/state").start().awaitTermination()
    return spark.read.schema(kpis.schema).parquet(f"{root}/out")


_WINDOWS = """SELECT s AS window_start, s + INTERVAL {size} AS window_end, count(*) AS sessions,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS energy, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_energy
  FROM {source} WHERE s + INTERVAL {size} <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOURS FROM events) GROUP BY s"""
_HOUR = "CAST(date_trunc('hour', ts) AS TIMESTAMP)"


@query("stream_hourly_kpis", _WINDOWS.format(size="1 HOUR", source=f"(SELECT *, {_HOUR} AS s FROM events)"))
def stream_hourly_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Windows closed by the watermark, two hours behind the newest event."""
    return _run(spark, windowed_kpis(_event_stream(spark, sf)))


@query(
    "stream_sliding_kpis",
    _WINDOWS.format(
        size="2 HOURS",
        source=f"(SELECT *, {_HOUR} AS s FROM events UNION ALL SELECT *, {_HOUR} - INTERVAL 1 HOUR AS s FROM events)",
    ),
)
def stream_sliding_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of two hours, one starting every hour."""
    return _run(spark, windowed_kpis(_event_stream(spark, sf), size="2 hours", slide="1 hour"))


@query(
    "stream_drift_status",
    with_views(
        f"""SELECT station_id, metric, rows, {R('z', 5)} AS z_score, coalesce(z > 2.0::DOUBLE, false) AS drifted FROM {_DRIFT}""", "metrics"
    ),
)
def stream_drift_status(spark: SparkSession, sf: str) -> DataFrame:
    """Metric rows arrive in two batches; the status after the second equals the batch result."""
    root = scratch_path(spark, "drift")
    metrics = metric_rows(spark, sf)
    watch = DriftWatch(root, KEYS)
    early = F.col("seq") < 1470
    for part in (metrics.where(early), metrics.where(~early)):
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(metrics.schema).parquet(f"{root}/in")
        watch.writer(stream, f"{root}/state").start().awaitTermination()
    return rounded(watch.latest_status(spark, metrics).select(*KEYS, "rows", "z_score", "drifted"), 5)


def _two_arrivals(spark: SparkSession, sf: str) -> WindowTable:
    """All events in two micro-batches: two thirds first, then the rest, much of which comes late."""
    root = scratch_path(spark, "windows")
    table = WindowTable(root)
    events = V.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("connectionTime"), F.col("value").alias("kWhDelivered"))
    first = F.col("event_id") % 3 != 0
    for part in (events.where(first), events.where(~first)):
        part.drop("event_id").coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(part.drop("event_id").schema).parquet(f"{root}/in")
        table.writer(stream, f"{root}/state").start().awaitTermination()
    return table


_FIRST = "event_id % 3 <> 0"
_CLOSED = f"(SELECT max(ts) - INTERVAL 2 HOURS FROM events WHERE {_FIRST})"


@query(
    "stream_open_kpis",
    f"""SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS sessions, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS energy,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_energy, s + INTERVAL 1 HOUR > (SELECT max(ts) - INTERVAL 2 HOURS FROM events) AS open
    FROM (SELECT *, {_HOUR} AS s FROM events) WHERE {_FIRST} OR s + INTERVAL 1 HOUR > {_CLOSED} GROUP BY s""",
)
def stream_open_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Every window after two batches, open ones too; what came late is not in."""
    return _two_arrivals(spark, sf).kpis(spark)


@query(
    "stream_late_rows",
    f"""SELECT 0::BIGINT AS batch, count(*) AS rows, 0::BIGINT AS late_rows FROM events WHERE {_FIRST}
    UNION ALL SELECT 1, count(*), count(*) FILTER (s + INTERVAL 1 HOUR <= {_CLOSED}) FROM (SELECT *, {_HOUR} AS s FROM events) WHERE NOT ({_FIRST})""",
)
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and late rows of both batches."""
    return _two_arrivals(spark, sf).batches(spark).drop("newest")
