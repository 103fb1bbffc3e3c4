"""Session KPIs per hour from a stream of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from voltaria.session import file_names
from voltaria.sources.versioned import VersionedTable

_STATE = "window_start timestamp, window_end timestamp, sessions long, energy decimal(38,2)"
_STATE_TYPE = (
    T.StructType().add("window_start", "timestamp").add("window_end", "timestamp").add("sessions", "long").add("energy", T.DecimalType(38, 2))
)
_FACTS = "newest timestamp, rows long, late_rows long"


def windowed_kpis(
    sessions: DataFrame,
    ts: str = "connectionTime",
    size: str = "1 hour",
    slide: str | None = None,
    late: str = "2 hours",
) -> DataFrame:
    """Session count, energy and mean energy per tumbling (or sliding) window; later rows are dropped.

    The watermark bounds the state: one row per open window, whatever the number of sessions.
    """
    timed = sessions.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = timed.groupBy(window.alias("w")).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum(F.col("kWhDelivered").cast("decimal(18,2)")).cast("double").alias("energy"),
    )
    return grouped.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "sessions",
        "energy",
        F.try_divide("energy", F.col("sessions").cast("double")).alias("mean_energy"),
    )


def start_append(kpis: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append closed windows to Parquet until the input is exhausted."""
    return (
        kpis.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


class WindowTable:
    """KPIs per window in dated files, brought up to date by each micro-batch.

    Open windows are visible at once, and each window is there once: a batch adds its sums to the windows it touches and
    rewrites only their days, so a repeated batch leaves the same rows. Rows that come after all
    their windows have closed (``late`` behind the newest time of earlier batches) change nothing and are counted. Rows without a
    time belong to no window and are not counted.
    """

    def __init__(self, root: str, size: str = "1 hour", slide: str | None = None, late: str = "2 hours", ts: str = "connectionTime") -> None:
        self.windows = VersionedTable(f"{root}/windows")
        self.partial_path, self.batch_path = f"{root}/partial", f"{root}/batches"
        self.size, self.slide, self.late, self.ts = size, slide, late, ts

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = self._newest(spark, batch_id)
        closed = F.col("window_end") <= seen - F.expr(f"interval {self.late}")
        own = f"{self.partial_path}/batch={batch_id}"
        self._sums(batch).withColumn("late", F.coalesce(closed, F.lit(False))).write.mode("overwrite").parquet(own)
        sums = spark.read.schema(f"{_STATE}, rows long, newest timestamp, late boolean").parquet(own)
        part = F.date_format("window_start", "yyyy-MM-dd")
        fresh = sums.where("not late").select("window_start", "window_end", "sessions", "energy", part.alias("part"))
        days = [r.part for r in fresh.select("part").distinct().collect()]  # the days that a batch touches
        known = fresh.unionByName(self.windows.read(spark, _STATE_TYPE, days, before=batch_id))
        merged = known.groupBy("window_start", "window_end", "part").agg(F.sum("sessions").alias("sessions"), F.sum("energy").cast("decimal(38,2)").alias("energy"))
        self.windows.write(merged.select("window_start", "window_end", "sessions", "energy", "part"), batch_id)
        facts = sums.agg(
            F.greatest(F.max("newest"), seen).alias("newest"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("late"), F.col("rows"))), F.lit(0)).cast("long").alias("late_rows"),
        )
        facts.write.mode("overwrite").parquet(f"{self.batch_path}/batch={batch_id}")

    def _sums(self, batch: DataFrame) -> DataFrame:
        """Sums per window. A row counts under ``rows`` in the last of its windows only."""
        timed = batch.withColumn(self.ts, F.col(self.ts).cast("timestamp"))
        window = F.window(self.ts, self.size, self.slide) if self.slide else F.window(self.ts, self.size)
        last = F.col(self.ts) < F.col("w.start") + F.expr(f"interval {self.slide or self.size}")
        return timed.select(window.alias("w"), self.ts, "kWhDelivered").groupBy("w").agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum(F.col("kWhDelivered").cast("decimal(18,2)")).cast("decimal(38,2)").alias("energy"),
            F.count_if(last).alias("rows"),
            F.max(self.ts).alias("newest"),
        ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "sessions", "energy", "rows", "newest")

    def _newest(self, spark: SparkSession, before: int) -> Column:
        """Newest time of the batches before one, null for the first."""
        held = [int(n.removeprefix("batch=")) for n in file_names(spark, self.batch_path) if n.startswith("batch=")]
        held = [b for b in held if b < before and "_SUCCESS" in file_names(spark, f"{self.batch_path}/batch={b}")]
        if not held:
            return F.lit(None).cast("timestamp")
        facts = spark.read.schema(_FACTS).parquet(f"{self.batch_path}/batch={max(held)}")
        return F.timestamp_micros(F.lit(facts.select(F.unix_micros("newest")).first()[0]).cast("long"))

    def writer(self, sessions: DataFrame, checkpoint: str) -> DataStreamWriter:
        return sessions.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint).trigger(availableNow=True)

    def batches(self, spark: SparkSession) -> DataFrame:
        """``batch, newest, rows, late_rows``: newest time so far, rows and late rows of every batch."""
        return spark.read.schema(f"{_FACTS}, batch long").parquet(self.batch_path).select("batch", F.col("newest").cast("timestamp_ntz").alias("newest"), "rows", "late_rows")

    def kpis(self, spark: SparkSession) -> DataFrame:
        """Every window once; ``open`` while rows may still reach it."""
        newest = self.batches(spark).agg(F.max("newest")).scalar()
        rows = self.windows.read(spark, _STATE_TYPE)
        return rows.select(
            F.col("window_start").cast("timestamp_ntz").alias("window_start"),
            F.col("window_end").cast("timestamp_ntz").alias("window_end"),
            "sessions",
            F.col("energy").cast("double").alias("energy"),
            F.try_divide(F.col("energy").cast("double"), F.col("sessions").cast("double")).alias("mean_energy"),
            (F.col("window_end").cast("timestamp_ntz") > newest - F.expr(f"interval {self.late}")).alias("open"),
        )
