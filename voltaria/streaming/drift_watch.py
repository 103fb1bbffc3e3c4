"""Metric log fed by a stream, with drift detection after each micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from voltaria.config import MonitorConfig
from voltaria.operators.monitor import drift, newest
from voltaria.sources.versioned import VersionedTable

BUCKETS = 64


class DriftWatch:
    """Appends each micro-batch to the log and brings the drift status of the affected groups up to date.

    Drift looks at the newest ``window`` rows of a group, so only those are kept, in hash buckets of the group. A batch
    reads and rewrites the buckets that its groups fall into and no others; the status table has the same buckets.
    So a batch costs what it touches, whatever the length of the log and the number of groups, and
    a batch that is run again after a failure leaves the same rows.
    """

    def __init__(self, root: str, keys: list[str], config: MonitorConfig = MonitorConfig(), buckets: int = BUCKETS) -> None:
        self.log_path = f"{root}/log"
        self.recent = VersionedTable(f"{root}/recent")
        self.status = VersionedTable(f"{root}/status")
        self.keys = keys
        self.config = config
        self.buckets = buckets

    def bucket(self) -> Column:
        """The bucket of a group, as text."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        own = f"{self.log_path}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(own)
        arrived = spark.read.schema(schema).parquet(own).withColumn("part", self.bucket())
        touched = [r.part for r in arrived.select("part").distinct().collect()]  # at most one name a bucket
        known = arrived.unionByName(self.recent.read(spark, schema, touched, before=batch_id))
        self.recent.write(newest(known, self.keys, self.config.window).drop("_age"), batch_id)
        kept = self.recent.read(spark, schema, touched, before=batch_id + 1).drop("part")
        self.status.write(drift(kept, self.keys, self.config).withColumn("part", self.bucket()), batch_id)

    def writer(self, metrics: DataFrame, checkpoint: str) -> DataStreamWriter:
        return (
            metrics.writeStream.foreachBatch(self)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
        )

    def latest_status(self, spark: SparkSession, metrics: DataFrame) -> DataFrame:
        """The newest status of every group; ``metrics`` is any frame of the log's columns, of which only the types are used."""
        return self.status.read(spark, drift(metrics, self.keys, self.config).schema).drop("part")
