"""Append-only metric logs: agent metrics, pricing decisions, model performance, episodes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaria.sources.panel import write_by_date


def conform(df: DataFrame, schema: T.StructType, now: datetime | None = None) -> DataFrame:
    """The log's columns in order; a missing one is null, a missing timestamp is the current UTC time."""

    def column(field: T.StructField):
        known = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = known.cast(field.dataType)
        if field.name == "timestamp":
            stamp = F.lit(now) if now is not None else F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
            value = F.coalesce(value, stamp.cast("timestamp_ntz"))
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema])


def append_log(df: DataFrame, path: str, schema: T.StructType, now: datetime | None = None) -> None:
    """Append rows, partitioned by date so that reads of recent days prune."""
    write_by_date(conform(df, schema, now), path, "timestamp")


def read_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    equals: dict[str, str] | None = None,
    limit: int | None = 500,
    unique: tuple[str, ...] = (),
) -> DataFrame:
    """Rows that match every equality, newest first; ``unique`` columns break ties of the timestamp."""
    stored = T.StructType([*schema.fields, T.StructField("date", T.DateType())])
    rows = spark.read.schema(stored).parquet(path).drop("date")
    return newest(rows, equals, limit, unique)


def newest(
    rows: DataFrame, equals: dict[str, str] | None = None, limit: int | None = 500, unique: tuple[str, ...] = ()
) -> DataFrame:
    """Filter, then the latest rows first; with a limit this is a top-n, not a full sort."""
    for name, value in (equals or {}).items():
        rows = rows.where(F.col(name) == F.lit(value))
    ranked = rows.orderBy(F.desc("timestamp"), *[F.desc(c) for c in unique])
    return ranked if limit is None else ranked.limit(limit)
