"""Charging-session source: explicit schema, bad values become null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaria.functions.scalar import finite, parse_timestamp
from voltaria.schemas import SESSIONS

TIME_COLUMNS = ("connectionTime", "disconnectTime", "doneChargingTime")


def read_sessions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Sessions from CSV, JSON or Parquet. Text formats are read as text and coerced."""
    if fmt == "parquet":
        return coerce_sessions(spark.read.parquet(path))
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in SESSIONS])
    reader = spark.read.schema(text)
    return coerce_sessions(reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path))


def coerce_sessions(df: DataFrame) -> DataFrame:
    """Cast to the session schema; a value that cannot be cast, a NaN or an infinity becomes null."""
    kinds = dict(df.dtypes)

    def column(field: T.StructField):
        c = F.col(field.name)
        if field.name not in kinds:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if field.name in TIME_COLUMNS:
            c = parse_timestamp(c) if kinds[field.name] == "string" else c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            c = finite(c.try_cast("double"))
        else:
            c = c.cast("string")
        return c.alias(field.name)

    extra = [F.col(c) for c in df.columns if c not in SESSIONS.fieldNames()]
    return df.select(*extra, *[column(f) for f in SESSIONS])
