"""Charging-network views over order, supplier and event tables.

The session, panel, district and edge tables of the domain are derived from a generic star schema, so
that every operator can run on tables of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.functions.scalar import clip, hours_between
from voltaria.operators.ordered import Series, windowed
from voltaria.session import broadcast_if_small

STATION_SERIES = Series(keys=("station_id",), by=("ts",))
DISTRICT_SERIES = Series(keys=("node_id",), by=("ts",))
SESSION_SERIES = Series(keys=("stationID",), by=("sessionID",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _period(unit: str, ts: str):
    return F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")


def _cents(column: str):
    """Exact money sum over whole cents: doubles added in task order would not repeat."""
    return F.sum(F.rint(F.col(column) * F.lit(100.0)).cast("long")) / F.lit(100.0)


def station_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly panel per supplier: ts, station_id, occupancy, volume, price, capacity."""
    lines = table(spark, sf_dir, "lineitem")
    grouped = lines.groupBy(_period("week", "l_shipdate").alias("ts"), F.col("l_suppkey").alias("station_id")).agg(
        F.count(F.lit(1)).cast("double").alias("occupancy"),
        F.sum("l_quantity").alias("volume"),
        _cents("l_extendedprice").alias("_money"),
    )
    price = clip(F.try_divide(F.col("_money"), F.col("volume")) / F.lit(100.0), 5.0, 30.0)
    return grouped.select(
        "ts",
        "station_id",
        "occupancy",
        "volume",
        price.alias("price"),
        (F.lit(2) + F.col("station_id") % 3).cast("double").alias("capacity"),
    )


def hourly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly panel per user: the same columns and a duration, with gaps where a user had no event."""
    grouped = (
        table(spark, sf_dir, "events")
        .groupBy(_period("hour", "ts").alias("ts"), F.col("user_id").alias("station_id"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("occupancy"),
            _cents("value").alias("volume"),
            hours_between(F.min("ts"), F.max("ts")).alias("duration"),
        )
    )
    price = clip(F.try_divide(F.col("volume"), F.col("occupancy")), 5.0, 30.0)
    return grouped.select(
        "ts",
        "station_id",
        "occupancy",
        "volume",
        "duration",
        price.alias("price"),
        (F.lit(1) + F.col("station_id") % 3).cast("double").alias("capacity"),
    )


def station_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station attributes from supplier, nation and region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("station_id"),
            F.col("s_nationkey").alias("node_id"),
            F.col("r_name").alias("region"),
            (F.col("s_nationkey") % 5).cast("double").alias("area"),
            (F.lit(2) + F.col("s_suppkey") % 3).cast("int").alias("count"),
            (F.col("s_suppkey") % 3).cast("int").alias("fast_count"),
            (F.col("n_regionkey") == 0).alias("cbd_flag"),
            (F.col("s_suppkey") % 2).cast("int").alias("dynamic_pricing"),
            F.col("s_acctbal").alias("balance"),
        )
    )


def district_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly panel per nation; capacity is three per supplier of the nation."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("node_id"))
    capacity = suppliers.groupBy("node_id").agg((F.count(F.lit(1)) * 3).cast("double").alias("capacity"))
    # Suppliers first collapse to one row per week, so the join carries the panel and not the line items.
    weekly = (
        table(spark, sf_dir, "lineitem")
        .groupBy(_period("week", "l_shipdate").alias("ts"), "l_suppkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("l_quantity").alias("volume"),
            F.sum(F.rint(F.col("l_extendedprice") * F.lit(100.0)).cast("long")).alias("cents"),
        )
    )
    grouped = (
        weekly.join(broadcast_if_small(suppliers), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("ts", "node_id")
        .agg(
            F.sum("n").cast("double").alias("occupancy"),
            F.sum("volume").alias("volume"),
            (F.sum("cents") / F.lit(100.0)).alias("_money"),
        )
    )
    price = clip(F.try_divide(F.col("_money"), F.col("volume")) / F.lit(100.0), 5.0, 30.0)
    return grouped.withColumn("price", price).join(broadcast_if_small(capacity), "node_id").select(
        "ts", "node_id", "occupancy", "volume", "price", "capacity"
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in both directions between nations that follow each other in a region; distance is the key gap."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("src"), "n_regionkey")
    chain = windowed(
        nation, Series(keys=("n_regionkey",), by=("src",)), {"dst": lambda w: F.lead("src").over(w)}, ahead=1
    ).where(F.col("dst").isNotNull())
    gap = (F.col("dst") - F.col("src")).cast("double").alias("dist")
    there = chain.select("src", "dst", gap)
    return there.unionByName(there.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "dist"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charging sessions from events: plug-in at the event, plug-out at the user's next event."""
    events = table(spark, sf_dir, "events")
    series = Series(keys=("user_id",), by=("ts", "event_id"))
    nexted = windowed(
        events.select("event_id", "ts", "user_id", "event_type", "value"),
        series,
        {"next_ts": lambda w: F.lead("ts").over(w)},
        ahead=1,
    )
    start, end = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("ts", "next_ts"))
    middle = F.timestamp_micros(F.floor((start + end) / 2)).cast("timestamp_ntz")
    kind = F.col("event_type")
    return nexted.select(
        F.col("event_id").alias("sessionID"),
        F.col("ts").alias("connectionTime"),
        F.col("next_ts").alias("disconnectTime"),
        F.when(kind != "view", middle).alias("doneChargingTime"),
        F.when(kind != "error", F.col("value")).alias("kWhDelivered"),
        F.when(kind != "signup", F.col("user_id").cast("string")).alias("stationID"),
        (F.col("user_id") % 10).cast("string").alias("siteID"),
    )
