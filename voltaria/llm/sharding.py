"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Shard s of weight w scores ``-w / ln(u)`` for a record, where u in (0, 1) comes from the MD5 of the key and the shard's name;
the highest score wins (ties: the lowest shard). A shard's score does not depend on the other shards, so one more
shard only takes records into itself, in proportion to its weight, and all others stay where they are.

Slots number the rows of a shard from 0 without gaps, in order of key, then CRC and size of the text. The narrow rows are
range-partitioned by that order (ties are cut too) and written with their slice; counts per slice and shard, few
rows, give each slice its first slot. No shard is ever one task.

Defined cases: a null key hashes like the text ``null``; null text has size 1 and CRC 0, like empty text; repeated rows share
their shard and get slots of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaria.session import stage

SLICE_ROWS = 1_000_000


def uniform(key: Column, shard: int) -> Column:
    """A number in (0, 1) from the MD5 of key and shard."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{shard}"))
    number = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (number + F.lit(0.5)) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of a key."""
    scores = [F.struct((F.lit(-float(w)) / F.log(uniform(key, s))).alias("score"), F.lit(-s).alias("order")) for s, w in enumerate(weights)]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["order"]).cast("int")


def shards(docs: DataFrame, key: str = "doc_id", text: str = "text", weights: list[float] | None = None, grown: float = 1.0) -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` for every row; ``grown`` is the weight of one more shard."""
    weights = weights or [1.0] * 8
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("key"),
        F.when(F.col(text).isNull(), F.lit(1)).otherwise(F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, grown]).alias("grown_shard"),
    )
    first = stage(rows, "shards")
    order = ["key", "text_crc32", "size"]
    slices = max(1, -(-first.count() // SLICE_ROWS), min(64, first.rdd.getNumPartitions()))
    ranged = first.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(slices, *order, "tie")
    held = stage(ranged.withColumn("slice", F.spark_partition_id()), "slices")
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = held.groupBy("slice", "shard").agg(F.count("*").alias("n"))
    starts = counts.select("slice", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("slice", "shard").orderBy(*order, "tie")) - 1
    numbered = held.withColumn("within", within).join(starts, ["slice", "shard"])
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("within")).cast("long").alias("slot"), "grown_shard")
