"""Joins of panel rows with an edge list whose nodes may have any number of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaria import session

#: Edges of one node that a join key may hold; a node with more is a hub.
HUB_EDGES = 100_000


def dealt(edges: DataFrame, key: str, hub_edges: int = HUB_EDGES) -> tuple[DataFrame, DataFrame]:
    """``edges`` with ``_chunk``, and ``key, _chunks`` of the hubs.

    A hub's edges are dealt by hash into chunks of about ``hub_edges``; all others have chunk 0. There are fewer hubs than
    edges / ``hub_edges``; they are counted once and written, as both sides of a join read them.
    """
    counts = edges.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(hub_edges)).cast("int").alias("_chunks"))
    hubs = session.broadcast_if_small(session.stage(counts.where("_chunks > 1"), "hubs"))
    chunk = F.when(F.col("_chunks").isNull(), 0).otherwise(F.pmod(F.xxhash64(*edges.columns), F.col("_chunks"))).cast("int")
    return edges.join(hubs, key, "left").withColumn("_chunk", chunk).drop("_chunks"), hubs


def met(rows: DataFrame, edges: DataFrame, key: str, hub_edges: int = HUB_EDGES) -> DataFrame:
    """``rows`` joined with ``edges`` on ``key``.

    An edge list of small known size is broadcast. Else a hub's rows are repeated for each chunk of its edges, so that
    no join key holds more than about ``hub_edges`` edges; what follows sums by (step, node) and combines before its shuffle.
    """
    if session.plan_bytes(edges) <= session.BROADCAST_BYTES:
        return rows.join(F.broadcast(edges), key)
    chunked, hubs = dealt(edges, key, hub_edges)
    every = F.sequence(F.lit(0), F.coalesce(F.col("_chunks"), F.lit(1)) - 1)
    repeated = rows.join(hubs, key, "left").withColumn("_chunk", F.explode(every)).drop("_chunks")
    return repeated.join(chunked, [key, "_chunk"]).drop("_chunk")
