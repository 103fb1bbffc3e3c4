"""N-gram Jaccard join by a partitioned universe.

Each text is the set of its distinct word shingles (see ``text``). Two sets A, B with Jaccard at least t differ in at
most ``(|A| + |B|)(1 - t)/(1 + t)`` elements. Sizes are cut into bands such that a partner of a set of band k lies in
band k or k + 1; band k allows ``D`` differences, and its universe is hashed into ``m`` segments of which ``q``
also index their one-deletion neighbours. A segment that is equal on both sides tolerates no difference, one
whose neighbourhoods meet tolerates one. So when the weights of a set's usable segments (1 plain, 2 with
neighbours, 0 when empty) sum to more than D, every partner shares a signature with it. ``m`` and ``q`` are the pair of
least estimated cost per band: signatures written plus the collisions expected of short segments.
A set whose weights do not reach that (many empty segments) also writes signatures of further hash seeds until
one suffices; only two such sets can miss each other in an earlier seed.

Signatures held by one set only are dropped in a sorted stream (``stream``). Then, per set, the cheapest (rarest) signatures whose
weights suffice are its probes, and a signature without a probe is dropped. Candidates are verified exactly
on the whole hash sets, in rounds that never list all pairs of a bucket (``linking``).

Defined cases: null, empty and wordless texts have an empty set and link with nothing; equal sets count as one
until the end, so repeated rows share a component; rows with a null key keep a null key; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltaria.llm import stream
from voltaria.llm.linking import link_sets
from voltaria.llm.text import mix, shingle_sets, signed
from voltaria.session import Staging, stage

_SEED = np.uint64(0x632BE59BD9B4E019)
_COLLISION_COST = 2.0
#: Marks in the documents' own rows that travel with the signatures: a null key, an empty set.
_NO_KEY, _EMPTY = 1 << 40, -2


@lru_cache(maxsize=None)
def bands(percent: int, largest: int) -> list[int]:
    """First sizes of the bands: partners of a size in band k lie in band k or k + 1 (or below)."""
    out = [1]
    while out[-1] <= largest:
        out.append(out[-1] * 100 // percent + 1)
    return out + [out[-1] * 100 // percent + 1]


@lru_cache(maxsize=None)
def allocation(first: int, beyond: int, percent: int) -> tuple[int, int, int]:
    """Differences, segments, and segments with one-deletion neighbours of the band ``first .. beyond - 1``.

    Weights must exceed the differences although some segments stay empty (a margin of three deviations).
    """
    differences = (2 * (beyond - 1) * (100 - percent)) // (100 + percent)
    size, best = (first + beyond - 1) / 2, None
    for m in range(max(1, (differences + 2) // 2), differences + differences // 3 + 3):
        empty = m * math.exp(-size / m) if m > 1 else 0.0
        single = empty * size / m
        q = max(0, differences + 1 + math.ceil(empty + 3 * math.sqrt(empty) - 0.05) - m)
        q += math.ceil(q * single / m)
        if q > m:
            continue
        cost = (m - q) + q * (1 + size / m) + _COLLISION_COST * (empty + single)
        if best is None or cost < best[0]:
            best = (cost, m, q)
    return differences, best[1], best[2]


def signatures(hashes: np.ndarray, band: int, first: int, beyond: int, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Signatures of a set in a band, the weight of each (0 for neighbours, which share their segment's), and
    the weight that may be left out of its probes."""
    _, m, q = allocation(first, beyond, percent)
    size = len(hashes)
    differences = ((size + min(size * 100 // percent, beyond - 1)) * (100 - percent)) // (100 + percent)
    signs, weights, spare = [], [], 0
    for seed in range(64):
        tag = mix(np.array([band * 64 + seed], dtype=np.uint64) * _SEED + np.uint64(1))[0]
        scrambled = mix(hashes ^ tag)
        segment = ((scrambled >> np.uint64(33)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        segment, scrambled = segment[order], scrambled[order]
        starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(segment)]]))
        ids = segment[starts]
        sums = np.add.reduceat(scrambled, starts)
        label = mix((ids.astype(np.uint64) + np.uint64(1)) * _SEED + tag)
        signs.append(mix(sums + label))
        near = (ids < q) & (sizes >= 2)
        weight = 1 + near.astype(np.int64)
        weights.append(weight)
        if near.any():
            inside = np.repeat(near, sizes)
            rest = (np.repeat(sums, sizes) - scrambled)[inside]
            signs.append(mix(rest + np.repeat(label, sizes)[inside]))
            weights.append(np.zeros(len(rest), dtype=np.int64))
        total = int(weight.sum())
        if total > differences:
            spare = total - differences - 1 if seed == 0 else 0
            break
    return np.concatenate(signs), np.concatenate(weights), min(spare, 255)


def set_id(hashes: np.ndarray) -> int:
    """One 63-bit id for equal sets."""
    return int(mix(np.array([mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))], dtype=np.uint64))[0] >> np.uint64(1))


def _emit(percent: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            signs, items, metas, ids, sizes = [], [], [], [], []
            for hashes in shingle_sets(batch.column(1), width):
                item = set_id(hashes) if len(hashes) else _EMPTY
                ids.append(item)
                sizes.append(len(hashes))
                if not len(hashes) or item in seen:
                    continue
                seen.add(item)
                edges = bands(percent, 1 << max(12, len(hashes).bit_length()))
                band = int(np.searchsorted(edges, len(hashes), side="right")) - 1
                for k in (band, band + 1):
                    sign, weight, spare = signatures(hashes, k, edges[k], edges[k + 1], percent)
                    signs.append(sign)
                    metas.append((k << 16) + (spare << 8) + weight)
                    items.append(np.full(len(sign), item, dtype=np.int64))
            if len(seen) > 1 << 20:
                seen.clear()
            none = np.zeros(0, np.int64)
            keys = pc.fill_null(batch.column(0), 0).to_numpy()
            rows = np.array(sizes, np.int64) + np.where(batch.column(0).is_null().to_numpy(zero_copy_only=False), _NO_KEY, 0)
            sign = signed(np.concatenate([none.view(np.uint64), *signs]))
            item, meta = np.concatenate([none, *items]), np.concatenate([none, *metas])
            yield stream.batch(sign, item, meta, (keys, np.array(ids, np.int64), rows))

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, items, sizes, sets = set(), [], [], []
            for hashes in shingle_sets(batch.column(0), width):
                if len(hashes) and (item := set_id(hashes)) not in seen:
                    seen.add(item)
                    items.append(item)
                    sizes.append(len(hashes))
                    sets.append(np.sort(signed(hashes)))
            offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
            values = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values)], ["item", "size", "hashes"])

    return run


def allocated(shared: DataFrame) -> DataFrame:
    """``bucket, item, probe`` of the signatures that at least one holder probes.

    A set need not probe its most frequent signatures as long as the weights left out stay within what it can spare.
    """
    held = stage(shared.groupBy("sign").agg(F.count("*").alias("held")), "frequencies")
    rows = shared.join(held, "sign").select(
        "sign", "item", "held", F.shiftright("meta", 16).alias("band"), (F.shiftright("meta", 8) % 256).alias("spare"), (F.col("meta") % 256).alias("weight")
    )
    order = Window.partitionBy("item", "band").orderBy(F.desc("held"), "sign").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("out", F.sum("weight").over(order)).withColumn("probe", F.expr("weight = 0 or out > spare"))
    rows = stage(rows.select(F.col("sign").alias("bucket"), "item", "probe"), "allocated")
    return rows.join(rows.where("probe").select("bucket").distinct(), "bucket", "left_semi")


def jaccard_groups(docs: DataFrame, key: str, text: str, percent: int = 80, width: int = 5) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, set_id (null if empty) and the set id standing for its group."""
    plain = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    kept = stage(stream.shared(plain.mapInArrow(_emit(percent, width), stream.KIND)), "signatures")
    base = kept.where("forced").select(
        F.when(F.col("meta") < _NO_KEY, F.col("sign")).alias(key), (F.col("meta") % (1 << 32)).alias("n_shingles"), F.when(F.col("item") != _EMPTY, F.col("item")).alias("set_id")
    )
    shared = kept.where("not forced").select("sign", "item", "meta").distinct()
    buckets = stage(allocated(shared), "members")
    wanted = buckets.select(F.col("item").alias("set_id")).distinct()
    holders = base.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min(key).alias("key")).select("key")
    texts = plain.join(holders.withColumnRenamed("key", "holder"), F.col("key").eqNullSafe(F.col("holder")), "left_semi").select("text")
    sets = texts.mapInArrow(_sets(width), "item long, size long, hashes array<long>").join(wanted.withColumnRenamed("set_id", "item"), "item", "left_semi")
    found = link_sets(buckets, stage(sets.dropDuplicates(["item"]), "candidates"), percent)
    return base.join(found.select(F.col("node").alias("set_id"), F.col("component").alias("linked_id")), "set_id", "left").select(
        key, "n_shingles", "set_id", F.coalesce("linked_id", "set_id").alias("group_id")
    )


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, width: int = 5) -> DataFrame:
    """``key, n_shingles, component_id``: the smallest key reachable by links (the own key for an empty set).

    The key must be an integer. Rows of null key that are copies of each other have a null component.
    """
    with Staging(docs.sparkSession) as held:
        found = stage(jaccard_groups(docs, key, text, percent, width), "components")
        held.release(found)
    least = found.where("group_id is not null").groupBy("group_id").agg(F.min(key).alias("least"))
    return found.join(least, "group_id", "left").select(key, "n_shingles", F.coalesce("least", key).alias("component_id"))
