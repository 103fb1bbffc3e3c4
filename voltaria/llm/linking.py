"""Connected groups of similar sets, found without listing the pairs within a bucket.

``link_sets`` takes buckets of items (a signature, a band) and returns each item's smallest linked item. Two kinds of
rounds follow each other. In a *joining* round every open item is verified against one head only, the heaviest of those
its buckets elect; what links takes one label, so a group of n similar items costs about n checks and gives about n links,
whatever number of buckets it shares. Joining rounds, with other heads each time, go on while they link an eighth of all items. A *settling* round
then elects a few leaders per bucket, verifies every member with another label against them, and drops the leaders: all their
pairs in the bucket are settled. Buckets whose members share a label are done. Buckets that still hold many labels
after the first settling round are dealt anew, once, by their members' rare hashes (prefix filter). No pair goes unchecked unless its two
items are already known to be connected, or cannot reach the threshold: two sets differ in all hashes that either
holds alone among all candidates, and of their other hashes in at least the difference of their numbers and the bits in
which their parities differ (bit i of a parity tells whether an odd number of hashes ends in i, so one hash flips one bit).

Pairs are verified in blocks bounded by the bytes of the sets they need, and a round's tables go when the next round has its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaria.session import Staging, stage

FIRST_LEADERS, LEADER_GROWTH, MANY_LABELS = 32, 32, 32
JOINING_SHARE = 8
BLOCK_BYTES = 8 << 20
#: Words of 64 bits of a parity.
PARITY_WORDS = 4
PARITY = [f"parity{i}" for i in range(PARITY_WORDS)]


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``a, b`` edges.

    Large-star and small-star steps in turn; each state is written to the shared folder. Hot nodes are
    aggregated before the shuffle, and adaptive joins split them.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state.n == 0 or state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = stage(small.where("a <> b").distinct(), "edges")
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def link_sets(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components of items whose sets reach ``percent`` Jaccard and that share a bucket.

    ``buckets``: ``bucket, item`` and, if not all of an item's buckets are needed to find its partners, ``probe`` (the
    item finds every partner in the buckets so marked); ``sets``: ``item, size, hashes`` (distinct hashes, one row an item).
    Returns ``node, component`` for every item that links with another. Leaders are the items in most buckets, so
    the buckets of one group of copies elect the same ones. Between rounds labels follow the links found by a few
    steps only, which may leave a bucket open for longer; the components are those of all links at the end.
    """
    spark = buckets.sparkSession
    sets = sets.select("item", "size", "hashes")
    facts = _facts(sets)
    # A set with more hashes of its own than any partner could lack has no partner.
    most = (F.col("size") + F.floor(F.col("size") * 100 / percent)) * (100 - percent)
    weight = buckets.groupBy("item").agg((F.count("*") * (1 << 32)).alias("weight"))
    weight = weight.select("item", (F.col("weight") + F.pmod(F.xxhash64("item"), F.lit(1 << 32))).alias("weight"))
    if "probe" not in buckets.columns:
        buckets = buckets.withColumn("probe", F.lit(True))
    fields = ["bucket", "item", "probe", "weight", "size", "lone", *PARITY]
    facts = stage(facts.where(F.col("lone") * (100 + percent) <= most).join(weight, "item"), "facts")
    items = facts.count()
    open_ = buckets.join(facts, "item").select(*fields)
    links: list[DataFrame] = []
    labels: DataFrame | None = None
    tested: DataFrame | None = None
    leaders, turn, joining, settled, refined = FIRST_LEADERS, 0, True, False, False
    with Staging(spark) as held:
        while True:
            cur = open_.withColumn("label", F.col("item"))
            if labels is not None:
                cur = open_.join(labels.withColumnRenamed("node", "item"), "item", "left").select(*fields, F.coalesce("component", "item").alias("label"))
            live = cur.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("bucket")
            cur = stage(cur.join(live, "bucket", "left_semi"), "open")
            held.release(cur, *links, *([labels] if labels else []), *([tested] if tested else []))
            if cur.isEmpty():
                break
            if settled and not refined:
                refined = True
                finer = _refined(cur, sets, facts, percent)
                if finer is not None:
                    open_, leaders = finer, FIRST_LEADERS
                    continue
            rank = F.col("weight") if turn == 0 else F.xxhash64("item", F.lit(turn))
            slot = F.lit(0) if joining else F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(leaders))
            top = [F.max_by(c, rank if joining else F.col("weight")).alias(f"head_{c}") for c in ("item", "label", "size", "lone", "probe", "weight", *PARITY)]
            heads = stage(cur.groupBy("bucket", slot.alias("slot")).agg(*top).drop("slot"), "heads")
            pairs = stage(_pairs(cur, heads, tested, percent, joining), "pairs")
            linked = 0
            if not pairs.isEmpty():
                found = stage(verified(pairs.drop("lo", "hi"), sets, percent), "links")
                done = pairs.select("lo", "hi")
                tested = done if tested is None else tested.unionByName(done)
                linked = found.count()
            if linked:
                links.append(found)
                labels = stage(_followed(found, labels), "labels")
            turn += 1
            open_ = cur.select(*fields)
            if not joining:
                open_ = open_.join(heads.select("bucket", F.col("head_item").alias("item")), ["bucket", "item"], "left_anti")
                leaders, settled = min(leaders * LEADER_GROWTH, 1 << 20), True
            joining = JOINING_SHARE * linked >= items
        if not links:
            held.release()
            return spark.createDataFrame([], "node long, component long")
        out = stage(_joined(reduce(DataFrame.unionByName, links), labels), "labels")
        held.release(out)
    return out


def _pairs(cur: DataFrame, heads: DataFrame, tested: DataFrame | None, percent: int, joining: bool) -> DataFrame:
    """``item, head, bytes, lo, hi`` and the labels of both, still to be verified: every member with every head of its buckets,
    each pair once; when joining, every item with one head."""
    # Either side's probes find a pair: those of the set with more hashes of its own, as they are fewer and rarer. A joining
    # round may miss pairs, and looks from the item's probes only.
    finds = F.when(F.struct("lone", "item") > F.struct("head_lone", "head_item"), F.col("probe")).otherwise(F.col("head_probe"))
    met = (cur.where("probe") if joining else cur).join(heads, "bucket").where("label <> head_label").where(_possible(percent))
    named = [F.col("head_item").alias("head"), ((F.col("size") + F.col("head_size")) * 8).alias("bytes"), F.least("item", "head_item").alias("lo"), F.greatest("item", "head_item").alias("hi")]
    pairs = (met if joining else met.where(finds)).select("item", "head_weight", "label", "head_label", *named)
    pairs = pairs.select("lo", "hi", F.struct("head_weight", "item", "head", "bytes", "label", "head_label").alias("p"))
    if tested is not None:
        pairs = pairs.unionByName(tested.withColumn("p", F.lit(None).cast(pairs.schema["p"].dataType)))
    # One sum a pair finds both its copies and whether it was verified before.
    pairs = pairs.groupBy("lo", "hi").agg(F.max("p").alias("p"), F.count_if(F.col("p").isNull()).alias("done")).where("done = 0").select("p.*", "lo", "hi")
    if joining:
        best = F.max_by(F.struct("head", "bytes", "label", "head_label", "lo", "hi"), "head_weight").alias("p")
        pairs = pairs.groupBy("item").agg(best).select("item", "p.*")
    return pairs.select("item", "head", "bytes", "label", "head_label", "lo", "hi")


def _refined(cur: DataFrame, sets: DataFrame, facts: DataFrame, percent: int) -> DataFrame | None:
    """The open buckets with those of many labels dealt anew by rare hashes, or None if there are none.

    A set that reaches the threshold with x holds that share of x's hashes. So if the hashes of all sets concerned are put
    in one order, rare ones first, both hold one of the other's first ``size - ceil(threshold * size) + 1`` hashes among their own.
    """
    many = stage(cur.groupBy("bucket").agg(F.count_distinct("label").alias("n")).where(F.col("n") > MANY_LABELS).select("bucket"), "many")
    if many.isEmpty():
        return None
    members = cur.join(many, "bucket", "left_semi").select("item").distinct()
    hashes = stage(sets.join(members, "item", "left_semi").select("item", "size", F.explode("hashes").alias("hash")), "hashes")
    counts = hashes.groupBy("hash").agg(F.count("*").alias("n"))
    order = Window.partitionBy("item").orderBy("n", "hash")
    first = F.col("size") - F.floor((F.col("size") * percent + 99) / 100) + 1
    rare = hashes.join(counts, "hash").withColumn("place", F.row_number().over(order)).where((F.col("place") <= first) & (F.col("n") > 1))
    finer = rare.select(F.xxhash64("hash", F.lit("prefix")).alias("bucket"), "item").join(facts, "item")
    kept = cur.join(many, "bucket", "left_anti").drop("label")
    return kept.unionByName(stage(finer.withColumn("probe", F.lit(True)).select(*kept.columns), "finer"))


def _followed(found: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Labels after new links: all items linked with one head, and the labels they had, take the least label among them."""
    least = found.groupBy("b").agg(F.least(F.min("label"), F.min("head_label")).alias("component"))
    moved = found.join(least, "b").select(F.explode(F.array("a", "b", "label", "head_label")).alias("node"), "component")
    least = (moved if labels is None else labels.unionByName(moved)).groupBy("node").agg(F.min("component").alias("component"))
    up = least.select(F.col("node").alias("component"), F.col("component").alias("next"))
    for _ in range(2):
        least = least.join(up, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return least


def _joined(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The components of all links. A label is the least item that its holder is known to be connected with, so what is left to
    find is which labels the links connect; the least item of a component is its own label."""
    of = lambda item, label: labels.select(F.col("node").alias(item), F.col("component").alias(label))
    apart = links.select("a", "b").join(of("a", "la"), "a").join(of("b", "lb"), "b").where("la <> lb")
    least = components(apart.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    least = least.select(F.col("node").alias("component"), F.col("component").alias("least"))
    return labels.join(least, "component", "left").select("node", F.coalesce("least", "component").alias("component"))


def _facts(sets: DataFrame) -> DataFrame:
    """``item, size, lone`` and a parity: how many of a set's hashes no other of these sets holds, and the parity of the rest."""
    held = sets.select("item", F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("n"), F.min("item").alias("item"))
    place = F.pmod("hash", F.lit(64 * PARITY_WORDS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place % 64)
    words = [F.bit_xor(F.when(F.floor(place / 64) == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"lone_{c}") for i, c in enumerate(PARITY)]
    lone = held.where("n = 1").groupBy("item").agg(F.count("*").alias("lone"), *words)
    schema = "item long, size long, " + ", ".join(f"{c} long" for c in PARITY)
    rest = [F.col(c).bitwiseXOR(F.coalesce(f"lone_{c}", F.lit(0).cast("long"))).alias(c) for c in PARITY]
    return sets.mapInArrow(_parities, schema).join(lone, "item", "left").select("item", "size", F.coalesce("lone", F.lit(0)).alias("lone"), *rest)


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set's item and size, and the parity of all its hashes."""
    bits = 64 * PARITY_WORDS
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            sizes = pc.list_value_length(batch.column(2)).to_numpy()
            place = np.repeat(np.arange(batch.num_rows) * bits, sizes) + (batch.column(2).flatten().to_numpy() & (bits - 1))
            odd = np.bincount(place, minlength=batch.num_rows * bits).astype(np.uint8) & 1
            words = np.packbits(odd.reshape(-1, bits), axis=1, bitorder="little").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(words[:, i].copy()) for i in range(PARITY_WORDS))], ["item", "size", *PARITY])


def _possible(percent: int) -> Column:
    """Whether two sets can reach the threshold, from what each holds alone, and the sizes and parities of what others hold too."""
    odd = reduce(Column.__add__, (F.bit_count(F.col(c).bitwiseXOR(F.col(f"head_{c}"))) for c in PARITY))
    apart = F.col("lone") + F.col("head_lone") + F.greatest(F.abs((F.col("size") - F.col("lone")) - (F.col("head_size") - F.col("head_lone"))), odd)
    fits = F.least("size", "head_size") * 100 >= F.greatest("size", "head_size") * percent
    return fits & (apart * (100 + percent) <= (F.col("size") + F.col("head_size")) * (100 - percent))


def verified(pairs: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK_BYTES) -> DataFrame:
    """The pairs ``a, b`` whose exact Jaccard similarity reaches the threshold, from ``item, head, bytes`` (of both sets); other
    columns stay.

    Pairs are dealt by item into blocks of about ``block`` bytes of sets; a block gets the set of each item once, not once a pair.
    """
    total = pairs.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    fit = pairs.withColumnsRenamed({"item": "a", "head": "b"}).drop("bytes").withColumn("block", F.pmod(F.xxhash64("a"), F.lit(1 + total // block)))
    wanted = fit.select("block", F.explode(F.array("a", "b")).alias("item")).groupBy("item").agg(F.collect_set("block").alias("blocks"))
    held = wanted.join(sets.select("item", "hashes"), "item").select(F.explode("blocks").alias("part"), "item", "hashes")

    def check(one: pa.Table, other: pa.Table) -> pa.Table:
        own = {item: x.values.to_numpy() for item, x in zip(other.column("item").to_pylist(), other.column("hashes"))}
        keep = []
        for a, b in zip(one.column("a").to_pylist(), one.column("b").to_pylist()):
            x, y = own[a], own.get(b)
            if y is None:
                keep.append(False)
                continue
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            shared = int(np.count_nonzero(y[at] == x))
            keep.append(shared * 100 >= (len(x) + len(y) - shared) * percent)
        return one.drop_columns(["block"]).filter(pa.array(keep, pa.bool_()))

    return fit.groupBy("block").cogroup(held.groupBy("part")).applyInArrow(check, fit.drop("block").schema)
