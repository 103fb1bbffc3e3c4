"""Regression forests and boosted trees of several expanding folds, grown side by side.

The trees are those that Spark ML fits to each fold: the same thresholds (from its sample), bags, feature subsets and
order of nodes, so its random draws are repeated here. What differs is the way: rows are binned once into chunks of bytes, and one
pass over the chunks of all folds sums what every open node of a level needs, so neither passes nor jobs grow with the folds.
Sums are added up by fold and tree on the executors; the driver gets one histogram per open node and picks the splits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, TaskContext, cloudpickle, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaria.session import stage

# Executors need not have this package: what a task uses of this module goes with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a chunk; bits of one column of marks.
ROWS = 8192
BITS = 60
# Fixed values of Spark ML: rows that thresholds are read from, and the least share that is drawn row by row.
SAMPLE = 10_000
GAP_SHARE = 0.4
EPSILON = 2.0**-52

_MASK = (1 << 64) - 1


class JavaRandom:
    """``java.util.Random``."""

    def __init__(self, seed: int) -> None:
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return _signed(self.state >> 16, 32)

    def long(self) -> int:
        return _signed((self._next() << 32) + self._next(), 64)


class XorShift:
    """Spark's ``XORShiftRandom``."""

    def __init__(self, seed: int) -> None:
        data = (seed & _MASK).to_bytes(8, "big")
        low = _murmur(data, 0x3C074A61)
        self.state = (_murmur(data, low) << 32) | low

    def bits(self, n: int) -> int:
        s = self.state
        s ^= (s << 21) & _MASK
        s ^= s >> 35
        s ^= (s << 4) & _MASK
        self.state = s
        return s & ((1 << n) - 1)

    def double(self) -> float:
        high = self.bits(26) << 27
        return (high + self.bits(27)) * 2.0**-53


def _signed(value: int, bits: int) -> int:
    value &= (1 << bits) - 1
    return value - (1 << bits) if value >> (bits - 1) else value


def _murmur(data: bytes, seed: int) -> int:
    h = seed
    for at in range(0, len(data), 4):
        k = int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        h = h * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _map_order(keys: list[int], shift: int = 0) -> list[int]:
    """The order in which an immutable Scala map goes over whole numbers that came in a hash map."""
    if not shift and len(keys) < 5:
        return sorted(keys, key=lambda key: (key & 15, key))
    slots: dict[int, list[int]] = {}
    for key in keys:
        slots.setdefault(_improved(key) >> shift & 31, []).append(key)
    alone = [slots[s][0] for s in sorted(slots) if len(slots[s]) == 1]
    return alone + [key for s in sorted(slots) if len(slots[s]) > 1 for key in _map_order(slots[s], shift + 5)]


def _improved(key: int) -> int:
    h = (key + ~(key << 9)) & 0xFFFFFFFF
    h ^= h >> 14
    h = (h + (h << 4)) & 0xFFFFFFFF
    return h ^ h >> 10


@dataclass(frozen=True)
class Settings:
    """What of an estimator's parameters decides its trees."""

    boosted: bool
    trees: int
    depth: int
    bins: int
    seed: int
    rate: float
    subset: int
    least: int
    gain: float
    step: float


def settings(estimator: object, width: int) -> Settings | None:
    """The settings of an estimator that can be grown here; None for any other, which is left to its own ``fit``."""
    if not isinstance(estimator, GBTRegressor | RandomForestRegressor):
        return None
    get, boosted = estimator.getOrDefault, isinstance(estimator, GBTRegressor)
    trees = get("maxIter" if boosted else "numTrees")
    strategy = get("featureSubsetStrategy")
    try:
        share = float(strategy)
    except ValueError:
        share = 1.0 if strategy == "all" else -1.0
    plain = not any(estimator.isSet(p) for p in ("weightCol", "validationIndicatorCol", "thresholds", "leafCol") if estimator.hasParam(p))
    plain = plain and get("minWeightFractionPerNode") == 0 and 1 < get("maxBins") <= 100 and (0 < share <= 1 or strategy.isdigit()) and get("maxDepth") > 0
    plain = plain and (get("lossType") == "squared" if boosted else get("bootstrap") and trees > 1)
    if not plain:
        return None
    subset = min(int(strategy), width) if strategy.isdigit() else ceil(share * width)
    return Settings(
        boosted, trees, get("maxDepth"), get("maxBins"), get("seed"), get("subsamplingRate"), subset, get("minInstancesPerNode"), get("minInfoGain"), get("stepSize") if boosted else 1.0
    )


class Tree:
    """A tree in heap order: node i has the children 2 i and 2 i + 1. Rows go left at a node without a split."""

    def __init__(self, depth: int) -> None:
        size = 2 << depth
        self.depth = depth
        self.feature, self.cut = np.zeros(size, np.intp), np.full(size, 255, np.uint8)
        self.n, self.s, self.q, self.gain = (np.zeros(size) for _ in range(4))
        self.inner = np.zeros(size, bool)

    def put(self, node: int, n: float, s: float, q: float) -> None:
        self.n[node], self.s[node], self.q[node] = n, s, q

    def spread(self, node: int) -> float:
        n = self.n[node]
        return (self.q[node] - self.s[node] * self.s[node] / n) / n if n else 0.0

    def values(self) -> np.ndarray:
        """The mean of each node, a leaf's also at the end of the way left below it."""
        out = np.divide(self.s, self.n, out=np.zeros(len(self.n)), where=self.n > 0)
        for i in range(1, len(out) // 2):
            if not self.inner[i]:
                out[2 * i] = out[i]
        return out


def walked(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, steps: int) -> np.ndarray:
    """The node that each row (a column of ``bins``) has reached after some steps from the root."""
    rows = bins.shape[1]
    if not steps:
        return np.ones(rows, np.intp)
    node = (bins[feature[1]] > cut[1]).astype(np.intp)
    node += 2
    flat, start, row = bins.reshape(-1), feature * rows, np.arange(rows)
    for _ in range(steps - 1):
        right = flat[start[node] + row] > cut[node]
        node *= 2
        node += right
    return node


def _chunks(batches: Iterator[pa.RecordBatch], size: int = ROWS) -> Iterator[list[np.ndarray]]:
    """The columns of a partition in runs of ``size`` rows; the last one may be shorter."""
    held, rows = [], 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += batch.num_rows
        if rows >= size:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            for at in range(0, rows - size + 1, size):
                yield [c[at : at + size] for c in columns]
            left = rows % size
            held, rows = [[c[rows - left :] for c in columns]], left
    if rows:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _batch(names: Iterable[str], *columns: list) -> pa.RecordBatch:
    kinds = [pa.binary() if isinstance(c[0], bytes) else pa.int64() if n == "chunk" else pa.int32() for n, c in zip(names, columns, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))


def _sample(df: DataFrame, features: list[str], sizes: Mapping[int, int], seed: int) -> dict[int, np.ndarray]:
    """The rows that Spark ML reads the thresholds of each fold from, about 10,000 a fold, in one scan."""
    draw = _signed(XorShift(seed).bits(32), 32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = JavaRandom(draw)
        for _ in range(TaskContext.get().partitionId()):
            seeds.long()
        own = seeds.long()
        samplers = {k: _Sampler(SAMPLE / n if SAMPLE < n else 1.0, XorShift(own)) for k, n in sizes.items()}
        for batch in batches:
            block = batch.column(0).to_numpy(zero_copy_only=False)
            values = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1)
            for k, sampler in samplers.items():
                rows = np.flatnonzero(block < k)
                taken = values[rows[sampler.take(len(rows))]]
                if len(taken):
                    yield _batch(("fold", "rows"), [k], [taken.tobytes()])

    found = df.select("block", *features).mapInArrow(run, "fold int, rows binary").collect()
    return {k: np.frombuffer(b"".join(r.rows for r in found if r.fold == k)).reshape(-1, len(features)) for k in sizes}


class _Sampler:
    """Positions that Spark's Bernoulli sampler takes of a run of rows."""

    def __init__(self, share: float, random: XorShift) -> None:
        self.share, self.random, self.wait = share, random, 0
        if share <= GAP_SHARE:
            self._advance()

    def _advance(self) -> None:
        self.wait = int(log(max(self.random.double(), 5e-11)) / log1p(-self.share))

    def take(self, rows: int) -> list[int]:
        if self.share >= 1:
            return list(range(rows))
        if self.share > GAP_SHARE:
            return [i for i in range(rows) if self.random.double() <= self.share]
        out, at = [], self.wait
        while at < rows:
            out.append(at)
            self._advance()
            at += 1 + self.wait
        self.wait = at - rows
        return out


def thresholds(sample: np.ndarray, total: int, bins: int) -> list[np.ndarray]:
    """Per feature the cuts that Spark ML puts between sampled values, at most ``bins`` - 1."""
    bins = min(bins, total)
    expected = min(SAMPLE / total, 1.0) * total
    out = []
    for column in sample.T:
        values, counts = np.unique(column[column != 0.0], return_counts=True)
        known = int(counts.sum())
        weights = counts.astype(float)
        if known and expected - known > EPSILON * known * 100:
            at = int(np.searchsorted(values, 0.0))
            values, weights = np.insert(values, at, 0.0), np.insert(weights, at, expected - known)
        middle = (values[:-1] + values[1:]) / 2.0
        if len(middle) > bins - 1:
            kept, stride, so_far = [], expected / bins, weights[0]
            target = stride
            for i in range(1, len(values)):
                before, so_far = so_far, so_far + weights[i]
                if abs(before - target) < abs(so_far - target):
                    kept.append(i - 1)
                    target += stride
            middle = middle[kept]
        out.append(middle)
    return out


_CHUNK = ("fold", "chunk", "bins", "target", "taken")


def _binned(df: DataFrame, features: list[str], cuts: Mapping[int, list[np.ndarray]], seed: int, rate: float, rounds: int, label: str) -> DataFrame:
    """``fold, chunk, bins, target, taken``: each fold's rows in chunks, ``taken`` holding a bit per round and row."""
    # Spark ML seeds the draws of a round with the seed, the round, and the partition plus one.
    marks = [F.rand(seed + m + 1) < rate for m in range(rounds if rate < 1 else 0)]
    rounds = len(marks)
    packed = [sum((F.shiftleft(c.cast("long"), i) for i, c in enumerate(marks[at : at + BITS])), F.lit(0).cast("long")) for at in range(0, rounds, BITS)]

    def run_for(k: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            for at, columns in enumerate(_chunks(batches)):
                target, values, held = columns[0], columns[1 : 1 + len(features)], columns[1 + len(features) :]
                if np.isnan(target).any() or not all(np.isfinite(v).all() for v in values):
                    raise ValueError("labels must not be null or NaN, and features must be finite")
                bins = np.stack([np.searchsorted(c, v) for c, v in zip(cuts[k], values, strict=True)]).astype(np.uint8)
                bits = [np.packbits((held[i // BITS] >> i % BITS) & 1 > 0) for i in range(rounds)]
                taken = np.concatenate(bits).tobytes() if bits else b""
                yield _batch(_CHUNK, [k], [(part << 32) + at], [bins.tobytes()], [target.astype(float).tobytes()], [taken])

        return run

    kind = "fold int, chunk long, bins binary, target binary, taken binary"
    made = [df.where(F.col("block") < k).select(F.col(label).cast("double").alias("_label"), *features, *(c.alias(f"_marks_{i}") for i, c in enumerate(packed))).mapInArrow(run_for(k), kind) for k in cuts]
    return _staged(made, "chunks")


def _staged(frames: list[DataFrame], label: str) -> DataFrame:
    """Frames of one schema, written at the same time and read as one."""
    spark = frames[0].sparkSession
    with ThreadPoolExecutor(len(frames)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(stage), df, label) for df in frames]
        out = [made.result() for made in running]
    files = [f for df in out for f in df.inputFiles()]
    return spark.read.schema(out[0].schema).parquet(*files) if files else out[0]


def _bags(df: DataFrame, own: Settings) -> DataFrame:
    """``chunk, bags``: how often each tree of a forest takes each row of a chunk, a row of bytes per tree.

    The draws are those of ``sampleByKey`` with one key, over every row once per tree. They go by partition and position only, so
    those of the largest fold are every fold's.
    """
    spark, trees = df.sparkSession, own.trees
    encoders = spark._jvm.org.apache.spark.sql.Encoders
    pair = encoders.tuple(encoders.INT(), encoders.LONG())

    def counted(held: list[np.ndarray]) -> bytes:
        found = np.bincount(np.concatenate(held), minlength=ROWS * trees)
        return np.ascontiguousarray(found.astype(np.uint8).reshape(ROWS, trees).T).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per, at, held = ROWS * trees, None, []
        for batch in batches:
            values = batch.column(0).to_numpy()
            while len(values):
                # A value is (partition, position, tree); partitions start at multiples of 2^33 positions.
                part, place = divmod(int(values[0]) // trees, 1 << 33)
                now, start = (part << 32) + place // ROWS, ((part << 33) + place // ROWS * ROWS) * trees
                if at is not None and now != at:
                    yield _batch(("chunk", "bags"), [at], [counted(held)])
                    held = []
                at, end = now, int(np.searchsorted(values, start + per))
                held.append(values[:end] - start)
                values = values[end:]
        if at is not None:
            yield _batch(("chunk", "bags"), [at], [counted(held)])

    rows = df.select((F.monotonically_increasing_id() * trees).alias("_row"))
    items = rows.select(F.lit(0).alias("_1"), F.explode(F.sequence("_row", F.col("_row") + (trees - 1))).alias("_2"))
    java = spark._jvm.org.apache.spark.api.java.JavaPairRDD.fromJavaRDD(getattr(items._jdf, "as")(pair).toJavaRDD())
    drawn = java.sampleByKey(True, {0: float(own.rate)}, own.seed + 1).values()
    drawn = DataFrame(spark._jsparkSession.createDataset(drawn.rdd(), encoders.LONG()).toDF(), spark)
    return drawn.mapInArrow(run, "chunk long, bags binary")


def _partials(growing: Mapping[int, Mapping[int, tuple]], width: int, bins: int, level: int, boosted: bool, rounds: int):
    """A task's sums: for each fold and tree counts, sums and sums of squares per feature, open node and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, k in enumerate(batch.column(0).to_pylist()):
                if k not in growing:
                    continue
                bin_of, label, extra = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in ((1, np.uint8), (2, np.float64), (3, np.uint8)))
                bin_of, n = bin_of.reshape(width, -1), len(label)
                for t, (feature, cut, slot_of, slots) in growing[k].items():
                    size = (slots + 1) * bins
                    rows, y, weight = bin_of, label, 1.0
                    if boosted and rounds:
                        y = 2.0 * (label - np.frombuffer(batch.column(4)[i].as_buffer()))
                    if not boosted:
                        bag = extra[t * ROWS : t * ROWS + n] if len(extra) else np.zeros(n, np.uint8)
                        chosen = np.flatnonzero(bag)
                        rows, weight, y = bin_of[:, chosen], bag[chosen].astype(float), label[chosen]
                    slot = slot_of[walked(rows, feature, cut, level)]
                    if boosted and len(extra):
                        per = (n + 7) // 8
                        slot[np.unpackbits(extra[rounds * per : (rounds + 1) * per], count=n) == 0] = slots
                    slot *= bins
                    if (k, t) not in sums:
                        sums[k, t] = np.zeros((3, width, size))
                    total = sums[k, t]
                    # Each sum goes on from the one so far, row by row: the bins' sums so far come first.
                    key = np.empty(size + len(y), np.intp)
                    key[:size] = np.arange(size)
                    added = np.empty((3, size + len(y)))
                    added[0, size:], added[1, size:] = weight, weight * y
                    added[2, size:] = added[1, size:] * y
                    for f in range(width):
                        np.add(slot, rows[f], out=key[size:])
                        added[:, :size] = total[:, f]
                        for j in range(3):
                            total[j, f] = np.bincount(key, added[j], size)
        for (k, t), total in sums.items():
            yield _batch(("fold", "tree", "sums"), [k], [t], [np.ascontiguousarray(total[:, :, :-bins]).tobytes()])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            found = np.frombuffer(batch.column(2)[i].as_buffer())
            if key in sums:
                sums[key] += found
            else:
                sums[key] = found.copy()
    for (k, t), total in sums.items():
        yield _batch(("fold", "tree", "sums"), [k], [t], [total.tobytes()])


_SUMS = "fold int, tree int, sums binary"


class Grower:
    """The trees of one fold that grow together, with their random draws."""

    def __init__(self, own: Settings, trees: int, seed: int, cuts: list[np.ndarray]) -> None:
        self.own, self.cuts, self.random = own, cuts, JavaRandom(seed)
        self.trees = [Tree(own.depth) for _ in range(trees)]
        # Open nodes in the order in which Spark ML takes them from its stack.
        self.open = [(t, 1) for t in reversed(range(trees))]

    def tasks(self) -> dict[int, tuple]:
        """Per tree with open nodes what a pass needs: splits so far, the slot of each node, the number of slots."""
        nodes: dict[int, list[int]] = {}
        for t, node in self.open:
            nodes.setdefault(t, []).append(node)
        out = {}
        for t, own in nodes.items():
            slot = np.full(2 << self.own.depth, len(own), np.intp)
            slot[own] = np.arange(len(own))
            out[t] = self.trees[t].feature, self.trees[t].cut, slot, len(own)
        return out

    def _subset(self, width: int) -> list[int]:
        kept = list(range(self.own.subset))
        if self.own.subset < width:
            random = XorShift(self.random.long())
            for i in range(self.own.subset, width):
                at = int(random.double() * (i + 1))
                if at < self.own.subset:
                    kept[at] = i
        return kept

    def split(self, sums: Mapping[int, np.ndarray], width: int, bins: int) -> None:
        """Split the open nodes by a level's sums; children that can be split are open next."""
        held: dict[int, list[int]] = {}
        for t, node in self.open:
            held.setdefault(t, []).append(node)
        split: list[tuple[int, int]] = []
        for t, node in self.open:
            tree, slot = self.trees[t], held[t].index(node)
            bin_sums = sums[t].reshape(3, width, len(held[t]), bins)[:, :, slot]
            best, found = -np.inf, None
            for f in self._subset(width):
                if not len(self.cuts[f]):
                    continue
                so_far = np.cumsum(bin_sums[:, f], axis=1)
                left, right = so_far[:, : len(self.cuts[f])], so_far[:, -1:] - so_far[:, : len(self.cuts[f])]
                if node == 1 and not tree.n[1]:
                    tree.put(1, *(left + right)[:, 0])
                gains = self._gains(tree.spread(node), left, right)
                at = int(np.argmax(gains))
                if gains[at] > best:
                    best, found = gains[at], (f, at, left[:, at], right[:, at])
            if node == 1 and not tree.n[1]:
                tree.put(1, *bin_sums[:, 0].sum(axis=1))
            if found is None or best <= 0:
                continue
            tree.feature[node], tree.cut[node], tree.gain[node], tree.inner[node] = found[0], found[1], best, True
            tree.put(2 * node, *found[2])
            tree.put(2 * node + 1, *found[3])
            split.append((t, node))
        # By tree, as Spark ML's map of them goes, and in the order taken; the last child is taken first.
        rank = {t: i for i, t in enumerate(_map_order(sorted(held)))}
        split.sort(key=lambda x: rank[x[0]])
        children = [(t, c) for t, node in split for c in (2 * node, 2 * node + 1) if 2 * node < 1 << self.own.depth]
        self.open = [(t, c) for t, c in children[::-1] if abs(self.trees[t].spread(c)) >= EPSILON]

    def _gains(self, spread: float, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each cut takes off the variance, in Spark ML's order of operations; -inf if it may not be made."""
        with np.errstate(divide="ignore", invalid="ignore"):
            within = [(x[2] - x[1] * x[1] / x[0]) / x[0] for x in (left, right)]
            n = left[0] + right[0]
            gains = spread - left[0] / n * within[0] - right[0] / n * within[1]
        fits = (left[0] >= max(self.own.least, 1)) & (right[0] >= max(self.own.least, 1)) & (gains >= self.own.gain)
        return np.where(fits, gains, -np.inf)


def _grow(table: DataFrame, growers: Mapping[int, Grower], width: int, own: Settings, rounds: int = 0) -> None:
    """All levels of the growers' trees, one pass over the table a level."""
    bins = max(len(c) for g in growers.values() for c in g.cuts) + 1
    for level in range(own.depth):
        growing = {k: tasks for k, g in growers.items() if (tasks := g.tasks())}
        if not growing:
            return
        run = _partials(growing, width, bins, level, own.boosted, rounds)
        parts = min(sum(map(len, growing.values())), table.sparkSession.sparkContext.defaultParallelism)
        found = table.mapInArrow(run, _SUMS).repartition(parts, "fold", "tree").mapInArrow(_added, _SUMS).collect()
        for k in growing:
            growers[k].split({r.tree: np.frombuffer(r.sums) for r in found if r.fold == k}, width, bins)


def _moved(table: DataFrame, trees: Mapping[int, Tree], width: int, weight: float) -> DataFrame:
    """The state with what the newest tree of each fold says added to ``said``."""
    held = {k: (t.feature, t.cut, t.values(), t.depth) for k, t in trees.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, k in enumerate(batch.column(0).to_pylist()):
                feature, cut, values, depth = held[k]
                now = weight * values[walked(np.frombuffer(batch.column(1)[i].as_buffer(), np.uint8).reshape(width, -1), feature, cut, depth)]
                said = np.frombuffer(batch.column(4)[i].as_buffer())
                out.append((said + now if len(said) else now).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.binary())], names=batch.schema.names)

    return table.mapInArrow(run, table.schema)


def _even(chunks: DataFrame, count: int) -> DataFrame:
    """Chunks in even partitions, by fold and in their order; few chunks stay in one."""
    cores = chunks.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(2 * cores, count // 16), count // 256)
    return stage(chunks.repartitionByRange(parts, "fold", "chunk").sortWithinPartitions("fold", "chunk"), "even")


def _boosted(chunks: DataFrame, width: int, own: Settings, cuts: Mapping[int, list[np.ndarray]]) -> dict[int, list[Tree]]:
    table = chunks.select("fold", "bins", "target", "taken", F.lit(b"").alias("said"))
    out: dict[int, list[Tree]] = {k: [] for k in cuts}
    held: list[DataFrame] = []
    try:
        for m in range(own.trees):
            if m:
                table = _moved(table, {k: trees[-1] for k, trees in out.items()}, width, own.step if m > 1 else 1.0).persist()
                held.append(table)
            growers = {k: Grower(own, 1, own.seed + m, cuts[k]) for k in cuts}
            _grow(table, growers, width, own, m)
            for k, g in growers.items():
                out[k].append(g.trees[0])
            for old in held[:-1]:
                old.unpersist()
            held = held[-1:]
    finally:
        for old in held:
            old.unpersist()
    return out


def _forest(chunks: DataFrame, bags: DataFrame, width: int, own: Settings, cuts: Mapping[int, list[np.ndarray]]) -> dict[int, list[Tree]]:
    # A chunk of rows that no tree takes has no bags.
    bagged = chunks.join(bags, "chunk", "left").select("fold", "bins", "target", F.coalesce("bags", F.lit(b"")).alias("bags"))
    growers = {k: Grower(own, own.trees, own.seed, cuts[k]) for k in cuts}
    _grow(stage(bagged, "bagged"), growers, width, own)
    return {k: g.trees for k, g in growers.items()}


def _model(estimator: object, own: Settings, trees: list[Tree], cuts: list[np.ndarray], features: list[str]) -> PipelineModel:
    """A pipeline of Spark ML's own classes. Its nodes carry no impurity (-1) and no statistics, which predictions do not need."""
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    kinds, single = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel

    def node(tree: Tree, values: np.ndarray, i: int):
        if not tree.inner[i]:
            return kinds.LeafNode(float(values[i]), -1.0, None)
        f = int(tree.feature[i])
        left, right = node(tree, values, 2 * i), node(tree, values, 2 * i + 1)
        return kinds.InternalNode(float(values[i]), -1.0, float(tree.gain[i]), left, right, kinds.ContinuousSplit(f, float(cuts[f][tree.cut[i]])), None)

    made = gateway.new_array(single, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, tree in enumerate(trees):
        made[i], weights[i] = single(node(tree, tree.values(), 1), len(features)), own.step if i else 1.0
    if own.boosted:
        java = jvm.org.apache.spark.ml.regression.GBTRegressionModel(estimator.uid, made, weights, len(features))
    else:
        java = jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(estimator.uid, made, len(features))
    estimator._to_java().copyValues(java, jvm.org.apache.spark.ml.param.ParamMap())
    model = (GBTRegressionModel if own.boosted else RandomForestRegressionModel)._from_java(java)
    return PipelineModel([VectorAssembler(inputCols=features, outputCol="features"), model])


def fit_folds(df: DataFrame, features: Iterable[str], estimators: Mapping[str, object], folds: int = 5, label: str = "label") -> dict[str, dict[int, PipelineModel]]:
    """For each estimator that can be grown here and each fold k = 1..folds a pipeline fitted to the blocks below k.

    ``df`` is a table as staged: every pass reads it in the same partitions.
    """
    names = list(features)
    able = {name: own for name, e in estimators.items() if (own := settings(e, len(names)))}
    if not able:
        return {}
    blocks = {r.block: r.n for r in df.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {k: sum(n for b, n in blocks.items() if b < k) for k in range(1, folds + 1)}
    if not all(sizes.values()):
        raise ValueError("a fold has no rows to learn from")
    samples = {seed: _sample(df, names, sizes, seed) for seed in {own.seed for own in able.values()}}
    cuts, chunks = {}, {}
    # Estimators of one seed and share learn from the same chunks.
    for own in able.values():
        kind = own.seed, own.bins, own.rate
        if kind not in chunks:
            cuts[kind] = {k: thresholds(samples[own.seed][k], n, own.bins) for k, n in sizes.items()}
            rounds = max((o.trees for o in able.values() if o.boosted and (o.seed, o.bins, o.rate) == kind), default=0)
            chunks[kind] = _binned(df, names, cuts[kind], own.seed, own.rate, rounds, label)

    def fit(name: str) -> dict[int, PipelineModel]:
        own = able[name]
        kind = own.seed, own.bins, own.rate
        if own.boosted:
            grown = _boosted(_even(chunks[kind], sum(ceil(n / ROWS) for n in sizes.values())), len(names), own, cuts[kind])
        else:
            grown = _forest(chunks[kind], _bags(df.where(F.col("block") < folds), own), len(names), own, cuts[kind])
        return {k: _model(estimators[name], own, grown[k], cuts[kind][k], names) for k in sizes}

    with ThreadPoolExecutor(len(able)) as pool:
        running = {name: pool.submit(inheritable_thread_target(df.sparkSession)(fit), name) for name in able}
        return {name: made.result() for name, made in running.items()}
