"""Ordered-series operators: lag, rolling, fill, interpolation, running sums, row positions, quantiles.

The common case is one window per key: one shuffle, one sort. That puts all rows of a key into one
task, which fails when a key holds a large share of the table (or when there is no key at all). Each
operator here therefore splits the input:

* keys whose rows fit one task take the plain window;
* keys beyond that are range-partitioned by key and all order columns, cut into as many slices as the rows
  need, and written with the number of their slice, so that it stays what it is when a task is run again.
  Ties of the first order column and its nulls are cut like other values, whatever the columns' types.
  What one slice owes the next (row counts, last value, running sum) is one row per key and slice.

Both ways give the same rows. Whether a key can exceed a task is read from the size statistics of the
plan where those suffice. Only a larger input is counted, with map-side partial counts; one that is
itself the result of shuffles is first written to the shared folder, so that they are not repeated.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from voltaria.session import input_bytes, is_derived, plan_bytes, stage

_SLICE, _POS, _CHUNK, _HOME = "_slice", "_pos", "_chunk", "_home"
PARTITION_ROWS = 1_000_000


@dataclass(frozen=True)
class Series:
    """How a frame is ordered: within ``keys``, by ``by``.

    The ``by`` columns are of any type that has an order and together unique within a key, or row-order
    operators would have no defined result.
    """

    keys: tuple[str, ...] = ()
    by: tuple[str, ...] = ("ts",)
    task_rows: int = 2_000_000
    task_bytes: int = 64 << 20
    #: The rows have a bound of their own, such as one per hour: no check is needed.
    bounded: bool = False

    def window(self, *extra: str, backward: bool = False) -> WindowSpec:
        order = [F.col(c).desc() if backward else F.col(c).asc() for c in self.by]
        return Window.partitionBy(*self.keys, *extra).orderBy(*order)


def same_keys(left: DataFrame, right: DataFrame, pairs: Iterable[tuple[str, str]]) -> Column:
    """Null-safe equality over key pairs; a null key is a group like any other."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def _fits(df: DataFrame, series: Series) -> bool:
    """Whether all rows together fit one task: by the estimate, or because little is read at all."""
    return plan_bytes(df) <= series.task_bytes or input_bytes(df) <= series.task_bytes // 4


def split_hot(df: DataFrame, series: Series) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows whose key fits one task, and the rows whose key does not, with the slice each falls in."""
    if series.bounded or _fits(df, series):
        return df, None
    if is_derived(df):
        df = stage(df, "series")
        if _fits(df, series):
            return df, None
    if not series.keys:
        rows = df.count()
        return (df, None) if rows <= series.task_rows else (None, _sliced(df, rows, series))
    names = [f"_hot_{k}" for k in series.keys]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(series.keys, names)]).agg(F.count(F.lit(1)).alias("_rows"))
    # A written table: its size is known when Spark picks the joins below.
    hot = stage(counts.where(F.col("_rows") > series.task_rows), "hot-keys")
    rows = hot.agg(F.sum("_rows").alias("n")).first()["n"]
    if not rows:
        return df, None
    on = same_keys(df, hot, zip(series.keys, names))
    return df.join(hot, on, "left_anti"), _sliced(df.join(hot, on, "left_semi"), rows, series)


def _sliced(df: DataFrame, rows: int, series: Series) -> DataFrame:
    """Rows in slices of about half a task, cut along keys and order columns and written with their number.

    Range partitions are as many as the cluster runs at once, or more where they would hold over ``PARTITION_ROWS``,
    but no more than slices: a small slice is a part of one, not a task and a file of its own.
    """
    size = max(1, series.task_rows // 2)
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / PARTITION_ROWS))
    ranged = df.repartitionByRange(max(2, min(wanted, math.ceil(rows / size))), *series.keys, *series.by)
    # The number counts on from 0 within each partition, whose own number is above these bits.
    number = F.monotonically_increasing_id()
    within = number.bitwiseAND(F.lit((1 << 33) - 1))
    return stage(ranged.sortWithinPartitions(*series.keys, *series.by).withColumn(_SLICE, number - within % size), "slices")


def _with_carry(
    sliced: DataFrame,
    series: Series,
    edges: Mapping[str, Column],
    carries: Mapping[str, Callable[[WindowSpec], Column]],
    backward: bool = False,
) -> DataFrame:
    """Join to each row what the earlier slices of its key hand over: one row per key and slice.

    These rows are written first: Spark broadcasts the table if its size is known to be small.
    """
    group = [*series.keys, _SLICE]
    order = F.col(_SLICE).desc() if backward else F.col(_SLICE).asc()
    earlier = Window.partitionBy(*series.keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ends = sliced.groupBy(*group).agg(*[c.alias(n) for n, c in edges.items()])
    held = ends.select(
        *[F.col(c).alias(f"_of_{c}") for c in group],
        *[make(earlier).alias(name) for name, make in carries.items()],
    )
    held = stage(held, "carries")
    joined = sliced.join(held, same_keys(sliced, held, [(c, f"_of_{c}") for c in group]), "left")
    return joined.drop(*[f"_of_{c}" for c in group])


def _place(sliced: DataFrame, series: Series, name: str) -> DataFrame:
    """Exact 0-based position within the key: rows of earlier slices plus position in the slice."""
    base = _with_carry(
        sliced,
        series,
        {"_n": F.count(F.lit(1))},
        {"_base": lambda w: F.coalesce(F.sum("_n").over(w), F.lit(0))},
    )
    local = F.row_number().over(series.window(_SLICE))
    return base.withColumn(name, (local + F.col("_base") - 1).cast("long")).drop("_base")


def _union(parts: list[DataFrame | None]) -> DataFrame:
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def windowed(
    df: DataFrame,
    series: Series,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    back: int = 0,
    ahead: int = 0,
    first: Sequence[Mapping[str, Callable[[WindowSpec], Column]]] = (),
) -> DataFrame:
    """Add columns computed over at most ``back`` earlier and ``ahead`` later rows of the same key.

    Each column is a function of the ordered window, e.g. ``lambda w: F.lag("x", 3).over(w)``. All of
    them share one sort. A hot key is cut into chunks of equal row count, and the rows a neighbouring
    chunk needs are copied to it and dropped again. The columns of ``first`` are made before, mapping by
    mapping, for others to read, and dropped at the end; ``back`` and ``ahead`` are the reach of all together.
    """
    cold, hot = split_hot(df, series)
    interim = [name for made in first for name in made]

    def project(part: DataFrame, window: WindowSpec) -> DataFrame:
        for made in (*first, columns):
            part = part.withColumns({name: make(window) for name, make in made.items()})
        return part.drop(*interim)

    parts: list[DataFrame | None] = []
    if cold is not None:
        parts.append(project(cold, series.window()))
    if hot is not None:
        size = max(series.task_rows, back, ahead, 1)
        offset = F.col(_POS) % size
        placed = _place(hot, series, _POS).drop(_SLICE)
        homes = F.array_compact(
            F.array(
                F.col(_HOME),
                F.when(offset >= size - back, F.col(_HOME) + 1),
                F.when(offset < ahead, F.col(_HOME) - 1),
            )
        )
        copies = placed.withColumn(_HOME, F.floor(F.col(_POS) / size)).withColumn(_CHUNK, F.explode(homes))
        chunk = Window.partitionBy(*series.keys, _CHUNK).orderBy(_POS)
        kept = project(copies, chunk).where(F.col(_CHUNK) == F.col(_HOME))
        parts.append(kept.drop(_POS, _CHUNK, _HOME))
    return _union(parts)


class Rolling:
    """Means and standard deviations over the last rows, in time that hardly grows with the length of the frames.

    Spark adds up every frame anew, row by row. Here only frames of up to ``DIRECT`` rows are: count, mean and squared
    deviations of a longer one are merged from those of shorter ones that lie end to end, each taken from the row where it
    ends. So every figure comes from the rows of its own frame, and nothing is subtracted from a running sum. ``steps`` go
    to ``first`` of :func:`windowed`, with a ``back`` of the longest frame (less 1 without ``behind``).
    """

    DIRECT, PARTS = 16, 12
    #: Means of equal values differ by rounding; a deviation of less than four units in the last place is none.
    _NOISE = 2.0**-50

    def __init__(self, columns: Iterable[str], lengths: Iterable[int], behind: int = 0) -> None:
        """``behind``: rows between the current one and the end of the frame, itself included."""
        self.columns, self.behind = tuple(columns), behind
        self.steps: list[dict[str, Callable[[WindowSpec], Column]]] = []
        self._made: set[int] = set()
        for n in sorted(set(lengths)) if self.columns else ():
            self._make(n)
            if behind:
                self._lag([(n, behind)])

    def mean(self, column: str, length: int) -> Column:
        n, mean, _ = self._part(column, length, self.behind)
        return F.when(n > 0, mean)

    def deviation(self, column: str, length: int, ddof: int = 1) -> Column:
        n, _, m = self._part(column, length, self.behind)
        return F.when(n > ddof, F.sqrt(m / (n - ddof)))

    @staticmethod
    def _name(figure: str, column: str, length: int, offset: int = 0) -> str:
        return f"_{figure}_{column}_{length}_{offset}"

    def _part(self, column: str, length: int, offset: int) -> list[Column]:
        """Count, mean (0 of none) and squared deviations of the ``length`` rows that end ``offset`` rows before this one."""
        return [F.col(self._name(f, column, length, offset)) for f in "nam"]

    def _lag(self, pieces: Iterable[tuple[int, int]]) -> None:
        done = {name for step in self.steps for name in step}
        lagged = {
            self._name(f, c, n, k): (lambda w, own=self._name(f, c, n), k=k: F.lag(own, k, 0.0).over(w))
            for n, k in pieces
            for c in self.columns
            for f in "nam"
        }
        self.steps.append({name: make for name, make in lagged.items() if name not in done})

    def _make(self, length: int) -> None:
        if length in self._made:
            return
        if length <= self.DIRECT:
            self.steps.append(self._direct(length))
        else:
            near = max((m for m in self._made if m < length and length // m <= self.PARTS), default=math.isqrt(length))
            rest = length % near
            for n in (near, rest) if rest else (near,):
                self._make(n)
            pieces = [(near, i * near) for i in range(length // near)] + ([(rest, length - rest)] if rest else [])
            self._lag([p for p in pieces if p[1]])
            self.steps += self._merged(length, pieces)
        self._made.add(length)

    def _direct(self, length: int) -> dict[str, Callable[[WindowSpec], Column]]:
        made: dict[str, Callable[[WindowSpec], Column]] = {}

        def over(c: str, make: Callable[[str], Column]) -> Callable[[WindowSpec], Column]:
            return lambda w: F.coalesce(make(c).over(w.rowsBetween(1 - length, 0)).cast("double"), F.lit(0.0))

        for c in self.columns:
            count, spread = over(c, F.count), over(c, F.var_pop)
            n, mean, m = (self._name(f, c, length) for f in "nam")
            made |= {n: count, mean: over(c, F.avg), m: lambda w, count=count, spread=spread: spread(w) * count(w)}
        return made

    def _merged(self, length: int, pieces: list[tuple[int, int]]) -> list[dict[str, Callable[[WindowSpec], Column]]]:
        """Counts, then means, then deviations from these: each is worked out once, in expressions short enough to compile."""
        counts: dict[str, Callable[[WindowSpec], Column]] = {}
        means: dict[str, Callable[[WindowSpec], Column]] = {}
        spreads: dict[str, Callable[[WindowSpec], Column]] = {}

        def averaged(parts: list[list[Column]], count: Column) -> Column:
            return F.when(count > 0, reduce(Column.__add__, (n * mean for n, mean, _ in parts)) / count).otherwise(F.lit(0.0))

        def spread(parts: list[list[Column]], count: Column, total: Column) -> Column:
            m = reduce(Column.__add__, (m + n * (mean - total) * (mean - total) for n, mean, m in parts))
            least = total * F.lit(self._NOISE)
            return F.when(m <= count * least * least, F.lit(0.0)).otherwise(m)

        for c in self.columns:
            parts = [self._part(c, *p) for p in pieces]
            n, mean, m = (self._name(f, c, length) for f in "nam")
            counts[n] = lambda w, parts=parts: reduce(Column.__add__, (p[0] for p in parts))
            means[mean] = lambda w, parts=parts, n=n: averaged(parts, F.col(n))
            spreads[m] = lambda w, parts=parts, n=n, mean=mean: spread(parts, F.col(n), F.col(mean))
        return [counts, means, spreads]


def in_one_go(df: DataFrame, series: Series, apply: Callable[[DataFrame, Series], DataFrame]) -> DataFrame:
    """Several row-order operators in turn, ``apply(rows, series)``, with one check of the keys: those that fit a task
    take them all on one shuffle and one sort, the others operator by operator."""
    cold, hot = split_hot(df, series)
    parts = [None if cold is None else apply(cold, replace(series, bounded=True))]
    if hot is not None:
        parts.append(apply(hot.drop(_SLICE), series))
    return _union(parts)


def position(df: DataFrame, series: Series, name: str = "position") -> DataFrame:
    """Add the exact 0-based row position within the key."""
    cold, hot = split_hot(df, series)
    parts: list[DataFrame | None] = []
    if cold is not None:
        parts.append(cold.withColumn(name, (F.row_number().over(series.window()) - 1).cast("long")))
    if hot is not None:
        parts.append(_place(hot, series, name).drop(_SLICE))
    return _union(parts)


def _fill(
    part: DataFrame, series: Series, columns: Mapping[str, Column], backward: bool, sliced: bool = False
) -> DataFrame:
    """Fill within keys, or within slices plus what the slices before hand over."""
    extra = (_SLICE,) if sliced else ()
    # A reversed running frame, not a following one: Spark evaluates those in quadratic time.
    running = series.window(*extra, backward=backward).rowsBetween(Window.unboundedPreceding, 0)
    if not sliced:
        return part.withColumns({n: F.last(c, ignorenulls=True).over(running) for n, c in columns.items()})
    pick = F.min_by if backward else F.max_by
    at = F.struct(*series.by)
    held = _with_carry(
        part,
        series,
        {f"_end_{n}": pick(c, F.when(c.isNotNull(), at)) for n, c in columns.items()},
        {f"_held_{n}": _last_of(f"_end_{n}") for n in columns},
        backward,
    )
    filled = held.withColumns(
        {
            n: F.coalesce(F.last(c, ignorenulls=True).over(running), F.col(f"_held_{n}"))
            for n, c in columns.items()
        }
    )
    return filled.drop(*[f"_held_{n}" for n in columns])


def _last_of(name: str) -> Callable[[WindowSpec], Column]:
    return lambda w: F.last(name, ignorenulls=True).over(w)


def _sum_of(name: str) -> Callable[[WindowSpec], Column]:
    return lambda w: F.sum(name).over(w)


def filled(
    df: DataFrame, series: Series, columns: Mapping[str, Column] | Iterable[str], backward: bool = False
) -> DataFrame:
    """Carry the last non-null value forward (or the next one backward) within each key."""
    sources = dict(columns) if isinstance(columns, Mapping) else {c: F.col(c) for c in columns}
    cold, hot = split_hot(df, series)
    parts = [None if cold is None else _fill(cold, series, sources, backward)]
    if hot is not None:
        parts.append(_fill(hot, series, sources, backward, True).drop(_SLICE))
    return _union(parts)


def _interpolate(part: DataFrame, series: Series, columns: list[str], sliced: bool = False) -> DataFrame:
    if sliced:
        placed = _place(part, series, _POS)
    else:
        placed = part.withColumn(_POS, F.row_number().over(series.window()).cast("long"))
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(_POS).alias("at"), F.col(c).alias("value"))) for c in columns}
    both = _fill(placed, series, {f"_prev_{c}": known[c] for c in columns}, False, sliced)
    both = _fill(both, series, {f"_next_{c}": known[c] for c in columns}, True, sliced)

    def between(c: str) -> Column:
        prev, nxt = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        share = (F.col(_POS) - prev["at"]) / F.when(nxt["at"] > prev["at"], nxt["at"] - prev["at"])
        inside = prev["value"] + (nxt["value"] - prev["value"]) * share
        return F.coalesce(F.col(c).cast("double"), inside, prev["value"], nxt["value"])

    out = both.withColumns({c: between(c) for c in columns})
    return out.drop(_POS, *[f"_prev_{c}" for c in columns], *[f"_next_{c}" for c in columns])


def interpolated(df: DataFrame, series: Series, columns: Iterable[str]) -> DataFrame:
    """Fill numeric nulls on the straight line by row position; ends take the nearest value."""
    names = list(columns)
    cold, hot = split_hot(df, series)
    parts = [None if cold is None else _interpolate(cold, series, names)]
    if hot is not None:
        parts.append(_interpolate(hot, series, names, True).drop(_SLICE))
    return _union(parts)


def running_sum(df: DataFrame, series: Series, columns: Mapping[str, Column]) -> DataFrame:
    """Add running sums within each key, the current row included; nulls count as zero."""
    cold, hot = split_hot(df, series)
    sources = {n: F.coalesce(c, F.lit(0)) for n, c in columns.items()}
    parts: list[DataFrame | None] = []
    if cold is not None:
        running = series.window().rowsBetween(Window.unboundedPreceding, 0)
        parts.append(cold.withColumns({n: F.sum(c).over(running) for n, c in sources.items()}))
    if hot is not None:
        running = series.window(_SLICE).rowsBetween(Window.unboundedPreceding, 0)
        held = _with_carry(
            hot,
            series,
            {f"_end_{n}": F.sum(c) for n, c in sources.items()},
            {f"_held_{n}": _sum_of(f"_end_{n}") for n in sources},
        )
        summed = held.withColumns(
            {n: F.sum(c).over(running) + F.coalesce(F.col(f"_held_{n}"), F.lit(0)) for n, c in sources.items()}
        )
        parts.append(summed.drop(_SLICE, *[f"_held_{n}" for n in sources]))
    return _union(parts)


def quantiles(df: DataFrame, columns: Iterable[str], probabilities: Iterable[float], series: Series = Series()) -> Column:
    """Exact quantiles (linear between ranks) as a scalar struct: column name -> array of values.

    ``percentile`` keeps every distinct value in one task. Beyond a task's size, approximate quantiles
    (mergeable sketches, no shuffle) bracket each rank, and only the values inside the brackets are ordered.
    """
    names, points = list(columns), list(probabilities)
    if _fits(df.select(*names), series):
        return df.agg(
            F.struct(*[F.percentile(c, F.array(*[F.lit(p) for p in points])).alias(c) for c in names]).alias("q")
        ).scalar()
    if is_derived(df):
        df = stage(df.select(*names), "quantiles")
    return F.struct(*[F.array(*_ranked_quantiles(df, c, points, series)).alias(c) for c in names])


def _ranked_quantiles(df: DataFrame, column: str, points: list[float], series: Series) -> list[Column]:
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    n = values.count()
    if n == 0:
        return [F.lit(None).cast("double") for _ in points]
    # A sketch of error e is off by e * n ranks; brackets of 2e on each side hold the rank and its neighbour.
    error = max(1e-4, 4 / n)
    edges = [(max(p - 2 * error, 0.0), min(p + 2 * error, 1.0)) for p in points]
    found = values.stat.approxQuantile("v", [e for pair in edges for e in pair], error)
    made = []
    for i, (p, (low, high)) in enumerate(zip(points, edges)):
        first = found[2 * i] if low > 0 else float("-inf")
        last = found[2 * i + 1] if high < 1 else float("inf")
        inside = values.where((F.col("v") >= first) & (F.col("v") <= last)).groupBy("v").agg(F.count(F.lit(1)).alias("_n"))
        counted = running_sum(inside, replace(series, keys=(), by=("v",)), {"_upto": F.col("_n")})
        before = values.agg(F.count_if(F.col("v") < first).alias("n")).scalar()
        rank = (n - 1) * p
        below, above = (
            F.min(F.when(F.col("_upto") + F.col("_before") > r, F.col("v"))) for r in (math.floor(rank), math.ceil(rank))
        )
        value = below + (above - below) * F.lit(rank - math.floor(rank))
        made.append(counted.withColumn("_before", before).agg(value.alias("q")).scalar())
    return made


def ordered_cut(df: DataFrame, by: tuple[str, ...], share: float, series: Series = Series()) -> DataFrame:
    """Add ``in_head``: true for the first ``floor(rows * share)`` rows in the order of ``by``.

    The split compares each row with the cut row, found by rank among the distinct values of the first
    column and then, within that value, of the next; no position is assigned to every row.
    """
    if is_derived(df):
        # Counted once per column and then split: what leads to it is not repeated.
        df = stage(df, "cut")
    wanted = F.floor(df.agg(F.count(F.lit(1)).alias("n")).scalar() * F.lit(share))
    inside: Column = F.lit(False)
    level, prefix = df, []
    for column in by:
        counts = level.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        upto = running_sum(counts, replace(series, keys=(), by=(column,)), {"_upto": F.col("_n")})
        cut = upto.where(F.col("_upto") > wanted).agg(
            F.min(F.struct(F.col(column).alias("value"), (F.col("_upto") - F.col("_n")).alias("before"))).alias("c")
        ).scalar()
        tied = reduce(lambda a, b: a & b, prefix, F.lit(True))
        inside = inside | (tied & (F.col(column) < cut["value"]))
        prefix.append(F.col(column) == cut["value"])
        level = level.where(F.col(column) == cut["value"])
        wanted = wanted - cut["before"]
    return df.withColumn("in_head", F.coalesce(inside, F.lit(True)))
