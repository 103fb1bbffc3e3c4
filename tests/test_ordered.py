"""Row-order operators: plain window, split hot keys and a pandas brute force agree."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltaria.functions import demand as D
from voltaria.operators import ordered as O

PLAIN = O.Series(keys=("k",), by=("t", "i"))
SPLIT = O.Series(keys=("k",), by=("t", "i"), task_rows=40, task_bytes=0)


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 900
    # One key and the null key hold most rows; timestamps tie now and then.
    key = rng.choice(np.array(["hot", None, "a", "b", "c"], dtype=object), n, p=[0.5, 0.3, 0.1, 0.07, 0.03])
    value = np.where(rng.random(n) < 0.3, np.nan, rng.integers(0, 1000, n) / 4)
    return pd.DataFrame({"i": np.arange(n), "k": key, "t": rng.integers(0, 400, n), "v": value})


@pytest.fixture(scope="module")
def table(spark, frame):
    rows = [
        (int(r.i), r.k, int(r.t), None if np.isnan(r.v) else float(r.v)) for r in frame.itertuples()
    ]
    return spark.createDataFrame(rows, "i long, k string, t long, v double").repartition(5)


def ordered(frame):
    out = frame.sort_values(["t", "i"], kind="stable").copy()
    return out, out.groupby(out["k"].fillna("<null>"), sort=False)


def result(df, columns):
    pdf = df.select("i", *columns).toPandas().sort_values("i").reset_index(drop=True)
    return pdf[columns].astype(float)


def expect(frame, columns):
    return frame.sort_values("i").reset_index(drop=True)[columns].astype(float)


@pytest.mark.parametrize("series", [PLAIN, SPLIT], ids=["plain", "split"])
def test_lag_lead_rolling(table, frame, series):
    out = O.windowed(
        table,
        series,
        {
            "lag3": lambda w: F.lag("v", 3).over(w),
            "lead2": lambda w: F.lead("v", 2).over(w),
            "mean": lambda w: F.avg("v").over(w.rowsBetween(-11, 0)),
            "std": lambda w: F.stddev_samp("v").over(w.rowsBetween(-11, 0)),
        },
        back=11,
        ahead=2,
    )
    want, groups = ordered(frame)
    want["lag3"] = groups["v"].shift(3)
    want["lead2"] = groups["v"].shift(-2)
    want["mean"] = groups["v"].transform(lambda s: s.rolling(12, min_periods=1).mean())
    want["std"] = groups["v"].transform(lambda s: s.rolling(12, min_periods=1).std())
    cols = ["lag3", "lead2", "mean", "std"]
    assert out.count() == len(frame)
    pd.testing.assert_frame_equal(result(out, cols), expect(want, cols), atol=1e-6)


@pytest.mark.parametrize("series", [PLAIN, SPLIT], ids=["plain", "split"])
def test_fill_interpolate_position_running(table, frame, series):
    want, groups = ordered(frame)
    want["f"] = groups["v"].ffill()
    want["b"] = groups["v"].bfill()
    want["x"] = groups["v"].transform(lambda s: s.interpolate(method="linear", limit_direction="both"))
    want["p"] = groups.cumcount()
    want["c"] = groups["v"].transform(lambda s: s.fillna(0).cumsum())
    out = O.filled(table, series, {"f": F.col("v")})
    out = O.filled(out, series, {"b": F.col("v")}, backward=True)
    out = O.position(out, series, "p")
    out = O.running_sum(out, series, {"c": F.col("v")})
    cols = ["f", "b", "p", "c"]
    pd.testing.assert_frame_equal(result(out, cols), expect(want, cols), atol=1e-6)
    line = O.interpolated(table.withColumn("x", F.col("v")), series, ["x"])
    pd.testing.assert_frame_equal(result(line, ["x"]), expect(want, ["x"]), atol=1e-6)


@pytest.mark.parametrize("series", [O.Series(), O.Series(task_rows=40, task_bytes=0)], ids=["plain", "split"])
def test_quantiles_and_cut(table, frame, series):
    q = table.limit(1).select(O.quantiles(table, ["v"], [0.25, 0.5, 0.9], series)["v"].alias("q")).first()["q"]
    assert q == pytest.approx(frame["v"].quantile([0.25, 0.5, 0.9]).tolist())
    cut = O.ordered_cut(table, ("t", "i"), 0.8, series)
    head = cut.where("in_head").select("i").toPandas()["i"]
    want = frame.sort_values(["t", "i"])["i"].head(int(len(frame) * 0.8))
    assert set(head) == set(want)


def test_split_survives_other_partition_counts(spark, table):
    outs = []
    for n in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        outs.append(result(O.position(table, SPLIT, "p"), ["p"]))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    pd.testing.assert_frame_equal(*outs)


def test_global_series_is_split(table, frame):
    series = O.Series(by=("t", "i"), task_rows=50, task_bytes=0)
    out = O.windowed(table, series, {"d": lambda w: F.col("i") - F.lag("i").over(w)}, back=1)
    want = frame.sort_values(["t", "i"])
    want["d"] = want["i"].diff()
    pd.testing.assert_frame_equal(result(out, ["d"]), expect(want, ["d"]))


@pytest.mark.parametrize("kind", ["text", "equal", "nulls", "many keys"])
def test_cuts_of_any_order(spark, kind):
    """Text order columns, ties, nulls and more hot keys than a driver would hold: plain rows, bounded slices."""
    rows = [
        (i, f"k{i % (1200 if kind == 'many keys' else 2)}", f"{i * 7919 % 3600:05d}" if kind == "text" else "same" if kind == "equal" else None if i % 3 else "x")
        for i in range(3600)
    ]
    df = spark.createDataFrame(rows, "i long, k string, t string").repartition(3)
    bound = 2 if kind == "many keys" else 200
    plain, cut = (O.Series(keys=("k",), by=("t", "i"), **x) for x in ({}, {"task_rows": bound, "task_bytes": 0}))
    made = [O.windowed(O.position(df, s, "p"), s, {"l": lambda w: F.lag("i").over(w)}, back=1) for s in (plain, cut)]
    assert made[0].exceptAll(made[1]).count() == 0 and made[1].count() == 3600
    _, hot = O.split_hot(df, cut)
    assert hot.count() == 3600
    assert hot.groupBy("k", "_slice").count().agg(F.max("count")).first()[0] <= max(bound, 4)


def test_small_slices_share_partitions(spark):
    """Slices of a few rows each are not tasks and files of their own, and stay in order."""
    df = spark.createDataFrame([(i, i * 7919 % 4001) for i in range(4000)], "i long, t long").repartition(3)
    series = O.Series(by=("t", "i"), task_rows=4, task_bytes=0)
    _, hot = O.split_hot(df, series)
    assert len(hot.inputFiles()) <= spark.sparkContext.defaultParallelism
    spans = hot.groupBy("_slice").agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("_slice").collect()
    assert max(x.n for x in spans) <= 2 and sum(x.n for x in spans) == 4000
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))
    got = {x.i: x.position for x in O.position(df, series).collect()}
    assert got == {i: p for p, (_, i) in enumerate(sorted((i * 7919 % 4001, i) for i in range(4000)))}


@pytest.mark.parametrize("series", [PLAIN, SPLIT], ids=["plain", "split"])
@pytest.mark.parametrize(("lengths", "behind"), [([1, 12, 36, 101], 0), ([100], 1), ([17, 300, 23], 0)], ids=["last", "before", "odd"])
def test_merged_frames(table, frame, series, lengths, behind):
    """Frames merged from shorter ones give what frames added up row by row give."""
    rolled = O.Rolling(["v"], lengths, behind)
    made = {f"{f}{n}": (lambda w, g=g, n=n: g("v", n)) for n in lengths for f, g in (("mean", rolled.mean), ("std", rolled.deviation))}
    out = O.windowed(table, series, made, back=max(lengths) - 1 + behind, first=rolled.steps)
    assert set(out.columns) == {*table.columns, *made}
    want, groups = ordered(frame)
    for n in lengths:
        want[f"mean{n}"] = groups["v"].transform(lambda s: s.shift(behind).rolling(n, min_periods=1).mean())
        want[f"std{n}"] = groups["v"].transform(lambda s: s.shift(behind).rolling(n, min_periods=1).std())
    pd.testing.assert_frame_equal(result(out, list(made)), expect(want, list(made)), atol=1e-6)


def test_merged_frames_keep_small_spreads(spark):
    """A huge value leaves no trace once its frame is over, and equal values have no spread."""
    values = [1e15, *([0.1] * 60), *(1e9 + i % 2 for i in range(60))]
    df = spark.createDataFrame(list(enumerate(values)), "i long, v double")
    rolled = O.Rolling(["v"], [20])
    out = O.windowed(df, O.Series(by=("i",)), {"mean": lambda w: rolled.mean("v", 20), "std": lambda w: rolled.deviation("v", 20, 0)}, back=19, first=rolled.steps)
    got = {x.i: x for x in out.collect()}
    assert all(got[i].std == 0 and got[i].mean == pytest.approx(0.1) for i in range(20, 61))
    assert all(got[i].std == pytest.approx(0.5) for i in range(80, 121))


def test_long_frames_are_not_added_up_row_by_row(spark):
    """A frame of 288 rows adds up a few rows a row and merges the rest."""
    df = spark.range(10).select(F.col("id").alias("t"), F.col("id").cast("double").alias("volume"))
    plan = D.add_demand_features(df, O.Series(by=("t",)), lags=(1,), windows=(12, 36, 288))._jdf.queryExecution().executedPlan().toString()
    frames = [int(n) for n in re.findall(r"specifiedwindowframe\(RowFrame, -(\d+), currentrow", plan)]
    assert frames and max(frames) < O.Rolling.DIRECT
