"""Drift, feedback, retraining and streaming jobs."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltaria import session
from voltaria.config import MonitorConfig
from voltaria.operators import monitor as K
from voltaria.operators.ordered import Series
from voltaria.session import scratch_path
from voltaria.sources.versioned import VersionedTable
from voltaria.streaming.drift_watch import DriftWatch
from voltaria.streaming.hourly_kpis import WindowTable


def metrics(spark, **groups):
    data = [(m, i, None if v is None else float(v)) for m, values in groups.items() for i, v in enumerate(values)]
    return spark.createDataFrame(data, "metric string, seq long, value double")


def by_hand(values, window=100, cut=2.0):
    last = values[-window:]
    known = np.array([v for v in last if v is not None])
    if len(last) < window // 2 or len(known) < 8:
        return False
    recent = max(len(known) // 4, 1)
    past = known[:-recent]
    return bool(past.std() >= 1e-8 and abs(known[-recent:].mean() - past.mean()) / past.std() > cut)


def test_drift_against_brute_force(spark):
    rng = np.random.default_rng(5)
    groups = {f"m{i}": list(rng.normal(0, 1, 130)) for i in range(4)}
    groups["jump"] = [*rng.normal(0, 1, 100), *rng.normal(9, 1, 25)]
    groups["gaps"] = [None if i % 3 else float(v) for i, v in enumerate(rng.normal(0, 1, 120))]
    groups["short"] = list(rng.normal(0, 1, 30))
    groups["flat"] = [1.0] * 100
    got = {r["metric"]: r for r in K.drift(metrics(spark, **groups)).collect()}
    for name, values in groups.items():
        values = [None if v is None else float(v) for v in values]
        assert got[name]["drifted"] == by_hand(values), name
    assert got["jump"]["drifted"] and got["flat"]["z_score"] is None
    assert got["gaps"]["latest"] == pytest.approx([v for v in groups["gaps"] if v is not None][-1])


def test_episode_derivations(spark):
    df = spark.createDataFrame([(1, 10.0, 0.25, 0.8, "x"), (2, 10.0, 0.25, None, "y")], "episode long, revenue_gain_pct double, congestion_rate double, mean_utilization double, note string")
    rows = K.episode_metrics(df).orderBy("episode").collect()
    assert [r["wait_time_proxy"] for r in rows] == [0.25 * 0.8 * 10, 0.25 * 0.25 * 10]
    assert rows[0]["pricing_efficiency_score"] == 8.0
    assert rows[0]["extra_json"] == '{"mean_utilization":0.8,"note":"x"}'


def test_history_and_unknown_metric(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "episode long, congestion_rate double")
    assert [r["episode"] for r in K.history(df, "congestion_rate", 3).collect()] == [7, 8, 9]
    with pytest.raises(ValueError):
        K.history(df, "other")


def test_feedback(spark):
    now = spark.createDataFrame([("revenue_gain_pct", 10.0), ("congestion_rate", 0.3)], "metric string, value double")
    goal = spark.createDataFrame(
        [("revenue_gain_pct", 18.0), ("congestion_rate", 0.1), ("utilization_rate", 0.5), ("other", 1.0)], "metric string, value double"
    )
    gaps = K.feedback(now, goal)
    advice = {r["metric"]: r["recommendation"] for r in gaps.collect()}
    assert advice == {
        "revenue_gain_pct": "raise_revenue_gain",
        "congestion_rate": "reduce_congestion",
        "utilization_rate": "improve_utilization",
        "other": None,
    }
    assert K.feedback_score(gaps).first()[0] == pytest.approx(100 - (8 * 0.4 + 0.2 * 0.2 + 0.5 * 0.25 + 0.1))


def test_retrain(spark):
    calm = [1.0, -1.0] * 50
    assert K.should_retrain(metrics(spark, revenue_gain_pct=calm)).first()["retrain"] is False
    low = K.should_retrain(metrics(spark, revenue_gain_pct=[*calm, -9.0])).first()
    assert low["gain_low"] and low["retrain"]
    crowded = K.should_retrain(metrics(spark, congestion_rate=[0.1, 0.5])).first()
    assert crowded["congestion_high"] and not crowded["drifted"]


@pytest.mark.parametrize("limits", [{}, {"task_rows": 15, "task_bytes": 0}], ids=["plain", "split"])
def test_z_runs(spark, limits):
    values = [float(i % 2) for i in range(40)] + [50.0 + 40.0 * i * i for i in range(6)] + [float(i % 2) for i in range(20)]
    series = Series(keys=("metric",), by=("seq",), **limits)
    runs = K.z_runs(metrics(spark, m=values), series, 2.0, 3, 30).collect()
    assert [(r["length"], r["start"], r["end"]) for r in runs] == [(6, 40, 45)]


def test_drift_watch_equals_batch_and_repeats(spark):
    rng = np.random.default_rng(11)
    data = metrics(spark, a=list(rng.normal(0, 1, 150)), b=[*rng.normal(0, 1, 100), *rng.normal(8, 1, 50)])
    root = scratch_path(spark, "test-drift")
    watch = DriftWatch(root, ["metric"], MonitorConfig())
    parts = [data.where("seq < 60"), data.where("seq >= 60 and seq < 110"), data.where("seq >= 110")]
    for i, part in enumerate(parts):
        watch(part, i)
    watch(parts[2], 2)  # the same batch again
    order = lambda df: [tuple(r) for r in df.select("metric", "rows", F.round("z_score", 6), "drifted").orderBy("metric").collect()]
    assert order(watch.latest_status(spark, data)) == order(K.drift(data))
    assert spark.read.parquet(watch.log_path).count() == data.count()


def changed_at(spark, root):
    """Modification time of every data file under a folder."""
    files, where = session._files(spark, root)
    found, out = files.listFiles(where, True), {}
    while found.hasNext():
        status = found.next()
        if status.getPath().getName().startswith("part-"):
            out[status.getPath().toString()] = status.getModificationTime()
    return out


def test_drift_watch_writes_only_the_buckets_it_touches(spark):
    names = [f"m{i}" for i in range(12)]
    first = metrics(spark, **{n: [float(i % 7) for i in range(60)] for n in names})
    later = metrics(spark, m3=[float(i % 7) for i in range(120)]).where("seq >= 60")
    root = scratch_path(spark, "test-touched")
    watch = DriftWatch(root, ["metric"], MonitorConfig(), buckets=32)
    watch(first, 0)
    before = {t: changed_at(spark, f"{root}/{t}/data") for t in ("recent", "status")}
    held = {t: getattr(watch, t).index(spark) for t in before}
    watch(later, 1)
    own = later.select(watch.bucket()).first()[0]
    for t, files in before.items():
        index = getattr(watch, t).index(spark)
        assert index == held[t] | {own: 1} and len(index) > 1
        after = changed_at(spark, f"{root}/{t}/data")
        assert all(f"part={own}/" in path for path in after.keys() - files.keys())
        assert all(after[path] == at for path, at in files.items() if path in after)
    watch(later, 1)
    watch(later.where("false"), 2)
    assert watch.recent.index(spark) == held["recent"] | {own: 1}
    order = lambda df: [tuple(r) for r in df.select("metric", "rows", "drifted").orderBy("metric").collect()]
    assert order(watch.latest_status(spark, first)) == order(K.drift(first.unionByName(later)))


def test_superseded_parts_go_two_batches_later(spark):
    table, rows = VersionedTable(scratch_path(spark, "test-parts")), lambda v, *parts: spark.createDataFrame([(v, p) for p in parts], "v long, part string")
    for batch, parts in enumerate([("a", "b"), ("a",), ("a",), ("a",)]):
        table.write(rows(batch, *parts), batch)
    read = lambda **more: sorted(tuple(r) for r in table.read(spark, rows(0, "a").schema, **more).collect())
    assert read() == [(0, "b"), (3, "a")] and read(before=3) == [(0, "b"), (2, "a")] and read(parts=["b"]) == [(0, "b")]
    assert table.batches(spark) == [2, 3]
    assert session.file_names(spark, f"{table.root}/data/batch=1") in ([], ["_SUCCESS"]) and "part=b" in session.file_names(spark, f"{table.root}/data/batch=0")
    assert "part=a" not in session.file_names(spark, f"{table.root}/data/batch=0")
    table.write(rows(9, "a"), 3)
    assert read() == [(0, "b"), (9, "a")]


def test_window_table_shows_open_windows_once_and_counts_late_rows(spark):
    at = lambda *times: spark.createDataFrame([(datetime.fromisoformat(f"2024-05-{t}"), 1.5) for t in times], "connectionTime timestamp, kWhDelivered double")
    for slide in (None, "30 minutes"):
        table = WindowTable(scratch_path(spark, "test-windows"), slide=slide)
        table(at("01 10:05:00", "01 10:20:00", "02 09:10:00"), 0)
        table(at("02 09:20:00", "02 06:00:00", "01 10:30:00", "02 07:10:00"), 1)
        state = lambda: sorted((str(r.window_start), r.sessions, r.energy, r.open) for r in table.kpis(spark).collect())
        want = state()
        table(at("02 09:20:00", "02 06:00:00", "01 10:30:00", "02 07:10:00"), 1)
        assert state() == want and len(want) == len({w[0] for w in want})
        assert sum(w[1] for w in want) == (5 if slide is None else 10)
        assert {w[0]: w[3] for w in want}["2024-05-02 09:00:00"] and not {w[0]: w[3] for w in want}["2024-05-01 10:00:00"]
        assert [tuple(r)[2:] for r in table.batches(spark).orderBy("batch").collect()] == [(3, 0), (4, 2)]
        index = table.windows.index(spark)
        assert index == {"2024-05-01": 0, "2024-05-02": 1}
        table(at().limit(0), 2)
        assert state() == want and table.windows.index(spark) == index


def test_z_runs_check_their_keys_once(spark, monkeypatch):
    """A large derived table is written once for all steps of a run, and taken through one shuffle."""
    from voltaria.operators import ordered

    rows = [(f"m{k}", i, float((i * 37 + k) % 11) + (50.0 if 60 <= i < 66 or i >= 112 else 0.0)) for k in range(3) for i in range(120)]
    df = spark.createDataFrame(rows, "metric string, seq long, value double").groupBy("metric", "seq").agg(F.sum("value").alias("value"))
    plain = K.z_runs(df, Series(keys=("metric",), by=("seq",), bounded=True), 1.0, 2, 20)
    staged = []
    monkeypatch.setattr(ordered, "stage", lambda rows, label: staged.append(label) or session.stage(rows, label))
    checked = K.z_runs(df, Series(keys=("metric",), by=("seq",), task_bytes=0), 1.0, 2, 20)
    assert staged == ["series", "hot-keys"]
    cut = K.z_runs(df, Series(keys=("metric",), by=("seq",), task_bytes=0, task_rows=30), 1.0, 2, 20)
    assert plain.count() >= 3
    assert plain.exceptAll(checked).count() == checked.exceptAll(plain).count() == 0
    assert plain.exceptAll(cut).count() == cut.exceptAll(plain).count() == 0
