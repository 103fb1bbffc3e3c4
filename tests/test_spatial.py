"""Neighbour features and graph operators against dense matrices."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltaria import session
from voltaria.operators import edges as E
from voltaria.operators import graph as G
from voltaria.operators import graph_network as N
from voltaria.operators import spatial as S

T0 = dt.datetime(2024, 1, 1)
ADJ = np.array([[0, 1, 0, 0], [1, 0, 1, 0], [0, 1, 0, 0], [0, 0, 0, 0]], dtype=float)
DIST = np.array([[0, 2, 0, 0], [2, 0, 4, 0], [0, 4, 0, 0], [0, 0, 0, 0]], dtype=float)


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(
        [(i, j, float(DIST[i, j])) for i in range(4) for j in range(4) if ADJ[i, j] > 0], "src long, dst long, dist double"
    )


def panel(spark, values):
    data = [(T0 + dt.timedelta(hours=t), n, v) for t, row in enumerate(values) for n, v in enumerate(row) if v is not None]
    return spark.createDataFrame(data, "ts timestamp_ntz, node_id long, volume double")


def test_lags_match_the_matrix_product(spark, edges):
    values = [[10.0, 20.0, 30.0, 5.0], [1.0, 2.0, 4.0, 8.0]]
    rows = S.add_spatial_lags(panel(spark, values), edges, ["volume"]).collect()
    inverse = np.divide(1.0, DIST, where=DIST > 0, out=np.zeros_like(DIST))
    weights = inverse / np.maximum(inverse.sum(axis=1), 1e-300)[:, None]
    plain = np.array(values) @ ADJ.T / np.maximum(ADJ.sum(axis=1), 1)
    for r in rows:
        t = (r["ts"] - T0).seconds // 3600
        assert r["volume_spatial_lag"] == pytest.approx(plain[t, r["node_id"]])
        assert r["volume_spatial_lag_w"] == pytest.approx((np.array(values) @ weights.T)[t, r["node_id"]])
    assert len(rows) == 8


def test_missing_neighbours(spark, edges):
    frame = panel(spark, [[10.0, 20.0, None, None]])
    zero = {r["node_id"]: r["volume_spatial_lag"] for r in S.add_spatial_lags(frame, edges, ["volume"]).collect()}
    skip = {r["node_id"]: r["volume_spatial_lag"] for r in S.add_spatial_lags(frame, edges, ["volume"], "skip").collect()}
    assert zero == {0: 20.0, 1: 5.0} and skip == {0: 20.0, 1: 10.0}
    with pytest.raises(ValueError):
        S.add_spatial_lags(frame, edges, ["volume"], "other")


def test_propagation_matches_the_matrix_power(spark, edges):
    values = np.array([[10.0, 20.0, 30.0, 5.0]])
    looped = ADJ + np.eye(4)
    half = np.diag(looped.sum(axis=1) ** -0.5)
    norm = half @ looped @ half
    made = G.propagated(panel(spark, values.tolist()).withColumn("other", F.lit(1)), edges, "volume", 4)
    for r in made.collect():
        for hop in (1, 2, 4):
            want = (np.linalg.matrix_power(norm, hop) @ values[0])[r["node_id"]]
            assert r[f"volume_hop_{hop}"] == pytest.approx(want)
    assert "other" in made.columns and made.count() == 4


def test_windows(spark):
    frame = panel(spark, [[float(t)] for t in range(10)]).withColumn("occupancy", F.col("volume") * 2)
    made = G.graph_windows(frame, window=3, horizon=2, target="volume").orderBy("ts").collect()
    assert len(made) == 10 - 3 - 2 + 1
    assert made[0]["features"][:6] == [0.0, 2.0, 4.0, 0.0, 1.0, 2.0] and made[0]["target"] == 4.0
    assert all(len(r["features"]) == G.feature_count(3) for r in made)
    assert len(G.graph_windows(frame, 3, 1, temporal=False).first()["features"]) == 6
    with pytest.raises(ValueError):
        G.graph_windows(frame, target="price")


def test_edge_weights(spark, edges):
    rows = {(r["src"], r["dst"]): r["weight"] for r in G.weighted_edges(edges).collect()}
    assert rows[0, 1] == pytest.approx(1.0) and rows[1, 2] == pytest.approx(2.001 / 4.001)


def test_capacity_needs_a_count(spark):
    with pytest.raises(KeyError):
        S.station_capacity(spark.createDataFrame([(1,)], "node_id long"))


def _wave(spark, steps=60, hubs=6):
    """A ring whose next value is a cut (not linear) of what the neighbours hold."""
    r = np.random.default_rng(3)
    edge = [(i, (i + s) % hubs, 1.0) for i in range(hubs) for s in (1, hubs - 1)]
    x = r.normal(size=(steps, hubs))
    mean = (x + np.roll(x, 1, axis=1) + np.roll(x, -1, axis=1)) / 3
    target = 3.0 * np.abs(mean)
    rows = [(T0 + dt.timedelta(hours=t), n, float(x[t, n]), float(target[t, n]), t < 40, 40 <= t < 48) for t in range(steps) for n in range(hubs)]
    frame = spark.createDataFrame(rows, "ts timestamp_ntz, node_id long, x double, target double, learn boolean, check boolean")
    return frame, spark.createDataFrame(edge, "src long, dst long, dist double"), x, target


def test_network_gradient_equals_differences(spark):
    frame, edges, x, target = _wave(spark, 6)
    frame = frame.withColumn("learn", F.col("node_id") != 2)
    links = G.normalised_links(edges, frame)
    net = N.initial(1, 2, 2, seed=5)
    net = net.like(net.flat() + 0.1)
    loss, checked, slope = N.gradient(N.first_sums(frame, links, ["x"]), links, net)

    def plain(flat):
        one, ring = net.like(flat), (np.eye(6) + np.roll(np.eye(6), 1, axis=0) + np.roll(np.eye(6), -1, axis=0)) / 3
        h = x[:, :, None]
        for weights, bias in one.layers:
            h = np.maximum(np.einsum("mn,tnf->tmf", ring, h) @ weights + bias, 0)
        error = (h @ one.head[0] + one.head[1] - target)[:, [0, 1, 3, 4, 5]]
        return (error**2).mean() / 2

    flat, eps = net.flat(), 1e-6
    want = [(plain(flat + eps * e) - plain(flat - eps * e)) / (2 * eps) for e in np.eye(len(flat))]
    assert checked is None and loss == pytest.approx(plain(flat))
    assert slope.flat() == pytest.approx(np.array(want), abs=1e-6)


def test_network_learns_what_a_linear_head_cannot(spark):
    frame, edges, x, target = _wave(spark)
    links = G.normalised_links(edges, frame)
    model = N.fit(frame, links, ["x"], hidden=4, layers=1, epochs=60, rate=0.1)
    test = frame.where("not learn and not check").join(N.predict(frame, links, model), ["ts", "node_id"]).toPandas()
    error = np.mean((test.prediction - test.target) ** 2)
    sides = np.stack([np.ones(x[:48].size), *[np.roll(x[:48], s, axis=1).ravel() for s in (0, 1, 5)]], axis=1)
    head, *_ = np.linalg.lstsq(sides, target[:48].ravel(), rcond=None)
    unseen = np.stack([np.ones(x[48:].size), *[np.roll(x[48:], s, axis=1).ravel() for s in (0, 1, 5)]], axis=1)
    linear = np.mean((unseen @ head - target[48:].ravel()) ** 2)
    assert len(test) == 12 * 6 and error < 0.3 * linear
    assert min(c for _, c in model.losses) < model.losses[0][1]
    with pytest.raises(ValueError):
        N.fit(frame.withColumn("learn", F.lit(False)), links, ["x"])


def test_network_training_stops_by_patience(spark):
    frame, edges, *_ = _wave(spark, 12)
    frame = frame.withColumns({"learn": F.col("node_id") < 3, "check": F.col("node_id") >= 3, "target": F.when(F.col("node_id") < 3, F.col("target")).otherwise(F.col("ts").cast("timestamp").cast("long") / -1e9)})
    links = G.normalised_links(edges, frame)
    model = N.fit(frame, links, ["x"], epochs=30, rate=0.3, patience=2)
    least = int(np.argmin([c for _, c in model.losses]))
    assert len(model.losses) == min(31, least + 3)


def test_hubs_are_dealt_into_bounded_chunks(spark, monkeypatch):
    """A star whose centre has 600 edges, joined without any broadcast."""
    star = [(0, n, 1.0 + n % 3) for n in range(1, 601)] + [(n, 0, 1.0 + n % 3) for n in range(1, 601)]
    edges = spark.createDataFrame(star, "src long, dst long, dist double")
    frame = panel(spark, [[float(n % 7) if n % 5 else None for n in range(601)] for _ in range(3)]).where("volume is not null or node_id = 0")
    frame = frame.unionByName(panel(spark, [[2.0]] * 3))
    calls = {
        "lags": lambda: S.add_spatial_lags(frame, edges, ["volume"]),
        "hops": lambda: G.propagated(frame, edges, "volume", 2),
        "pairs": lambda: S.neighbor_correlation(frame, edges),
    }
    want = {name: sorted(call().collect()) for name, call in calls.items()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(E, "HUB_EDGES", 50)
    monkeypatch.setattr(E.met, "__defaults__", (50,))
    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        chunked, hubs = E.dealt(edges, "dst", 50)
        assert hubs.collect() == [(0, 12)]
        assert chunked.groupBy("dst", "_chunk").count().agg(F.max("count")).first()[0] < 100 and chunked.count() == 1200
        for name, call in calls.items():
            made = call()
            assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString()
            for a, b in zip(sorted(made.collect()), want[name], strict=True):
                assert a[:2] == b[:2] and list(a[2:]) == pytest.approx(list(b[2:]), nan_ok=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
