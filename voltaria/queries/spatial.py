"""Queries over neighbour features, graph windows and propagation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.functions.demand import add_row_demand
from voltaria.operators import graph as G
from voltaria.operators import graph_network as N
from voltaria.operators import metrics as M
from voltaria.operators import spatial as S
from voltaria.operators.ordered import windowed
from voltaria.queries.registry import DIGITS, R, query, rounded, settle
from voltaria.queries.views_sql import clip_util, with_views
from voltaria.sources import driver_views as V


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    return add_row_demand(V.district_panel(spark, sf)).drop("revenue", "revenue_per_kwh")


_COLUMNS = ("occupancy", "volume", "price", "utilization_rate")


def _lags_sql(missing: str) -> str:
    sums, outs = [], []
    for c in _COLUMNS:
        sums.append(f"sum(p.{c}) AS {c}_s, sum(p.{c} / e.dist) AS {c}_w, count(p.{c}) AS {c}_n, sum(CASE WHEN p.{c} IS NOT NULL THEN 1 / e.dist END) AS {c}_d")
        degree, weight = ("degree", "weight") if missing == "zero" else (f"{c}_n", f"{c}_d")
        outs.append(f"{R(f'coalesce({c}_s / {degree}, 0)', 6)} AS {c}_spatial_lag, {R(f'coalesce({c}_w / {weight}, 0)', 6)} AS {c}_spatial_lag_w")
    return with_views(
        f"""SELECT ts, node_id, occupancy, volume, price, capacity, utilization_rate, {', '.join(outs)}
        FROM (SELECT *, {clip_util()} AS utilization_rate FROM district_panel)
        LEFT JOIN (SELECT p.ts, e.src AS node_id, {', '.join(sums)}
          FROM (SELECT *, {clip_util()} AS utilization_rate FROM district_panel) p JOIN edges e ON p.node_id = e.dst GROUP BY 1, 2)
          USING (ts, node_id)
        LEFT JOIN (SELECT src AS node_id, count(*) AS degree, sum(1 / dist) AS weight FROM edges GROUP BY 1) USING (node_id)""",
        "district_panel",
        "edges",
    )


def _lagged(spark: SparkSession, sf: str, missing: str) -> DataFrame:
    made = S.add_spatial_lags(_panel(spark, sf), V.edges(spark, sf), missing=missing)
    return made.withColumns({c: settle(c, 6) for c in made.columns if "_spatial_lag" in c})


@query("spatial_lags", _lags_sql("zero"))
def spatial_lags(spark: SparkSession, sf: str) -> DataFrame:
    return _lagged(spark, sf, "zero")


@query("spatial_lags_present", _lags_sql("skip"))
def spatial_lags_present(spark: SparkSession, sf: str) -> DataFrame:
    return _lagged(spark, sf, "skip")


@query("station_capacity", 'SELECT s_suppkey AS node_id, CAST(2 + s_suppkey % 3 AS DOUBLE) AS station_capacity FROM supplier')
def station_capacity(spark: SparkSession, sf: str) -> DataFrame:
    dim = V.station_dim(spark, sf).select(F.col("station_id").alias("node_id"), "count")
    return S.station_capacity(dim)


@query(
    "weighted_edges",
    with_views(
        "SELECT src, dst, dist, (1.0::DOUBLE / (dist + 0.001::DOUBLE)) / (SELECT max(1.0::DOUBLE / (dist + 0.001::DOUBLE)) FROM edges) AS weight FROM edges",
        "edges",
    ),
)
def weighted_edges(spark: SparkSession, sf: str) -> DataFrame:
    return G.weighted_edges(V.edges(spark, sf))


@query(
    "graph_windows",
    with_views(
        f"""SELECT ts, station_id, target, CAST(27 AS INTEGER) AS n, first_occupancy, last_volume,
          {R('sin(2 * pi() * hour(ts) / 24)')} AS hour_sin, {R('(isodow(ts) - 1) / 6.0::DOUBLE')} AS weekday_norm
        FROM (SELECT ts, station_id, lead(occupancy, 2) OVER w AS target, lag(occupancy, 11) OVER w AS first_occupancy,
            volume AS last_volume, row_number() OVER w AS rn FROM hourly_panel WINDOW w AS (PARTITION BY station_id ORDER BY ts))
        WHERE rn >= 12 AND target IS NOT NULL""",
        "hourly_panel",
    ),
)
def graph_windows(spark: SparkSession, sf: str) -> DataFrame:
    made = G.graph_windows(V.hourly_panel(spark, sf), 12, 2, key="station_id")
    x = F.col("features")
    return made.select(
        "ts",
        "station_id",
        "target",
        F.size(x).alias("n"),
        x[0].alias("first_occupancy"),
        x[23].alias("last_volume"),
        settle(x[24]).alias("hour_sin"),
        settle(x[26]).alias("weekday_norm"),
    )


_HOPS = """,
links AS (SELECT src, dst FROM edges UNION ALL SELECT DISTINCT node_id, node_id FROM district_panel),
degrees AS (SELECT src AS node, CAST(count(*) AS DOUBLE) AS d FROM links GROUP BY 1),
a AS (SELECT src, dst, 1.0::DOUBLE / sqrt(s.d * t.d) AS a FROM links JOIN degrees s ON src = s.node JOIN degrees t ON dst = t.node),
h1 AS (SELECT ts, src AS node_id, sum(occupancy * a) AS x FROM district_panel JOIN a ON node_id = dst GROUP BY 1, 2),
present AS (SELECT p.ts, p.node_id, h1.x FROM district_panel p JOIN h1 USING (ts, node_id)),
h2 AS (SELECT ts, src AS node_id, sum(x * a) AS x FROM present JOIN a ON node_id = dst GROUP BY 1, 2)"""


@query(
    "graph_propagation",
    with_views(_HOPS, "district_panel", "edges").replace(")\n,", "),", 1)
    + f"""
SELECT ts, node_id, occupancy, {R('h1.x', 6)} AS occupancy_hop_1, {R('h2.x', 6)} AS occupancy_hop_2
FROM district_panel LEFT JOIN h1 USING (ts, node_id) LEFT JOIN h2 USING (ts, node_id)""",
)
def graph_propagation(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.district_panel(spark, sf).select("ts", "node_id", "occupancy")
    made = G.propagated(panel, V.edges(spark, sf), "occupancy", 2)
    return made.withColumns({c: settle(c, 6) for c in made.columns if "_hop_" in c})


@query("graph_forecast")
def graph_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the propagation forecast beside those of the last value, per model, on the same test rows."""
    panel = V.district_panel(spark, sf).select("ts", "node_id", "occupancy")
    _, predicted = G.fit_graph_forecast(panel, V.edges(spark, sf))
    both = predicted.select("target", "prediction", F.lit("propagation").alias("model")).unionByName(
        predicted.select("target", F.col("occupancy").alias("prediction"), F.lit("last value").alias("model"))
    )
    return M.regression_metrics(both, "target", "prediction", ["model"], guard=1e-8)


@query("graph_convolution_forecast")
def graph_convolution_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the learned convolution beside those of the last value, per model, on the same test rows."""
    panel = V.district_panel(spark, sf).select("ts", "node_id", "occupancy")
    _, predicted = N.fit_convolution_forecast(panel, V.edges(spark, sf), epochs=25)
    test = predicted.where("not in_head")
    both = test.select("target", "prediction", F.lit("convolution").alias("model")).unionByName(
        test.select("target", F.col("occupancy").alias("prediction"), F.lit("last value").alias("model"))
    )
    return M.regression_metrics(both, "target", "prediction", ["model"], guard=1e-8)


@query(
    "graph_convolution_facts",
    with_views(
        """SELECT count(*) FILTER (rn <= floor(n * 0.72::DOUBLE)) AS rows_learned, count(*) FILTER (rn > floor(n * 0.8::DOUBLE)) AS rows_test,
          count(*) AS predictions, true AS loss_fell, true AS below_mean_error
        FROM (SELECT row_number() OVER (ORDER BY ts, node_id) AS rn, count(*) OVER () AS n
          FROM (SELECT ts, node_id, lag(occupancy, 11) OVER w AS first, lead(occupancy) OVER w AS target FROM district_panel WINDOW w AS (PARTITION BY node_id ORDER BY ts))
          WHERE first IS NOT NULL AND target IS NOT NULL)""",
        "district_panel",
    ),
)
def graph_convolution_facts(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold whatever the data: sizes of the parts, a finite prediction for every sample, a loss on the rows learned
    from that fell, and ended below that of their mean (half a squared unit after scaling)."""
    panel = V.district_panel(spark, sf).select("ts", "node_id", "occupancy")
    samples, inputs = N.forecast_samples(panel)
    links = G.normalised_links(V.edges(spark, sf), panel)
    model = N.fit(samples, links, inputs, epochs=8)
    least = min(loss for loss, _ in model.losses)
    predicted = N.predict(samples, links, model)
    return samples.join(predicted, ["ts", "node_id"]).agg(
        F.count_if("learn").alias("rows_learned"),
        F.count_if(~F.col("in_head")).alias("rows_test"),
        F.count_if(F.abs("prediction") < float("inf")).alias("predictions"),
        F.lit(least < model.losses[0][0]).alias("loss_fell"),
        F.lit(least < 0.5).alias("below_mean_error"),
    )


_NETWORK = N.Network(
    ((np.array([[0.5, -0.3], [0.2, 0.4]]), np.array([0.1, 0.05])), (np.array([[0.3, 0.6], [-0.2, 0.5]]), np.array([0.05, -0.1]))),
    (np.array([0.7, -0.4]), 0.2),
)


def _gradient_sql() -> str:
    """Both layers forward and backward, written out for the fixed network."""

    def unit(names: list[str], weights, bias: float) -> str:
        return " + ".join([f"{n} * ({w}::DOUBLE)" for n, w in zip(names, weights)] + [f"({bias}::DOUBLE)"])

    (w0, b0), (w1, b1) = _NETWORK.layers
    w2, b2 = _NETWORK.head
    hidden = [", ".join(f"greatest({unit([f'p{n}{i}' for i in (0, 1)], w[:, j], b[j])}, 0.0::DOUBLE) AS h{n}{j}" for j in (0, 1)) for n, (w, b) in enumerate(_NETWORK.layers)]
    sent = ", ".join(f"{unit(['g10', 'g11'], w1[i], 0.0)} AS s{i}" for i in (0, 1))
    rows = [(f"layer {n} weight", i, j, f"avg(p{n}{i} * g{n}{j})") for n in (0, 1) for i in (0, 1) for j in (0, 1)]
    rows += [(f"layer {n} bias", 0, j, f"avg(g{n}{j})") for n in (0, 1) for j in (0, 1)]
    rows += [("head weight", 0, j, f"avg(h1{j} * d)") for j in (0, 1)] + [("head bias", 0, 0, "avg(d)"), ("loss", 0, 0, "avg(d * d) / 2")]
    shown = "\nUNION ALL ".join(f"SELECT '{part}' AS part, {i} AS i, {j} AS j, {R(value, 6)} AS value FROM pulled" for part, i, j, value in rows)
    ctes = f""",
x AS (SELECT ts, node_id, occupancy / capacity AS x0, price / 30.0::DOUBLE AS x1, volume / (25.0::DOUBLE * capacity) AS target FROM district_panel),
p0 AS (SELECT ts, src AS node_id, sum(x0 * a) AS p00, sum(x1 * a) AS p01 FROM x JOIN a ON node_id = dst GROUP BY 1, 2),
l0 AS (SELECT x.*, p00, p01, {hidden[0]} FROM x JOIN p0 USING (ts, node_id)),
p1 AS (SELECT ts, src AS node_id, sum(h00 * a) AS p10, sum(h01 * a) AS p11 FROM l0 JOIN a ON node_id = dst GROUP BY 1, 2),
l1 AS (SELECT l0.*, p10, p11, {hidden[1]} FROM l0 JOIN p1 USING (ts, node_id)),
err AS (SELECT *, {unit(['h10', 'h11'], w2, b2)} - target AS d FROM l1),
g1 AS (SELECT *, {', '.join(f'CASE WHEN h1{j} > 0 THEN d * ({w2[j]}::DOUBLE) ELSE 0 END AS g1{j}' for j in (0, 1))} FROM err),
sent AS (SELECT *, {sent} FROM g1),
q AS (SELECT ts, dst AS node_id, sum(s0 * a) AS q0, sum(s1 * a) AS q1 FROM sent JOIN a ON node_id = src GROUP BY 1, 2),
pulled AS (SELECT sent.*, {', '.join(f'CASE WHEN h0{j} > 0 THEN q{j} ELSE 0 END AS g0{j}' for j in (0, 1))} FROM sent JOIN q USING (ts, node_id))"""
    links = _HOPS[: _HOPS.index(",\nh1 AS")]
    return with_views(links + ctes, "district_panel", "edges").replace(")\n,", "),", 1) + "\n" + shown


@query("graph_convolution_gradient", _gradient_sql())
def graph_convolution_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """Loss and gradient of a fixed network of two layers over the whole panel, number by number."""
    panel = V.district_panel(spark, sf)
    load, rate = F.col("occupancy") / F.col("capacity"), F.col("price") / 30.0
    samples = panel.select("ts", "node_id", load.alias("x0"), rate.alias("x1"), (F.col("volume") / (25.0 * F.col("capacity"))).alias("target"), F.lit(True).alias("learn"))
    links = G.normalised_links(V.edges(spark, sf), panel)
    loss, _, slope = N.gradient(N.first_sums(samples, links, ["x0", "x1"]), links, _NETWORK)
    rows = [("loss", 0, 0, loss), ("head bias", 0, 0, slope.head[1])]
    rows += [("head weight", 0, j, float(v)) for j, v in enumerate(slope.head[0])]
    for n, (weights, bias) in enumerate(slope.layers):
        rows += [(f"layer {n} weight", int(i), int(j), float(v)) for (i, j), v in np.ndenumerate(weights)]
        rows += [(f"layer {n} bias", 0, j, float(v)) for j, v in enumerate(bias)]
    return spark.createDataFrame(rows, "part string, i int, j int, value double").withColumn("value", settle("value", 6))


_NAIVE = """(SELECT node_id, occupancy AS y, lag(occupancy) OVER (PARTITION BY node_id ORDER BY ts) AS p FROM district_panel)"""


def _scores_sql(by: str) -> str:
    group = f"GROUP BY {by}" if by else ""
    return with_views(
        f"""SELECT {by + ', ' if by else ''}count(y) AS rows, {R('sqrt(avg((y - p) * (y - p)))', 6)} AS rmse, {R('avg(abs(y - p))')} AS mae,
          {R('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y) + 1e-8)', 6)} AS r2, {R('avg(abs((y - p) / y)) * 100', 6)} AS mape
        FROM {_NAIVE} WHERE p IS NOT NULL {group}""",
        "district_panel",
    )


def _naive(spark: SparkSession, sf: str) -> DataFrame:
    panel = V.district_panel(spark, sf).select("ts", "node_id", F.col("occupancy").alias("y"))
    return windowed(panel, V.DISTRICT_SERIES, {"p": lambda w: F.lag("y").over(w)}, back=1).where(F.col("p").isNotNull())


@query("forecast_scores_per_node", _scores_sql("node_id"))
def forecast_scores_per_node(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.regression_metrics(_naive(spark, sf), "y", "p", ["node_id"], guard=1e-8), 6, mae=DIGITS)


@query("forecast_scores", _scores_sql(""))
def forecast_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.regression_metrics(_naive(spark, sf), "y", "p", guard=1e-8), 6, mae=DIGITS)


@query(
    "neighbor_correlation",
    with_views(
        f"""SELECT e.src, e.dst, {R('corr(a.volume, b.volume)', 6)} AS correlation FROM edges e
        JOIN district_panel a ON a.node_id = e.src JOIN district_panel b ON b.node_id = e.dst AND a.ts = b.ts
        WHERE e.src < e.dst GROUP BY 1, 2""",
        "district_panel",
        "edges",
    ),
)
def neighbor_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(S.neighbor_correlation(V.district_panel(spark, sf), V.edges(spark, sf)), 6)
