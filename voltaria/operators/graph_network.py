"""A graph convolution network whose layers are learned by gradients that Spark sums.

A layer takes, for every node and step, the sum of its neighbours' values under the normalised adjacency with self loops,
multiplies it by learned weights and cuts it at 0; a linear head reads the last layer. Forward, every layer but the first is
one edge join and one aggregation per (step, node); backward, the error runs along the reversed edges the same way. An epoch
is one job that ends in one row of sums, so the driver holds the weights only (a few hundred numbers, set by ``hidden`` and
``layers``, not by the data). What neighbours give the first layer does not change and is written once.

Rows without a target, or outside the part learned from, still speak to their neighbours but add no error.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaria.operators.edges import met
from voltaria.operators.graph import normalised_links
from voltaria.operators.ordered import Series, ordered_cut, windowed
from voltaria.session import stage


class Network(NamedTuple):
    """Weights (inputs x outputs) and biases of each convolution, and the head's weights and bias."""

    layers: tuple[tuple[np.ndarray, np.ndarray], ...]
    head: tuple[np.ndarray, float]

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for pair in self.layers for part in pair] + [self.head[0], [self.head[1]]])

    def like(self, flat: np.ndarray) -> Network:
        """A network of this shape with other numbers."""
        at, layers = 0, []
        for weights, bias in self.layers:
            layers.append((flat[at : at + weights.size].reshape(weights.shape), flat[at + weights.size : at + weights.size + bias.size]))
            at += weights.size + bias.size
        return Network(tuple(layers), (flat[at:-1], float(flat[-1])))


class Fitted(NamedTuple):
    """A trained network, the scales of its columns, and the losses of each epoch (learned rows, checked rows)."""

    network: Network
    center: dict[str, float]
    scale: dict[str, float]
    losses: list[tuple[float, float | None]]


def initial(inputs: int, hidden: int, layers: int, seed: int = 7) -> Network:
    """Random weights scaled to the number of inputs, in pairs of opposite sign, so that no direction is cut off from the start;
    biases start at 0."""
    draw, sizes = np.random.default_rng(seed), [inputs, *[hidden] * layers]
    halves = [draw.normal(0, np.sqrt(2 / a), (a, (b + 1) // 2)) for a, b in zip(sizes, sizes[1:])]
    made = tuple((np.concatenate([half, -half], axis=1)[:, :b], np.zeros(b)) for half, b in zip(halves, sizes[1:]))
    return Network(made, (draw.normal(0, np.sqrt(1 / hidden), hidden), 0.0))


def around(rows: DataFrame, links: DataFrame, sums: dict[str, str], reverse: bool = False) -> DataFrame:
    """Rows with the named sums over their neighbours in the same step (``reverse``: over those they are neighbours of).

    ``(ts, node_id)`` is unique; the self loop brings a row's own columns along.
    """
    here, there = ("src", "dst") if reverse else ("dst", "src")
    ends = links.select(F.col(here).alias("node_id"), F.col(there).alias("_to"), "a")
    carried = [c for c in rows.columns if c not in ("ts", "node_id")]
    return (
        met(rows, ends, "node_id")
        .groupBy("ts", "_to")
        .agg(
            F.expr("bool_or(node_id = _to)").alias("_present"),
            *[F.expr(f"max(if(node_id = _to, {c}, null)) AS {c}") for c in carried],
            *[F.expr(f"sum({c} * a) AS {name}") for name, c in sums.items()],
        )
        .where("_present")
        .drop("_present")
        .withColumnRenamed("_to", "node_id")
    )


def _number(value: float) -> str:
    return f"({float(value)!r}D)"


def _affine(names: Sequence[str], weights: np.ndarray, bias: float) -> str:
    return " + ".join([*[f"{n} * {_number(w)}" for n, w in zip(names, weights)], _number(bias)])


def _names(kind: str, layer: int, count: int) -> list[str]:
    return [f"_{kind}{layer}_{i}" for i in range(count)]


def first_sums(rows: DataFrame, links: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """``rows`` with what the first layer reads in place of ``inputs``."""
    return around(rows, links, dict(zip(_names("p", 0, len(inputs)), inputs))).drop(*inputs)


def forward(rows: DataFrame, links: DataFrame, network: Network) -> DataFrame:
    """``rows`` of :func:`first_sums` with every layer's values and the output ``_y``."""
    for n, (weights, bias) in enumerate(network.layers):
        reads, gives = _names("p", n, len(weights)), _names("h", n, len(bias))
        if n:
            rows = around(rows, links, dict(zip(reads, _names("h", n - 1, len(weights)))))
        rows = rows.selectExpr("*", *[f"greatest({_affine(reads, weights[:, j], bias[j])}, 0D) AS {g}" for j, g in enumerate(gives)])
    return rows.selectExpr("*", f"{_affine(gives, *network.head)} AS _y")


def gradient(rows: DataFrame, links: DataFrame, network: Network, target: str = "target", learn: str = "learn", check: str | None = None) -> tuple[float, float | None, Network]:
    """Half the mean squared error over the ``learn`` rows and over the ``check`` rows, and the gradient of the first."""
    made = forward(rows, links, network).selectExpr("*", f"_y - {target} AS _e")
    made = made.selectExpr("*", f"if({learn} and _e is not null, _e, null) AS _d")
    last = len(network.layers) - 1
    outputs = len(network.layers[last][1])
    held, pulled = _names("h", last, outputs), _names("g", last, outputs)
    made = made.selectExpr("*", *[f"if({h} > 0, coalesce(_d, 0D) * {_number(w)}, 0D) AS {g}" for g, h, w in zip(pulled, held, network.head[0])])
    for n in range(last, 0, -1):
        weights = network.layers[n][0]
        sent, back = _names("s", n, len(weights)), _names("q", n, len(weights))
        made = made.selectExpr("*", *[f"{_affine(pulled, weights[i], 0.0)} AS {s}" for i, s in enumerate(sent)])
        made = around(made, links, dict(zip(back, sent)), reverse=True).drop(*sent)
        pulled = _names("g", n - 1, len(weights))
        made = made.selectExpr("*", *[f"if({h} > 0, {q}, 0D) AS {g}" for g, h, q in zip(pulled, _names("h", n - 1, len(weights)), back)]).drop(*back)
    sums = []
    for n, (weights, bias) in enumerate(network.layers):
        reads, down = _names("p", n, len(weights)), _names("g", n, len(bias))
        sums += [f"{p} * {g}" for p in reads for g in down] + down
    sums += [f"{h} * _d" for h in held] + ["_d"]
    checked = f"avg(if({check}, _e * _e / 2, null))" if check else "cast(null AS double)"
    parts = [f"sum({part}) AS _{i}" for i, part in enumerate(sums)]
    total = made.selectExpr("count(_d) AS n", "avg(_d * _d / 2) AS loss", f"{checked} AS held", *parts).first()
    if not total.n:
        raise ValueError("no row to learn from")
    return total.loss, total.held, network.like(np.array(total[3:]) / total.n)


def fit(
    samples: DataFrame,
    links: DataFrame,
    inputs: Sequence[str],
    hidden: int = 4,
    layers: int = 2,
    epochs: int = 40,
    rate: float = 0.05,
    patience: int = 10,
    seed: int = 7,
) -> Fitted:
    """A network for ``target`` of ``samples`` (``ts, node_id, target, learn, check`` and the inputs, without nulls).

    Columns are scaled by the rows learned from; steps are Adam's over all rows. Training ends ``patience`` epochs after the least
    loss over the ``check`` rows (over those learned from, if there are none), and the weights of that epoch are kept.
    """
    named = [*inputs, "target"]
    learned = samples.where("learn and target is not null")
    facts = learned.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in named for f in (F.avg, F.stddev_pop)]).first()
    if facts[0] is None:
        raise ValueError("no row to learn from")
    center = {c: facts[f"{c}_avg"] for c in named}
    scale = {c: facts[f"{c}_stddev_pop"] or 1.0 for c in named}
    rows = stage(first_sums(_scaled(samples.select("ts", "node_id", "learn", "check", *named), center, scale), links, inputs), "convolved")
    network = best = initial(len(inputs), hidden, layers, seed)
    mean, spread = np.zeros(len(network.flat())), np.zeros(len(network.flat()))
    losses: list[tuple[float, float | None]] = []
    least, kept_at = np.inf, 0
    for epoch in range(epochs + 1):
        loss, checked, slope = gradient(rows, links, network, check="check")
        losses.append((loss, checked))
        now = loss if checked is None else checked
        if now < least:
            least, kept_at, best = now, epoch, network
        if epoch - kept_at >= patience:
            break
        step = slope.flat()
        mean, spread = 0.9 * mean + 0.1 * step, 0.999 * spread + 0.001 * step**2
        move = mean / (1 - 0.9 ** (epoch + 1)) / (np.sqrt(spread / (1 - 0.999 ** (epoch + 1))) + 1e-8)
        network = network.like(network.flat() - rate * move)
    return Fitted(best, center, scale, losses)


def _scaled(rows: DataFrame, center: dict[str, float], scale: dict[str, float]) -> DataFrame:
    return rows.withColumns({c: (F.col(c) - F.lit(center[c])) / F.lit(scale[c]) for c in center if c in rows.columns})


def predict(samples: DataFrame, links: DataFrame, model: Fitted) -> DataFrame:
    """``ts, node_id, prediction`` of every row; all nodes of a step must be among the samples to speak to each other."""
    inputs = [c for c in model.center if c != "target"]
    rows = first_sums(_scaled(samples.select("ts", "node_id", *inputs), model.center, model.scale), links, inputs)
    value = F.col("_y") * F.lit(model.scale["target"]) + F.lit(model.center["target"])
    return forward(rows, links, model.network).select("ts", "node_id", value.alias("prediction"))


def forecast_samples(panel: DataFrame, window: int = 12, horizon: int = 1, column: str = "occupancy") -> tuple[DataFrame, list[str]]:
    """Samples of the newest ``window`` values with the one ``horizon`` steps ahead, and their input columns.

    ``learn`` holds on the first 72 % of the samples in time, ``check`` on the next 8 %; the rest is the test.
    """
    series = Series(keys=("node_id",), by=("ts",))
    lagged = {f"{column}_b{k}": (lambda w, k=k: F.lag(column, k).over(w)) for k in range(window)}
    made = windowed(panel, series, {**lagged, "target": lambda w: F.lead(column, horizon).over(w)}, back=window - 1, ahead=horizon)
    made = stage(made.dropna(subset=[*lagged, "target"]), "samples")
    cut = ordered_cut(made, ("ts", "node_id"), 0.72).withColumnRenamed("in_head", "learn")
    cut = ordered_cut(cut, ("ts", "node_id"), 0.8).withColumn("check", F.col("in_head") & ~F.col("learn"))
    return stage(cut, "samples"), list(lagged)


def fit_convolution_forecast(panel: DataFrame, edges: DataFrame, window: int = 12, horizon: int = 1, **settings) -> tuple[Fitted, DataFrame]:
    """A network that reads windows of a node and its neighbours, and ``ts, node_id, occupancy, target, prediction, in_head``."""
    samples, inputs = forecast_samples(panel, window, horizon)
    links = normalised_links(edges, panel)
    model = fit(samples, links, inputs, **settings)
    return model, samples.select("ts", "node_id", "occupancy", "target", "in_head").join(predict(samples, links, model), ["ts", "node_id"])
