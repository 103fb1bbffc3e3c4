"""Graph windows and k-hop propagation for district forecasts."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaria.functions.temporal import hour_angle, weekday_share
from voltaria.operators.edges import met
from voltaria.operators.ordered import Series, ordered_cut, windowed
from voltaria.session import broadcast_if_small, stage


def weighted_edges(edges: DataFrame, epsilon: float = 1e-3) -> DataFrame:
    """Edge list with weight ``1 / (dist + epsilon)`` scaled so that the largest weight is 1."""
    raw = F.try_divide(F.lit(1.0), F.coalesce(F.col("dist"), F.lit(0.0)) + F.lit(epsilon))
    top = edges.agg(F.max(raw)).scalar()
    return edges.withColumn("weight", F.try_divide(raw, top))


def graph_windows(
    panel: DataFrame,
    window: int = 12,
    horizon: int = 1,
    target: str = "occupancy",
    temporal: bool = True,
    key: str = "node_id",
) -> DataFrame:
    """One sample per node and step with ``window`` past values and a target ``horizon`` steps ahead.

    ``features`` holds the occupancies, the volumes and, with ``temporal``, sine and cosine of the hour
    and the scaled weekday: ``2 * window + 3`` numbers. Steps without a full window or target are left out.
    """
    if target not in ("occupancy", "volume"):
        raise ValueError(f"target must be 'occupancy' or 'volume', not {target!r}")
    made = windowed(
        panel,
        Series(keys=(key,), by=("ts",)),
        {
            "_occ": lambda w: F.collect_list(F.coalesce("occupancy", F.lit(0.0))).over(w.rowsBetween(1 - window, 0)),
            "_vol": lambda w: F.collect_list(F.coalesce("volume", F.lit(0.0))).over(w.rowsBetween(1 - window, 0)),
            "target": lambda w: F.lead(target, horizon).over(w),
        },
        back=window - 1,
        ahead=horizon,
    )
    angle = hour_angle(F.hour("ts"))
    clock = F.array(F.sin(angle), F.cos(angle), weekday_share(F.col("ts")))
    parts = [F.col("_occ"), F.col("_vol"), *([clock] if temporal else [])]
    return made.where((F.size("_occ") == window) & F.col("target").isNotNull()).select(
        "ts", key, F.concat(*parts).alias("features"), "target"
    )


def feature_count(window: int, temporal: bool = True) -> int:
    return 2 * window + (3 if temporal else 0)


def normalised_links(edges: DataFrame, panel: DataFrame) -> DataFrame:
    """``src, dst, a``: the symmetric normalised adjacency, with a self loop for every node of the panel."""
    links = edges.where(F.col("src") != F.col("dst")).select("src", "dst")
    loops = panel.select(F.col("node_id").alias("src")).distinct().withColumn("dst", F.col("src"))
    full = links.unionByName(loops)
    degree = full.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).cast("double").alias("d"))
    scaled = (
        full.join(degree.select(F.col("node").alias("src"), F.col("d").alias("ds")), "src")
        .join(degree.select(F.col("node").alias("dst"), F.col("d").alias("dd")), "dst")
        .select("src", "dst", (F.lit(1.0) / F.sqrt(F.col("ds") * F.col("dd"))).alias("a"))
    )
    # Every hop and epoch reads the same links; they are found once.
    return broadcast_if_small(stage(scaled, "links"))


def propagated(panel: DataFrame, edges: DataFrame, column: str, hops: int = 2) -> DataFrame:
    """``{column}_hop_{k}``: the value smoothed k times by the symmetric normalised adjacency with self loops.

    One edge join and one aggregation per hop (simple graph convolution: the learned part comes after);
    ``(ts, node_id)`` is unique. Every third hop is written to the shared folder to keep the plan short.
    """
    scaled = normalised_links(edges, panel)
    own = F.col("src") == F.col("dst")
    current = panel.select("ts", "node_id", column)
    carried = [column]
    for hop in range(1, hops + 1):
        # The self loop brings a node's own values along and shows that it has a row in this step.
        current = (
            met(current.withColumnRenamed("node_id", "dst"), scaled, "dst")
            .groupBy("ts", F.col("src").alias("node_id"))
            .agg(
                F.bool_or(own).alias("_present"),
                *[F.max(F.when(own, F.col(c))).alias(c) for c in carried],
                F.sum(F.col(carried[-1]) * F.col("a")).alias(f"{column}_hop_{hop}"),
            )
            .where("_present")
            .drop("_present")
        )
        carried.append(f"{column}_hop_{hop}")
        if hop % 3 == 0:
            current = stage(current, "hop")
    rest = [c for c in panel.columns if c not in ("ts", "node_id", column)]
    return panel.select("ts", "node_id", *rest).join(current, ["ts", "node_id"]) if rest else current


def fit_graph_forecast(panel: DataFrame, edges: DataFrame, hops: int = 3, window: int = 12, horizon: int = 1):
    """Linear head on k-hop smoothed occupancy windows, fitted on the first 80 % of the samples in time.

    Returns the model and the predictions of the others.
    """
    smooth = propagated(panel, edges, "occupancy", hops)
    series = Series(keys=("node_id",), by=("ts",))
    signals = ["occupancy", *[f"occupancy_hop_{k}" for k in range(1, hops + 1)]]
    lagged = {f"{c}_b{k}": (lambda w, c=c, k=k: F.lag(c, k).over(w)) for c in signals for k in range(window)}
    made = windowed(
        smooth,
        series,
        {**lagged, "target": lambda w: F.lead("occupancy", horizon).over(w)},
        back=window - 1,
        ahead=horizon,
    ).dropna(subset=[*lagged, "target"])
    # Read by the fit and by the predictions.
    samples = stage(ordered_cut(made, ("ts", "node_id"), 0.8), "samples")
    ready = VectorAssembler(inputCols=list(lagged), outputCol="x").transform(samples)
    head = LinearRegression(featuresCol="x", labelCol="target", predictionCol="prediction", regParam=0.01)
    model = head.fit(ready.where("in_head"))
    return model, model.transform(ready.where("not in_head")).select("ts", "node_id", "occupancy", "target", "prediction")


def as_vectors(samples: DataFrame) -> DataFrame:
    """Samples with ``features`` as a vector, for Spark ML estimators."""
    return samples.withColumn("features", array_to_vector("features"))
