"""Queries over model preparation, training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.config import DEFAULT_LAGS
from voltaria.functions.demand import add_lags, add_row_demand, lag_columns
from voltaria.operators import learn as L
from voltaria.operators.ordered import windowed
from voltaria.queries.registry import R, query
from voltaria.queries.views_sql import clip_util, with_views
from voltaria.schemas import MODEL_PERFORMANCE
from voltaria.session import scratch_path, stage
from voltaria.sources import driver_views as V
from voltaria.sources import metric_log as ML

ORDER = ("ts", "station_id")
DEMAND_FEATURES = ["occupancy", "price", "capacity", "volume", "volume_lag_1", "volume_lag_3", "volume_lag_6", "volume_lag_12"]
CONGESTION_FEATURES = ["volume_lag_1", "price_lag_1", "occupancy_lag_1", "occupancy_lag_3", "capacity"]


def demand_table(spark: SparkSession, sf: str) -> DataFrame:
    """Lagged volumes and the volume of the next week."""
    ahead = {"future_volume": lambda w: F.lead("volume").over(w)}
    columns = {**lag_columns(["volume"], DEFAULT_LAGS), **ahead}
    return windowed(V.station_panel(spark, sf), V.STATION_SERIES, columns, back=max(DEFAULT_LAGS), ahead=1)


def congestion_table(spark: SparkSession, sf: str) -> DataFrame:
    """Earlier weeks as features, so that the label is not among them."""
    panel = add_row_demand(V.station_panel(spark, sf))
    return add_lags(panel, V.STATION_SERIES, ["volume", "price", "occupancy"], (1, 3))


def _demand(spark: SparkSession, sf: str) -> DataFrame:
    # Every fit and score below reads the prepared table, so it is written once.
    return stage(L.prepare_regression(demand_table(spark, sf), DEMAND_FEATURES, "future_volume", ORDER), "demand")


def _congestion(spark: SparkSession, sf: str) -> DataFrame:
    prepared = L.prepare_classification(congestion_table(spark, sf), CONGESTION_FEATURES, "utilization_rate", ORDER)
    return stage(prepared, "congestion")


_RANKED = "row_number() OVER (ORDER BY ts, station_id) AS rn, count(*) OVER () AS n"


@query(
    "regression_table",
    with_views(
        f"""SELECT ts, station_id, coalesce(lag(volume, 12) OVER w, 0) AS volume_lag_12, coalesce(lead(volume) OVER w, 0) AS label,
          CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
        FROM (SELECT *, {_RANKED} FROM station_panel) WINDOW w AS (PARTITION BY station_id ORDER BY ts)""",
        "station_panel",
    ),
)
def regression_table(spark: SparkSession, sf: str) -> DataFrame:
    made = L.prepare_regression(demand_table(spark, sf), DEMAND_FEATURES, "future_volume", ORDER)
    return made.select("ts", "station_id", "volume_lag_12", "label", "split")


@query(
    "classification_table",
    with_views(
        f"""SELECT ts, station_id, coalesce(lag(occupancy, 3) OVER w, 0) AS occupancy_lag_3,
          CASE WHEN {clip_util()} > 0.8::DOUBLE THEN 1.0::DOUBLE ELSE 0 END AS label,
          CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
        FROM (SELECT *, {_RANKED} FROM station_panel) WINDOW w AS (PARTITION BY station_id ORDER BY ts)""",
        "station_panel",
    ),
)
def classification_table(spark: SparkSession, sf: str) -> DataFrame:
    made = L.prepare_classification(congestion_table(spark, sf), CONGESTION_FEATURES, "utilization_rate", ORDER)
    return made.select("ts", "station_id", "occupancy_lag_3", "label", "split")


@query(
    "validation_split",
    with_views(
        """SELECT ts, station_id, rn > floor(m * 0.9::DOUBLE) AS is_validation
        FROM (SELECT *, floor(n * 0.8::DOUBLE) AS m FROM (SELECT ts, station_id, row_number() OVER (ORDER BY ts, station_id) AS rn, count(*) OVER () AS n FROM station_panel))
        WHERE rn <= m""",
        "station_panel",
    ),
)
def validation_split(spark: SparkSession, sf: str) -> DataFrame:
    """The last tenth of the training rows."""
    split = L.chronological_split(V.station_panel(spark, sf).select(*ORDER), ORDER)
    train = stage(split.where(F.col("split") == "train"), "train")
    return L.validation_split(train, ORDER).drop("split")


_LABELS = f"(SELECT ts, station_id, CASE WHEN {clip_util()} > 0.8::DOUBLE THEN 1.0::DOUBLE ELSE 0 END AS label FROM station_panel)"
_COUNTS = f"(SELECT count(CASE WHEN label = 1 THEN 1 END) AS p, count(CASE WHEN label <> 1 THEN 1 END) AS q FROM {_LABELS})"


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = add_row_demand(V.station_panel(spark, sf))
    return rows.select("ts", "station_id", (F.col("utilization_rate") > 0.8).cast("double").alias("label"))


@query("class_balance", with_views(f"SELECT p AS positives, q AS negatives, q / greatest(p, 1) AS ratio FROM {_COUNTS}", "station_panel"))
def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return L.class_balance(_labels(spark, sf))


@query(
    "class_weights",
    with_views(
        f"SELECT ts, station_id, label, CAST(p + q AS DOUBLE) / (2.0::DOUBLE * CASE WHEN label = 1 THEN p ELSE q END) AS weight FROM {_LABELS}, {_COUNTS}",
        "station_panel",
    ),
)
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return L.with_class_weights(_labels(spark, sf))


@query(
    "class_weights_positive",
    with_views(
        f"SELECT ts, station_id, label, CASE WHEN label = 1 THEN q / greatest(p, 1) ELSE 1.0::DOUBLE END AS weight FROM {_LABELS}, {_COUNTS}",
        "station_panel",
    ),
)
def class_weights_positive(spark: SparkSession, sf: str) -> DataFrame:
    return L.with_class_weights(_labels(spark, sf), "positive")


def _parts(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training rows with their validation mark, and test rows."""
    train = stage(L.validation_split(prepared.where(F.col("split") == "train"), ORDER), "train")
    return train, prepared.where(F.col("split") == "test")


def _fitted(train: DataFrame, features: list[str], candidates: dict) -> dict:
    return L.fit_all(train, features, candidates, "is_validation")


def _selected(models: dict, train: DataFrame, compare, metric: str, order: tuple[str, ...]):
    """The candidate that does best on the validation rows."""
    held = train.where("is_validation")
    return models[L.best_model(compare(models, held), metric, order).first()["model"]]


@query("demand_models")
def demand_models(spark: SparkSession, sf: str) -> DataFrame:
    """Test metrics of both regressors, appended to the performance log and read back."""
    train, test = _parts(_demand(spark, sf))
    models = _fitted(train, DEMAND_FEATURES, L.regressors())
    path = scratch_path(spark, "performance")
    ML.append_log(L.performance_records(L.compare_regressors(models, test), settings=L.hyperparams(models)), path, MODEL_PERFORMANCE)
    return ML.read_log(spark, path, MODEL_PERFORMANCE, limit=None).drop("timestamp")


@query("best_demand_model")
def best_demand_model(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _parts(_demand(spark, sf))
    models = _fitted(train, DEMAND_FEATURES, L.regressors())
    return L.best_model(L.compare_regressors(models, test), "r2", L.REGRESSORS)


@query("best_congestion_model")
def best_congestion_model(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _parts(_congestion(spark, sf))
    models = _fitted(L.with_class_weights(train), CONGESTION_FEATURES, L.classifiers())
    return L.best_model(L.compare_classifiers(models, test), "f1", L.CLASSIFIERS)


@query("demand_feature_importance")
def demand_feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _parts(_demand(spark, sf))
    models = _fitted(train, DEMAND_FEATURES, L.regressors())
    model = _selected(models, train, L.compare_regressors, "r2", L.REGRESSORS)
    return L.feature_importance(spark, model, DEMAND_FEATURES)


@query("congestion_predictions")
def congestion_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Probability and class of the test rows from a model that was saved and loaded."""
    train, test = _parts(_congestion(spark, sf))
    weighted = L.with_class_weights(train)
    models = _fitted(weighted, CONGESTION_FEATURES, L.classifiers())
    model = _selected(models, train, L.compare_classifiers, "f1", L.CLASSIFIERS)
    path = scratch_path(spark, "model")
    L.save_model(model, path)
    return L.predict(L.load_model(path), test).select("ts", "station_id", "label", "prediction", "probability")


@query(
    "time_series_folds",
    with_views(
        """SELECT p.ts, station_id, CAST(floor((i - 1) * 6 / n) AS INTEGER) AS block FROM station_panel p
        JOIN (SELECT ts, row_number() OVER (ORDER BY ts) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT ts FROM station_panel)) s ON p.ts = s.ts""",
        "station_panel",
    ),
)
def time_series_folds(spark: SparkSession, sf: str) -> DataFrame:
    return L.expanding_folds(V.station_panel(spark, sf).select("ts", "station_id"))


@query("cross_validation")
def cross_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of both regressors on five expanding folds."""
    prepared = L.clean_features(demand_table(spark, sf), DEMAND_FEATURES).withColumn(
        "label", F.coalesce("future_volume", F.lit(0.0))
    )
    folds = stage(L.expanding_folds(prepared, folds=5), "folds")
    return L.cross_validate(folds, DEMAND_FEATURES, L.regressors(), 5)


_PARTS = """SELECT count(*) FILTER (rn <= floor(floor(n * 0.8::DOUBLE) * 0.9::DOUBLE)) AS rows_train,
      count(*) FILTER (rn > floor(floor(n * 0.8::DOUBLE) * 0.9::DOUBLE) AND rn <= floor(n * 0.8::DOUBLE)) AS rows_validation,
      count(*) FILTER (rn > floor(n * 0.8::DOUBLE)) AS rows_test
    FROM (SELECT row_number() OVER (ORDER BY ts, station_id) AS rn, count(*) OVER () AS n FROM station_panel)"""


def _sizes(train: DataFrame, test: DataFrame) -> DataFrame:
    held = train.agg(F.count_if(~F.col("is_validation")).alias("rows_train"), F.count_if("is_validation").alias("rows_validation"))
    return held.crossJoin(test.agg(F.count("*").alias("rows_test")))  # one row each


@query(
    "demand_model_facts",
    with_views(
        f"""SELECT model, rows_train, rows_validation, rows_test, true AS below_mean_error, true AS shares_sum_to_one, true AS rounds_kept
        FROM (SELECT unnest(['boosted', 'forest']) AS model), ({_PARTS})""",
        "station_panel",
    ),
)
def demand_model_facts(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of both regressors whatever the data: sizes of the parts, an error on the rows learned from that is
    below that of their mean, importances that sum to 1, and a number of rounds between 1 and those asked for."""
    train, test = _parts(_demand(spark, sf))
    models = _fitted(train, DEMAND_FEATURES, L.regressors())
    scores = L.compare_regressors(models, train.where("not is_validation")).select("model", (F.col("r2") >= 0).alias("below_mean_error"))
    facts = [
        (name, bool(abs(sum(model.stages[-1].featureImportances.toArray()) - 1) < 1e-9), 1 <= len(model.stages[-1].treeWeights) <= 20) for name, model in models.items()
    ]
    known = spark.createDataFrame(facts, "model string, shares_sum_to_one boolean, rounds_kept boolean")
    out = scores.join(known, "model").crossJoin(_sizes(train, test))
    return out.select("model", "rows_train", "rows_validation", "rows_test", "below_mean_error", "shares_sum_to_one", "rounds_kept")


@query(
    "congestion_model_facts",
    with_views(
        f"""SELECT model, rows_train, rows_validation, rows_test, rows_test AS probabilities, rows_test AS classes, 0 AS changed_by_loading
        FROM (SELECT unnest(['boosted', 'forest']) AS model), ({_PARTS})""",
        "station_panel",
    ),
)
def congestion_model_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Of both classifiers: test rows with a probability in 0..1, with a class that follows from it, and with another
    probability once the model was saved and loaded."""
    train, test = _parts(_congestion(spark, sf))
    models = _fitted(L.with_class_weights(train), CONGESTION_FEATURES, L.classifiers())
    out = None
    for name, model in models.items():
        path = scratch_path(spark, "model")
        L.save_model(model, path)
        again = L.predict(L.load_model(path), test).select(*ORDER, F.col("probability").alias("again"))
        p, positive = F.col("probability"), F.col("prediction") == 1
        facts = L.predict(model, test).join(again, list(ORDER)).agg(
            F.count_if(p.between(0, 1)).alias("probabilities"),
            F.count_if(F.when(p == 0.5, F.lit(True)).otherwise(positive == (p > 0.5))).alias("classes"),
            F.count_if(F.abs(p - F.col("again")) > 1e-12).cast("int").alias("changed_by_loading"),
        )
        part = facts.withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.crossJoin(_sizes(train, test)).select("model", "rows_train", "rows_validation", "rows_test", "probabilities", "classes", "changed_by_loading")


_BLOCKS = """(SELECT p.ts, CAST(floor((i - 1) * 6 / n) AS INTEGER) AS block FROM station_panel p
      JOIN (SELECT ts, row_number() OVER (ORDER BY ts) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT ts FROM station_panel)) s ON p.ts = s.ts)"""


@query(
    "cross_validation_parts",
    with_views(
        f"""SELECT fold, count(*) FILTER (block < fold) AS rows_train, count(*) FILTER (block = fold) AS rows_test,
          max(CASE WHEN block < fold THEN ts END) AS last_train, min(CASE WHEN block = fold THEN ts END) AS first_test
        FROM {_BLOCKS}, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS fold) WHERE block <= fold GROUP BY fold""",
        "station_panel",
    ),
)
def cross_validation_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows on both sides of each fold, and the steps at which they meet."""
    blocks = L.expanding_folds(V.station_panel(spark, sf).select("ts", "station_id"))
    sides = blocks.select("ts", "block", F.explode(F.sequence(F.greatest("block", F.lit(1)), F.lit(5))).alias("fold"))
    learned = F.col("block") < F.col("fold")
    return sides.groupBy("fold").agg(
        F.count_if(learned).alias("rows_train"),
        F.count_if(~learned).alias("rows_test"),
        F.max(F.when(learned, F.col("ts"))).alias("last_train"),
        F.min(F.when(~learned, F.col("ts"))).alias("first_test"),
    )
