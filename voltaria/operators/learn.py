"""Demand and congestion models as Spark ML pipelines."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaria.functions.congestion import congestion_label
from voltaria.functions.scalar import finite
from voltaria.operators import metrics as M
from voltaria.operators.ordered import Series, ordered_cut, running_sum
from voltaria.operators.trees import fit_folds

SEED = 42
TRAIN_SHARE = 0.8
VALIDATION_SHARE = 0.1
# Fixed value: rounds without a lower validation loss after which boosting ends.
PATIENCE = 50

# The order in which equal candidates win.
REGRESSORS = ("boosted", "forest")
CLASSIFIERS = ("forest", "boosted")


def clean_features(df: DataFrame, features: Iterable[str]) -> DataFrame:
    """Features as finite doubles, missing ones 0."""
    return df.withColumns({c: F.coalesce(finite(F.col(c).cast("double")), F.lit(0.0)) for c in features})


def chronological_split(df: DataFrame, by: tuple[str, ...], share: float = TRAIN_SHARE) -> DataFrame:
    """Add ``split``: the first ``floor(rows * share)`` rows in time are ``train``, the rest ``test``."""
    cut = ordered_cut(df, by, share)
    return cut.withColumn("split", F.when(F.col("in_head"), "train").otherwise("test")).drop("in_head")


def validation_split(train: DataFrame, by: tuple[str, ...], share: float = VALIDATION_SHARE) -> DataFrame:
    """Add ``is_validation`` for the latest ``share`` of the training rows."""
    cut = ordered_cut(train, by, 1.0 - share)
    return cut.withColumn("is_validation", ~F.col("in_head")).drop("in_head")


def prepare_regression(df: DataFrame, features: Iterable[str], target: str, by: tuple[str, ...]) -> DataFrame:
    """Cleaned features, ``label`` (missing 0) and the chronological split. Features are named explicitly,
    so that no other future target leaks in."""
    ready = clean_features(df, features).withColumn("label", F.coalesce(finite(F.col(target).cast("double")), F.lit(0.0)))
    return chronological_split(ready, by)


def prepare_classification(
    df: DataFrame, features: Iterable[str], utilization: str, by: tuple[str, ...], threshold: float = 0.8
) -> DataFrame:
    """As above with ``label`` = utilization above the threshold; the utilization itself is not a feature."""
    names = [c for c in features if c != utilization]
    ready = clean_features(df, names).withColumn("label", congestion_label(F.col(utilization), threshold).cast("double"))
    return chronological_split(ready, by)


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """``positives, negatives, ratio`` with ratio = negatives / max(positives, 1)."""
    pos = F.count_if(F.col(label) == 1)
    neg = F.count_if(F.col(label) != 1)
    return df.agg(pos.alias("positives"), neg.alias("negatives"), (neg / F.greatest(pos, F.lit(1))).alias("ratio"))


def with_class_weights(df: DataFrame, method: str = "balanced", label: str = "label") -> DataFrame:
    """Add ``weight``: ``balanced`` gives n / (2 n_class); ``positive`` weighs positives by the class ratio."""
    if method not in ("balanced", "positive"):
        raise ValueError(f"unknown class-weight method {method!r}")
    df = df.withColumn("_counts", class_balance(df, label).select(F.struct("positives", "negatives", "ratio").alias("c")).scalar())
    counts = F.col("_counts")
    positive = F.col(label) == 1
    if method == "positive":
        weight = F.when(positive, counts["ratio"]).otherwise(F.lit(1.0))
    else:
        total = (counts["positives"] + counts["negatives"]).cast("double")
        own = F.when(positive, counts["positives"]).otherwise(counts["negatives"])
        weight = F.try_divide(total, F.lit(2.0) * own)
    return df.withColumn("weight", weight).drop("_counts")


def regressors(trees: int = 20, depth: int = 5) -> Mapping[str, object]:
    common = dict(featuresCol="features", labelCol="label", predictionCol="prediction", seed=SEED, maxDepth=depth)
    return {
        "boosted": GBTRegressor(maxIter=trees, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", **common),
        "forest": RandomForestRegressor(numTrees=trees, subsamplingRate=0.8, featureSubsetStrategy="0.8", **common),
    }


def classifiers(trees: int = 20, depth: int = 5, weighted: bool = True) -> Mapping[str, object]:
    common = dict(featuresCol="features", labelCol="label", predictionCol="prediction", seed=SEED, maxDepth=depth)
    if weighted:
        common["weightCol"] = "weight"
    return {
        "forest": RandomForestClassifier(numTrees=trees, subsamplingRate=0.8, featureSubsetStrategy="0.8", **common),
        "boosted": GBTClassifier(maxIter=trees, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", **common),
    }


def fit_all(
    train: DataFrame, features: Iterable[str], estimators: Mapping[str, object], validation: str | None = None, patience: int = PATIENCE
) -> dict[str, PipelineModel]:
    """One fitted pipeline per candidate.

    ``validation`` names a boolean column of rows to learn nothing from: boosted trees are cut back to the round of
    least loss on them, under the rule of ``best_round``; forests are fitted without them. Candidates are fitted at the
    same time, so that the many short jobs of one leave no core idle that another can use.
    """
    names = list(features)
    rows = train.where(~F.col(validation)) if validation else train

    def fit(estimator) -> PipelineModel:
        fitted = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), estimator]).fit(rows)
        if validation and estimator.hasParam("maxIter"):
            fitted = cut_back(fitted, train.where(validation), patience)
        return fitted

    if not estimators:
        return {}
    with ThreadPoolExecutor(len(estimators)) as pool:
        # Each thread inherits the local properties, such as a job group, of the caller's.
        running = {name: pool.submit(inheritable_thread_target(train.sparkSession)(fit), estimator) for name, estimator in estimators.items()}
        return {name: made.result() for name, made in running.items()}


def best_round(losses: Iterable[float], patience: int = PATIENCE) -> int:
    """Rounds to keep: the first of least loss, among those up to the round that ends a run of ``patience`` rounds
    without a lower one. No losses, or losses that are not numbers, keep the first round."""
    best, kept = float("inf"), 1
    for i, loss in enumerate(losses, 1):
        if loss < best:
            best, kept = loss, i
        elif i - kept >= patience:
            break
    return kept


def round_losses(model: PipelineModel, rows: DataFrame) -> list[float]:
    """Mean loss on rows after each tree of a boosted pipeline; one job, one number a tree."""
    boosted, ready = model.stages[-1], rows
    for step in model.stages[:-1]:
        ready = step.transform(ready)
    if isinstance(boosted, GBTRegressionModel):
        return list(boosted.evaluateEachIteration(ready, "squared"))
    return list(boosted.evaluateEachIteration(ready))


def cut_back(model: PipelineModel, held: DataFrame, patience: int = PATIENCE) -> PipelineModel:
    """A boosted pipeline with the trees up to the best round on held rows; unchanged without such rows.

    Round i depends on the rounds before it only, so the first trees of a long fit are those of a short one.
    """
    if held.isEmpty():
        return model
    boosted = model.stages[-1]
    return PipelineModel([*model.stages[:-1], first_trees(boosted, best_round(round_losses(model, held), patience))])


def first_trees(boosted: GBTRegressionModel | GBTClassificationModel, rounds: int) -> GBTRegressionModel | GBTClassificationModel:
    """A boosted model of the first ``rounds`` trees, with the same settings."""
    java, context = boosted._java_obj, SparkContext._active_spark_context
    trees = java.trees()[:rounds]
    kept = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(context._jvm.double, rounds)
    for i, weight in enumerate(boosted.treeWeights[:rounds]):
        kept[i], weights[i] = trees[i], float(weight)
    if isinstance(boosted, GBTRegressionModel):
        made = context._jvm.org.apache.spark.ml.regression.GBTRegressionModel(boosted.uid, kept, weights, boosted.numFeatures)
    else:
        made = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(boosted.uid, kept, weights, boosted.numFeatures, boosted.numClasses)
    java.copyValues(made, context._jvm.org.apache.spark.ml.param.ParamMap())
    made.set(made.getParam("maxIter"), rounds)
    return type(boosted)._from_java(made)


def hyperparams(models: Mapping[str, PipelineModel]) -> dict[str, str]:
    """The settings of each fitted candidate as JSON; a boosted one's ``maxIter`` is the number of trees it kept."""
    kept = ("maxDepth", "maxIter", "numTrees", "stepSize", "subsamplingRate", "featureSubsetStrategy", "seed")
    out = {}
    for name, model in models.items():
        held = {p.name: v for p, v in model.stages[-1].extractParamMap().items() if p.name in kept}
        out[name] = json.dumps(held, sort_keys=True)
    return out


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and, for a classifier, ``probability`` of the positive class."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        scored = scored.withColumn("probability", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction")


def compare_regressors(models: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Regression metrics per candidate, in one aggregation over all predictions."""
    return M.regression_metrics(_all_predictions(models, test), "label", "prediction", ["model"])


def compare_classifiers(models: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Counts, accuracy, precision, recall, F1 and the area under the ROC curve per candidate."""
    scored = _all_predictions(models, test)
    areas = None
    for name in models:
        area = M.roc_auc(scored.where(F.col("model") == name), "label", "probability").withColumn("model", F.lit(name))
        areas = area if areas is None else areas.unionByName(area)
    return M.classification_metrics(scored, "label", "prediction", ["model"]).join(areas, "model")


def _all_predictions(models: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    out = None
    for name, model in models.items():
        part = predict(model, test)
        part = part.select("label", "prediction", *({"probability"} & set(part.columns))).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def best_model(scores: DataFrame, metric: str, order: Iterable[str]) -> DataFrame:
    """The candidate with the highest metric; the earlier one in ``order`` wins a tie. A few rows at most."""
    rank = F.create_map(*[F.lit(x) for pair in ((n, i) for i, n in enumerate(order)) for x in pair])
    return scores.orderBy(F.desc(metric), rank[F.col("model")]).limit(1)


def feature_importance(spark: SparkSession, model: PipelineModel, features: Iterable[str]) -> DataFrame:
    """``(feature, importance)``, most important first; one row per feature, read from the fitted model."""
    weights = model.stages[-1].featureImportances
    rows = [(name, float(weights[i])) for i, name in enumerate(features)]
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def performance_records(scores: DataFrame, split: str = "test", settings: Mapping[str, str] | None = None) -> DataFrame:
    """Rows for the model-performance log: one per model and metric, with the model's settings."""
    names = [c for c, kind in scores.dtypes if c != "model" and kind == "double"]
    return scores.select(F.col("model").alias("model_name"), *names).unpivot(
        "model_name", names, "metric_name", "metric_value"
    ).withColumns({"dataset_split": F.lit(split), "hyperparams": _setting(settings or {})})


def _setting(settings: Mapping[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for name, value in settings.items():
        out = F.when(F.col("model_name") == name, F.lit(value)).otherwise(out)
    return out


def expanding_folds(df: DataFrame, ts: str = "ts", folds: int = 5) -> DataFrame:
    """Add ``block`` 0..folds: equal shares of the steps in time order.

    Fold k trains on the blocks below k and tests on block k (k = 1..folds). Blocks follow the distinct
    steps, so no step is cut in two.
    """
    steps = df.select(ts).distinct()
    numbered = running_sum(steps, Series(by=(ts,)), {"_i": F.lit(1)})
    total = steps.agg(F.count(F.lit(1))).scalar()
    blocks = numbered.select(ts, F.floor((F.col("_i") - 1) * (folds + 1) / total).cast("int").alias("block"))
    return df.join(blocks, ts)


def cross_validate(df: DataFrame, features: Iterable[str], estimators: Mapping[str, object], folds: int = 5) -> DataFrame:
    """Regression metrics per candidate and fold of :func:`expanding_folds`.

    Candidates that :func:`fit_folds` can grow are fitted to all folds side by side, others fold by fold.
    """
    features = list(features)
    grown, out = fit_folds(df, features, estimators, folds), None
    rest = {name: estimator for name, estimator in estimators.items() if name not in grown}
    for k in range(1, folds + 1):
        fitted = fit_all(df.where(F.col("block") < k), features, rest)
        models = {name: grown[name][k] if name in grown else fitted[name] for name in estimators}
        part = compare_regressors(models, df.where(F.col("block") == k)).withColumn("fold", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return out
