"""Boosted fits that end by patience."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from voltaria.operators import learn as L
from voltaria.operators import trees as G
from voltaria.session import scratch_path, stage


def test_best_round():
    assert L.best_round([3, 2, 1, 2, 3]) == 3
    assert L.best_round([3, 2, 2, 2.5, 1], patience=2) == 2  # the lower loss comes after two rounds without one
    assert L.best_round([3, 2, 2, 2.5, 1], patience=4) == 5
    assert L.best_round([5, 4, 3, 2, 1], patience=1) == 5
    assert L.best_round([]) == 1 and L.best_round([float("nan")] * 3) == 1
    assert L.best_round([2.0, *[3.0] * 49, 1.0]) == 51 and L.best_round([2.0, *[3.0] * 50, 1.0]) == 1


@pytest.fixture(scope="module")
def noisy(spark):
    """A plain signal under much noise: late trees learn the noise."""
    rows = spark.range(0, 400, 1, 2).select("id", (F.rand(3) * 6).alias("x"), F.rand(4).alias("u"), (F.col("id") % 3 == 0).alias("v"))
    return stage(rows.withColumn("label", F.sin("x") + F.randn(5) * 0.8), "noisy")


def test_regressor_is_cut_at_its_best_round(spark, noisy):
    estimator = {"boosted": L.regressors(trees=16, depth=7)["boosted"]}
    learned, held = noisy.where("not v"), noisy.where("v")
    full = L.fit_all(learned, ["x", "u"], estimator)["boosted"]
    losses = L.round_losses(full, held)
    assert len(losses) == 16 and min(losses) < losses[-1]
    cut = L.fit_all(noisy, ["x", "u"], estimator, "v")["boosted"]
    rounds = L.best_round(losses)
    assert len(cut.stages[-1].treeWeights) == rounds < 16
    assert f'"maxIter": {rounds}' in L.hyperparams({"boosted": cut})["boosted"]
    error = L.predict(cut, held).agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]
    assert error == pytest.approx(min(losses))
    path = scratch_path(spark, "cut")
    L.save_model(cut, path)
    assert len(PipelineModel.load(path).stages[-1].treeWeights) == rounds
    impatient = L.fit_all(noisy, ["x", "u"], estimator, "v", patience=1)["boosted"]
    assert len(impatient.stages[-1].treeWeights) == L.best_round(losses, 1)


def test_classifier_is_cut_and_empty_validation_changes_nothing(noisy):
    rows = noisy.withColumn("label", (F.col("label") > 0).cast("double"))
    estimator = {"boosted": L.classifiers(trees=8, depth=7, weighted=False)["boosted"]}
    full = L.fit_all(rows.where("not v"), ["x", "u"], estimator)["boosted"]
    cut = L.fit_all(rows, ["x", "u"], estimator, "v")["boosted"]
    assert len(cut.stages[-1].treeWeights) == L.best_round(L.round_losses(full, rows.where("v")))
    assert L.predict(cut, rows).where("probability between 0 and 1").count() == rows.count()
    assert L.cut_back(full, rows.where("false")) is full


def test_candidates_are_fitted_at_the_same_time(spark):
    """Each of two fits waits for the other; the models come back under their names."""
    import threading

    from pyspark.ml import Estimator
    from pyspark.ml.feature import VectorAssembler

    met = threading.Barrier(2, timeout=60)

    class Waiting(Estimator):
        def _fit(self, rows):
            met.wait()
            return VectorAssembler(inputCols=["x"], outputCol=f"seen_{rows.count()}")

    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "x double, label double")
    models = L.fit_all(rows, ["x"], {"one": Waiting(), "other": Waiting()})
    assert list(models) == ["one", "other"] and all(m.stages[-1].getOutputCol() == "seen_2" for m in models.values())


@pytest.fixture(scope="module")
def blocks(spark):
    """Rows of six blocks over several partitions, with ties, zeros, fractions and a feature that is always 0."""
    rows = spark.range(0, 30_000, 1, 3).select(
        (F.col("id") % 6).cast("int").alias("block"),
        F.floor(F.rand(1) * 40).cast("double").alias("a"),
        F.when(F.rand(2) < 0.7, F.rand(3) * 10 - 3).otherwise(0.0).alias("b"),
        (F.col("id") % 3).cast("double").alias("c"),
        F.lit(0.0).alias("d"),
    )
    return stage(rows.withColumn("label", F.rint(F.col("a") * F.abs("b") + F.randn(5) * 8)), "blocks")


def test_trees_of_all_folds_are_those_of_spark_ml(blocks):
    features, estimators = ["a", "b", "c", "d"], L.regressors(trees=6, depth=4)
    grown = G.fit_folds(blocks, features, estimators)
    for k in (1, 5):
        fitted = L.fit_all(blocks.where(F.col("block") < k), features, estimators)
        held = blocks.where(F.col("block") == k).select(*features, "label")
        for name, model in fitted.items():
            ours, theirs = (m[name].stages[-1] for m in ({name: grown[name][k]}, fitted))
            assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees]
            both = L.predict(grown[name][k], held).withColumnRenamed("prediction", "ours")
            both = model.transform(both).agg(F.max(F.abs(F.col("ours") - F.col("prediction"))), F.stddev("prediction")).first()
            assert both[0] < 1e-9 < both[1]


def test_jobs_of_cross_validation_do_not_grow_with_folds(spark, blocks):
    """All folds go through the same passes: more folds are a few more jobs, and not another fit's."""

    def jobs(folds: int) -> int:
        group = f"folds-{folds}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            L.cross_validate(blocks, ["a", "b"], L.regressors(trees=3, depth=3), folds)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(5) < 1.5 * jobs(1)


def test_estimators_that_are_not_grown_are_fitted_fold_by_fold(blocks):
    """Another kind of regressor, and one whose setting is not covered, still come back for each fold."""
    from pyspark.ml.regression import LinearRegression

    other = {"linear": LinearRegression(), "absolute": L.regressors(trees=2, depth=2)["boosted"].copy().setLossType("absolute")}
    assert not G.fit_folds(blocks, ["a", "b"], other)
    scores = L.cross_validate(blocks, ["a", "b"], other, 2).collect()
    assert sorted((r.model, r.fold) for r in scores) == [("absolute", 1), ("absolute", 2), ("linear", 1), ("linear", 2)]
