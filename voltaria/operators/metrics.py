"""Evaluation metrics as aggregates over prediction tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaria.functions.scalar import ratio
from voltaria.operators.ordered import Series, running_sum


def _r2(error_sq: Column, spread: Column, guard: float) -> Column:
    return F.lit(1.0) - F.try_divide(error_sq, spread + F.lit(guard))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Iterable[str] = (), guard: float = 0.0) -> DataFrame:
    """rmse, mae, r2 and mape (percent, over non-zero actuals; infinite when there are none), per group.

    ``var_pop`` keeps the spread exact for large means without a second pass. A constant actual with an
    exact prediction scores r2 = 1, any other prediction of it 0.
    """
    y, p = F.col(actual), F.col(predicted)
    gap = y - p
    spread = F.var_pop(y) * F.count(y)
    share = F.abs(ratio(gap, y))
    found = df.groupBy(*by).agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        F.sum(gap * gap).alias("_sse"),
        spread.alias("_spread"),
        F.avg(share).alias("_mape"),
        F.count(y).alias("rows"),
    )
    flat = F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = _r2(F.col("_sse"), F.col("_spread"), guard)
    return found.select(
        *by,
        "rows",
        "rmse",
        "mae",
        (r2 if guard else F.when(F.col("_spread") == 0, flat).otherwise(r2)).alias("r2"),
        F.coalesce(F.col("_mape") * 100.0, F.lit(float("inf"))).alias("mape"),
    )


def classification_metrics(df: DataFrame, actual: str, predicted: str, by: Iterable[str] = ()) -> DataFrame:
    """accuracy, precision, recall and f1; 0 where a denominator is empty."""
    y, p = F.col(actual) == 1, F.col(predicted) == 1
    counted = df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )

    def share(top: Column, bottom: Column) -> Column:
        return F.coalesce(ratio(top, bottom), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counted.select(
        *by,
        "tp",
        "fp",
        "fn",
        "tn",
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_points(df: DataFrame, actual: str, score: str, series: Series = Series()) -> DataFrame:
    """``(score, tp, fp, positives, negatives)``: rows scored at least ``score``, per distinct score."""
    by_score = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) != 1).alias("neg")
    )
    falling = by_score.withColumn("_order", -F.col("score"))
    points = running_sum(
        falling,
        Series(by=("_order",), task_rows=series.task_rows, task_bytes=series.task_bytes),
        {"tp": F.col("pos"), "fp": F.col("neg")},
    )
    totals = df.agg(
        F.struct(F.count_if(F.col(actual) == 1).alias("p"), F.count_if(F.col(actual) != 1).alias("n")).alias("t")
    ).scalar()
    return points.select(
        "score", "pos", "neg", "tp", "fp", totals["p"].alias("positives"), totals["n"].alias("negatives")
    )


def roc_curve(df: DataFrame, actual: str, score: str, series: Series = Series()) -> DataFrame:
    """``(threshold, fpr, tpr)`` per distinct score."""
    points = roc_points(df, actual, score, series)
    return points.select(
        F.col("score").alias("threshold"),
        ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )


def roc_auc(df: DataFrame, actual: str, score: str, series: Series = Series()) -> DataFrame:
    """``auc`` by the trapezoid over distinct scores; null when only one class is present.

    Twice the area is a sum of whole numbers, so it does not depend on the order of summation.
    """
    points = roc_points(df, actual, score, series)
    twice = F.col("neg").cast("decimal(38,0)") * (2 * F.col("tp") - F.col("pos"))
    area = points.agg(
        F.sum(twice).cast("double").alias("area"), F.max("positives").alias("p"), F.max("negatives").alias("n")
    )
    return area.select(ratio(F.col("area"), F.lit(2.0) * F.col("p") * F.col("n")).alias("auc"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("rows"))


def gain_pct(new: Column, old: Column) -> Column:
    """Relative gain in percent; from 0 it is infinite for a positive new value, else 0."""
    return F.when(old == 0, F.when(new > 0, float("inf")).otherwise(0.0)).otherwise(F.try_divide(new - old, old) * 100.0)


def uplift_pct(before: Column, after: Column) -> Column:
    """Relative increase in percent; from nothing it is infinite for a positive count, else 0."""
    grown = F.try_divide((after - before).cast("double"), before.cast("double")) * 100.0
    return F.when(before <= 0, F.when(after > 0, float("inf")).otherwise(0.0)).otherwise(grown)


def time_share(charging: Column, total: Column) -> Column:
    """Charging time over available time in [0, 1]; 0 without available time."""
    share = F.least(F.greatest(F.try_divide(charging, total), F.lit(0.0)), F.lit(1.0))
    return F.when(total <= 0, 0.0).otherwise(share)


def revenue_per_unit(revenue: Column, kwh: Column) -> Column:
    """Revenue per kWh; 0 without energy."""
    return F.when(kwh <= 0, 0.0).otherwise(F.try_divide(revenue, kwh))
