"""Tariff decisions, scenarios and evaluation metrics."""

import math

import pytest
from pyspark.sql import functions as F

from voltaria.config import ACTIONS, TariffConfig
from voltaria.operators import metrics as M
from voltaria.operators import tariff as X
from voltaria.plans import marts
from voltaria.queries.inputs import weekly_decided, weekly_decisions

SF = "/root/testdata/sf0.001"
CFG = TariffConfig()


def rows(spark, *cases):
    """(occupancy, price, volume) at capacity 10."""
    data = [(i, float(o), 10.0, 0.0, float(p), 12.0, 0.5, 0.0, float(v)) for i, (o, p, v) in enumerate(cases)]
    return spark.createDataFrame(data, "i long, " + ", ".join(f"{c} double" for c in X.DECISION_COLUMNS))


def by_hand(price, volume, util, change):
    new = min(max(price * (1 + change), 5.0), 30.0)
    moved = (new - price) / (price + 1e-8)
    sold = max(volume * (1 - 0.3 * moved), 0.0)
    gain = (new * sold - 15.0 * volume) / (15.0 * volume + 1e-8)
    return new, sold, gain - 0.5 * abs(util - 0.7) - 2.0 * max(0.0, util - 0.9) ** 2


def test_outcomes_by_hand(spark):
    df = rows(spark, (9.5, 15, 100), (2, 28, 10), (5, 1, 10))
    for r in X.score_actions(df).collect():
        want = by_hand(r["current_price"], r["volume"], r["utilization"], r["change"])
        assert (r["new_price"], r["new_volume"], r["reward"]) == pytest.approx(want)
    assert X.score_actions(df).count() == 3 * len(ACTIONS)


def test_price_below_the_minimum_jumps(spark):
    first = X.rule_actions(rows(spark, (5, 1, 10))).first()
    assert first["new_price"] == 5.0 and first["new_volume"] == 0.0


def test_best_action_is_the_highest_reward(spark):
    df = rows(spark, (5, 15, 100), (5, 30, 100), (5, 28, 100))
    best = {r["i"]: r["name"] for r in X.best_actions(df).collect()}
    # At the upper bound every increase is the same, so the smallest change wins.
    assert best == {0: "+30%", 1: "0%", 2: "+10%"}


def test_best_is_never_below_the_rule(spark):
    decisions = weekly_decisions(spark, SF)
    best = X.best_actions(decisions).select("ts", "station_id", F.col("reward").alias("b"))
    rule = X.rule_actions(decisions).select("ts", "station_id", F.col("reward").alias("r"))
    joined = best.join(rule, ["ts", "station_id"])
    assert joined.where(F.col("b") < F.col("r") - 1e-9).count() == 0
    assert joined.count() == decisions.count()


def test_rule(spark):
    names = [r["name"] for r in X.rule_actions(rows(spark, (9, 15, 1), (8, 15, 1), (3, 15, 1), (2, 15, 1))).orderBy("i").collect()]
    assert names == ["+30%", "0%", "0%", "-20%"]


def test_missing_columns(spark):
    with pytest.raises(ValueError):
        X.add_observation(rows(spark, (1, 1, 1)).drop("volume"))


def test_scenarios_and_comparison(spark):
    df = rows(spark, (9, 15, 10), (1, 15, 10))
    fixed, dynamic = X.fixed_scenario(df), X.dynamic_scenario(X.rule_actions(df))
    f = fixed.first()
    assert (f["total_revenue"], f["congestion_rate"], f["off_peak_rate"]) == (300.0, 0.5, 0.5)
    table = {r["metric"]: r for r in X.compare_scenarios(fixed, dynamic).collect()}
    surge, discount = 19.5 * 10 * (1 - 0.3 * 0.3), 12.0 * 10 * (1 + 0.3 * 0.2)
    assert table["total_revenue"]["dynamic"] == pytest.approx(surge + discount)
    assert table["congestion_rate"]["change"] == pytest.approx(0.0)
    assert table["demand_shift_pp"]["fixed"] is None
    assert X.fixed_scenario(df, price=10.0).first()["total_revenue"] == 200.0


def test_waterfall_adds_up(spark):
    decided = weekly_decided(spark, SF)
    parts = marts.revenue_waterfall(decided).agg(F.sum("revenue_delta")).first()[0]
    total = decided.agg(F.sum("revenue_new") - F.sum("revenue_baseline")).first()[0]
    assert parts == pytest.approx(total)


def test_action_distribution_keeps_zeros(spark):
    counts = {r["name"]: r["rows"] for r in X.action_distribution(X.rule_actions(rows(spark, (9, 15, 1)))).collect()}
    assert len(counts) == 6 and sum(counts.values()) == 1


def test_recommended_price(spark):
    df = spark.createDataFrame([(0.4, 0.3), (1.0, 0.3), (0.0, -0.2)], "p double, c double")
    got = [r[0] for r in df.select(X.recommended_price(F.col("p"), F.col("c"))).collect()]
    assert got == pytest.approx([19.5, 30.0, 5.0])


def test_regression_metrics(spark):
    df = spark.createDataFrame([(3.0, 2.5), (-0.5, 0.0), (2.0, 2.0), (7.0, 8.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    assert (round(r["rmse"], 4), r["mae"]) == (0.6124, 0.5)
    assert r["r2"] == pytest.approx(1 - 1.5 / 29.1875)
    zero = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0)], "y double, p double")
    z = M.regression_metrics(zero, "y", "p").first()
    assert math.isinf(z["mape"]) and z["r2"] == 0.0


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (0, 0), (0, 0), (0, 0)], "y int, p int")
    r = M.classification_metrics(df, "y", "p").first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == pytest.approx((5 / 6, 1.0, 2 / 3, 0.8))
    none = spark.createDataFrame([(0, 0)], "y int, p int")
    assert M.classification_metrics(none, "y", "p").first()["f1"] == 0.0


@pytest.mark.parametrize("limits", [{}, {"task_rows": 20, "task_bytes": 0}], ids=["plain", "split"])
def test_auc_against_all_pairs(spark, limits):
    import random

    from voltaria.operators.ordered import Series

    rng = random.Random(3)
    data = [(rng.random() < 0.4, rng.randrange(40) / 40) for _ in range(300)]
    df = spark.createDataFrame([(int(y), s) for y, s in data], "y int, s double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.roc_auc(df, "y", "s", Series(**limits)).first()[0] == pytest.approx(want)
    assert M.roc_auc(df.where("y = 1"), "y", "s").first()[0] is None


def test_kpi_edge_cases(spark):
    df = spark.createDataFrame([(2477000.0, 2090000.0), (1.0, 0.0), (0.0, 0.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    gains = [r[0] for r in df.select(M.gain_pct(a, b)).collect()]
    assert gains[0] == pytest.approx(18.5, abs=0.05) and math.isinf(gains[1]) and gains[2] == 0.0
    assert df.limit(1).select(M.uplift_pct(F.lit(100), F.lit(131))).first()[0] == pytest.approx(31.0)
    assert df.limit(1).select(M.revenue_per_unit(F.lit(16820.0), F.lit(1000.0))).first()[0] == 16.82
    assert [r[0] for r in df.select(M.time_share(a, b)).collect()] == [1.0, 0.0, 0.0]
