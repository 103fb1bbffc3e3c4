"""Row-local features and row-order features on small literal cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltaria.functions import congestion as N
from voltaria.functions import demand as D
from voltaria.functions import pricing as P
from voltaria.functions import temporal as T
from voltaria.functions.scalar import clip, finite, parse_timestamp, ratio, timestamp_from_parts
from voltaria.operators.ordered import Series

ROWS = Series(keys=("k",), by=("i",))


def series(spark, *values, name="x", kind="double"):
    return spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], f"k string, i long, {name} {kind}")


def column(df, expr, order="i"):
    return [r[0] for r in df.orderBy(order).select(expr).collect()]


def test_utilization(spark):
    df = spark.createDataFrame(
        [(0, 5.0, 20.0), (1, 10.0, 20.0), (2, 25.0, 20.0), (3, -5.0, 20.0), (4, 3.0, 0.0), (5, None, 20.0)],
        "i long, occupancy double, capacity double",
    )
    assert column(df, D.utilization_rate(F.col("occupancy"), F.col("capacity"))) == [0.25, 0.5, 1.0, 0.0, 0.0, 0.0]


def test_revenue_and_per_kwh(spark):
    df = spark.createDataFrame([(0, 10.0, 15.0), (1, 20.0, 12.0), (2, None, 18.0), (3, 0.0, 3.0)], "i long, v double, p double")
    revenue = D.revenue(F.col("v"), F.col("p"))
    assert column(df, revenue) == [150.0, 240.0, 0.0, 0.0]
    assert column(df, D.revenue_per_kwh(revenue, F.col("v"))) == [15.0, 12.0, None, None]


def test_charging_duration(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    df = spark.createDataFrame(
        [(0, t(1), t(3), t(2)), (1, t(1), t(3), None), (2, t(5), t(6), t(4))],
        "i long, connectionTime timestamp_ntz, disconnectTime timestamp_ntz, doneChargingTime timestamp_ntz",
    )
    assert column(df, D.charging_duration_hours(df)) == [1.0, None, None]
    assert column(df, D.charging_duration_hours(df, fallback=True)) == [1.0, 2.0, None]
    plain = df.drop("doneChargingTime")
    assert column(plain, D.charging_duration_hours(plain)) == [2.0, 2.0, 1.0]
    with pytest.raises(KeyError):
        D.charging_duration_hours(df.drop("connectionTime"))


def test_lag_rolling_future(spark):
    df = series(spark, 1.0, 2.0, 3.0, 4.0, 5.0)
    lagged = D.add_lags(df, ROWS, ["x", "missing"], [1, 2])
    assert column(lagged, "x_lag_1") == [None, 1.0, 2.0, 3.0, 4.0]
    assert column(lagged, "x_lag_2") == [None, None, 1.0, 2.0, 3.0]
    rolled = D.add_rolling(df, ROWS, ["x"], [3])
    assert column(rolled, "x_rolling_mean_3") == [1.0, 1.5, 2.0, 3.0, 4.0]
    assert column(rolled, "x_rolling_std_3") == pytest.approx([None, 0.7071067811865476, 1.0, 1.0, 1.0])
    future = D.add_future_targets(series(spark, 10.0, 20.0, 30.0, 40.0, 50.0), ROWS, ["x"])
    assert column(future, "future_x") == [20.0, 30.0, 40.0, 50.0, None]


def test_demand_features_follow_the_columns_present(spark):
    df = series(spark, 1.0, 2.0, name="volume")
    out = D.add_demand_features(df, ROWS, lags=[1], windows=[2])
    assert {"volume_lag_1", "volume_rolling_mean_2"} <= set(out.columns)
    assert not {"utilization_rate", "revenue"} & set(out.columns)


def test_congestion(spark):
    df = spark.createDataFrame(
        [(0, 15.0, 20.0, 5.0), (1, 20.0, 20.0, 0.0), (2, 25.0, 20.0, 5.0)], "i long, occupancy double, capacity double, area double"
    )
    out = N.add_congestion_features(df)
    assert column(out, "queue_length_proxy") == [0.0, 0.0, 5.0]
    assert column(out, "occupancy_density") == [3.0, None, 5.0]
    assert column(out, "congestion_label") == [0, 1, 1]
    score = column(out, "congestion_score")
    assert score == pytest.approx([0.2 * 0.6, 0.5, 1.0])
    assert column(N.add_congestion_features(df.drop("area")), "occupancy_density") == [0.0, 0.0, 0.0]
    assert N.add_congestion_features(df.drop("capacity")).columns == ["i", "occupancy", "area"]


def test_label_boundary(spark):
    df = series(spark, 0.3, 0.79, 0.80, 0.81, 0.95, None)
    assert column(df, N.congestion_label(F.col("x"))) == [0, 0, 0, 1, 1, 0]


def test_constant_part_scores_zero(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, 1.0, 2.0)], "i long, occupancy double, capacity double")
    assert column(N.add_congestion_features(df), "congestion_score") == [0.0, 0.0]


def test_price_change_level_elasticity(spark):
    df = series(spark, 15.0, 15.0, 16.0, 14.0, 18.0, name="price")
    assert column(P.add_price_change(df, ROWS), "price_change") == [None, 0.0, 1.0, -2.0, 4.0]
    assert column(df, P.price_level(F.col("price"))) == ["normal", "normal", "surge", "discount", "surge"]
    pair = spark.createDataFrame(
        [("a", 0, 100.0, 10.0), ("a", 1, 97.0, 11.0), ("a", 2, 90.0, 11.0), ("a", 3, 80.0, 0.0), ("a", 4, 60.0, 5.0)],
        "k string, i long, volume double, price double",
    )
    got = column(P.add_demand_elasticity(pair, ROWS, 1), "demand_elasticity")
    assert got[0] is None and got[1] == pytest.approx(-0.3)
    assert got[2] is None  # no price change
    assert got[3] == pytest.approx((80 / 90 - 1) / -1)
    assert got[4] == 0.0  # price rises from 0
    both = P.add_pricing_features(pair, ROWS, periods=1)
    assert column(both, "demand_elasticity") == got
    assert column(both, "price_pct_change")[4] is None


def test_pct_change_pads_gaps(spark):
    out = P.add_pct_change(series(spark, 10.0, None, 20.0), ROWS, "x", "pct")
    assert column(out, "pct") == [None, 0.0, 1.0]


def test_temporal(spark):
    stamps = ["2024-01-01 07:00:00", "2024-01-06 22:30:00", "2024-01-07 06:59:00", "2024-01-07 20:00:00", "not a time"]
    df = spark.createDataFrame(list(enumerate(stamps)), "i long, ts string")
    out = T.add_temporal_features(df)
    assert column(out, "hour") == [7, 22, 6, 20, None]
    assert column(out, "weekday") == [0, 5, 6, 6, None]
    assert column(out, "weekend") == [False, True, True, True, None]
    assert column(out, "peak_period") == [True, False, False, True, False]
    assert column(out, "off_peak_period") == [False, True, True, False, False]
    assert column(T.add_calendar_extras(out), "time_slot")[:4] == ["morning", "night", "morning", "evening"]
    with pytest.raises(KeyError):
        T.add_temporal_features(df, "other")


def test_scalars(spark):
    df = series(spark, float("nan"), float("inf"), -3.0, 50.0, None)
    assert column(df, finite(F.col("x"))) == [None, None, -3.0, 50.0, None]
    assert column(df, clip(finite(F.col("x")), 0, 10)) == [None, None, 0.0, 10.0, None]
    assert column(df, ratio(F.lit(1.0), F.lit(0.0))) == [None] * 5
    made = df.limit(1).select(timestamp_from_parts(*[F.lit(v) for v in (2024, 2, 29, 1, 2, 3)]), parse_timestamp(F.lit("x")))
    assert tuple(made.first()) == (dt.datetime(2024, 2, 29, 1, 2, 3), None)
