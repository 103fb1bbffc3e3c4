"""Cleaning, quality rules and resampling on small literal cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltaria.operators import clean as C
from voltaria.operators import hourly as H
from voltaria.operators import quality as Q
from voltaria.operators.ordered import Series

ROWS = Series(keys=("k",), by=("i",))


def frame(spark, *values):
    return spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, i long, x double")


def xs(df, name="x"):
    return [r[0] for r in df.orderBy("i").select(name).collect()]


@pytest.mark.parametrize(
    ("strategy", "want"),
    [
        ("interpolate", [1.0, 1.0, 2.0, 3.0, 3.0]),
        ("ffill", [None, 1.0, 1.0, 3.0, 3.0]),
        ("bfill", [1.0, 1.0, 3.0, 3.0, None]),
        ("median", [2.0, 1.0, 2.0, 3.0, 2.0]),
        ("mean", [2.0, 1.0, 2.0, 3.0, 2.0]),
        ("drop", [1.0, 3.0]),
    ],
)
def test_missing(spark, strategy, want):
    assert xs(C.handle_missing(frame(spark, None, 1.0, None, 3.0, None), strategy, ["x"], ROWS)) == want


def test_interpolate_literal(spark):
    assert xs(C.handle_missing(frame(spark, 1.0, None, 3.0, None, 5.0), "interpolate", ["x"], ROWS)) == [1, 2, 3, 4, 5]


def test_missing_errors(spark):
    with pytest.raises(ValueError):
        C.handle_missing(frame(spark, 1.0), "guess")
    with pytest.raises(ValueError):
        C.handle_missing(frame(spark, 1.0), "ffill")


def test_outliers(spark):
    df = frame(spark, 1.0, 2.0, 3.0, 4.0, 5.0, 100.0)
    assert xs(C.outliers_only(C.flag_outliers(df, ["x", "k", "absent"]))) == [100.0]
    many = frame(spark, *([1.0] * 5 + [2.0] * 15 + [50.0]))
    assert xs(C.outliers_only(C.flag_outliers(many, ["x"], "zscore", 1.0))) == [50.0]
    with pytest.raises(ValueError):
        C.flag_outliers(df, ["x"], "other")


def test_scaling(spark):
    df = frame(spark, 0.0, 25.0, 50.0, None, 100.0)
    fitted = C.fit_scaler(df, ["x"], "minmax")
    scaled = C.normalize(df, ["x"], fitted)
    assert xs(scaled) == [0.0, 0.25, 0.5, None, 1.0]
    assert xs(C.inverse_normalize(scaled, ["x", "absent"], fitted)) == [0.0, 25.0, 50.0, None, 100.0]
    flat = frame(spark, 3.0, 3.0)
    assert xs(C.normalize(flat, ["x"], C.fit_scaler(flat, ["x"], "standard"))) == [0.0, 0.0]
    # A column that was never fitted is left alone.
    assert xs(C.inverse_normalize(df, ["x"], C.fit_scaler(df.withColumn("y", F.lit(1.0)), ["y"]))) == xs(df)


def test_clean_sessions(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = [
        (0, t(0), t(2), None, 4.0, "s", "1"),
        (1, t(1), None, None, None, "s", "1"),
        (2, t(2), t(60), None, 8.0, "s", "1"),
        (3, t(3), t(5), None, -6.0, "s", None),
        (3, t(3), t(5), None, -6.0, "s", None),
        (4, None, t(5), None, 1.0, "u", "1"),
    ]
    df = spark.createDataFrame(
        rows,
        "sessionID long, connectionTime timestamp_ntz, disconnectTime timestamp_ntz, doneChargingTime timestamp_ntz, "
        "kWhDelivered double, stationID string, siteID string",
    )
    out = {r["sessionID"]: r for r in C.clean_sessions(df, Series(keys=("stationID",), by=("sessionID",))).collect()}
    assert set(out) == {0, 1, 3}
    assert out[1]["kWhDelivered"] == 6.0 and out[1]["session_duration_hours"] == 1.0
    assert out[3]["kWhDelivered"] == 0.0 and out[3]["siteID"] == "UNKNOWN"


def test_rules(spark):
    df = spark.createDataFrame(
        [(1, "a", 3, 1, 2, 1.0, 0.0, 1), (2, "b", -3, 1, 2, 0.0, 0.0, 2)],
        "num int, grid string, count int, fast_count int, slow_count int, area double, CBD double, dynamic_pricing int",
    )
    rules = Q.district_rules()
    assert tuple(Q.validation_report(df, rules).first()) == (2, 1, 1)
    assert {r["rule"]: r["failures"] for r in Q.rule_counts(df, rules).collect()}["count_negative"] == 1
    assert [r["error"] for r in Q.first_errors(df, rules, ["num"], 2).collect()] == ["count_negative", "area_not_positive"]
    with pytest.raises(ValueError):
        Q.raise_on_errors(df, rules)
    assert Q.trimmed(spark.createDataFrame([(" x ",)], "s string")).first()[0] == "x"
    assert Q.validation_report(df, rules, sample=1.0).first()["total"] == 2


def test_empty_hours_are_kept(spark):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    df = spark.createDataFrame(
        [(t(1, 5), 2.0, 1.0), (t(1, 50), None, 3.0), (t(4), 6.0, 1.0)],
        "connectionTime timestamp_ntz, kWhDelivered double, session_duration_hours double",
    )
    got = [tuple(r) for r in H.hourly_sessions(df).orderBy("ts").collect()]
    assert got == [(t(1), 2.0, 1, 2.0), (t(2), None, 0, None), (t(3), None, 0, None), (t(4), 6.0, 1, 1.0)]


def test_step_means_are_not_flat_means(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([(t(0), 1.0), (t(0), 3.0), (t(5), 8.0)], "ts timestamp_ntz, volume double")
    assert H.hourly_panel_means(df).first()["urbanev_mean_volume"] == 5.0


def test_unified_joins_both_spans(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    sessions = spark.createDataFrame(
        [(t(0), 2.0, 1.0)], "connectionTime timestamp_ntz, kWhDelivered double, session_duration_hours double"
    )
    panel = spark.createDataFrame([(t(2), 4.0), (t(4), 8.0)], "ts timestamp_ntz, volume double")
    rows = H.unified_hourly(sessions, panel).orderBy("ts").collect()
    assert [r["ts"].hour for r in rows] == [0, 2, 3, 4]
    assert [r["urbanev_mean_volume"] for r in rows] == [4.0, 4.0, 6.0, 8.0]
    assert [r["acn_mean_kWh"] for r in rows] == [2.0] * 4
