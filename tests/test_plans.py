"""Plans and results that must hold whatever the partitioning."""

import re

import pytest
from pyspark.sql import functions as F

from voltaria import queries
from voltaria.functions.demand import add_demand_features
from voltaria.operators import clean as C
from voltaria.operators import ordered as O
from voltaria.session import broadcast_if_small, input_bytes, is_derived, plan_bytes, scratch_path, stage
from voltaria.sources import driver_views as V

SF = "/root/testdata/sf0.001"
queries.load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


ROW_LEVEL = [
    "demand_features",
    "panel_lags",
    "pricing_features",
    "spatial_lags",
    "graph_windows",
    "rule_tariff",
    "best_actions",
    "action_outcomes",
    "sessions_clean",
    "session_energy_interpolated",
    "metric_drift",
    "metric_z_runs",
    "kpi_trend",
    "station_tariffs",
]


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_no_single_partition_on_facts(spark, name):
    assert "Exchange SinglePartition" not in plan(queries.QUERIES[name](spark, SF))


def test_demand_features_take_one_shuffle_and_one_sort(spark):
    stored = stage(V.station_panel(spark, SF), "panel")
    text = plan(add_demand_features(stored, V.STATION_SERIES))
    assert text.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_action_scoring_does_not_shuffle(spark):
    from voltaria.operators.tariff import best_actions
    from voltaria.queries.inputs import weekly_decisions

    stored = stage(weekly_decisions(spark, SF), "decisions")
    text = plan(best_actions(stored))
    assert "Exchange" not in text and "ArrayTransform" not in text


def test_scan_reads_only_what_is_used(spark):
    text = plan(V.station_panel(spark, SF).where(F.col("station_id") == 3).select("ts", "occupancy"))
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in text
    assert "EqualTo(l_suppkey,3)" in text


@pytest.mark.parametrize("name", ["sessions_clean", "spatial_lags", "roc_auc", "metric_drift", "chronological_split"])
def test_results_do_not_depend_on_partitions(spark, name):
    seen = set()
    for n in ("1", "4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = queries.QUERIES[name](spark, SF)
        seen.add((df.count(), df.agg(F.sum(F.hash(*sorted(df.columns)).cast("long"))).first()[0]))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(seen) == 1


def test_clean_sessions_with_split_keys(spark):
    """The null station holds a fifth of the rows; split or not, the result is the same."""
    df = stage(V.sessions(spark, SF), "sessions")
    split = O.Series(keys=("stationID",), by=("sessionID",), task_rows=60, task_bytes=0)
    plain, cut = C.clean_sessions(df, V.SESSION_SERIES), C.clean_sessions(df, split)
    assert plain.exceptAll(cut).count() == 0 and plain.count() == cut.count()


def test_hot_keys_go_to_bounded_groups(spark):
    """No window group of a split series exceeds the task bound plus its halo."""
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).alias("k"), F.col("id").alias("t"))
    df = stage(df, "hot")
    series = O.Series(keys=("k",), by=("t",), task_rows=200, task_bytes=0)
    cold, hot = O.split_hot(df, series)
    assert hot.count() == 1334 and hot.select("k").distinct().count() == 1 and cold.count() == 4000 - 1334
    assert hot.groupBy("k", "_slice").count().agg(F.max("count")).first()[0] <= 200


def test_size_checks(spark):
    panel, dim = V.station_panel(spark, SF), V.station_dim(spark, SF)
    assert is_derived(panel) and not is_derived(V.table(spark, SF, "lineitem"))
    joined = panel.join(dim, "station_id")
    assert plan_bytes(joined) > input_bytes(joined)
    big = spark.range(10**9).withColumn("x", F.col("id") * 2)
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in broadcast_if_small(big)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in broadcast_if_small(dim, one_row_per_key=True)._jdf.queryExecution().analyzed().toString().lower()


def test_scratch_paths_are_under_the_shared_folder(spark):
    from voltaria.session import shared_dir

    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))
