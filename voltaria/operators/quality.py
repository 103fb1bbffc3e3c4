"""Data-quality rules as expressions: one pass, per-rule counts and the first failing rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaria.operators.ordered import Series, windowed


def session_rules() -> dict[str, Column]:
    """Rule name -> condition under which a session row is invalid."""
    return {
        "connection_time_missing": F.col("connectionTime").isNull(),
        "disconnect_time_missing": F.col("disconnectTime").isNull(),
        "energy_missing": F.col("kWhDelivered").isNull(),
        "energy_negative": F.col("kWhDelivered") < 0,
        "station_missing": F.col("stationID").isNull(),
        "site_missing": F.col("siteID").isNull(),
        "disconnect_before_connection": F.col("disconnectTime") < F.col("connectionTime"),
    }


def district_rules() -> dict[str, Column]:
    """Rule name -> condition under which a district row is invalid."""
    counts = {f"{c}_negative": F.col(c).isNull() | (F.col(c) < 0) for c in ("num", "count", "fast_count", "slow_count")}
    return {
        **counts,
        "area_not_positive": F.col("area").isNull() | (F.col("area") <= 0),
        "cbd_negative": F.col("CBD").isNull() | (F.col("CBD") < 0),
        "dynamic_pricing_not_a_flag": F.col("dynamic_pricing").isNull() | ~F.col("dynamic_pricing").between(0, 1),
    }


def price_rules(low: float = 5.0, high: float = 30.0) -> dict[str, Column]:
    """A price outside the bounds makes the clipped policy price a large jump."""
    return {"price_out_of_bounds": F.col("price").isNull() | ~F.col("price").between(low, high)}


def trimmed(df: DataFrame) -> DataFrame:
    """Strip surrounding blanks of every text column."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.trim(c) for c in texts}) if texts else df


def with_errors(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``errors``: the names of the broken rules."""
    return df.withColumn("errors", F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])))


def validation_report(
    df: DataFrame, rules: Mapping[str, Column], sample: float | None = None, seed: int = 42
) -> DataFrame:
    """One row: total, valid and invalid rows. All rows by default; ``sample`` checks a fraction."""
    checked = df if sample is None else df.sample(fraction=sample, seed=seed)
    bad = F.size("errors") > 0
    return with_errors(checked, rules).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~bad).alias("valid"),
        F.count_if(bad).alias("invalid"),
    )


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, failures)`` for each rule, zero counts included, in one aggregate."""
    counted = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    return counted.unpivot([], list(rules), "rule", "failures")


def first_errors(df: DataFrame, rules: Mapping[str, Column], order: Iterable[str], limit: int = 20) -> DataFrame:
    """The first broken rules as ``(order..., error)`` rows."""
    keys = list(order)
    named = {name: i for i, name in enumerate(rules)}
    rank = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    exploded = with_errors(df, rules).select(*keys, F.explode("errors").alias("error"))
    return exploded.orderBy(*keys, rank[F.col("error")]).limit(limit)


def raise_on_errors(df: DataFrame, rules: Mapping[str, Column]) -> None:
    """Fail if any row breaks a rule; only the three counts reach the driver."""
    report = validation_report(df, rules).first()
    if report["invalid"]:
        raise ValueError(f"{report['invalid']} of {report['total']} rows break a rule")


def null_profile(df: DataFrame) -> DataFrame:
    """``(column, nulls)`` for every column, in one aggregate."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column", "nulls")


def grid_checks(
    panel: DataFrame, node: str, expected_steps: int, expected_nodes: int, spacing_seconds: int
) -> DataFrame:
    """``(check, expected, actual, ok)``: number of steps and nodes, and rows off the expected spacing."""
    series = Series(keys=(node,), by=("ts",))
    stamp = F.unix_seconds(F.col("ts").cast("timestamp"))
    gaps = windowed(panel.select(node, "ts"), series, {"gap": lambda w: stamp - F.lag(stamp).over(w)}, back=1)
    off = gaps.agg(F.count_if(F.col("gap") != spacing_seconds).alias("n"))
    steps = panel.select("ts").distinct().agg(F.count(F.lit(1)).alias("n"))
    nodes = panel.select(node).distinct().agg(F.count(F.lit(1)).alias("n"))
    rows = [("steps", expected_steps, steps), ("nodes", expected_nodes, nodes), ("off_spacing", 0, off)]
    out = None
    for name, expected, found in rows:
        row = found.select(
            F.lit(name).alias("check"),
            F.lit(expected).cast("long").alias("expected"),
            F.col("n").cast("long").alias("actual"),
            (F.col("n") == expected).alias("ok"),
        )
        out = row if out is None else out.union(row)
    return out


def derived_grid_checks(panel: DataFrame, node: str, dimension: DataFrame) -> DataFrame:
    """:func:`grid_checks` with its expectations taken from the data: the spacing is the commonest gap between a node's
    steps (ties: the shorter), the steps are those of that spacing between the first and the last, the nodes are the rows of the dimension."""
    series = Series(keys=(node,), by=("ts",))
    stamp = F.unix_seconds(F.col("ts").cast("timestamp"))
    gaps = windowed(panel.select(node, "ts"), series, {"gap": lambda w: stamp - F.lag(stamp).over(w)}, back=1)
    common = gaps.where("gap is not null").groupBy("gap").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "gap").first()
    span = panel.agg((F.max(stamp) - F.min(stamp)).alias("s"), F.count(F.lit(1)).alias("n")).first()
    spacing = common["gap"] if common else 0
    steps = span["s"] // spacing + 1 if spacing else min(span["n"], 1)
    return grid_checks(panel, node, steps, dimension.select(node).distinct().count(), spacing)
