"""Tariff decisions: the counterfactual of an action, its reward, policies and scenario comparison."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaria.config import ACTIONS, TariffConfig
from voltaria.functions.demand import utilization_rate
from voltaria.functions.scalar import clip
from voltaria.functions.temporal import hour_angle

TINY = 1e-8
DECISION_COLUMNS = (
    "occupancy",
    "capacity",
    "predicted_demand",
    "current_price",
    "hour",
    "fast_ratio",
    "cbd_flag",
    "volume",
)


def require_decision_columns(df: DataFrame) -> None:
    missing = [c for c in DECISION_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"decision rows lack the columns {missing}")


def _utilization() -> Column:
    """Occupied share; unlike the feature of the same name, a negative capacity also counts as none."""
    return F.when(F.col("capacity") > 0, utilization_rate(F.col("occupancy"), F.col("capacity"))).otherwise(F.lit(0.0))


def add_observation(df: DataFrame, config: TariffConfig = TariffConfig()) -> DataFrame:
    """The eight policy inputs: demand, scaled price, clock, utilization and station kind."""
    require_decision_columns(df)
    angle = hour_angle(F.col("hour"))
    price = (F.col("current_price") - config.min_price) / F.lit(config.max_price - config.min_price + TINY)
    return df.withColumns(
        {
            "price_norm": price,
            "hour_sin": F.sin(angle),
            "hour_cos": F.cos(angle),
            "utilization": _utilization(),
        }
    )


OBSERVATION = ("occupancy", "predicted_demand", "price_norm", "hour_sin", "hour_cos", "utilization", "fast_ratio", "cbd_flag")


def step_outcome(price: Column, volume: Column, utilization: Column, change: Column, config: TariffConfig) -> Column:
    """What one relative price change does to a row: a struct of price, volume, revenues, gain and reward.

    The demand response uses the change of the *clipped* price, so a price below the minimum jumps.
    """
    new_price = clip(price * (F.lit(1.0) + change), config.min_price, config.max_price)
    moved = (new_price - price) / (price + F.lit(TINY))
    new_volume = F.greatest(volume * (F.lit(1.0) - F.lit(config.elasticity) * moved), F.lit(0.0))
    revenue = new_price * new_volume
    base = F.lit(config.baseline_price) * volume
    gain = (revenue - base) / (base + F.lit(TINY))
    over = F.greatest(utilization - F.lit(config.congestion_knee), F.lit(0.0))
    reward = (
        F.lit(config.revenue_weight) * gain
        - F.lit(config.balance_weight) * F.abs(utilization - F.lit(config.target_utilization))
        - F.lit(config.congestion_weight) * over * over
    )
    return F.struct(
        new_price.alias("new_price"),
        moved.alias("price_change"),
        new_volume.alias("new_volume"),
        revenue.alias("revenue_new"),
        base.alias("revenue_baseline"),
        gain.alias("revenue_gain"),
        (over * over).alias("congestion_penalty"),
        reward.alias("reward"),
    )


def action_table() -> Column:
    """The actions as an array of ``(action, change, name)``."""
    return F.array(
        *[F.struct(F.lit(i).alias("action"), F.lit(m).alias("change"), F.lit(n).alias("name")) for i, m, n in ACTIONS]
    )


def score_actions(df: DataFrame, config: TariffConfig = TariffConfig()) -> DataFrame:
    """One row per input row and action, with the outcome of that action."""
    base = df.withColumn("utilization", _utilization()).withColumn("_a", F.explode(action_table()))
    outcome = step_outcome(F.col("current_price"), F.col("volume"), F.col("utilization"), F.col("_a")["change"], config)
    return base.select(*df.columns, "utilization", "_a.*", outcome.alias("_o")).select("*", "_o.*").drop("_o")


def best_actions(df: DataFrame, config: TariffConfig = TariffConfig()) -> DataFrame:
    """The action with the highest reward per row; ties go to the smallest change.

    A price never alters a later row, so the best policy is the best action of each row: the actions are
    scored inside the row, without a shuffle.
    """
    base = df.withColumn("utilization", _utilization())

    def scored(index: int, change: float, name: str) -> Column:
        o = step_outcome(F.col("current_price"), F.col("volume"), F.col("utilization"), F.lit(change), config)
        # Compared at nine digits, so that equal rewards tie whatever their last bits.
        rank = F.floor(o["reward"] * F.lit(1e9) + F.lit(0.5))
        return F.struct(
            rank.alias("rank"), F.lit(-abs(change)).alias("calm"), F.lit(change).alias("change"),
            F.lit(index).alias("action"), F.lit(name).alias("name"),
        )

    # Written out per action: a lambda over an array would leave generated code.
    best = F.greatest(*[scored(*a) for a in ACTIONS])
    chosen = base.withColumn("_b", best).select(*base.columns, "_b.action", "_b.change", "_b.name")
    return _with_outcome(chosen, df.columns, config)


def _with_outcome(chosen: DataFrame, columns: Iterable[str], config: TariffConfig) -> DataFrame:
    outcome = step_outcome(F.col("current_price"), F.col("volume"), F.col("utilization"), F.col("change"), config)
    return (
        chosen.withColumn("_o", outcome)
        .select(*columns, "utilization", "action", "change", "name", "_o.*")
    )


def rule_change(utilization: Column, config: TariffConfig = TariffConfig()) -> Column:
    """Surge above the upper threshold, discount below the lower one, else no change."""
    return (
        F.when(utilization > config.surge_threshold, F.lit(config.surge_multiplier))
        .when(utilization < config.off_peak_threshold, F.lit(config.discount_multiplier))
        .otherwise(F.lit(0.0))
    )


def rule_actions(df: DataFrame, config: TariffConfig = TariffConfig()) -> DataFrame:
    """The threshold tariff per row, with the outcome of its price change."""
    base = df.withColumn("utilization", _utilization())
    change = rule_change(F.col("utilization"), config)
    index = F.when(change > 0, F.lit(5)).when(change < 0, F.lit(0)).otherwise(F.lit(2))
    named = base.withColumns(
        {"action": index, "change": change, "name": F.element_at(F.array(*[F.lit(n) for _, _, n in ACTIONS]), index + 1)}
    )
    return _with_outcome(named, df.columns, config)


def recommended_price(price_norm: Column, change: Column, config: TariffConfig = TariffConfig()) -> Column:
    """Tariff for an observation: undo the price scaling, apply the change, clip."""
    price = price_norm * F.lit(config.max_price - config.min_price) + F.lit(config.min_price)
    return clip(price * (F.lit(1.0) + change), config.min_price, config.max_price)


def evaluate_policy(decided: DataFrame, by: Iterable[str] = (), extra: Iterable[Column] = ()) -> DataFrame:
    """Mean and population std of the reward, revenues, gain and mean utilization; ``extra`` rides along."""
    total = decided.groupBy(*by).agg(
        F.avg("reward").alias("mean_reward"),
        F.stddev_pop("reward").alias("std_reward"),
        F.sum("revenue_new").alias("total_revenue"),
        F.sum("revenue_baseline").alias("baseline_revenue"),
        F.avg("utilization").alias("mean_utilization"),
        F.count(F.lit(1)).alias("steps"),
        *extra,
    )
    gain = (F.col("total_revenue") - F.col("baseline_revenue")) / (F.col("baseline_revenue") + F.lit(TINY)) * 100.0
    return total.withColumn("revenue_gain_pct", gain)


def action_distribution(decided: DataFrame) -> DataFrame:
    """``(action, name, rows)`` with a zero row for an action never taken."""
    counted = decided.groupBy("action").agg(F.count(F.lit(1)).alias("_rows"))
    actions = decided.sparkSession.range(1).select(F.inline(action_table())).drop("change")
    return actions.join(counted, "action", "left").select("action", "name", F.coalesce("_rows", F.lit(0)).alias("rows"))


def _scenario_parts(revenue: Column, utilization: Column, config: TariffConfig) -> list[Column]:
    return [
        F.sum(revenue).alias("total_revenue"),
        F.avg(revenue).alias("mean_revenue_per_step"),
        F.avg(utilization).alias("mean_utilization"),
        F.avg((utilization > config.surge_threshold).cast("double")).alias("congestion_rate"),
        F.avg((utilization < config.off_peak_threshold).cast("double")).alias("off_peak_rate"),
        F.count(F.lit(1)).alias("steps"),
    ]


def fixed_scenario(
    df: DataFrame,
    by: Iterable[str] = (),
    price: float | None = None,
    config: TariffConfig = TariffConfig(),
    extra: Iterable[Column] = (),
) -> DataFrame:
    """Revenue and load figures at one fixed price; ``extra`` aggregates ride in the same pass."""
    at = config.baseline_price if price is None else price
    return df.groupBy(*by).agg(*_scenario_parts(F.lit(at) * F.col("volume"), _utilization(), config), *extra)


def dynamic_scenario(decided: DataFrame, by: Iterable[str] = (), config: TariffConfig = TariffConfig()) -> DataFrame:
    """The same figures for decided rows, plus the mean price."""
    return decided.groupBy(*by).agg(
        *_scenario_parts(F.col("revenue_new"), F.col("utilization"), config), F.avg("new_price").alias("mean_price")
    )


_FIGURES = ("total_revenue", "mean_utilization", "congestion_rate", "off_peak_rate")


def compare_decided(decided: DataFrame, price: float | None = None, config: TariffConfig = TariffConfig()) -> DataFrame:
    """:func:`compare_scenarios` of one table of decided rows with ``volume``: both scenarios in one aggregation."""
    at = config.baseline_price if price is None else price

    def packed(revenue: Column, name: str) -> Column:
        # Column names of the parts: revenue, mean utilization, congestion, off-peak, steps.
        return F.struct(*_scenario_parts(revenue, F.col("utilization"), config)).alias(name)

    wide = decided.agg(packed(F.lit(at) * F.col("volume"), "f"), packed(F.col("revenue_new"), "d"))
    return _compared(wide)


def compare_scenarios(fixed: DataFrame, dynamic: DataFrame) -> DataFrame:
    """``(metric, fixed, dynamic, change)`` from two one-row scenarios; signs as fixed minus dynamic for rates."""
    f = fixed.agg(F.struct(*[F.max(c).alias(c) for c in _FIGURES]).alias("f")).scalar()
    return _compared(dynamic.select(f.alias("f"), F.struct(*_FIGURES).alias("d")))


def _compared(wide: DataFrame) -> DataFrame:

    def pct(c: str, falling: bool) -> Column:
        gap = F.col(f"f.{c}") - F.col(f"d.{c}") if falling else F.col(f"d.{c}") - F.col(f"f.{c}")
        return gap / (F.col(f"f.{c}") + F.lit(TINY)) * 100.0

    rows = [
        ("total_revenue", "total_revenue", pct("total_revenue", False)),
        ("revenue_gain_pct", None, pct("total_revenue", False)),
        ("mean_utilization", "mean_utilization", (F.col("d.mean_utilization") - F.col("f.mean_utilization")) * 100.0),
        ("congestion_rate", "congestion_rate", pct("congestion_rate", True)),
        ("congestion_reduction_pct", None, pct("congestion_rate", True)),
        ("off_peak_rate", "off_peak_rate", pct("off_peak_rate", True)),
        ("off_peak_uplift_pct", None, pct("off_peak_rate", True)),
        ("demand_shift_pp", None, (F.col("f.off_peak_rate") - F.col("d.off_peak_rate")) * 100.0),
    ]
    none = F.lit(None).cast("double")
    packed = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                (F.col(f"f.{c}") if c else none).alias("fixed"),
                (F.col(f"d.{c}") if c else none).alias("dynamic"),
                change.alias("change"),
            )
            for name, c, change in rows
        ]
    )
    return wide.select(F.inline(packed))


def decision_records(decided: DataFrame, source: str, station: str = "station_id", ts: str = "ts") -> DataFrame:
    """Rows for the pricing-decision log."""
    return decided.select(
        F.col(ts).alias("timestamp"),
        F.col(station).cast("string").alias("station_id"),
        "utilization",
        F.col("current_price").alias("baseline_price"),
        F.col("new_price").alias("optimized_price"),
        (F.col("new_price") - F.col("current_price")).alias("price_delta"),
        F.col("revenue_baseline").alias("revenue_old"),
        "revenue_new",
        (F.col("revenue_gain") * 100.0).alias("revenue_gain_pct"),
        F.lit(source).alias("decision_source"),
    )
