"""Queries over tariff decisions and scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.operators import tariff as X
from voltaria.queries.inputs import hourly_decided, hourly_decisions, station_rows, weekly_decided, weekly_decisions
from voltaria.queries.registry import DIGITS, R, query, rounded, settle
from voltaria.queries.views_sql import clip_util, with_views
from voltaria.session import broadcast_if_small
from voltaria.sources import driver_views as V


@query(
    "policy_observations",
    with_views(
        f"""SELECT ts, station_id, occupancy, predicted_demand, (current_price - 5.0::DOUBLE) / (25.0::DOUBLE + 1e-8) AS price_norm,
          {R('sin(2 * pi() * hour / 24)')} AS hour_sin, {R('cos(2 * pi() * hour / 24)')} AS hour_cos,
          {clip_util()} AS utilization, fast_ratio, cbd_flag FROM hourly_rows""",
        "hourly_rows",
    ),
)
def policy_observations(spark: SparkSession, sf: str) -> DataFrame:
    made = X.add_observation(hourly_decisions(spark, sf)).select("ts", "station_id", *X.OBSERVATION)
    return made.withColumns({c: settle(c) for c in ("hour_sin", "hour_cos")})


_OUT = "ts, station_id, utilization, action, change, name, new_price, price_change, new_volume, revenue_new, revenue_baseline, revenue_gain, congestion_penalty, reward"


@query("action_outcomes", with_views(f"SELECT {_OUT} FROM hourly_actions", "hourly_actions"))
def action_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return X.score_actions(hourly_decisions(spark, sf)).select(*_OUT.split(", "))


_BEST = """SELECT {out} FROM (SELECT *, row_number() OVER (PARTITION BY station_id, ts
    ORDER BY floor(reward * 1e9 + 0.5::DOUBLE) DESC, abs(change), change DESC) AS rn FROM {source}) WHERE rn = 1"""


@query("best_actions", with_views(_BEST.format(out=_OUT, source="weekly_actions"), "weekly_actions"))
def best_actions(spark: SparkSession, sf: str) -> DataFrame:
    return X.best_actions(weekly_decisions(spark, sf)).select(*_OUT.split(", "))


@query("rule_tariff", with_views(f"SELECT {_OUT} FROM weekly_decided", "weekly_decided"))
def rule_tariff(spark: SparkSession, sf: str) -> DataFrame:
    return weekly_decided(spark, sf).select(*_OUT.split(", "))


@query(
    "recommended_tariffs",
    with_views(
        f"""SELECT ts, station_id, least(greatest((price_norm * 25.0::DOUBLE + 5.0::DOUBLE) * (1.0::DOUBLE + change), 5.0::DOUBLE), 30.0::DOUBLE) AS tariff
        FROM (SELECT ts, station_id, (current_price - 5.0::DOUBLE) / (25.0::DOUBLE + 1e-8) AS price_norm,
          CASE WHEN {clip_util()} > 0.8::DOUBLE THEN 0.3::DOUBLE WHEN {clip_util()} < 0.3::DOUBLE THEN -0.2::DOUBLE ELSE 0.0::DOUBLE END AS change
          FROM hourly_rows)""",
        "hourly_rows",
    ),
)
def recommended_tariffs(spark: SparkSession, sf: str) -> DataFrame:
    seen = X.add_observation(hourly_decisions(spark, sf))
    change = X.rule_change(F.col("utilization"))
    return seen.select("ts", "station_id", X.recommended_price(F.col("price_norm"), change).alias("tariff"))


_EVAL = f"""{R('avg(reward)', 6)} AS mean_reward, {R('stddev_pop(reward)', 5)} AS std_reward, {R('sum(revenue_new)', 3)} AS total_revenue,
  {R('sum(revenue_baseline)', 3)} AS baseline_revenue, {R('avg(utilization)')} AS mean_utilization, count(*) AS steps,
  {R('(sum(revenue_new) - sum(revenue_baseline)) / (sum(revenue_baseline) + 1e-8) * 100', 6)} AS revenue_gain_pct"""


def _evaluated(decided: DataFrame, by: list[str]) -> DataFrame:
    return rounded(
        X.evaluate_policy(decided, by), 6, std_reward=5, total_revenue=3, baseline_revenue=3, mean_utilization=DIGITS
    )


@query("policy_evaluation", with_views(f"SELECT station_id, {_EVAL} FROM weekly_decided GROUP BY 1", "weekly_decided"))
def policy_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluated(weekly_decided(spark, sf), ["station_id"])


@query(
    "policy_evaluation_best",
    with_views(f"SELECT {_EVAL} FROM ({_BEST.format(out=_OUT, source='hourly_actions')})", "hourly_actions"),
)
def policy_evaluation_best(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluated(X.best_actions(hourly_decisions(spark, sf)), [])


@query(
    "action_distribution",
    with_views(
        """SELECT a.action, a.name, coalesce(n, 0) AS rows FROM (VALUES (0, '-20%'), (1, '-10%'), (2, '0%'), (3, '+10%'), (4, '+20%'), (5, '+30%')) a(action, name)
        LEFT JOIN (SELECT action, count(*) AS n FROM weekly_decided GROUP BY 1) d ON a.action = d.action""",
        "weekly_decided",
    ),
)
def action_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return X.action_distribution(weekly_decided(spark, sf))


def _scenario_sql(revenue: str, util: str) -> str:
    return f"""{R(f'sum({revenue})', 3)} AS total_revenue, {R(f'avg({revenue})', 6)} AS mean_revenue_per_step, {R(f'avg({util})')} AS mean_utilization,
      {R(f'avg(CASE WHEN {util} > 0.8::DOUBLE THEN 1.0::DOUBLE ELSE 0 END)')} AS congestion_rate,
      {R(f'avg(CASE WHEN {util} < 0.3::DOUBLE THEN 1.0::DOUBLE ELSE 0 END)')} AS off_peak_rate, count(*) AS steps"""


_SCENARIO_DIGITS = dict(total_revenue=3, mean_revenue_per_step=6, mean_price=6)


@query(
    "fixed_scenario",
    with_views(f"SELECT station_id, {_scenario_sql('15.0::DOUBLE * volume', clip_util())} FROM station_panel GROUP BY 1", "station_panel"),
)
def fixed_scenario(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.fixed_scenario(V.station_panel(spark, sf), ["station_id"]), **_SCENARIO_DIGITS)


@query(
    "dynamic_scenario",
    with_views(
        f"SELECT station_id, {_scenario_sql('revenue_new', 'utilization')}, {R('avg(new_price)', 6)} AS mean_price FROM weekly_decided GROUP BY 1",
        "weekly_decided",
    ),
)
def dynamic_scenario(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.dynamic_scenario(weekly_decided(spark, sf), ["station_id"]), **_SCENARIO_DIGITS)


@query(
    "scenario_comparison",
    with_views(
        f"""SELECT metric, {R('fixed', 3)} AS fixed, {R('dynamic', 3)} AS dynamic, {R('change', 3)} AS change FROM (
          SELECT unnest([
            {{'metric': 'total_revenue', 'fixed': fr, 'dynamic': dr, 'change': (dr - fr) / (fr + 1e-8) * 100}},
            {{'metric': 'revenue_gain_pct', 'fixed': NULL, 'dynamic': NULL, 'change': (dr - fr) / (fr + 1e-8) * 100}},
            {{'metric': 'mean_utilization', 'fixed': fu, 'dynamic': du, 'change': (du - fu) * 100}},
            {{'metric': 'congestion_rate', 'fixed': fc, 'dynamic': dc, 'change': (fc - dc) / (fc + 1e-8) * 100}},
            {{'metric': 'congestion_reduction_pct', 'fixed': NULL, 'dynamic': NULL, 'change': (fc - dc) / (fc + 1e-8) * 100}},
            {{'metric': 'off_peak_rate', 'fixed': fo, 'dynamic': d_o, 'change': (fo - d_o) / (fo + 1e-8) * 100}},
            {{'metric': 'off_peak_uplift_pct', 'fixed': NULL, 'dynamic': NULL, 'change': (fo - d_o) / (fo + 1e-8) * 100}},
            {{'metric': 'demand_shift_pp', 'fixed': NULL, 'dynamic': NULL, 'change': (fo - d_o) * 100}}], recursive := true)
          FROM (SELECT sum(15.0::DOUBLE * volume) AS fr, avg(utilization) AS fu, avg(CASE WHEN utilization > 0.8 THEN 1.0::DOUBLE ELSE 0 END) AS fc,
              avg(CASE WHEN utilization < 0.3 THEN 1.0::DOUBLE ELSE 0 END) AS fo, sum(revenue_new) AS dr, avg(utilization) AS du,
              avg(CASE WHEN utilization > 0.8 THEN 1.0::DOUBLE ELSE 0 END) AS dc, avg(CASE WHEN utilization < 0.3 THEN 1.0::DOUBLE ELSE 0 END) AS d_o
            FROM weekly_decided))""",
        "weekly_decided",
    ),
)
def scenario_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.compare_decided(weekly_decided(spark, sf)), 3)


@query(
    "district_kpis",
    with_views(
        f"""SELECT node_id, region, {_scenario_sql('15.0::DOUBLE * volume', clip_util())}, sum(congested) AS congested_steps
        FROM (SELECT *, CAST({clip_util()} > 0.8::DOUBLE AS INTEGER) AS congested FROM station_panel JOIN station_dim USING (station_id)) GROUP BY 1, 2""".replace(
            "sum(congested)", "CAST(sum(congested) AS BIGINT)"
        ),
        "station_panel",
        "station_dim",
    ),
)
def district_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: panel, utilization, congestion, revenue at the fixed price, per district."""
    dim = V.station_dim(spark, sf).select("station_id", "node_id", "region")
    rows = station_rows(spark, sf).join(broadcast_if_small(dim, one_row_per_key=True), "station_id")
    congested = F.count_if(F.col("utilization_rate") > 0.8).alias("congested_steps")
    return rounded(X.fixed_scenario(rows, ["node_id", "region"], extra=[congested]), **_SCENARIO_DIGITS)


@query("hourly_rule_tariff", with_views(f"SELECT {_OUT} FROM hourly_decided", "hourly_decided"))
def hourly_rule_tariff(spark: SparkSession, sf: str) -> DataFrame:
    return hourly_decided(spark, sf).select(*_OUT.split(", "))
