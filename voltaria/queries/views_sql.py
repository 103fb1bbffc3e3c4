"""The driver-table views as SQL, for the reference statements."""

from __future__ import annotations

_FILL = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_NEXT = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"


def clip_util(occ: str = "occupancy", cap: str = "capacity") -> str:
    return f"least(greatest(coalesce({occ} / nullif({cap}, 0), 0.0::DOUBLE), 0.0::DOUBLE), 1.0::DOUBLE)"


def interpolate(source: str, keys: str, order: str, column: str, keep: str) -> str:
    """Linear interpolation by row position as a derived table with the columns ``keep`` and ``column``."""
    part = f"PARTITION BY {keys} ORDER BY {order}" if keys else f"ORDER BY {order}"
    return f"""(SELECT {keep}, coalesce({column},
        pv + (nv - pv) * (CAST(pos - pp AS DOUBLE) / nullif(np - pp, 0)), pv, nv) AS {column}
      FROM (SELECT *,
        last_value(CASE WHEN {column} IS NOT NULL THEN pos END IGNORE NULLS) OVER (w {_FILL}) AS pp,
        last_value({column} IGNORE NULLS) OVER (w {_FILL}) AS pv,
        first_value(CASE WHEN {column} IS NOT NULL THEN pos END IGNORE NULLS) OVER (w {_NEXT}) AS np,
        first_value({column} IGNORE NULLS) OVER (w {_NEXT}) AS nv
        FROM (SELECT *, row_number() OVER ({part}) AS pos FROM {source})
        WINDOW w AS ({part})))"""


_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "station_panel": (
        (),
        """SELECT CAST(date_trunc('week', l_shipdate) AS TIMESTAMP) AS ts, l_suppkey AS station_id,
          CAST(count(*) AS DOUBLE) AS occupancy, sum(l_quantity) AS volume,
          least(greatest(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / sum(l_quantity) / 100.0::DOUBLE,
            5.0::DOUBLE), 30.0::DOUBLE) AS price,
          CAST(2 + l_suppkey % 3 AS DOUBLE) AS capacity
        FROM lineitem GROUP BY 1, l_suppkey""",
    ),
    "hourly_panel": (
        (),
        """SELECT ts, station_id, occupancy, volume, duration,
          least(greatest(volume / occupancy, 5.0::DOUBLE), 30.0::DOUBLE) AS price,
          CAST(1 + station_id % 3 AS DOUBLE) AS capacity
        FROM (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, user_id AS station_id,
            CAST(count(*) AS DOUBLE) AS occupancy,
            CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS volume,
            (epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9 AS duration
          FROM events e GROUP BY date_trunc('hour', e.ts), user_id)""",
    ),
    "station_dim": (
        (),
        """SELECT s_suppkey AS station_id, s_nationkey AS node_id, r_name AS region,
          CAST(s_nationkey % 5 AS DOUBLE) AS area, CAST(2 + s_suppkey % 3 AS INTEGER) AS "count",
          CAST(s_suppkey % 3 AS INTEGER) AS fast_count, n_regionkey = 0 AS cbd_flag,
          CAST(s_suppkey % 2 AS INTEGER) AS dynamic_pricing, s_acctbal AS balance
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "district_panel": (
        (),
        """SELECT ts, node_id, occupancy, volume,
          least(greatest(money / volume / 100.0::DOUBLE, 5.0::DOUBLE), 30.0::DOUBLE) AS price, capacity
        FROM (SELECT CAST(date_trunc('week', l_shipdate) AS TIMESTAMP) AS ts, s_nationkey AS node_id,
            CAST(count(*) AS DOUBLE) AS occupancy, sum(l_quantity) AS volume,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS money
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
        JOIN (SELECT s_nationkey AS node_id, CAST(3 * count(*) AS DOUBLE) AS capacity FROM supplier GROUP BY 1)
          USING (node_id)""",
    ),
    "edges": (
        (),
        """SELECT src, dst, CAST(abs(dst - src) AS DOUBLE) AS dist FROM (
          SELECT src, dst FROM (SELECT n_nationkey AS src, lead(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS dst FROM nation)
          UNION ALL
          SELECT dst, src FROM (SELECT n_nationkey AS src, lead(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS dst FROM nation))
        WHERE src IS NOT NULL AND dst IS NOT NULL""",
    ),
    "sessions": (
        (),
        """SELECT event_id AS sessionID, ts AS connectionTime, next_ts AS disconnectTime,
          CASE WHEN event_type <> 'view' THEN make_timestamp((epoch_us(ts) + epoch_us(next_ts)) // 2) END AS doneChargingTime,
          CASE WHEN event_type <> 'error' THEN value END AS kWhDelivered,
          CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END AS stationID,
          CAST(user_id % 10 AS VARCHAR) AS siteID
        FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events)""",
    ),
    "energy_filled": (
        ("sessions",),
        "SELECT * REPLACE (greatest(kWhDelivered, 0.0::DOUBLE) AS kWhDelivered) FROM "
        + interpolate(
            "sessions",
            "stationID",
            "sessionID",
            "kWhDelivered",
            "sessionID, connectionTime, disconnectTime, doneChargingTime, stationID, siteID",
        ),
    ),
    "clean_sessions": (
        ("energy_filled",),
        f"""SELECT *, (epoch_us(disconnectTime) - epoch_us(connectionTime)) / 3.6e9 AS session_duration_hours
        FROM (SELECT DISTINCT sessionID, connectionTime, disconnectTime, doneChargingTime, kWhDelivered,
            coalesce(stationID, 'UNKNOWN') AS stationID, coalesce(siteID, 'UNKNOWN') AS siteID
          FROM (SELECT sessionID, kWhDelivered, stationID, siteID,
            last_value(connectionTime IGNORE NULLS) OVER (w {_FILL}) AS connectionTime,
            last_value(disconnectTime IGNORE NULLS) OVER (w {_FILL}) AS disconnectTime,
            last_value(doneChargingTime IGNORE NULLS) OVER (w {_FILL}) AS doneChargingTime
            FROM energy_filled WINDOW w AS (PARTITION BY stationID ORDER BY sessionID))
          WHERE connectionTime IS NOT NULL AND disconnectTime IS NOT NULL)
        WHERE (epoch_us(disconnectTime) - epoch_us(connectionTime)) / 3.6e9 BETWEEN 0 AND 48""",
    ),
    "weekly_rows": (
        ("station_panel", "station_dim"),
        """SELECT ts, station_id, occupancy, capacity,
          coalesce(lag(volume) OVER (PARTITION BY station_id ORDER BY ts), volume) AS predicted_demand,
          price AS current_price, CAST(hour(ts) AS DOUBLE) AS hour,
          CAST(fast_count AS DOUBLE) / CAST("count" AS DOUBLE) AS fast_ratio,
          CAST(cbd_flag AS DOUBLE) AS cbd_flag, volume
        FROM station_panel JOIN station_dim USING (station_id)""",
    ),
    "hourly_rows": (
        ("hourly_panel",),
        """SELECT ts, station_id, occupancy, capacity,
          coalesce(lag(volume) OVER (PARTITION BY station_id ORDER BY ts), volume) AS predicted_demand,
          price AS current_price, CAST(hour(ts) AS DOUBLE) AS hour,
          CAST(station_id % 3 AS DOUBLE) / 3.0::DOUBLE AS fast_ratio,
          CAST(station_id % 5 = 0 AS DOUBLE) AS cbd_flag, volume
        FROM hourly_panel""",
    ),
    "episodes": (
        ("weekly_decided",),
        """SELECT ts, station_id, CAST(epoch_us(ts) // 604800000000 AS BIGINT) AS episode,
          revenue_gain * 100.0::DOUBLE AS revenue_gain_pct, utilization AS utilization_rate, congestion_rate,
          congestion_rate * utilization * 10.0::DOUBLE AS wait_time_proxy,
          revenue_gain * 100.0::DOUBLE / (congestion_rate + 1.0::DOUBLE) AS pricing_efficiency_score
        FROM (SELECT *, CAST(utilization > 0.8::DOUBLE AS DOUBLE) AS congestion_rate FROM weekly_decided)""",
    ),
    "metrics": (
        ("episodes",),
        """SELECT station_id, episode AS seq, metric, value FROM episodes UNPIVOT INCLUDE NULLS (value FOR metric IN
          (revenue_gain_pct, utilization_rate, congestion_rate, wait_time_proxy, pricing_efficiency_score))""",
    ),
}


def outcome_sql(source: str, keep: str, change: str = "change") -> str:
    """The outcome of a price change on decision rows that carry ``utilization`` and the change."""
    return f"""SELECT {keep}, new_price, price_change, new_volume, revenue_new, revenue_baseline,
        (revenue_new - revenue_baseline) / (revenue_baseline + 1e-8) AS revenue_gain,
        over_knee * over_knee AS congestion_penalty,
        1.0::DOUBLE * ((revenue_new - revenue_baseline) / (revenue_baseline + 1e-8))
          - 0.5::DOUBLE * abs(utilization - 0.7::DOUBLE) - 2.0::DOUBLE * over_knee * over_knee AS reward
      FROM (SELECT *, new_price * new_volume AS revenue_new, 15.0::DOUBLE * volume AS revenue_baseline
        FROM (SELECT *, greatest(volume * (1.0::DOUBLE - 0.3::DOUBLE * price_change), 0.0::DOUBLE) AS new_volume
          FROM (SELECT *, (new_price - current_price) / (current_price + 1e-8) AS price_change,
              greatest(utilization - 0.9::DOUBLE, 0.0::DOUBLE) AS over_knee
            FROM (SELECT *, least(greatest(current_price * (1.0::DOUBLE + {change}), 5.0::DOUBLE), 30.0::DOUBLE) AS new_price
              FROM {source}))))"""


_ROW = "ts, station_id, occupancy, capacity, predicted_demand, current_price, hour, fast_ratio, cbd_flag, volume, utilization"
ACTIONS_SQL = """(SELECT * FROM (VALUES (0, -0.2::DOUBLE, '-20%'), (1, -0.1::DOUBLE, '-10%'), (2, 0.0::DOUBLE, '0%'),
      (3, 0.1::DOUBLE, '+10%'), (4, 0.2::DOUBLE, '+20%'), (5, 0.3::DOUBLE, '+30%')) t(action, change, name))"""


def _decided(rows: str) -> str:
    return outcome_sql(
        f"""(SELECT *, CASE WHEN utilization > 0.8::DOUBLE THEN 5 WHEN utilization < 0.3::DOUBLE THEN 0 ELSE 2 END AS action,
          CASE WHEN utilization > 0.8::DOUBLE THEN 0.3::DOUBLE WHEN utilization < 0.3::DOUBLE THEN -0.2::DOUBLE
            ELSE 0.0::DOUBLE END AS change,
          CASE WHEN utilization > 0.8::DOUBLE THEN '+30%' WHEN utilization < 0.3::DOUBLE THEN '-20%' ELSE '0%' END AS name
          FROM (SELECT *, {clip_util()} AS utilization FROM {rows}))""",
        f"{_ROW}, action, change, name",
    )


_VIEWS["weekly_decided"] = (("weekly_rows",), _decided("weekly_rows"))
_VIEWS["hourly_decided"] = (("hourly_rows",), _decided("hourly_rows"))
for _name, _rows in (("weekly_actions", "weekly_rows"), ("hourly_actions", "hourly_rows")):
    _VIEWS[_name] = (
        (_rows,),
        outcome_sql(
            f"(SELECT * FROM (SELECT *, {clip_util()} AS utilization FROM {_rows}), {ACTIONS_SQL} a)",
            f"{_ROW}, action, change, name",
        ),
    )


def with_views(body: str, *names: str) -> str:
    """``WITH`` the named views (and those they build on), then the body."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in _VIEWS[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    # Materialized, as each is used more than once in the larger statements.
    ctes = ",\n".join(f"{n} AS MATERIALIZED (\n{_VIEWS[n][1]}\n)" for n in ordered)
    return f"WITH {ctes}\n{body}"
