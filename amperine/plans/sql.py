"""SQL fragments for the comparison queries (DuckDB dialect)."""

from __future__ import annotations

from amperine import constants as K
from amperine.plans.derived import digits_of

WIDTHS = {"1m": "1 minute", "2m": "2 minutes", "15m": "15 minutes", "1h": "1 hour", "1d": "1 day"}
MEANS = [
    "avg_voltage_r", "avg_voltage_s", "avg_voltage_t",
    "avg_current_r", "avg_current_s", "avg_current_t",
    "avg_power_factor", "avg_voltage_imbalance_rate", "avg_current_imbalance_rate",
]
POWER = ["max_activePower", "avg_activePower", "15m_Total_kWh"]

READINGS = """readings AS (
  SELECT 20 * l_orderkey AS "timestamp",
         CAST(strftime(timestamp '2025-04-01 00:00:00' + to_seconds(20 * l_orderkey), '%Y%m%d%H%M%S') AS BIGINT) AS "localtime",
         concat('module_', lpad(CAST(l_suppkey % 13 AS VARCHAR), 2, '0')) AS module,
         timestamp '2025-04-01 00:00:00' + to_seconds(20 * l_orderkey) AS localtime_datetime,
         CAST(200 + l_quantity AS DOUBLE) AS voltageR,
         CAST(205 + l_partkey % 40 AS DOUBLE) AS voltageS,
         CAST(210 + l_suppkey % 30 AS DOUBLE) AS voltageT,
         CAST(358 + l_quantity AS DOUBLE) AS voltageRS,
         CAST(361 + l_partkey % 20 AS DOUBLE) AS voltageST,
         CAST(362 + l_suppkey % 20 AS DOUBLE) AS voltageTR,
         CAST(l_quantity AS DOUBLE) AS currentR,
         CAST(l_partkey % 50 AS DOUBLE) AS currentS,
         CAST(l_linenumber * 5 AS DOUBLE) AS currentT,
         CAST(1000 * l_linenumber + l_partkey AS DOUBLE) AS activePower,
         CAST(85 + l_linenumber * 2 AS DOUBLE) AS powerFactorR,
         CAST(80 + l_partkey % 21 AS DOUBLE) AS powerFactorS,
         CAST(90 + l_quantity % 10 AS DOUBLE) AS powerFactorT,
         CAST(l_linenumber * 10 AS DOUBLE) AS reactivePowerLagging,
         l_orderkey * CAST(0.25 AS DOUBLE) AS accumActiveEnergy
  FROM lineitem)"""

MEASURES = [
    "voltageR", "voltageS", "voltageT", "voltageRS", "voltageST", "voltageTR",
    "currentR", "currentS", "currentT", "activePower",
    "powerFactorR", "powerFactorS", "powerFactorT", "reactivePowerLagging", "accumActiveEnergy",
]


def mean(prefix: str) -> str:
    return f"(({prefix}R + {prefix}S + {prefix}T) / 3.0)"


def top(prefix: str) -> str:
    return f"greatest({prefix}R, {prefix}S, {prefix}T)"


def imbalance(prefix: str) -> str:
    return f"(({top(prefix)} - {mean(prefix)}) / nullif({mean(prefix)}, 0) * 100.0)"


def r6(name: str, expr: str | None = None) -> str:
    """Rounded column; adding zero turns -0.0 into 0.0."""
    quoted = f'"{name}"'
    return f"round({expr or quoted}, {digits_of(name)}) + CAST(0 AS DOUBLE) AS {quoted}"


def window_end(column: str, width: str) -> str:
    return (
        f"time_bucket(INTERVAL '{width}', {column} - INTERVAL 1 MICROSECOND) + INTERVAL '{width}'"
    )


def aggregate(name: str, width: str, source: str = "readings") -> str:
    """CTE with every metric of the window aggregate, unrounded."""
    return f"""{name} AS (
  SELECT module AS equipment_id, {window_end('localtime_datetime', width)} AS window_end_time,
         CASE WHEN min(voltageRS) <= 360 OR min(voltageST) <= 360 OR min(voltageTR) <= 360 THEN 1
              WHEN (avg(powerFactorR) + avg(powerFactorS) + avg(powerFactorT)) / 3.0 <= 90 THEN 1
              ELSE 0 END AS is_anomaly,
         avg(voltageR) AS avg_voltage_r, avg(voltageS) AS avg_voltage_s, avg(voltageT) AS avg_voltage_t,
         avg(currentR) AS avg_current_r, avg(currentS) AS avg_current_s, avg(currentT) AS avg_current_t,
         avg({mean('powerFactor')}) AS avg_power_factor,
         avg({imbalance('voltage')}) AS avg_voltage_imbalance_rate,
         avg({imbalance('current')}) AS avg_current_imbalance_rate,
         max(activePower) / 1000.0 AS "max_activePower",
         avg(activePower) / 1000.0 AS "avg_activePower",
         max(accumActiveEnergy) - min(accumActiveEnergy) AS "15m_Total_kWh",
         count(*) AS event_count
  FROM {source} GROUP BY 1, 2)"""


STEP = (
    "CASE aggregation_level WHEN '1m' THEN INTERVAL '1 minute' WHEN '15m' THEN INTERVAL '15 minutes' "
    "WHEN '1h' THEN INTERVAL '1 hour' ELSE INTERVAL '1 day' END"
)


def runs(name: str, source: str, keys: str) -> str:
    """CTE that numbers runs of windows, `step` apart, in the column run."""
    by = f"(PARTITION BY {keys} ORDER BY window_end_time)"
    return f"""{name}_breaks AS (
  SELECT *, CASE WHEN lag(window_end_time) OVER {by} + step = window_end_time THEN 0 ELSE 1 END AS fresh FROM {source}),
{name} AS (SELECT *, sum(fresh) OVER {by} AS run FROM {name}_breaks)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def scoring_rows(levels: list[str] = K.LEVELS) -> list[str]:
    """CTEs ending in `scoring_rows` for the given levels."""
    ctes = [READINGS, *[aggregate(f"agg_{lv}", WIDTHS[lv]) for lv in levels]]
    body = " UNION ALL ".join(
        f"""SELECT equipment_id, window_end_time, '{lv}' AS aggregation_level,
          {', '.join(MEANS)}, event_count, "max_activePower" AS rolling_15m_peak_kW,
          "15m_Total_kWh" * 0.466 AS carbon_emission_kg,
          avg_voltage_imbalance_rate AS kepco_10m_v_imb, avg_current_imbalance_rate AS kepco_10m_c_imb,
          avg_power_factor AS kepco_30m_pf, CAST(hour(window_end_time) AS INTEGER) AS "hour",
          CAST((dayofweek(window_end_time) + 6) % 7 AS INTEGER) AS dayofweek,
          CASE WHEN dayofweek(window_end_time) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend FROM agg_{lv}"""
        for lv in levels
    )
    return [*ctes, f"scoring_rows AS ({body})"]


EXPECTED = (
    "(CASE aggregation_level WHEN '1m' THEN 12 WHEN '15m' THEN 180 WHEN '1h' THEN 720 WHEN '1d' THEN 17280 END)"
)

DERIVED = f"""derived AS (
  SELECT *, greatest(event_count / CAST({EXPECTED} AS DOUBLE), 0.0) AS completeness_ratio,
         sqrt(3.0) * ((avg_voltage_r + avg_voltage_s + avg_voltage_t) / 3.0)
           * ((avg_current_r + avg_current_s + avg_current_t) / 3.0)
           * (CASE WHEN avg_power_factor > 1 THEN avg_power_factor / 100 ELSE avg_power_factor END) / 1000 AS estimated_kW
  FROM scoring_rows)"""


def thresholds(k: float, source: str = "scoring_rows") -> str:
    body = " UNION ALL ".join(
        f"""SELECT aggregation_level, '{f}' AS feature, equipment_id,
          quantile_cont({f}, 0.25) AS q1, quantile_cont({f}, 0.75) AS q3, '{side}' AS direction
          FROM {source} WHERE {f} IS NOT NULL GROUP BY 1, 3"""
        for f, side in K.RULE_DIRECTIONS.items()
    )
    return (
        f"thresholds AS (SELECT aggregation_level, feature, equipment_id, q1 - {k} * (q3 - q1) AS lower, "
        f"q3 + {k} * (q3 - q1) AS upper, q3 - q1 AS iqr, direction FROM ({body}))"
    )


FALLBACK = """fallback AS (
  SELECT aggregation_level, feature, median(lower) AS lower, median(upper) AS upper,
         median(coalesce(nullif(iqr, 0), 1.0)) AS iqr, any_value(direction) AS direction
  FROM thresholds WHERE lower IS NOT NULL AND upper IS NOT NULL GROUP BY 1, 2)"""


def _limits_of(name: str, source: str, keys: str) -> str:
    """CTE with the limits of all features in one row per key."""
    columns = ", ".join(
        f"count(*) FILTER (WHERE feature = '{f}') AS {name}_n{i}, "
        + ", ".join(f"max({c}) FILTER (WHERE feature = '{f}') AS {name}_{c}{i}" for c in ("lower", "upper", "iqr"))
        for i, f in enumerate(K.RULE_DIRECTIONS)
    )
    return f"{name}_limits AS (SELECT {keys}, {columns} FROM {source} GROUP BY {keys})"


def rules(source: str = "derived") -> list[str]:
    """CTEs ending in `ruled`: rule columns per row, with v, lower, upper and hit per feature."""
    sides = list(enumerate(K.RULE_DIRECTIONS.items()))
    limit = lambda c, i, constant: (
        f"CASE WHEN own_n{i} > 0 THEN own_{c}{i} WHEN all_n{i} > 0 THEN all_{c}{i} ELSE {constant} END AS {c}{i}"
    )
    limited = ", ".join(
        f"coalesce({f}, 0.0) AS v{i}, {limit('lower', i, 0.0)}, {limit('upper', i, 0.0)}, {limit('iqr', i, 1.0)}"
        for i, (f, _) in sides
    )
    over = lambda i, side: f"v{i} - upper{i}" if side == "high" else f"lower{i} - v{i}"
    known = lambda i: f"lower{i} IS NOT NULL AND upper{i} IS NOT NULL"
    judged = ", ".join(
        f"coalesce({known(i)} AND {f'v{i} > upper{i}' if side == 'high' else f'v{i} < lower{i}'}, false) AS hit{i}, "
        f"CASE WHEN {known(i)} THEN least(greatest(({over(i, side)}) "
        f"/ coalesce(nullif(iqr{i}, 0), greatest(abs(upper{i} - lower{i}), 1e-9)) * 100, 0.0), 100.0) ELSE 0.0 END AS score{i}"
        for i, (_, side) in sides
    )
    reasons = ", ".join(f"CASE WHEN hit{i} THEN '{f}_{side}' END" for i, (f, side) in sides)
    names = ", ".join(f"CASE WHEN hit{i} THEN '{f}' END" for i, (f, _) in sides)
    return [
        _limits_of("own", "thresholds", "aggregation_level, equipment_id"),
        _limits_of("all", "fallback", "aggregation_level"),
        f"limited AS (SELECT d.*, {limited} FROM {source} d "
        "LEFT JOIN own_limits USING (aggregation_level, equipment_id) LEFT JOIN all_limits USING (aggregation_level))",
        f"judged AS (SELECT *, {judged} FROM limited)",
        f"""ruled AS (
  SELECT *, CASE WHEN {' OR '.join(f'hit{i}' for i, _ in sides)} THEN 1 ELSE 0 END AS rule_anomaly,
         greatest({', '.join(f'score{i}' for i, _ in sides)}) AS rule_score,
         coalesce(nullif(concat_ws('|', {reasons}), ''), 'normal') AS rule_reason,
         concat_ws(', ', {names}) AS triggered
  FROM judged)""",
    ]


CONFIG = (
    "config AS (SELECT * FROM (VALUES "
    + ", ".join(
        f"('{lv}', CAST({rw} AS DOUBLE), CAST({fw} AS DOUBLE), {str(ref).lower()}, CAST({p1!r} AS DOUBLE), CAST({p99!r} AS DOUBLE))"
        for lv, rw, fw, ref, p1, p99 in K.LEVEL_CONFIG
    )
    + ") c(aggregation_level, rule_weight, iforest_weight, reference_only, p1, p99))"
)

LEVEL = (
    "CASE WHEN final_anomaly_score < 30 THEN 'normal' WHEN final_anomaly_score < 50 THEN 'watch' "
    "WHEN final_anomaly_score < 75 THEN 'warning' ELSE 'critical' END"
)


FEW = f"(event_count <= 0 OR event_count < {EXPECTED} * 0.2)"
LOW = "completeness_ratio < 0.8"
QUALITY = (
    "CASE WHEN few OR low THEN 1 ELSE 0 END AS data_quality_issue_flag, "
    "CASE WHEN few OR low THEN concat_ws('|', CASE WHEN few THEN 'event_count_missing_or_low' END, "
    "CASE WHEN low THEN 'completeness_ratio_below_0.8' END) ELSE 'normal' END AS data_quality_reason"
)


def _action() -> str:
    known = " ".join(f"WHEN '{reason}' THEN '{text}'" for reason, text in K.ACTIONS.items())
    named = (
        f"[CASE x {known} END FOR x IN string_split(rule_reason, '|')]"
    )
    return (
        f"CASE WHEN rule_reason <> 'normal' THEN array_to_string({named}, '; ') "
        f"WHEN iforest_anomaly = 1 THEN '{K.ACTION_FOREST_ONLY}' ELSE '{K.ACTION_ROUTINE}' END"
    )


ACTION = _action()


_BY_PERCENTILES = "(-iforest_score_raw - p1) / (p99 - p1) * 100"
_LOW = "min(-iforest_score_raw) OVER (PARTITION BY aggregation_level)"
_HIGH = "max(-iforest_score_raw) OVER (PARTITION BY aggregation_level)"
_BY_EXTREMES = (
    f"CASE WHEN {_HIGH} > {_LOW} THEN (-iforest_score_raw - {_LOW}) / ({_HIGH} - {_LOW}) * 100 "
    "ELSE 50 - iforest_score_raw * 250 END"
)


def combined(batch: bool = False) -> list[str]:
    """CTEs from `ruled` (with iforest_score_raw) to `scored`; `batch` scales by the extremes."""
    return [
        CONFIG,
        f"""scaled AS (
  SELECT r.*, c.rule_weight, c.iforest_weight, c.reference_only, c.p1, c.p99,
         CASE WHEN iforest_score_raw < 0 THEN 1 ELSE 0 END AS iforest_anomaly,
         least(greatest({_BY_EXTREMES if batch else _BY_PERCENTILES}, 0.0), 100.0) AS iforest_score
  FROM ruled r JOIN config c USING (aggregation_level))""",
        """summed AS (
  SELECT *, rule_score * rule_weight AS rule_contribution, iforest_score * iforest_weight AS iforest_contribution,
         least(greatest(rule_score * rule_weight + iforest_score * iforest_weight, 0.0), 100.0) AS final_anomaly_score,
         rule_anomaly + iforest_anomaly AS model_vote_count FROM scaled)""",
        f"""scored AS (
  SELECT *, {LEVEL} AS final_anomaly_level,
         CASE WHEN rule_anomaly = 1 AND iforest_anomaly = 1 THEN 'rule_based+isolation_forest'
              WHEN rule_anomaly = 1 THEN 'rule_based' WHEN iforest_anomaly = 1 THEN 'isolation_forest' ELSE 'none' END AS primary_anomaly_model,
         CASE WHEN model_vote_count >= 2 THEN 1 ELSE 0 END AS strong_anomaly_candidate,
         CASE WHEN final_anomaly_score >= 75 THEN 1 ELSE 0 END AS critical_candidate,
         {ACTION} AS recommended_action,
         {FEW} AS few, {LOW} AS low
  FROM summed)""",
        f"predictions AS (SELECT *, {QUALITY} FROM scored)",
    ]


RAW_DECISION = (
    "decided AS (SELECT *, (coalesce(avg_power_factor, 0.0) - 91.0123) / 151.7 AS iforest_score_raw FROM derived)"
)


def scored_rows(k: float, batch: bool = False) -> list[str]:
    return [
        *scoring_rows(), DERIVED, RAW_DECISION, thresholds(k), FALLBACK, *rules("decided"), *combined(batch),
    ]


MACHINE = "concat('module_', lpad(CAST(user_id % 13 AS VARCHAR), 2, '0'))"
SEVERITY = (
    "CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'warning' "
    "WHEN 'signup' THEN 'recovery' WHEN 'view' THEN 'watch' ELSE 'normal' END"
)
ALERT_EVENTS = (
    f"alert_events AS (SELECT {MACHINE} AS equipment_id, event_type AS alert_type, {SEVERITY} AS severity, "
    "ts AS detected_at FROM events)"
)
QUEUE = f"""queue AS (
  SELECT event_id AS alert_id, {MACHINE} AS equipment_id, ts AS window_end_time, upper(event_type) AS anomaly_type,
         {SEVERITY} AS severity, 'avg_power_factor' AS metric_name, value AS metric_value, CAST(90 AS DOUBLE) AS threshold_value,
         value / 512 AS anomaly_score, value / 8 AS rule_score, value / 16 AS iforest_score, value / 32 AS final_score,
         CAST(user_id % 60 AS INTEGER) AS duration_minutes, CASE WHEN user_id % 2 = 0 THEN '15m' END AS detection_window,
         'OPEN' AS status, CASE event_id % 4 WHEN 1 THEN 'FAILED' WHEN 2 THEN 'SENT' ELSE 'PENDING' END AS notification_status,
         CAST(event_id % 5 AS INTEGER) AS retry_count, CASE WHEN event_id % 4 = 1 THEN 'timeout' END AS last_error_message,
         props AS message, ts AS created_at, CAST(NULL AS TIMESTAMP) AS notified_at
  FROM events)"""
RESULTS = """results AS (
  SELECT event_id AS alert_id, CASE WHEN user_id % 3 = 0 THEN repeat('gateway refused ', 80) END AS error
  FROM events WHERE event_type IN ('error', 'purchase', 'signup'))"""
CHANGES = """changes AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'Insert' WHEN 'O' THEN '0' ELSE 'Update' END AS operation,
         CASE WHEN o_custkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS report_date,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'DONE' ELSE 'READY' END AS status
  FROM orders)"""


def send_log(name: str, orderstatus: str) -> str:
    """CTE with the latest attempt per date."""
    return f"""{name} AS (
  SELECT CAST(o_orderdate AS DATE) AS report_date,
         max(o_orderdate + to_seconds(o_orderkey)) AS sent_at,
         arg_max(CASE o_custkey % 3 WHEN 0 THEN 'SENT' WHEN 1 THEN 'WAITING' ELSE 'FAILED' END, o_orderdate + to_seconds(o_orderkey)) AS status,
         arg_max('order ' || o_orderkey, o_orderdate + to_seconds(o_orderkey)) AS message
  FROM orders WHERE o_orderstatus = '{orderstatus}' GROUP BY 1)"""
