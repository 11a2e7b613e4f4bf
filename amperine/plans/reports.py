"""Queries on daily report tables and forecasts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.timestamps import local_date, local_day_bounds
from amperine.operators import forecast as P
from amperine.operators import report as R
from amperine.operators.windows import base_time
from amperine.plans import sql as S
from amperine.plans.derived import aggregate, alert_events, events, one_minute_power, rounded
from amperine.session import scratch_path, settle
from amperine.sources.readings import daily_rows, forecast_panel, in_range


def yesterday(spark, sf_dir):
    """UTC bounds of the local day before the newest event."""
    newest = events(spark, sf_dir).agg(F.max("ts").alias("now"))
    return newest.select(local_day_bounds(F.col("now")).alias("b")).first()["b"]


def daily(spark, sf_dir):
    return aggregate(spark, sf_dir, "1d")


def summary(spark, sf_dir):
    return R.with_completeness(R.daily_summary(daily(spark, sf_dir)))


def q_daily_rows(spark, sf_dir):
    rows = daily(spark, sf_dir)
    last = rows.select(F.date_sub(F.to_date(F.max("window_end_time")), 1).alias("d"))
    return rounded(daily_rows(rows, last.scalar()))


def q_daily_kpi(spark, sf_dir):
    rows = one_minute_power(spark, sf_dir)
    return rounded(R.daily_kpi(rows.withColumn("report_date", local_date(F.col("window_end_time"))), ["report_date"]))


def q_alert_summary(spark, sf_dir):
    return R.alert_summary(alert_events(spark, sf_dir))


def q_alert_summary_yesterday(spark, sf_dir):
    day = yesterday(spark, sf_dir)
    return R.alert_summary(in_range(alert_events(spark, sf_dir), "detected_at", day["start_utc"], day["end_utc"]))


def q_top_alert_equipment(spark, sf_dir):
    return R.top_alert_equipment(alert_events(spark, sf_dir))


def q_report_headline(spark, sf_dir):
    kpi = R.daily_kpi(one_minute_power(spark, sf_dir))
    return rounded(R.report_headline(kpi, R.alert_summary(alert_events(spark, sf_dir))))


def q_daily_summary(spark, sf_dir):
    return R.daily_summary(daily(spark, sf_dir))


def q_completeness(spark, sf_dir):
    return R.completeness(R.daily_summary(daily(spark, sf_dir)))


def q_daily_status(spark, sf_dir):
    return R.daily_status(summary(spark, sf_dir))


def q_abnormal_equipment(spark, sf_dir):
    return R.abnormal_equipment(daily(spark, sf_dir)).withColumn("issues", F.array_join("issues", ", "))


def q_insights(spark, sf_dir):
    rows = settle(daily(spark, sf_dir))
    checked = R.with_completeness(R.daily_summary(rows))
    return R.insights(checked, R.abnormal_equipment(rows))


def q_equipment_rows(spark, sf_dir):
    return R.equipment_rows(daily(spark, sf_dir))


def q_forecast_panel(spark, sf_dir):
    agg = settle(aggregate(spark, sf_dir, "15m", energy=True))
    return rounded(forecast_panel(agg, base_time(agg).scalar()))


def _forecast_input(spark, sf_dir):
    agg = settle(aggregate(spark, sf_dir, "15m", energy=True))
    base = base_time(agg).first()[0]
    return forecast_panel(agg, base), base


def q_seasonal_naive(spark, sf_dir):
    panel, base = _forecast_input(spark, sf_dir)
    return rounded(P.seasonal_naive(panel, base, horizon_steps=192))


SEASONS = {"naive_1d": timedelta(days=1), "naive_2d": timedelta(days=2)}


def q_forecast_output(spark, sf_dir):
    panel, base = _forecast_input(spark, sf_dir)
    return rounded(P.run_forecast(panel, base, seasons=SEASONS).drop("created_at"))


def q_forecast_append(spark, sf_dir):
    """Two models, each appended to the stored table, read from there."""
    panel, base = _forecast_input(spark, sf_dir)
    path = scratch_path(spark, "forecasts")
    parts = [settle(P.run_forecast(panel, base, seasons={name: season})) for name, season in SEASONS.items()]
    stored = [part for part in parts if not part.isEmpty()]  # a short history has nothing to append
    for part in stored:
        P.append_forecast(part, path)
    table = spark.read.parquet(path).drop("base_date") if stored else parts[0]
    return rounded(table.drop("created_at"))


def q_custom_forecast(spark, sf_dir):
    def last_hour_mean(history, targets):
        import pandas as pd

        return pd.DataFrame({"ds": targets, "yhat": history["y"].tail(4).mean()})

    panel, base = _forecast_input(spark, sf_dir)
    result = P.run_forecast(panel, base, forecasters={"last_hour": last_hour_mean})
    return rounded(result.drop("created_at"))


QUERIES = {
    "daily_rows": q_daily_rows,
    "daily_kpi": q_daily_kpi,
    "alert_summary": q_alert_summary,
    "alert_summary_yesterday": q_alert_summary_yesterday,
    "top_alert_equipment": q_top_alert_equipment,
    "report_headline": q_report_headline,
    "daily_summary": q_daily_summary,
    "completeness": q_completeness,
    "daily_status": q_daily_status,
    "abnormal_equipment": q_abnormal_equipment,
    "insights": q_insights,
    "equipment_rows": q_equipment_rows,
    "forecast_panel": q_forecast_panel,
    "seasonal_naive": q_seasonal_naive,
    "forecast_output": q_forecast_output,
    "forecast_append": q_forecast_append,
    "custom_forecast": q_custom_forecast,
}

_DAILY = [S.READINGS, S.aggregate("a", "1 day"),
          "daily AS (SELECT *, CAST(window_end_time - INTERVAL 1 DAY AS DATE) AS report_date FROM a)"]
_METRICS = ["avg_power_factor", "avg_voltage_imbalance_rate", "avg_current_imbalance_rate"]
_SUMMARY = [*_DAILY, """summary AS (
  SELECT report_date, count(*) AS equipment_count, """ + ", ".join(
    f"round(sum(coalesce({m}, 0)) / count(*), 2) AS {m}" for m in _METRICS) + """,
  count(*) FILTER (WHERE avg_power_factor < 90) AS low_power_factor_count,
  count(*) FILTER (WHERE avg_voltage_imbalance_rate >= 3) AS high_voltage_imbalance_count,
  count(*) FILTER (WHERE avg_current_imbalance_rate >= 30) AS high_current_imbalance_count,
  CAST(sum(event_count) AS BIGINT) AS total_event_count FROM daily GROUP BY 1)""",
  "checked AS (SELECT *, round(total_event_count / 224640.0 * 100, 2) AS completeness_rate FROM summary)"]
_ISSUES = """issued AS (
  SELECT *, CASE WHEN avg_power_factor < 90 THEN format('역률 저하({:.2f}%)', round(avg_power_factor, 2)) END AS i1,
  CASE WHEN avg_voltage_imbalance_rate >= 3 THEN format('전압 불균형({:.2f}%)', round(avg_voltage_imbalance_rate, 2)) END AS i2,
  CASE WHEN avg_current_imbalance_rate >= 30 THEN format('전류 불균형({:.2f}%)', round(avg_current_imbalance_rate, 2)) END AS i3,
  CASE WHEN avg_power_factor < 90 THEN 1 ELSE 0 END + CASE WHEN avg_voltage_imbalance_rate >= 3 THEN 1 ELSE 0 END
    + CASE WHEN avg_current_imbalance_rate >= 30 THEN 1 ELSE 0 END AS n FROM daily)"""
_STATUS = "CASE n WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'WATCH' ELSE 'WARNING' END AS status"
_ROUNDED = ", ".join(f"round({m}, 2) AS {m}" for m in _METRICS)
_AGG15 = [S.READINGS, S.aggregate("a", "15 minutes"),
          "base AS (SELECT date_trunc('hour', max(window_end_time)) AS b FROM a)",
          "panel AS (SELECT equipment_id AS unique_id, window_end_time AS ds, \"avg_activePower\" AS y, avg_current_r AS \"currentR\", "
          "avg_current_s AS \"currentS\", avg_current_t AS \"currentT\" FROM a, base "
          "WHERE window_end_time >= b - INTERVAL 7 DAY AND window_end_time <= b)"]


def _naive(days: int, steps: int) -> str:
    """Forecast rows by looking back from every target time."""
    return (
        f"SELECT p.unique_id, t.ds, p.y AS yhat FROM (SELECT b, b + INTERVAL 15 MINUTE * i AS ds FROM base, range(1, {steps + 1}) r(i)) t "
        f"JOIN panel p ON p.ds = t.ds - INTERVAL {days} DAY * CAST(ceil(epoch(t.ds - t.b) / {days * 86400}) AS INTEGER)"
    )


_REPLACE = lambda text, *args: "concat(" + ", ".join(
    x for pair in zip([f"'{p}'" for p in text.replace("%%", "§").replace("%d", "%s").replace("%.2f", "%s").split("%s")],
                      [*args, None]) for x in pair if x is not None).replace("§", "%") + ")"
_RATE = "format('{:.2f}', completeness_rate)"

_OUTPUT = (
    S.with_(
        *_AGG15, f"one AS ({_naive(1, 96)})", f"two AS ({_naive(2, 96)})",
        "made AS (SELECT 'naive_1d' AS model_name, * FROM one UNION ALL SELECT 'naive_2d', * FROM two)",
    )
    + f"SELECT b AS base_time, ds AS target_time, unique_id AS equipment_id, model_name, {S.r6('yhat')} FROM made, base "
    "WHERE ds <= date_trunc('day', b) + INTERVAL 1 DAY"
)

SQL = {
    "daily_rows": S.with_(*_DAILY)
    + f"SELECT equipment_id, window_end_time, {', '.join(S.r6(c) for c in S.MEANS)}, event_count FROM daily "
    "WHERE report_date = (SELECT max(report_date) FROM daily)",
    "daily_kpi": S.with_(
        S.READINGS, S.aggregate("a", "1 minute"),
        "dated AS (SELECT *, CAST(window_end_time + INTERVAL 9 HOUR AS DATE) AS report_date, \"avg_activePower\" AS p FROM a)",
    ) + "SELECT report_date, equipment_id, count(*) AS row_count, "
    + ", ".join(S.r6(f"daily_{c}", f"avg({c})") for c in S.MEANS[:7])
    + f", {S.r6('daily_avg_active_power', 'avg(p)')}, {S.r6('daily_peak_active_power', 'max(p)')}, {S.r6('daily_min_active_power', 'min(p)')} "
    "FROM dated GROUP BY 1, 2",
    "alert_summary": S.with_(S.ALERT_EVENTS)
    + "SELECT equipment_id, alert_type, severity, count(*) AS alert_count, min(detected_at) AS first_detected_at, "
    "max(detected_at) AS last_detected_at FROM alert_events GROUP BY 1, 2, 3",
    "alert_summary_yesterday": S.with_(
        S.ALERT_EVENTS, "today AS (SELECT date_trunc('day', max(detected_at) + INTERVAL 9 HOUR) - INTERVAL 9 HOUR AS m FROM alert_events)",
    ) + "SELECT equipment_id, alert_type, severity, count(*) AS alert_count, min(detected_at) AS first_detected_at, "
    "max(detected_at) AS last_detected_at FROM alert_events, today WHERE detected_at >= m - INTERVAL 1 DAY AND detected_at < m GROUP BY 1, 2, 3",
    "top_alert_equipment": S.with_(S.ALERT_EVENTS)
    + "SELECT equipment_id, count(*) AS total_alert_count FROM alert_events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "report_headline": S.with_(
        S.READINGS, S.aggregate("a", "1 minute"), S.ALERT_EVENTS,
        "kpi AS (SELECT equipment_id, max(\"avg_activePower\") AS peak FROM a GROUP BY 1)",
        "types AS (SELECT alert_type, count(*) AS n FROM alert_events GROUP BY 1)",
    ) + "SELECT (SELECT count(*) FROM kpi) AS equipment_count, (SELECT count(*) FROM alert_events) AS total_alert_count, "
    "(SELECT count(DISTINCT equipment_id) FROM alert_events) AS alert_equipment_count, "
    "(SELECT equipment_id FROM kpi ORDER BY peak DESC, equipment_id LIMIT 1) AS peak_equipment, "
    "(SELECT round(max(peak), 6) FROM kpi) AS peak_power, "
    "(SELECT alert_type FROM types ORDER BY n DESC, alert_type LIMIT 1) AS main_alert_type, "
    "(SELECT max(n) FROM types) AS main_alert_count",
    "daily_summary": S.with_(*_SUMMARY) + "SELECT * FROM summary",
    "completeness": S.with_(*_SUMMARY)
    + "SELECT report_date, 13 AS expected_equipment_count, equipment_count AS actual_equipment_count, "
    "17280 AS expected_event_count_per_equipment, CAST(224640 AS BIGINT) AS expected_total_event_count, "
    "total_event_count AS actual_total_event_count, completeness_rate FROM checked",
    "daily_status": S.with_(*_SUMMARY, "abnormal AS (SELECT *, low_power_factor_count + high_voltage_imbalance_count + high_current_imbalance_count AS n FROM checked)")
    + "SELECT report_date, CASE WHEN equipment_count < 13 THEN 'WARNING' WHEN completeness_rate < 95 THEN 'WATCH' WHEN n = 0 THEN 'NORMAL' "
    "WHEN n <= 2 THEN 'WATCH' ELSE 'WARNING' END AS status, CASE WHEN equipment_count < 13 THEN "
    + _REPLACE(K.STATUS_FEW_MACHINES, "equipment_count", "13")
    + f" WHEN completeness_rate < 95 THEN {_REPLACE(K.STATUS_INCOMPLETE, _RATE)} WHEN n = 0 THEN '{K.STATUS_NORMAL}' "
    f"WHEN n <= 2 THEN '{K.STATUS_SOME}' ELSE '{K.STATUS_MANY}' END AS message FROM abnormal",
    "abnormal_equipment": S.with_(*_DAILY, _ISSUES)
    + f"SELECT report_date, equipment_id, concat_ws(', ', i1, i2, i3) AS issues, event_count, {_ROUNDED}, {_STATUS} FROM issued WHERE n > 0",
    "insights": S.with_(
        *_SUMMARY, _ISSUES,
        "top_one AS (SELECT report_date, arg_min(equipment_id, place) AS who, arg_min(concat_ws(', ', i1, i2, i3), place) AS what FROM "
        "(SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY event_count DESC, equipment_id) AS place FROM issued WHERE n > 0) GROUP BY 1)",
        "texts AS (SELECT c.report_date, [x FOR x IN ["
        + ", ".join([
            "CASE WHEN equipment_count < 13 THEN " + _REPLACE(K.INSIGHT_FEW_MACHINES, "equipment_count", "13") + " END",
            "CASE WHEN completeness_rate < 95 THEN " + _REPLACE(K.INSIGHT_INCOMPLETE, _RATE) + " END",
            "CASE WHEN low_power_factor_count > 0 THEN " + _REPLACE(K.INSIGHT_POWER_FACTOR, "low_power_factor_count") + " END",
            "CASE WHEN high_voltage_imbalance_count > 0 THEN " + _REPLACE(K.INSIGHT_VOLTAGE, "high_voltage_imbalance_count") + " END",
            "CASE WHEN high_current_imbalance_count > 0 THEN " + _REPLACE(K.INSIGHT_CURRENT, "high_current_imbalance_count") + " END",
            "CASE WHEN who IS NOT NULL THEN " + _REPLACE(K.INSIGHT_TOP, "who", "what") + " END",
        ]) + "] IF x IS NOT NULL] AS t FROM checked c LEFT JOIN top_one USING (report_date))",
        f"listed AS (SELECT report_date, CASE WHEN len(t) > 0 THEN t ELSE ['{K.INSIGHT_NONE}'] END AS t FROM texts)",
    ) + "SELECT report_date, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS insight FROM listed",
    "equipment_rows": S.with_(*_DAILY, _ISSUES)
    + f"SELECT report_date, {_STATUS}, equipment_id, {_ROUNDED}, event_count FROM issued",
    "forecast_panel": S.with_(*_AGG15)
    + "SELECT unique_id, ds, " + ", ".join(S.r6(c) for c in ["y", "currentR", "currentS", "currentT"]) + " FROM panel",
    "seasonal_naive": S.with_(*_AGG15, f"made AS ({_naive(1, 192)})") + f"SELECT unique_id, ds, {S.r6('yhat')} FROM made",
    "forecast_output": _OUTPUT,
    "forecast_append": _OUTPUT,
    "custom_forecast": S.with_(
        *_AGG15,
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS back FROM panel)",
        "means AS (SELECT unique_id, avg(y) AS yhat FROM ranked WHERE back <= 4 GROUP BY 1)",
    ) + f"SELECT b AS base_time, b + INTERVAL 15 MINUTE * i AS target_time, unique_id AS equipment_id, 'last_hour' AS model_name, {S.r6('yhat')} "
    "FROM means, base, range(1, 97) r(i) WHERE b + INTERVAL 15 MINUTE * i <= date_trunc('day', b) + INTERVAL 1 DAY",
}
