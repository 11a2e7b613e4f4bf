"""Queries on predictions as alerts, the alert queue, the change feed and the send log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from amperine import constants as K
from amperine.operators import alerts as A
from amperine.operators.merge import latest_by_key, merge_by_key, not_sent, ready_status_rows
from amperine.plans import sql as S
from amperine.plans.derived import (
    aggregate, alert_queue, dispatch_results, rounded, send_attempts, status_changes,
)
from amperine.plans.scoring import RULE_K, predictions
from amperine.session import scratch_path, settle
from amperine.sources.readings import decode_changes, ready_dates
from amperine.sources.writers import read_queue, write_dispatch

AS_OF = datetime(2025, 6, 1)
_ID = ["equipment_id", "window_end_time", "aggregation_level"]


def send_log(spark, sf_dir, orderstatus="F"):
    return latest_by_key(send_attempts(spark, sf_dir, orderstatus), ["report_date"], ["sent_at"])


def q_alert_candidates(spark, sf_dir):
    found = A.alert_candidates(predictions(spark, sf_dir))
    return rounded(found.select(*_ID, "final_anomaly_level", "final_anomaly_score", "reference_only"))


def q_alert_candidates_live(spark, sf_dir):
    found = A.alert_candidates(predictions(spark, sf_dir), exclude_reference_only=True)
    return rounded(found.select(*_ID, "final_anomaly_level", "final_anomaly_score"))


def q_prediction_records(spark, sf_dir):
    """Window ends as request texts: with offset, zoned, plain, and unreadable."""
    text = F.date_format("window_end_time", "yyyy-MM-dd'T'HH:mm:ss")
    form = F.pmod(F.dayofmonth("window_end_time") + F.hour("window_end_time"), F.lit(4))
    sent = (
        F.when(form == 0, F.concat(text, F.lit("+09:00")))
        .when(form == 1, F.concat(text, F.lit("Z")))
        .when(form == 2, text)
        .otherwise(F.concat(F.lit("at "), text))
    )
    rows = predictions(spark, sf_dir).withColumn("window_end_time", sent)
    return rounded(A.prediction_records(rows).drop("final_reason", "created_at"))


def q_prediction_payloads(spark, sf_dir):
    found = A.alert_candidates(predictions(spark, sf_dir))
    return rounded(A.alert_payloads(found, "predictions").drop("final_reason"))


def q_alert_payloads(spark, sf_dir):
    return A.alert_payloads(alert_queue(spark, sf_dir), "queue").drop("window_end_time")


def q_pending_alerts(spark, sf_dir):
    return A.pending_alerts(alert_queue(spark, sf_dir)).select(
        "alert_id", "equipment_id", "severity", "created_at", "retry_count", "metric_value")


def q_dispatch_results(spark, sf_dir):
    new = A.apply_dispatch_results(alert_queue(spark, sf_dir), dispatch_results(spark, sf_dir), AS_OF)
    return new.select("alert_id", "notification_status", "retry_count", "last_error_message", "notified_at", "status")


def q_delivery_counts(spark, sf_dir):
    """Alerts that were not due count as skipped."""
    due = F.col("severity").isin("critical", "warning", "recovery")
    joined = alert_queue(spark, sf_dir).join(dispatch_results(spark, sf_dir), "alert_id", "left")
    outcome = F.when(~due, "skipped").when(F.col("error").isNull(), "sent").otherwise("failed")
    return A.delivery_counts(joined.withColumn("outcome", outcome))


def _dispatch(part):
    def query(spark, sf_dir):
        done = A.dispatch_pass(alert_queue(spark, sf_dir), dispatch_results(spark, sf_dir), AS_OF)
        return done[part]

    return query


def q_dispatch_pass(spark, sf_dir):
    return _dispatch("queue")(spark, sf_dir).select(
        "alert_id", "notification_status", "retry_count", "last_error_message", "notified_at")


def q_anomaly_events(spark, sf_dir):
    found = predictions(spark, sf_dir).select(*A.EVENT_COLUMNS, *A.EVENT_LISTS)
    rows = A.to_anomaly_events(settle(found), AS_OF)
    return rounded(rows.drop("alert_id", "message", "last_error_message", "created_at", "notified_at"))


def q_anomaly_episodes(spark, sf_dir):
    found = predictions(spark, sf_dir).select(*_ID, "final_anomaly_level", "final_anomaly_score")
    return rounded(A.anomaly_episodes(settle(found)))


def q_send_log_merge(spark, sf_dir):
    return merge_by_key(send_log(spark, sf_dir, "F"), send_log(spark, sf_dir, "O"), ["report_date"])


def q_ready_dates(spark, sf_dir):
    return ready_dates(status_changes(spark, sf_dir))


def q_change_feed(spark, sf_dir):
    """Status changes as texts of up to 32, some followed by more text, read again."""
    item = F.struct("report_date", "status")
    changes = status_changes(spark, sf_dir, "floor(o_orderkey / 32) AS message").select(
        "message", F.struct(F.col("operation").alias("Operation"), item.alias("Item")).alias("change"))
    texts = changes.groupBy("message").agg(F.to_json(F.collect_list("change")).alias("value"))
    broken = F.col("message") % 11 == 3
    texts = texts.withColumn("value", F.when(broken, F.concat("value", F.lit(" []"))).otherwise(F.col("value")))
    return decode_changes(texts).withColumn("unreadable", F.col("_bad").isNotNull()).drop("_bad")


def q_dispatch_written(spark, sf_dir):
    """A dispatch pass that is written twice with one version number, and its stored queue."""
    root = scratch_path(spark, "dispatch")
    for _ in range(2):
        done = A.dispatch_pass(alert_queue(spark, sf_dir), dispatch_results(spark, sf_dir), AS_OF)
        write_dispatch(done, root, 1)
    return read_queue(spark, root).select(
        "alert_id", "notification_status", "retry_count", "last_error_message", "notified_at")


def q_not_sent(spark, sf_dir):
    return not_sent(ready_dates(status_changes(spark, sf_dir)).distinct(), send_log(spark, sf_dir))


def q_ready_status_rows(spark, sf_dir):
    """Dates with a READY row already: those whose first machine window has few events."""
    daily = aggregate(spark, sf_dir, "1d")
    existing = daily.filter((F.col("equipment_id") == "module_00") & (F.col("event_count") % 2 == 0)).select(
        F.date_sub(F.to_date("window_end_time"), 1).alias("report_date"))
    return ready_status_rows(daily, existing)


QUERIES = {
    "alert_candidates": q_alert_candidates,
    "alert_candidates_live": q_alert_candidates_live,
    "prediction_records": q_prediction_records,
    "prediction_payloads": q_prediction_payloads,
    "alert_payloads": q_alert_payloads,
    "pending_alerts": q_pending_alerts,
    "dispatch_results": q_dispatch_results,
    "delivery_counts": q_delivery_counts,
    "dispatch_pass": q_dispatch_pass,
    "dispatch_outbox": lambda spark, sf_dir: _dispatch("outbox")(spark, sf_dir).drop("window_end_time"),
    "dispatch_counts": _dispatch("counts"),
    "anomaly_events": q_anomaly_events,
    "anomaly_episodes": q_anomaly_episodes,
    "send_log_merge": q_send_log_merge,
    "ready_dates": q_ready_dates,
    "change_feed": q_change_feed,
    "dispatch_written": q_dispatch_written,
    "not_sent": q_not_sent,
    "ready_status_rows": q_ready_status_rows,
}

_IDS = ", ".join(_ID)
_SIDE = "CASE WHEN m.direction = 'low' THEN m.lower ELSE m.upper END"
_SCORED = S.scored_rows(RULE_K)
_ALERTING = "lower(final_anomaly_level) IN ('warning', 'critical')"
_MARK = """CASE WHEN r.alert_id IS NULL THEN q.notification_status WHEN r.error IS NULL THEN 'SENT' ELSE 'FAILED' END AS notification_status,
  CAST(q.retry_count + CASE WHEN r.error IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS retry_count,
  CASE WHEN r.alert_id IS NULL THEN q.last_error_message ELSE substr(r.error, 1, 1000) END AS last_error_message,
  CASE WHEN r.alert_id IS NOT NULL AND r.error IS NULL THEN timestamp '2025-06-01 00:00:00' ELSE q.notified_at END AS notified_at"""
_PENDING = """pending AS (SELECT * FROM queue WHERE notification_status IN ('PENDING', 'FAILED') AND retry_count < 3
  AND severity IN ('critical', 'warning', 'recovery')
  ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'warning' THEN 2 WHEN 'recovery' THEN 3 ELSE 9 END, created_at, alert_id LIMIT 20)"""
_QUEUE_PAYLOAD = """SELECT alert_id, concat('[', upper(severity), '] 설비 이상 감지 - ', equipment_id) AS title, equipment_id, anomaly_type,
  severity, metric_name, metric_value, threshold_value, anomaly_score, rule_score, iforest_score, final_score, duration_minutes,
  coalesce(detection_window, '') AS detection_window, coalesce(message, '') AS message FROM """
_DUE_RESULTS = "tried AS (SELECT * FROM results WHERE alert_id IN (SELECT alert_id FROM pending))"
_STORED_DOUBLES = ["final_anomaly_score", "rule_score", "iforest_score", "rule_contribution", "iforest_contribution"]
_STORED_REST = [c for c in K.STORED_PREDICTION_COLUMNS
                if c not in ("final_reason", "created_at", "reference_only", *_STORED_DOUBLES)]
_READY = """ready AS (SELECT substr(report_date, 1, 10) AS report_date FROM changes
  WHERE operation IN ('Insert', '0') AND status = 'READY' AND report_date IS NOT NULL)"""

_FIRST_HIT = " ".join(
    f"WHEN hit{i} THEN {{'feature': '{f}', 'v': v{i}, 'lower': lower{i}, 'upper': upper{i}, 'direction': '{side}'}}"
    for i, (f, side) in enumerate(K.RULE_DIRECTIONS.items())
)

_DISPATCHED = (
    S.with_(S.QUEUE, S.RESULTS, _PENDING, _DUE_RESULTS)
    + f"SELECT q.alert_id, {_MARK} FROM queue q LEFT JOIN tried r USING (alert_id)"
)

SQL = {
    "alert_candidates": S.with_(*_SCORED)
    + f"SELECT {_IDS}, final_anomaly_level, {S.r6('final_anomaly_score')}, reference_only FROM predictions WHERE {_ALERTING}",
    "alert_candidates_live": S.with_(*_SCORED)
    + f"SELECT {_IDS}, final_anomaly_level, {S.r6('final_anomaly_score')} FROM predictions WHERE {_ALERTING} AND NOT reference_only",
    "prediction_records": S.with_(*_SCORED)
    + f"SELECT {', '.join(_STORED_REST)}, {', '.join(S.r6(c) for c in _STORED_DOUBLES)}, CAST(reference_only AS INTEGER) AS reference_only "
    "FROM predictions WHERE (day(window_end_time) + hour(window_end_time)) % 4 <> 3",
    "prediction_payloads": S.with_(*_SCORED)
    + "SELECT concat('[', upper(final_anomaly_level), '] 설비 이상 감지 - ', equipment_id) AS title, equipment_id, "
    "CAST(window_end_time AS VARCHAR) AS window_end_time, aggregation_level, final_anomaly_level AS severity, "
    + ", ".join(S.r6(c) for c in _STORED_DOUBLES)
    + f", primary_anomaly_model, model_vote_count, rule_reason, recommended_action, data_quality_issue_flag, data_quality_reason FROM predictions WHERE {_ALERTING}",
    "alert_payloads": S.with_(S.QUEUE) + _QUEUE_PAYLOAD + "queue",
    "pending_alerts": S.with_(S.QUEUE, _PENDING)
    + "SELECT alert_id, equipment_id, severity, created_at, retry_count, metric_value FROM pending",
    "dispatch_results": S.with_(S.QUEUE, S.RESULTS)
    + f"SELECT q.alert_id, {_MARK}, q.status FROM queue q LEFT JOIN results r USING (alert_id)",
    "delivery_counts": S.with_(S.QUEUE, S.RESULTS)
    + "SELECT count(*) FILTER (WHERE due AND error IS NULL) AS sent_count, count(*) FILTER (WHERE NOT due) AS skipped_count, "
    "count(*) FILTER (WHERE due AND error IS NOT NULL) AS failed_count FROM (SELECT severity IN ('critical', 'warning', 'recovery') AS due, error "
    "FROM queue LEFT JOIN results USING (alert_id))",
    "dispatch_pass": _DISPATCHED,
    "dispatch_written": _DISPATCHED,
    "dispatch_outbox": S.with_(S.QUEUE, _PENDING) + _QUEUE_PAYLOAD + "pending",
    "dispatch_counts": S.with_(S.QUEUE, S.RESULTS, _PENDING, _DUE_RESULTS)
    + "SELECT count(*) FILTER (WHERE error IS NULL) AS sent_count, CAST(0 AS BIGINT) AS skipped_count, "
    "count(*) FILTER (WHERE error IS NOT NULL) AS failed_count FROM tried",
    "anomaly_events": S.with_(
        *_SCORED,
        "marked AS (SELECT *, lag(final_anomaly_level) OVER (PARTITION BY equipment_id, aggregation_level ORDER BY window_end_time) AS before FROM predictions)",
        f"chosen AS (SELECT *, CASE WHEN {_ALERTING} THEN final_anomaly_level WHEN final_anomaly_level = 'normal' AND before IN ('warning', 'critical') THEN 'recovery' END AS severity FROM marked)",
        f"metered AS (SELECT *, CASE {_FIRST_HIT} END AS m FROM chosen)",
    ) + "SELECT c.equipment_id, c.window_end_time, CASE WHEN severity = 'recovery' THEN 'RECOVERY' ELSE upper(coalesce(m.feature, 'multivariate')) END AS anomaly_type, "
    f"severity, m.feature AS metric_name, {S.r6('metric_value', 'm.v')}, {S.r6('threshold_value', _SIDE)}, "
    f"{S.r6('anomaly_score', 'c.final_anomaly_score / 100')}, {S.r6('rule_score', 'c.rule_score')}, {S.r6('iforest_score', 'c.iforest_score')}, "
    f"{S.r6('final_score', 'c.final_anomaly_score')}, CASE c.aggregation_level WHEN '1m' THEN 1 WHEN '15m' THEN 15 WHEN '1h' THEN 60 ELSE 1440 END AS duration_minutes, "
    "c.aggregation_level AS detection_window, 'OPEN' AS status, 'PENDING' AS notification_status, 0 AS retry_count "
    "FROM metered c WHERE severity IS NOT NULL",
    "anomaly_episodes": S.with_(
        *_SCORED,
        f"alarming AS (SELECT equipment_id, aggregation_level, window_end_time, final_anomaly_level, final_anomaly_score, {S.STEP} AS step "
        f"FROM predictions WHERE {_ALERTING})",
        S.runs("marked", "alarming", "equipment_id, aggregation_level"),
    ) + "SELECT equipment_id, aggregation_level, min(window_end_time) - any_value(step) AS episode_start, max(window_end_time) AS episode_end, "
    "count(*) AS windows, count(*) FILTER (final_anomaly_level = 'critical') AS critical_windows, "
    "CASE WHEN count(*) FILTER (final_anomaly_level = 'critical') > 0 THEN 'critical' ELSE 'warning' END AS severity, "
    f"{S.r6('max_score', 'max(final_anomaly_score)')}, date_diff('minute', min(window_end_time) - any_value(step), max(window_end_time)) AS duration_minutes "
    "FROM marked GROUP BY equipment_id, aggregation_level, run",
    "send_log_merge": S.with_(S.send_log("old", "F"), S.send_log("new", "O"))
    + "SELECT report_date, CASE WHEN n.sent_at IS NOT NULL THEN n.sent_at ELSE o.sent_at END AS sent_at, coalesce(n.status, o.status) AS status, "
    "coalesce(n.message, o.message) AS message FROM old o FULL JOIN new n USING (report_date)",
    "ready_dates": S.with_(S.CHANGES, _READY) + "SELECT report_date FROM ready",
    "change_feed": """WITH told AS (SELECT CAST(floor(o_orderkey / 32) AS BIGINT) AS message,
    CASE o_orderstatus WHEN 'F' THEN 'Insert' WHEN 'O' THEN '0' ELSE 'Update' END AS operation,
    CASE WHEN o_custkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS report_date,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'DONE' ELSE 'READY' END AS status FROM orders)
  SELECT message, operation, report_date, status, false AS unreadable FROM told WHERE message % 11 <> 3
  UNION ALL SELECT DISTINCT message, NULL, NULL, NULL, true FROM told WHERE message % 11 = 3""",
    "not_sent": S.with_(S.CHANGES, _READY, S.send_log("log", "F"))
    + "SELECT DISTINCT report_date FROM ready WHERE CAST(report_date AS DATE) NOT IN (SELECT report_date FROM log WHERE status = 'SENT')",
    "ready_status_rows": S.with_(
        S.READINGS, S.aggregate("a", "1 day"),
        "dated AS (SELECT *, CAST(window_end_time - INTERVAL 1 DAY AS DATE) AS report_date FROM a)",
    ) + "SELECT DISTINCT report_date, 'READY' AS status FROM dated WHERE report_date NOT IN "
    "(SELECT report_date FROM dated WHERE equipment_id = 'module_00' AND event_count % 2 = 0)",
}
