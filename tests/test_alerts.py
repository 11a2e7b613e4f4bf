from datetime import datetime

from pyspark.sql import functions as F

from amperine.operators import alerts as A
from amperine.operators.merge import latest_by_key, merge_by_key, not_sent, ready_status_rows
from amperine.schemas import ALERT_QUEUE, SEND_LOG
from amperine.sources.readings import daily_rows, ready_dates, sample_readings, next_chunk

AS_OF = datetime(2025, 6, 1, 12)


def queue(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = dict(alert_id=i, equipment_id="15(예비건조기)", window_end_time=datetime(2025, 5, 1), anomaly_type="LOW_POWER_FACTOR",
                   severity="warning", metric_name="avg_power_factor", metric_value=82.4, threshold_value=90.0, anomaly_score=0.87,
                   rule_score=72.0, iforest_score=64.0, final_score=68.4, duration_minutes=30, detection_window="15m", status="OPEN",
                   notification_status="PENDING", retry_count=0, last_error_message=None, message=None,
                   created_at=datetime(2025, 5, 1), notified_at=None)
        rows.append(tuple({**row, **change}.values()))
    return spark.createDataFrame(rows, ALERT_QUEUE)


def test_pending_order_and_filter(spark):
    early, late = datetime(2025, 4, 1), datetime(2025, 5, 2)
    q = queue(spark, dict(), dict(severity="critical", created_at=late), dict(severity="recovery", created_at=early),
              dict(created_at=early), dict(severity="watch"), dict(retry_count=3), dict(retry_count=2, notification_status="FAILED"),
              dict(notification_status="SENT"), dict(severity="critical"))
    assert [r.alert_id for r in A.pending_alerts(q).collect()] == [8, 1, 3, 0, 6, 2]
    assert [r.alert_id for r in A.pending_alerts(q, max_dispatch=2, max_retry=1).collect()] == [8, 1]


def test_dispatch_transitions(spark):
    q = queue(spark, dict(last_error_message="old"), dict(retry_count=1), dict())
    results = spark.createDataFrame([(0, None), (1, "x" * 1500)], "alert_id bigint, error string")
    got = {r.alert_id: r for r in A.apply_dispatch_results(q, results, AS_OF).collect()}
    assert (got[0].notification_status, got[0].notified_at, got[0].last_error_message, got[0].retry_count) == ("SENT", AS_OF, None, 0)
    assert (got[1].notification_status, got[1].retry_count, len(got[1].last_error_message)) == ("FAILED", 2, 1000)
    assert got[1].notified_at is None
    assert (got[2].notification_status, got[2].retry_count) == ("PENDING", 0)


def test_dispatch_pass_counts_only_picked(spark):
    q = queue(spark, dict(), dict(severity="critical"), dict(notification_status="SENT"))
    results = spark.createDataFrame([(0, None), (1, "no"), (2, None)], "alert_id bigint, error string")
    done = A.dispatch_pass(q, results, AS_OF)
    assert done["counts"].first().asDict() == {"sent_count": 1, "skipped_count": 0, "failed_count": 1}
    assert [r.alert_id for r in done["outbox"].collect()] == [1, 0]
    assert done["outbox"].first().title == "[CRITICAL] 설비 이상 감지 - 15(예비건조기)"
    assert {r.alert_id: r.notification_status for r in done["queue"].collect()} == {0: "SENT", 1: "FAILED", 2: "SENT"}


def test_candidates_ignore_case_and_null(spark):
    df = spark.createDataFrame([("Warning", False), ("CRITICAL", True), ("watch", False), (None, False)],
                               "final_anomaly_level string, reference_only boolean")
    assert A.alert_candidates(df).count() == 2
    assert A.alert_candidates(df, exclude_reference_only=True).count() == 1


LOG = ["report_date", "sent_at", "status", "message"]


def log(spark, *rows):
    return spark.createDataFrame([(datetime.fromisoformat(d).date(), AS_OF, s, m) for d, s, m in rows], SEND_LOG)


def test_merge_updates_inserts_and_keeps(spark):
    old = log(spark, ("2025-05-01", "SENT", "a"), ("2025-05-02", "WAITING", "b"))
    new = log(spark, ("2025-05-02", "SENT", None), ("2025-05-03", "FAILED", "d"))
    got = {str(r.report_date): (r.status, r.message) for r in merge_by_key(old, new, ["report_date"]).collect()}
    assert got == {"2025-05-01": ("SENT", "a"), "2025-05-02": ("SENT", None), "2025-05-03": ("FAILED", "d")}


def test_latest_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    assert sorted(map(tuple, latest_by_key(df, ["k"], ["t"]).collect())) == [("a", 3, None), ("b", 1, "z")]


def test_ready_dates_and_not_sent(spark):
    rows = [("Insert", "2025-05-01T00:00:00", "READY"), ("0", "2025-05-02", "READY"), ("Update", "2025-05-03", "READY"),
            ("Insert", "2025-05-04", "DONE"), ("Insert", None, "READY"), ("2", "2025-05-05", "READY")]
    dates = ready_dates(spark.createDataFrame(rows, "operation string, report_date string, status string"))
    assert [r.report_date for r in dates.collect()] == ["2025-05-01", "2025-05-02"]
    due = not_sent(dates, log(spark, ("2025-05-01", "SENT", ""), ("2025-05-02", "WAITING", "")))
    assert [r.report_date for r in due.collect()] == ["2025-05-02"]


def test_ready_status_rows_and_daily_rows(spark):
    daily = spark.createDataFrame([("b", "2025-05-02"), ("a", "2025-05-02"), ("a", "2025-05-03")], "equipment_id string, t string").select(
        "equipment_id", F.col("t").cast("timestamp_ntz").alias("window_end_time"))
    existing = spark.createDataFrame([("2025-05-01",)], "report_date string")
    rows = ready_status_rows(daily, existing).collect()
    assert [(str(r.report_date), r.status) for r in rows] == [("2025-05-02", "READY")]
    assert [r.equipment_id for r in daily_rows(daily, "2025-05-01").collect()] == ["a", "b"]


def test_chunks_walk_through_all_timestamps(spark):
    df = spark.range(60).select((F.col("id") % 10).alias("timestamp"), F.concat(F.lit("m"), F.col("id") % 3).alias("module"), "id")
    last, seen = None, []
    while rows := next_chunk(df, last, 4).collect():
        seen += [r.id for r in rows]
        assert len({r.timestamp for r in rows}) <= 4
        last = rows[-1].timestamp
    assert sorted(seen) == list(range(60))
    assert {r.module for r in next_chunk(df, 2, 5, end_timestamp=4, modules=["m1"]).collect()} == {"m1"}
    assert [r.timestamp for r in sample_readings(df, 3, ["id"]).collect()] == [0, 0, 0]


def test_recovery_and_first_metric(spark):
    kind = ("equipment_id string, window_end_time string, aggregation_level string, final_anomaly_level string, final_anomaly_score double, "
            "rule_score double, iforest_score double, final_reason string, triggered_features array<string>, "
            "triggered_feature_values map<string,double>, threshold_values map<string,struct<lower:double,upper:double>>, "
            "threshold_direction map<string,string>")
    hit = (["avg_power_factor", "kepco_30m_pf"], {"avg_power_factor": 70.0}, {"avg_power_factor": (90.0, 100.0)}, {"avg_power_factor": "low"})
    none = ([], {}, {}, {})
    rows = [("a", "2025-05-01 00:15:00", "15m", "critical", 80.0, 90.0, 60.0, "why", *hit),
            ("a", "2025-05-02 00:30:00", "15m", "normal", 5.0, 0.0, 10.0, "fine", *none),
            ("a", "2025-05-02 00:45:00", "15m", "normal", 5.0, 0.0, 10.0, "fine", *none),
            ("a", "2025-05-02 01:00:00", "1h", "normal", 5.0, 0.0, 10.0, "fine", *none)]
    df = spark.createDataFrame(rows, kind).withColumn("window_end_time", F.col("window_end_time").cast("timestamp_ntz"))
    events = A.to_anomaly_events(df, AS_OF)
    assert events.columns == ALERT_QUEUE.fieldNames()
    got = {r.severity: r for r in events.collect()}
    assert set(got) == {"critical", "recovery"}
    assert (got["critical"].metric_name, got["critical"].metric_value, got["critical"].threshold_value) == ("avg_power_factor", 70.0, 90.0)
    assert got["recovery"].anomaly_type == "RECOVERY" and got["recovery"].window_end_time == datetime(2025, 5, 2, 0, 30)


def test_repeated_results_leave_one_row_per_alert(spark):
    from amperine.operators.alerts import apply_dispatch_results

    queue = spark.createDataFrame(
        [(i, "PENDING", None, 0, None) for i in (1, 2, 3)],
        "alert_id long, notification_status string, notified_at timestamp_ntz, retry_count int, last_error_message string",
    )
    results = spark.createDataFrame([(1, "down"), (1, None), (2, "a"), (2, "b")], "alert_id long, error string")
    got = apply_dispatch_results(queue, results, "2025-01-01 00:00:00").collect()
    assert {(r.alert_id, r.notification_status, r.retry_count) for r in got} == {
        (1, "SENT", 0), (2, "FAILED", 1), (3, "PENDING", 0)
    } and len(got) == 3
