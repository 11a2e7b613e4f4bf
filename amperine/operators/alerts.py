"""Alert candidates, payloads, the alert queue and its dispatch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.numeric import integer_or, number_or
from amperine.functions.timestamps import parse_naive
from amperine.operators.merge import cut_error
from amperine.operators.series import islands, previous_in_series
from amperine.schemas import ALERT_QUEUE

_ALERT_TEXT = ["window_end_time", "aggregation_level"]
_ALERT_SCORES = [
    "final_anomaly_score", "rule_score", "iforest_score", "rule_contribution", "iforest_contribution",
]


# what `to_anomaly_events` reads of a prediction, besides the lists and maps per feature
EVENT_COLUMNS = [
    "equipment_id", "window_end_time", "aggregation_level", "final_anomaly_level", "final_anomaly_score",
    "rule_score", "iforest_score", "final_reason",
]
EVENT_LISTS = ["triggered_features", "triggered_feature_values", "threshold_values", "threshold_direction"]


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def alert_candidates(predictions: DataFrame, exclude_reference_only: bool = False) -> DataFrame:
    """Predictions at warning or critical level, whatever the letter case."""
    level = F.lower(F.coalesce("final_anomaly_level", F.lit("normal")))
    chosen = predictions.filter(level.isin("warning", "critical"))
    if exclude_reference_only:
        chosen = chosen.filter(~F.coalesce(F.col("reference_only").cast("boolean"), F.lit(False)))
    return chosen


def alert_payloads(df: DataFrame, kind: str) -> DataFrame:
    """Message rows from 'predictions' or from the alert 'queue' (the page text is left out)."""
    if kind == "predictions":
        level = F.lower(F.coalesce(F.col("final_anomaly_level").cast("string"), F.lit("normal")))
        return df.select(
            _title(level).alias("title"),
            _text("equipment_id").alias("equipment_id"),
            *[_text(c).alias(c) for c in _ALERT_TEXT],
            level.alias("severity"),
            *[number_or(F.col(c)).alias(c) for c in _ALERT_SCORES],
            _text("primary_anomaly_model").alias("primary_anomaly_model"),
            integer_or(F.col("model_vote_count")).alias("model_vote_count"),
            *[_text(c).alias(c) for c in ("rule_reason", "final_reason", "recommended_action")],
            integer_or(F.col("data_quality_issue_flag")).alias("data_quality_issue_flag"),
            _text("data_quality_reason").alias("data_quality_reason"),
        )
    if kind != "queue":
        raise ValueError("kind is 'predictions' or 'queue'")
    return df.select(
        "alert_id",
        _title(_text("severity")).alias("title"),
        *[_text(c).alias(c) for c in ("equipment_id", "window_end_time", "anomaly_type", "severity", "metric_name")],
        "metric_value", "threshold_value", "anomaly_score", "rule_score", "iforest_score",
        "final_score", "duration_minutes",
        *[_text(c).alias(c) for c in ("detection_window", "message")],
    )


def _title(severity: Column) -> Column:
    return F.format_string(K.ALERT_TITLE, F.upper(severity), _text("equipment_id"))


def prediction_records(predictions: DataFrame) -> DataFrame:
    """The 22 stored columns. Rows without a readable window end are left out."""
    number = ["final_anomaly_score", "rule_score", "iforest_score", "rule_contribution", "iforest_contribution"]
    whole = [
        "strong_anomaly_candidate", "critical_candidate", "rule_anomaly", "iforest_anomaly",
        "model_vote_count", "data_quality_issue_flag", "reference_only",
    ]
    changed = {c: number_or(F.col(c)) for c in number} | {c: integer_or(F.col(c)) for c in whole}
    changed["final_anomaly_level"] = F.coalesce("final_anomaly_level", F.lit("normal"))
    changed["window_end_time"] = parse_naive(F.col("window_end_time"))
    changed["created_at"] = parse_naive(F.col("created_at"))
    return (
        predictions.withColumns(changed)
        .filter(F.col("window_end_time").isNotNull())
        .select(*K.STORED_PREDICTION_COLUMNS)
    )


def _priority(severity: Column) -> Column:
    rank = F.when(F.lit(False), 0)
    for place, name in enumerate(K.SEVERITY_ORDER, start=1):
        rank = rank.when(severity == name, place)
    return rank.otherwise(9)


def pending_alerts(
    queue: DataFrame, max_dispatch: int = K.DISPATCH_LIMIT, max_retry: int = K.RETRY_LIMIT
) -> DataFrame:
    """The next alerts to send: most severe first, then oldest, then lowest id."""
    due = queue.filter(
        F.col("notification_status").isin("PENDING", "FAILED")
        & (F.col("retry_count") < max_retry)
        & F.col("severity").isin(K.SEVERITY_ORDER)
    )
    return due.orderBy(_priority(F.col("severity")), "created_at", "alert_id").limit(max_dispatch)


def apply_dispatch_results(queue: DataFrame, results: DataFrame, as_of) -> DataFrame:
    """New queue state from results (alert_id, error); a null error means sent.

    Alerts without a result keep their state. Delivery is at least once, so an alert may
    have several results: it counts as sent if one of them says so, and stays one row.
    Of several errors the one of the latest `attempted_at` is kept where results have that column.
    """
    last = F.max_by("error", "attempted_at") if "attempted_at" in results.columns else F.max("error")
    once = results.groupBy("alert_id").agg(F.max(F.col("error").isNull()).alias("_sent"), last.alias("_last"))
    marked = once.select(
        "alert_id", F.when(~F.col("_sent"), F.col("_last")).alias("_error"), F.lit(True).alias("_tried")
    )
    joined = queue.join(marked, "alert_id", "left")
    tried = F.coalesce("_tried", F.lit(False))
    failed = tried & F.col("_error").isNotNull()
    sent = tried & F.col("_error").isNull()
    when = as_of if isinstance(as_of, Column) else F.lit(as_of)
    changed = {
        "notification_status": F.when(sent, "SENT").when(failed, "FAILED").otherwise(F.col("notification_status")),
        "notified_at": F.when(sent, when.cast("timestamp_ntz")).otherwise(F.col("notified_at")),
        "retry_count": F.col("retry_count") + F.when(failed, 1).otherwise(0),
        "last_error_message": F.when(failed, cut_error(F.col("_error")))
        .when(sent, None)
        .otherwise(F.col("last_error_message")),
    }
    return joined.withColumns(changed).select(*queue.columns)


def delivery_counts(results: DataFrame, outcome: str = "outcome") -> DataFrame:
    """One row with sent, skipped and failed counts."""
    count = lambda name: F.count_if(F.col(outcome) == name).alias(f"{name}_count")
    return results.agg(count("sent"), count("skipped"), count("failed"))


def dispatch_pass(queue: DataFrame, results: DataFrame, as_of, **limits) -> dict[str, DataFrame]:
    """One pass over the queue: outbox rows, the new queue, and the counts.

    `results` holds what the delivery reported; only alerts picked in this pass count.
    """
    picked = pending_alerts(queue, **limits)
    counted = results.join(picked.select("alert_id"), "alert_id", "left_semi")
    outcome = F.when(F.col("error").isNull(), "sent").otherwise("failed")
    return {
        "outbox": alert_payloads(picked, "queue"),
        "queue": apply_dispatch_results(queue, counted, as_of),
        "counts": delivery_counts(counted.withColumn("outcome", outcome)),
    }


def to_anomaly_events(predictions: DataFrame, as_of) -> DataFrame:
    """Queue rows for warning and critical predictions, and for recoveries.

    A recovery is a normal row whose previous window of the same machine and level was
    warning or critical. The metric is the first triggered feature. `alert_id` is a hash of
    the row's key, so a re-run gives the same ids.

    What a queue row needs of the lists and maps per feature is taken out of them before the
    rows are brought into order, so that those are not shuffled.
    """
    level = F.col("final_anomaly_level")
    recovered = (level == "normal") & F.col("_before").isin("warning", "critical")
    severity = F.when(level.isin("warning", "critical"), level).when(recovered, "recovery")
    first = F.try_element_at("triggered_features", F.lit(1))
    limits = F.try_element_at("threshold_values", first)
    low_side = F.try_element_at("threshold_direction", first) == "low"
    taken = {
        "metric_name": first,
        "metric_value": F.try_element_at("triggered_feature_values", first),
        "threshold_value": F.when(low_side, limits["lower"]).otherwise(limits["upper"]),
    }
    made = {
        "alert_id": F.xxhash64("equipment_id", "aggregation_level", F.col("window_end_time").cast("string"), "severity"),
        "window_end_time": F.col("window_end_time").cast("timestamp_ntz"),
        "anomaly_type": F.when(F.col("severity") == "recovery", "RECOVERY").otherwise(
            F.upper(F.coalesce("metric_name", F.lit("multivariate")))
        ),
        "anomaly_score": F.col("final_anomaly_score") / 100,
        "final_score": F.col("final_anomaly_score"),
        "duration_minutes": _minutes(F.col("aggregation_level")),
        "detection_window": F.col("aggregation_level"),
        "status": F.lit("OPEN"),
        "notification_status": F.lit("PENDING"),
        "retry_count": F.lit(0),
        "last_error_message": F.lit(None).cast("string"),
        "message": F.col("final_reason"),
        "created_at": F.lit(as_of).cast("timestamp_ntz"),
        "notified_at": F.lit(None).cast("timestamp_ntz"),
    }
    used = [*EVENT_COLUMNS, *[c for c in ALERT_QUEUE.fieldNames() if c in predictions.columns and c not in EVENT_COLUMNS]]
    narrow = predictions.select(*used, *EVENT_LISTS).withColumns(taken).drop(*EVENT_LISTS)
    known = previous_in_series(
        narrow, ["equipment_id", "aggregation_level"], "window_end_time", {"_before": F.col("final_anomaly_level")}
    )
    rows = known.withColumn("severity", severity).filter(F.col("severity").isNotNull())
    return rows.withColumns(made).select(*ALERT_QUEUE.fieldNames())


def anomaly_episodes(predictions: DataFrame) -> DataFrame:
    """Spells of consecutive warning or critical windows, per machine and level.

    Start and end of the spell, its true duration in minutes, windows in it, how many were
    critical, the worst level and the highest final score. One row per machine, level and
    window end is taken for granted.
    """
    level = F.lower("final_anomaly_level")
    alarming = predictions.filter(level.isin("warning", "critical"))
    seconds = reduce(lambda rest, lv: F.when(F.col("aggregation_level") == lv, K.LEVEL_SECONDS[lv]).otherwise(rest), K.LEVELS, F.lit(None))
    spells = islands(
        alarming.withColumn("window_end_time", F.col("window_end_time").cast("timestamp_ntz")),
        ["equipment_id", "aggregation_level"], "window_end_time", seconds,
        {"critical_windows": (F.sum, (level == "critical").cast("long")), "max_score": (F.max, F.col("final_anomaly_score"))},
    )
    return spells.select(
        "equipment_id", "aggregation_level", F.col("start").alias("episode_start"), F.col("end").alias("episode_end"), "windows",
        "critical_windows", F.when(F.col("critical_windows") > 0, "critical").otherwise("warning").alias("severity"), "max_score",
        F.timestamp_diff("MINUTE", "start", "end").alias("duration_minutes"),
    )


def _minutes(level: Column) -> Column:
    return F.when(level == "1m", 1).when(level == "15m", 15).when(level == "1h", 60).when(level == "1d", 1440)
