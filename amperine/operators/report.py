"""Daily report tables. All of them cover every report date at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.numeric import integer_or, number_or
from amperine.functions.timestamps import report_date

_METRICS = ["avg_power_factor", "avg_voltage_imbalance_rate", "avg_current_imbalance_rate"]


# --- from 1-minute aggregates and alert events ----------------------------------------


def daily_kpi(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per machine (and `by`): row count, means, highest and lowest power."""
    keys = [*(by or []), "equipment_id"]
    electrical = [f"avg_{kind}_{p}" for kind in ("voltage", "current") for p in "rst"]
    means = [F.avg(c).alias(f"daily_{c}") for c in [*electrical, "avg_power_factor", "avg_active_power"]]
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            *means,
            F.max("avg_active_power").alias("daily_peak_active_power"),
            F.min("avg_active_power").alias("daily_min_active_power"),
        )
        .orderBy(*keys)
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Count, first and last detection per (machine, type, severity)."""
    return (
        alerts.groupBy("equipment_id", "alert_type", "severity")
        .agg(
            F.count(F.lit(1)).alias("alert_count"),
            F.min("detected_at").alias("first_detected_at"),
            F.max("detected_at").alias("last_detected_at"),
        )
        .orderBy(F.desc("alert_count"), "equipment_id", "alert_type", "severity")
    )


def top_alert_equipment(alerts: DataFrame, n: int = 5) -> DataFrame:
    counts = alerts.groupBy("equipment_id").agg(F.count(F.lit(1)).alias("total_alert_count"))
    return counts.orderBy(F.desc("total_alert_count"), "equipment_id").limit(n)


def report_headline(kpi: DataFrame, summary: DataFrame) -> DataFrame:
    """One row: machine and alert totals, peak machine, main alert type ('-' when empty)."""
    # ties go to the first name in order
    peak = kpi.agg(
        F.countDistinct("equipment_id").alias("equipment_count"),
        F.min(
            F.struct(-F.col("daily_peak_active_power"), F.col("equipment_id").alias("who"))
        ).alias("_peak"),
    )
    types = summary.groupBy("alert_type").agg(F.sum("alert_count").alias("_n"))
    main = types.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_alert_count"),
        F.min(F.struct((-F.col("_n")).alias("n"), "alert_type")).alias("_main"),
    )
    machines = summary.agg(F.countDistinct("equipment_id").alias("alert_equipment_count"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    # three one-row tables side by side
    row = one(peak).join(one(main), "_one").join(one(machines), "_one")
    return row.select(
        "equipment_count",
        "total_alert_count",
        "alert_equipment_count",
        F.coalesce(F.col("_peak.who"), F.lit("-")).alias("peak_equipment"),
        (-F.col("_peak.col1")).alias("peak_power"),
        F.coalesce(F.col("_main.alert_type"), F.lit("-")).alias("main_alert_type"),
        F.coalesce(-F.col("_main.n"), F.lit(0)).alias("main_alert_count"),
    )


# --- from daily aggregates ------------------------------------------------------------


def _below(value: Column) -> Column:
    return value < K.REPORT_POWER_FACTOR_MIN


def _issue_flags(fill: bool) -> list[Column]:
    """Low power factor, high voltage and high current imbalance; null counts as 0 if filled."""
    get = (lambda c: number_or(F.col(c))) if fill else F.col
    return [
        _below(get("avg_power_factor")),
        get("avg_voltage_imbalance_rate") >= K.REPORT_VOLTAGE_IMBALANCE_MAX,
        get("avg_current_imbalance_rate") >= K.REPORT_CURRENT_IMBALANCE_MAX,
    ]


def equipment_status() -> Column:
    """NORMAL, WATCH (one issue) or WARNING; a missing power factor counts as low."""
    issues = sum((F.when(flag, 1).otherwise(0) for flag in _issue_flags(fill=True)), F.lit(0))
    return F.when(issues == 0, "NORMAL").when(issues == 1, "WATCH").otherwise("WARNING")


def _dated(daily: DataFrame) -> DataFrame:
    if "report_date" in daily.columns:
        return daily
    return daily.withColumn("report_date", report_date(F.col("window_end_time")))


def equipment_rows(daily: DataFrame) -> DataFrame:
    """Report table: status and rounded metrics per machine and date."""
    return _dated(daily).select(
        "report_date",
        equipment_status().alias("status"),
        F.col("equipment_id").cast("string").alias("equipment_id"),
        *[F.round(number_or(F.col(c)), 2).alias(c) for c in _METRICS],
        F.coalesce(F.col("event_count").try_cast("bigint"), F.lit(0)).alias("event_count"),
    )


def abnormal_equipment(daily: DataFrame) -> DataFrame:
    """Machines with issues: the issue texts, rounded metrics and status.

    Unlike the status, a missing metric is no issue here.
    """
    templates = [K.ISSUE_POWER_FACTOR, K.ISSUE_VOLTAGE, K.ISSUE_CURRENT]
    issues = [
        F.when(flag, F.format_string(text, F.round(number_or(F.col(metric)), 2)))
        for flag, text, metric in zip(_issue_flags(fill=False), templates, _METRICS)
    ]
    rows = _dated(daily).withColumn("issues", F.array_compact(F.array(*issues)))
    return (
        rows.filter(F.size("issues") > 0)
        .select(
            "report_date",
            F.col("equipment_id").cast("string").alias("equipment_id"),
            "issues",
            F.coalesce(F.col("event_count").try_cast("bigint"), F.lit(0)).alias("event_count"),
            *[F.round(number_or(F.col(c)), 2).alias(c) for c in _METRICS],
            equipment_status().alias("status"),
        )
        .orderBy("report_date", F.desc("event_count"), "equipment_id")
    )


def daily_summary(daily: DataFrame) -> DataFrame:
    """Per date: mean metrics (null as 0, counted in the mean), issue counts, total events."""
    count = F.count(F.lit(1))
    mean = lambda c: F.round(F.sum(number_or(F.col(c))) / count, 2).alias(c)
    names = ["low_power_factor_count", "high_voltage_imbalance_count", "high_current_imbalance_count"]
    return (
        _dated(daily)
        .groupBy("report_date")
        .agg(
            count.alias("equipment_count"),
            *[mean(c) for c in _METRICS],
            *[F.count_if(flag).alias(name) for flag, name in zip(_issue_flags(fill=False), names)],
            F.sum(F.coalesce(F.col("event_count").try_cast("bigint"), F.lit(0))).alias("total_event_count"),
        )
    )


def _completeness(equipment: int, events: int) -> list[Column]:
    total = equipment * events
    rate = F.col("total_event_count") / F.lit(total) * 100 if total > 0 else F.lit(0.0)
    return [
        F.lit(equipment).alias("expected_equipment_count"),
        F.col("equipment_count").alias("actual_equipment_count"),
        F.lit(events).alias("expected_event_count_per_equipment"),
        F.lit(total).cast("bigint").alias("expected_total_event_count"),
        F.col("total_event_count").alias("actual_total_event_count"),
        F.round(rate, 2).alias("completeness_rate"),
    ]


def completeness(
    summary: DataFrame, equipment: int = K.EXPECTED_EQUIPMENT, events: int = K.EXPECTED_EVENTS_PER_DAY
) -> DataFrame:
    """Expected and actual counts and the completeness rate in percent, per date."""
    return summary.select("report_date", *_completeness(equipment, events))


def with_completeness(
    summary: DataFrame, equipment: int = K.EXPECTED_EQUIPMENT, events: int = K.EXPECTED_EVENTS_PER_DAY
) -> DataFrame:
    return summary.select("*", *_completeness(equipment, events))


_COUNTS = ["low_power_factor_count", "high_voltage_imbalance_count", "high_current_imbalance_count"]


def daily_status(checked: DataFrame) -> DataFrame:
    """Overall status and message per date, from `with_completeness(daily_summary(...))`."""
    actual, expected = F.col("actual_equipment_count"), F.col("expected_equipment_count")
    rate = F.col("completeness_rate")
    abnormal = F.col(_COUNTS[0]) + F.col(_COUNTS[1]) + F.col(_COUNTS[2])
    rules = [
        (actual < expected, "WARNING", F.format_string(K.STATUS_FEW_MACHINES, actual, expected)),
        (rate < 95, "WATCH", F.format_string(K.STATUS_INCOMPLETE, rate)),
        (abnormal == 0, "NORMAL", F.lit(K.STATUS_NORMAL)),
        (abnormal <= 2, "WATCH", F.lit(K.STATUS_SOME)),
        (F.lit(True), "WARNING", F.lit(K.STATUS_MANY)),
    ]
    verdict = F.coalesce(
        *[F.when(test, F.struct(F.lit(s).alias("status"), m.alias("message"))) for test, s, m in rules]
    )
    return checked.withColumn("_v", verdict).select(
        "report_date", F.col("_v.status").alias("status"), F.col("_v.message").alias("message")
    )


def insights(checked: DataFrame, abnormal: DataFrame) -> DataFrame:
    """Report remarks per date as rows (report_date, pos, insight)."""
    busiest = F.struct(-F.col("event_count"), F.col("equipment_id"))
    top = abnormal.groupBy("report_date").agg(
        F.min_by(F.struct("equipment_id", "issues"), busiest).alias("_top")
    )
    actual, expected = F.col("actual_equipment_count"), F.col("expected_equipment_count")
    rate = F.col("completeness_rate")
    texts = [
        F.when(actual < expected, F.format_string(K.INSIGHT_FEW_MACHINES, actual, expected)),
        F.when(rate < 95, F.format_string(K.INSIGHT_INCOMPLETE, rate)),
        *[
            F.when(F.col(count) > 0, F.format_string(text, F.col(count)))
            for count, text in zip(_COUNTS, [K.INSIGHT_POWER_FACTOR, K.INSIGHT_VOLTAGE, K.INSIGHT_CURRENT])
        ],
        F.when(
            F.col("_top").isNotNull(),
            F.format_string(K.INSIGHT_TOP, F.col("_top.equipment_id"), F.array_join("_top.issues", ", ")),
        ),
    ]
    found = checked.join(top, "report_date", "left").withColumn("_t", F.array_compact(F.array(*texts)))
    listed = F.when(F.size("_t") > 0, F.col("_t")).otherwise(F.array(F.lit(K.INSIGHT_NONE)))
    return found.select("report_date", F.posexplode(listed).alias("pos", "insight"))
