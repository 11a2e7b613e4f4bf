from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.operators import forecast as P
from amperine.operators import report as R
from amperine.operators.quality import missing_columns, quality_monitor
from amperine.sources.readings import forecast_panel

DAY = date(2025, 5, 1)


def daily(spark, *rows):
    """Rows are (machine, power factor, voltage imbalance, current imbalance, events)."""
    return spark.createDataFrame([(DAY, *r) for r in rows], "report_date date, equipment_id string, avg_power_factor double, "
                                 "avg_voltage_imbalance_rate double, avg_current_imbalance_rate double, event_count bigint")


def full(spark, *rows, machines=13):
    rest = [(f"x{i:02d}", 99.0, 0.0, 0.0, 17280) for i in range(machines - len(rows))]
    return daily(spark, *rows, *rest)


def status_of(df, **expected):
    return R.daily_status(R.with_completeness(R.daily_summary(df), **expected)).first()


def test_equipment_status_and_issues_treat_null_differently(spark):
    df = daily(spark, ("ok", 90.0, 2.99, 29.9, 5), ("one", 89.9, 0.0, 0.0, 5), ("two", 89.9, 3.0, 0.0, 5), ("null", None, None, None, None))
    rows = {r.equipment_id: r for r in R.equipment_rows(df).collect()}
    assert {k: r.status for k, r in rows.items()} == {"ok": "NORMAL", "one": "WATCH", "two": "WARNING", "null": "WATCH"}
    assert rows["null"].event_count == 0 and rows["null"].avg_power_factor == 0.0
    found = R.abnormal_equipment(df).collect()
    assert [r.equipment_id for r in found] == ["one", "two"]
    assert found[1].issues == ["역률 저하(89.90%)", "전압 불균형(3.00%)"]


def test_summary_counts_null_as_zero_in_means_only(spark):
    row = R.daily_summary(daily(spark, ("a", 80.0, 6.0, 30.0, 10), ("b", None, None, None, None))).first()
    assert (row.equipment_count, row.avg_power_factor, row.avg_voltage_imbalance_rate, row.avg_current_imbalance_rate) == (2, 40.0, 3.0, 15.0)
    assert (row.low_power_factor_count, row.high_voltage_imbalance_count, row.high_current_imbalance_count) == (1, 1, 1)
    assert row.total_event_count == 10


def test_daily_status_rules_in_order(spark):
    assert status_of(full(spark, machines=12)).message == K.STATUS_FEW_MACHINES % (12, 13)
    low = full(spark, ("a", 99.0, 0.0, 0.0, 0))
    assert status_of(low).status == "WATCH" and "92.31%" in status_of(low).message
    assert status_of(full(spark)).status == "NORMAL"
    assert status_of(full(spark, ("a", 80.0, 5.0, 0.0, 17280))).message == K.STATUS_SOME
    assert status_of(full(spark, ("a", 80.0, 5.0, 50.0, 17280))).status == "WARNING"
    assert R.completeness(R.daily_summary(full(spark)), equipment=0).first().completeness_rate == 0.0


def test_insights(spark):
    said = lambda df: [r.insight for r in R.insights(R.with_completeness(R.daily_summary(df)), R.abnormal_equipment(df)).orderBy("pos").collect()]
    assert said(full(spark)) == [K.INSIGHT_NONE]
    got = said(full(spark, ("b", 80.0, 0.0, 40.0, 17280), ("a", 85.0, 0.0, 0.0, 17280)))
    assert got == [K.INSIGHT_POWER_FACTOR % 2, K.INSIGHT_CURRENT % 1, K.INSIGHT_TOP % ("a", "역률 저하(85.00%)")]


def test_headline_of_nothing(spark):
    kpi = spark.createDataFrame([], "equipment_id string, daily_peak_active_power double")
    alerts = spark.createDataFrame([], "equipment_id string, alert_type string, severity string, detected_at timestamp_ntz")
    row = R.report_headline(kpi, R.alert_summary(alerts)).first()
    assert (row.equipment_count, row.total_alert_count, row.peak_equipment, row.main_alert_type, row.main_alert_count) == (0, 0, "-", "-", 0)


# --- forecasts ------------------------------------------------------------------------

BASE = datetime(2025, 5, 8, 13)


def panel(spark, days=8):
    rows = [("m", BASE - i * P.STEP, float(i), 1.0, 2.0, 3.0) for i in range(-4, 96 * days)]
    df = spark.createDataFrame(rows, "equipment_id string, window_end_time timestamp_ntz, avg_activePower double, "
                               "avg_current_r double, avg_current_s double, avg_current_t double")
    return forecast_panel(df, BASE)


def test_panel_keeps_both_ends_and_drops_unusable(spark):
    times = [r.ds for r in panel(spark).collect()]
    assert (min(times), max(times), len(times)) == (BASE - timedelta(days=7), BASE, 7 * 96 + 1)
    bad = spark.createDataFrame([("m", BASE, "x"), (None, BASE, "1"), ("m", BASE, "2.5")], "equipment_id string, window_end_time timestamp_ntz, avg_activePower string")
    bad = bad.withColumns({f"avg_current_{p}": F.lit(1.0) for p in "rst"})
    assert [r.y for r in forecast_panel(bad, BASE).collect()] == [2.5]


def test_seasonal_naive_repeats_the_last_season(spark):
    rows = {r.ds: r.yhat for r in P.seasonal_naive(panel(spark), BASE, horizon_steps=200).collect()}
    assert len(rows) == 200
    assert rows[BASE + P.STEP] == 95.0 and rows[BASE + 96 * P.STEP] == 0.0 and rows[BASE + 97 * P.STEP] == 95.0


def test_run_forecast_cuts_at_midnight_and_unions(spark):
    def flat(history, targets):
        return pd.DataFrame({"ds": targets, "flat-median": float(len(history))})

    out = P.run_forecast(panel(spark), BASE, seasons={"naive": timedelta(days=1)}, forecasters={"flat": flat}, created_at=BASE)
    assert out.columns == P.RESULT_COLUMNS
    got = out.toPandas()
    assert got.groupby("model_name").size().to_dict() == {"naive": 44, "flat": 44}
    assert got["target_time"].max() == pd.Timestamp("2025-05-09") and (got.loc[got.model_name == "flat", "yhat"] == 673.0).all()


def test_forecast_column_choice_and_errors(spark, tmp_path):
    df = spark.createDataFrame([("m", BASE, 1.0, 2.0)], "unique_id string, ds timestamp_ntz, `A-median` double, yhat double")
    assert P.normalise_forecast(df, "A", BASE).first().yhat == 1.0
    assert P.normalise_forecast(df, "B", BASE).first().yhat == 2.0
    with pytest.raises(ValueError):
        P.normalise_forecast(df.drop("yhat"), "B", BASE)
    with pytest.raises(ValueError):
        P.run_forecast(df, BASE)
    result = P.normalise_forecast(df, "A", BASE)
    with pytest.raises(ValueError):
        P.append_forecast(result.limit(0), str(tmp_path / "f"))
    for _ in range(2):
        P.append_forecast(result, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).count() == 2


# --- quality --------------------------------------------------------------------------


def test_quality_monitor(spark):
    at = lambda text: datetime.fromisoformat(f"2025-05-01T{text}")
    rows = [("a", at("10:00:05"), 1), ("a", at("10:00:05"), 1), ("a", at("10:00:10"), 2), ("a", at("12:30:00"), 3), (None, at("10:00:05"), 1), (" ", at("10:00:05"), 1)]
    df = spark.createDataFrame(rows, "module string, localtime_datetime timestamp_ntz, timestamp bigint")
    got = {(r.equipment_id, r.window_end_time.hour): r for r in quality_monitor(df, "1h", expected=4).collect()}
    first, second = got[("a", 11)], got[("a", 13)]
    assert (first.event_count, first.duplicate_count, first.missing_count, first.completeness) == (3, 1, 2, 0.5)
    assert first.count_ratio is None and not first.is_jump and not first.missing_id
    assert second.count_ratio == pytest.approx(1 / 3) and second.is_jump
    assert got[(None, 11)].missing_id and got[(" ", 11)].missing_id
    assert missing_columns(df, ["module", "voltageR"]) == ["voltageR"]
