from datetime import datetime

from pyspark.sql import functions as F

from amperine.functions.timestamps import format_localtime, local_day_bounds, parse_localtime, parse_naive
from amperine.operators.windows import aggregate_readings, base_time, from_states, reading_states, rollup
from amperine.operators.features import model_input
import pytest

COLUMNS = ["voltageR", "voltageS", "voltageT", "voltageRS", "voltageST", "voltageTR", "currentR", "currentS",
           "currentT", "activePower", "powerFactorR", "powerFactorS", "powerFactorT", "accumActiveEnergy"]
NORMAL = dict(voltageR=220.0, voltageS=220.0, voltageT=220.0, voltageRS=380.0, voltageST=380.0, voltageTR=380.0,
              currentR=10.0, currentS=10.0, currentT=10.0, activePower=1000.0, powerFactorR=95.0,
              powerFactorS=95.0, powerFactorT=95.0, accumActiveEnergy=5.0)
SCHEMA = "module string, localtime_datetime timestamp_ntz, " + ", ".join(f"{c} double" for c in COLUMNS)


def readings(spark, *rows):
    """Rows are (machine, time text, changed values)."""
    made = []
    for machine, when, changes in rows:
        values = {**NORMAL, **changes}
        made.append((machine, datetime.fromisoformat(when), *[values[c] for c in COLUMNS]))
    return spark.createDataFrame(made, SCHEMA)


def test_window_is_open_at_start_and_closed_at_end(spark):
    df = readings(spark, ("a", "2025-04-01T10:00:00", {}), ("a", "2025-04-01T10:00:00.000001", {}),
                  ("a", "2025-04-01T10:15:00", {}))
    got = {r.window_end_time: r.event_count for r in aggregate_readings(df, "15 minutes").collect()}
    assert got == {datetime(2025, 4, 1, 10, 0): 1, datetime(2025, 4, 1, 10, 15): 2}
    left = {r.window_end_time: r.event_count for r in aggregate_readings(df, "15 minutes", closed="left").collect()}
    assert left == {datetime(2025, 4, 1, 10, 15): 2, datetime(2025, 4, 1, 10, 30): 1}


def test_label_offset(spark):
    df = readings(spark, ("a", "2025-04-01T10:05:00", {}))
    row = aggregate_readings(df, "1 hour", label_hours=9).first()
    assert row.window_end_time == datetime(2025, 4, 1, 20, 0)


def test_imbalance_and_zero_mean(spark):
    df = readings(spark, ("a", "2025-04-01T10:00:30", dict(currentR=30.0, currentS=15.0, currentT=15.0)),
                  ("b", "2025-04-01T10:00:30", dict(currentR=0.0, currentS=0.0, currentT=0.0)),
                  ("c", "2025-04-01T10:00:30", dict(currentS=None)))
    rows = {r.equipment_id: r for r in aggregate_readings(df, "1 minute").collect()}
    assert rows["a"].avg_current_imbalance_rate == pytest.approx(50.0)
    assert rows["b"].avg_current_imbalance_rate is None
    assert rows["c"].avg_current_imbalance_rate is None and rows["c"].avg_current_r == 10.0
    assert rows["a"].avg_voltage_imbalance_rate == 0.0


def test_window_anomaly_limits_and_nulls(spark):
    at = "2025-04-01T10:00:30"
    df = readings(
        spark, ("dip", at, dict(voltageST=360.0)), ("fine", at, dict(voltageST=360.1)),
        ("pf90", at, {f"powerFactor{p}": 90.0 for p in "RST"}),
        ("pf_above", at, dict(powerFactorR=90.1, powerFactorS=90.0, powerFactorT=90.0)),
        ("unknown", at, {c: None for c in COLUMNS}),
        ("one_null", at, dict(powerFactorR=80.0, powerFactorS=95.0, powerFactorT=95.0)),
        ("one_null", at, dict(powerFactorR=None, powerFactorS=85.0, powerFactorT=85.0)),
    )
    rows = {r.equipment_id: r for r in aggregate_readings(df, "1 minute", anomaly=True).collect()}
    flags = {k: r.is_anomaly for k, r in rows.items()}
    assert flags == {"dip": 1, "fine": 0, "pf90": 1, "pf_above": 0, "unknown": 0, "one_null": 1}
    # the flag uses the mean of phase means, the metric the mean of complete rows
    assert rows["one_null"].avg_power_factor == pytest.approx(90.0)


def test_text_measures_are_coerced(spark):
    df = readings(spark, ("a", "2025-04-01T10:00:30", {})).withColumn("voltageR", F.lit("bad"))
    row = aggregate_readings(df, "1 minute").first()
    assert row.avg_voltage_r is None and row.avg_voltage_s == 220.0


def _many(spark):
    rows = []
    for i in range(400):
        rows.append((f"m{i % 3}", f"2025-04-01T{10 + i // 60:02d}:{i % 60:02d}:0{i % 7}",
                     dict(voltageR=200.0 + i % 11, currentS=float(i % 5), activePower=100.0 * (i % 13), accumActiveEnergy=i / 4)))
    return readings(spark, *rows)


def as_rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_rollup_equals_direct(spark):
    df = _many(spark)
    direct = aggregate_readings(df, "1 hour")
    assert as_rows(rollup(aggregate_readings(df, "1 minute"), "1 hour").select(direct.columns)) == as_rows(direct)


def test_rollup_interval_is_rerunnable(spark):
    fine = aggregate_readings(_many(spark), "1 minute")
    start, end = datetime(2025, 4, 1, 11), datetime(2025, 4, 1, 13)
    part = rollup(fine, "1 hour", start, end)
    whole = rollup(fine, "1 hour").filter((F.col("window_end_time") > F.lit(start)) & (F.col("window_end_time") <= F.lit(end)))
    assert as_rows(part) == as_rows(whole) and part.count() == 6


def test_states_equal_direct(spark):
    df = _many(spark).withColumn("voltageS", F.when(F.col("currentS") != 3, F.col("voltageS")))
    states = reading_states(df)
    direct = aggregate_readings(df, "15 minutes", energy=True)
    assert as_rows(from_states(states, "15 minutes").select([f"`{c}`" for c in direct.columns])) == as_rows(direct)
    assert as_rows(from_states(states)) == as_rows(aggregate_readings(df, "1 minute", energy=True))


def test_model_input_calendar(spark):
    df = readings(spark, ("a", "2025-04-05T10:05:00", {}), ("b", "2025-04-07T00:05:00", {}))
    rows = {r.equipment_id: r for r in model_input(aggregate_readings(df, "15 minutes", energy=True)).collect()}
    assert (rows["a"].dayofweek, rows["a"].is_weekend, rows["a"].hour) == (5, 1, 10)  # Saturday
    assert (rows["b"].dayofweek, rows["b"].is_weekend) == (0, 0)
    assert len(rows["a"]) == 21


def test_base_time_of_nothing_is_an_error(spark):
    empty = spark.createDataFrame([], "window_end_time timestamp_ntz")
    with pytest.raises(Exception, match="base time"):
        base_time(empty).collect()


def test_local_time_functions(spark):
    df = spark.createDataFrame([("20250401093005",), ("2025040109300",), ("20251301000000",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_localtime(F.col("t"))).collect()]
    assert got == [datetime(2025, 4, 1, 9, 30, 5), None, None, None]
    back = spark.range(1).select(format_localtime(F.lit(datetime(2025, 4, 1, 9, 30, 5)).cast("timestamp_ntz"))).first()[0]
    assert back == 20250401093005
    bounds = spark.range(1).select(
        local_day_bounds(F.lit("2025-04-01 16:00:00").cast("timestamp_ntz")).alias("b")).first()["b"]
    assert bounds.start_utc == datetime(2025, 3, 31, 15) and bounds.end_utc == datetime(2025, 4, 1, 15)


def test_parse_naive_drops_the_offset(spark):
    texts = ["2025-04-15T23:45:00", "2025-04-15T23:45:00Z", "2025-04-15T23:45:00+09:00", "2025-04-15 23:45:00.5-03:00",
             "2025-04-15", "yesterday", "2025-04", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_naive(F.col("t"))).collect()]
    end = datetime(2025, 4, 15, 23, 45)
    assert got == [end, end, end, datetime(2025, 4, 15, 23, 45, 0, 500000), datetime(2025, 4, 15), None, None, None]
