"""What is shuffled, written and parsed per row by the steps that grow with the readings."""

import contextlib
import io
import os
import re
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from amperine.operators.alerts import EVENT_COLUMNS, EVENT_LISTS, to_anomaly_events
from amperine.operators.combine import scale_iforest
from amperine.operators.iforest import _mean_path, _steps, fit_scaler
from amperine.operators.rules import rule_score
from amperine.operators.series import previous_in_series
from amperine.operators.windows import merge_states, reading_states
from amperine.operators.thresholds import FEATURES, with_thresholds
from amperine.plans import alerts, derived, scoring, streams
from amperine.plans.derived import readings
from amperine.session import lookup_join, settle
from amperine.sources.payloads import one_value
from amperine.sources.writers import DAY, replace_windows
from amperine.streaming import late
from amperine.streaming.sinks import publish, write_batch

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_states_are_made_behind_one_shuffle_of_readings(spark):
    lines = plan(reading_states(readings(spark, SF_DIR))).splitlines()
    places = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(places) == 1 and "_hour" in lines[places[0]]
    assert all(i < places[0] for i, line in enumerate(lines) if "Aggregate" in line)


def test_scaler_puts_batches_with_nulls_together(spark):
    rng = np.random.default_rng(5)
    x = (1e6 + rng.normal(size=(500, 3))).astype("float32").astype(float)
    rows = [("1m" if i % 3 else "1h", [None if i % 7 == 0 else float(v[0]), float(v[1]), 2.0]) for i, v in enumerate(x)]
    rows += [("1m", None), (None, [1.0, None, 3.0])]
    df = spark.createDataFrame(rows, "aggregation_level string, features array<float>").repartition(5)
    got = {r[0]: r for r in fit_scaler(df, size=3).collect()}
    for level in ("1m", "1h"):
        for i in range(3):
            values = [r[1][i] for r in rows if r[0] == level and r[1] and r[1][i] is not None]
            assert got[level]["mean"][i] == pytest.approx(np.mean(values), rel=1e-12)
            assert got[level]["scale"][i] == pytest.approx(np.std(values) or 1.0, rel=1e-9)
    assert got[None]["mean"] == [1.0, None, 3.0] and got[None]["scale"] == [1.0, 1.0, 1.0]
    assert "stddev_pop" not in plan(fit_scaler(df, size=3))


def test_walk_without_leaf_tests_equals_a_plain_walk():
    rng = np.random.default_rng(3)
    feature, split, depth = np.full((4, 15), -1), np.zeros((4, 15)), rng.random((4, 15))
    for tree, inner in enumerate(([], [0], [0, 2, 6], [0, 1, 2, 4])):
        feature[tree, inner], split[tree, inner] = rng.integers(0, 3, len(inner)), rng.normal(size=len(inner))
    x = rng.normal(size=(9000, 3))
    x[0], x[1] = np.nan, np.inf

    def plain(row):
        total = 0.0
        for f, s, d in zip(feature, split, depth):
            at = 0
            while f[at] >= 0:
                at = 2 * at + 1 + int(row[f[at]] > s[at])
            total += d[at]
        return total / 4

    assert _mean_path(x, (*_steps(feature, split), depth)).tolist() == [plain(row) for row in x]


def test_a_text_is_parsed_as_a_member_only_behind_a_closing_bracket(spark):
    assert one_value("t").count("try_parse_json") == 2
    texts = ["{}", "1, 2", "", "null", "[1]", "1], [2", "1} , {", "{} ]", "[1] x", '"]"', "{}}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.expr(one_value("t")).isNotNull().alias("ok"))
    assert {r.t for r in df.collect() if r.ok} == {"{}", "null", "[1]", '"]"'}


def test_anomaly_events_shuffle_no_lists(spark):
    kinds = {"triggered_features": "array<string>", "triggered_feature_values": "map<string,double>",
             "threshold_values": "map<string,struct<lower:double,upper:double>>", "threshold_direction": "map<string,string>"}
    number = ("final_anomaly_score", "rule_score", "iforest_score")
    schema = ", ".join(f"{c} {'timestamp_ntz' if c == 'window_end_time' else 'double' if c in number else 'string'}" for c in EVENT_COLUMNS)
    df = spark.createDataFrame([], schema + "".join(f", {c} {kinds[c]}" for c in EVENT_LISTS))
    tree = to_anomaly_events(df, "2025-06-01 00:00:00")._jdf.queryExecution().optimizedPlan().toString()
    ordered = tree[tree.index("Window ["):].split("Project [", 1)[0]
    assert not any(name in ordered for name in EVENT_LISTS)


def test_events_are_stored_in_short_compressed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "scratch_path", lambda spark, name: str(tmp_path / name))
    streams.q_stream_quarantine(spark, SF_DIR)
    names = [p.name for p in (tmp_path / "stream-events" / "in").glob("part-*")]
    assert names and all(n.endswith(".gz") for n in names)


def test_batches_are_written_densely(spark, tmp_path):
    write_batch(spark.range(10), str(tmp_path / "t"), 3)
    assert all(".zstd." in p.name for p in (tmp_path / "t" / "batch_id=3").glob("part-*"))


def test_corrections_join_no_readings_with_windows(spark, tmp_path, monkeypatch):
    root, start = str(tmp_path), datetime(2025, 4, 1, 1)
    rows = readings(spark, SF_DIR).limit(50).withColumn("localtime_datetime", F.lit(start).cast("timestamp_ntz"))
    rows = rows.withColumn(DAY, F.lit(start).cast("date"))
    publish({"ontime": rows, "late": rows, "newest": spark.range(1).select(F.lit(start).cast("timestamp_ntz").alias("newest"))}, root, 0, "split")
    made = []
    monkeypatch.setattr(late, "replace_windows", lambda new, better, path: made.append((plan(better), better.collect())))
    late.merge_windows(spark, root, rows.schema, "15m", "15 minutes", energy=True)
    (tree, found), = made
    shuffled = [line for line in tree.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and not any("_end" in line for line in shuffled)  # windows of single readings
    assert sum(r.event_count for r in found) == 100


def test_a_day_of_windows_is_one_file(spark, tmp_path):
    path, names = str(tmp_path / "t"), "equipment_id string, window_end_time timestamp_ntz, v int"
    rows = spark.createDataFrame([(f"m{i}", datetime(2025, 4, 1 + i % 3, 1), i) for i in range(60)], names).repartition(6)
    replace_windows(rows, rows.limit(0), path)
    assert [len(list(p.glob("part-*"))) for p in (tmp_path / "t").glob(f"{DAY}=*")] == [1, 1, 1]


def test_scoring_rows_are_stored_as_states_only(spark, monkeypatch):
    stored = []
    keep = lambda df: stored.append(df.columns) or settle(df)
    monkeypatch.setattr(derived, "settle", keep)
    monkeypatch.setattr(scoring, "settle", keep)
    assert scoring.stored_rows(spark, SF_DIR).count() > 0
    assert len(stored) == 4 and all("sum_avg_power_factor" in names for names in stored)


def test_a_row_takes_its_limits_as_one_struct(spark):
    limits = spark.createDataFrame(
        [("1m", f, m, lo, lo + 2.0, 1.0, "high") for f in FEATURES[:5] for m, lo in (("a", 1.0), ("b", 3.0))] + [("1m", FEATURES[0], "c", None, 5.0, 1.0, "high")],
        "aggregation_level string, feature string, equipment_id string, lower double, upper double, iqr double, direction string")
    df = spark.createDataFrame([("1m", "a"), ("1m", "c"), ("1m", "x"), (None, "a")], "aggregation_level string, equipment_id string")
    out = with_thresholds(df, limits)
    tree = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_own_" not in tree.split("Relation")[0]
    got = {(r.aggregation_level, r.equipment_id): [r[f"limit_{f}"].lower for f in FEATURES] for r in out.collect()}
    assert got == {("1m", "a"): [1.0] * 5 + [0.0], ("1m", "c"): [None] + [2.0] * 4 + [0.0], ("1m", "x"): [2.0] * 5 + [0.0], (None, "a"): [0.0] * 6}


def test_alerts_are_scored_in_compiled_code(spark):
    """The JVM compiles no method above 8000 bytes; Spark then gives up the fused stage (`tune`)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = alerts.q_alert_candidates(spark, SF_DIR)._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(made))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < 8000


def test_windows_are_grouped_by_their_end_only(spark):
    states = reading_states(readings(spark, SF_DIR))
    for df in (states, merge_states(states, "15 minutes")):
        keys = re.findall(r"HashAggregate\(keys=\[(.*?)\]", plan(df))
        assert keys and all("_end" in k and "window#" not in k for k in keys)


def test_a_score_without_limits_or_numbers(spark):
    limit = "struct<lower:double,upper:double,bar:double,unit:double>"
    low, high, nan = (0.0, 1.0, 5.0, 10.0), (0.0, 1.0, 1.0, 2.0), (0.0, 1.0, 1.0, float("nan"))
    gap = (None, 1.0, None, None)
    schema = "n int, " + ", ".join(f"{f} double, limit_{f} {limit}" for f in FEATURES)
    row = lambda n, *limits: (n, *[x for each in limits for x in (2.0, each)])
    rows = [row(0, *[gap] * 6), row(1, gap, high, *[gap] * 4), row(2, nan, *[gap] * 5), row(3, low, *[gap] * 5), row(4, *[gap] * 5, low)]
    got = {r.n: r.rule_score for r in rule_score(spark.createDataFrame(rows, schema)).collect()}
    assert got == {0: 0.0, 1: 50.0, 2: 100.0, 3: 0.0, 4: 30.0}


def test_percentiles_that_cannot_scale(spark):
    inf, nan = float("inf"), float("nan")
    pairs = [(None, 1.0), (0.0, None), (nan, 1.0), (0.0, nan), (-inf, 1.0), (0.0, inf), (1.0, 1.0), (2.0, 1.0), (0.0, 0.5)]
    df = spark.createDataFrame([(i, -0.1, *p) for i, p in enumerate(pairs)], "n int, iforest_score_raw double, p1 double, p99 double")
    got = {r.n: r.iforest_score for r in scale_iforest(df).collect()}
    assert got == {**{i: 75.0 for i in range(8)}, 8: 20.0}


def test_days_are_carried_without_a_lookup(spark):
    """A row per key and day, for long spans more than the driver can broadcast."""
    rows = [(m, datetime(2025, 4, d, h), f"{m}{d}{h}") for m in ("a", None) for d in (1, 2, 5) for h in (3, 0, 7)] + [("a", None, "none")]
    df = spark.createDataFrame(rows, "m string, t timestamp_ntz, v string").repartition(3)
    made = previous_in_series(df, ["m"], "t", {"was": F.col("v")})
    assert "Broadcast" not in plan(made) and "Join" not in plan(made)
    want, last = {("none", None)}, {}
    for m, t, v in sorted((r for r in rows if r[1]), key=lambda r: r[1]):
        want.add((v, last.get(m)))
        last[m] = v
    assert {(r.v, r.was) for r in made.collect()} == want and made.columns == ["m", "t", "v", "was"]


def test_a_large_lookup_is_never_broadcast(spark):
    table = spark.range(30).select((F.col("id") % 29).alias("k"), F.col("id").alias("v")).filter("v < 29")
    joined = lookup_join(spark.range(40).withColumnRenamed("id", "k"), table, ["k"], max_rows=10)
    assert "Broadcast" not in plan(joined)
    assert sorted((r.k, r.v) for r in joined.collect()) == [(k, k if k < 29 else None) for k in range(40)]
