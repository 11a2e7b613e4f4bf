import json
import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.numeric import safe_double
from amperine.operators import combine
from amperine.operators.features import derive_features, feature_vector, validate_rows
from amperine.operators.iforest import (
    isolation_by_joins,
    Forest, average_path, fit_iforest, fit_scaler, forest_config, score_iforest,
)
from amperine.operators.rules import rule_score
from amperine.operators.scoring import rejected_rows, score
from amperine.operators.thresholds import FEATURES, fit_thresholds, with_thresholds
from amperine.schemas import THRESHOLDS

EXAMPLE = {
    "equipment_id": "13(3호기)", "window_end_time": "2025-04-15T23:45:00", "aggregation_level": "15m",
    "avg_voltage_r": 221.0, "avg_voltage_s": 218.5, "avg_voltage_t": 220.2, "avg_current_r": 31.0,
    "avg_current_s": 44.0, "avg_current_t": 20.0, "avg_power_factor": 72.0, "avg_voltage_imbalance_rate": 4.5,
    "avg_current_imbalance_rate": 46.0, "event_count": 180.0, "rolling_15m_peak_kW": 28.0,
    "carbon_emission_kg": 2.8, "kepco_10m_v_imb": 3.8, "kepco_10m_c_imb": 38.0, "kepco_30m_pf": 76.0,
    "hour": 23.0, "dayofweek": 1.0, "is_weekend": 0.0, "completeness_ratio": 1.0,
}
TYPES = ", ".join(f"`{k}` {'string' if isinstance(v, str) else 'double'}" for k, v in EXAMPLE.items())


def rows_of(spark, *changes, drop=()):
    kept = [k for k in EXAMPLE if k not in drop]
    types = ", ".join(f"`{k}` {'string' if isinstance(EXAMPLE[k], str) else 'double'}" for k in kept)
    return spark.createDataFrame([tuple({**EXAMPLE, **c}[k] for k in kept) for c in changes or [{}]], types)


def limits_of(spark, *rows):
    full = [(lv, f, eq, lo, up, iqr, K.RULE_DIRECTIONS[f]) for lv, f, eq, lo, up, iqr in rows]
    return spark.createDataFrame(full, THRESHOLDS)


ALL = [("15m", f, "13(3호기)", 10.0, 20.0, 5.0) for f in FEATURES]


def ruled(spark, limits, *changes):
    return rule_score(with_thresholds(derive_features(rows_of(spark, *changes)), limits)).collect()


def test_rule_scores_and_explanations(spark):
    limits = limits_of(
        spark, ("15m", "avg_current_imbalance_rate", "13(3호기)", 0.0, 40.0, 12.0),
        ("15m", "avg_voltage_imbalance_rate", "13(3호기)", 0.0, 4.5, 1.0),
        ("15m", "rolling_15m_peak_kW", "13(3호기)", 0.0, 50.0, 1.0),
        ("15m", "carbon_emission_kg", "13(3호기)", 0.0, 50.0, 1.0),
        ("15m", "avg_power_factor", "13(3호기)", 80.0, 100.0, 0.0),
        ("15m", "kepco_30m_pf", "13(3호기)", None, 100.0, 5.0),
    )
    row = ruled(spark, limits, {})[0]
    assert row.rule_anomaly == 1
    # current: (46 - 40) / 12 = 50; voltage 4.5 is not above 4.5; factor: (80 - 72) / |100 - 80| = 40
    assert row.rule_score == pytest.approx(50.0)
    assert row.rule_reason == "avg_current_imbalance_rate_high|avg_power_factor_low"
    assert row.triggered_features == ["avg_current_imbalance_rate", "avg_power_factor"]
    assert row.triggered_feature_values == {"avg_current_imbalance_rate": 46.0, "avg_power_factor": 72.0}
    assert row.threshold_values["avg_power_factor"].asDict() == {"lower": 80.0, "upper": 100.0}
    assert row.threshold_direction == {"avg_current_imbalance_rate": "high", "avg_power_factor": "low"}


def test_rule_score_is_clipped_and_normal_is_empty(spark):
    high = [("15m", f, "13(3호기)", -1e9, 1e9, 1.0) for f in FEATURES]
    row = ruled(spark, limits_of(spark, *high), {})[0]
    assert (row.rule_anomaly, row.rule_score, row.rule_reason) == (0, 0.0, "normal")
    assert row.triggered_features == [] and row.threshold_values == {}
    row = ruled(spark, limits_of(spark, *ALL), {"avg_current_imbalance_rate": 1e6})[0]
    assert row.rule_score == 100.0


def test_unusable_limits_never_trigger(spark):
    nan = float("nan")
    row = ruled(spark, limits_of(spark, *[("15m", f, "13(3호기)", nan, nan, nan) for f in FEATURES]), {})[0]
    assert (row.rule_anomaly, row.rule_score) == (0, 0.0)
    row = ruled(spark, limits_of(spark, *[("15m", f, "13(3호기)", None, None, None) for f in FEATURES]), {})[0]
    assert (row.rule_anomaly, row.rule_score) == (0, 0.0)


def test_fallback_to_medians_then_constants(spark):
    f = "rolling_15m_peak_kW"
    limits = limits_of(spark, ("15m", f, "a", 0.0, 10.0, 0.0), ("15m", f, "b", 0.0, 30.0, 4.0),
                       ("15m", f, "c", None, 99.0, 9.0), ("1h", "avg_power_factor", "a", 1.0, 2.0, 3.0))
    row = with_thresholds(rows_of(spark), limits).first()
    limit = row[f"limit_{f}"]  # medians of a and b; iqr 0 counts as 1
    assert (limit.lower, limit.upper, limit.unit) == (0.0, 20.0, 2.5)
    other = row["limit_carbon_emission_kg"]
    assert (other.lower, other.upper, other.bar, other.unit) == (0.0, 0.0, 0.0, 1.0)


def test_random_rows_against_plain_python(spark):
    rng = np.random.default_rng(5)
    pick = lambda *values: values[int(rng.integers(len(values)))]
    machines, levels = ["a", "b", "c"], ["15m", "1h"]
    table = {
        (lv, f, m): (pick(None, 5.0, 60.0), pick(None, 30.0, 80.0), pick(None, 0.0, 2.0, float("inf")))
        for lv in levels for f in FEATURES for m in machines if rng.random() < 0.7
    }
    changes = [
        {"equipment_id": pick("a", "b", "c", "d"), "aggregation_level": pick(*levels),
         **{f: float(rng.uniform(0, 100)) for f in FEATURES}}
        for _ in range(200)
    ]

    def expected(row):
        hits, best = [], 0.0
        for f in FEATURES:
            lv, side = row["aggregation_level"], K.RULE_DIRECTIONS[f]
            limit = table.get((lv, f, row["equipment_id"]))
            if limit is None:
                known = [v for (l, g, _), v in table.items() if (l, g) == (lv, f) and v[0] is not None and v[1] is not None]
                limit = tuple(np.median([(v[0], v[1], v[2] or 1.0) for v in known], axis=0)) if known else (0.0, 0.0, 1.0)
            lower, upper, iqr = limit
            if lower is None or upper is None:
                continue
            unit = iqr if iqr and math.isfinite(iqr) else max(abs(upper - lower), 1e-9)
            over = row[f] - upper if side == "high" else lower - row[f]
            best = max(best, min(max(over / unit * 100, 0.0), 100.0))
            if over > 0:
                hits.append(f"{f}_{side}")
        return round(best, 8), "|".join(hits) or "normal"

    limits = limits_of(spark, *[(lv, f, m, *v) for (lv, f, m), v in table.items()])
    indexed = [{**c, "event_count": float(i + 1)} for i, c in enumerate(changes)]
    got = {int(r.event_count): (round(r.rule_score, 8), r.rule_reason) for r in ruled(spark, limits, *indexed)}
    assert got == {i + 1: expected({**EXAMPLE, **c}) for i, c in enumerate(changes)}


@pytest.mark.parametrize("value,level", [(0, "normal"), (29.999, "normal"), (30, "watch"), (49.9, "watch"), (50, "warning"),
                                         (74.99, "warning"), (75, "critical"), (100, "critical")])
def test_level_bounds(spark, value, level):
    assert spark.range(1).select(combine.final_level(F.lit(float(value)))).first()[0] == level


def test_safe_double(spark):
    texts = ["1.5", "bad", None, "NaN", "Infinity", "-Infinity", "-0.25", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(safe_double(F.col("t"))).collect()] == [1.5, 0, 0, 0, 0, 0, -0.25, 0]


def test_derived_features_absent_or_null(spark):
    row = derive_features(rows_of(spark, drop=["completeness_ratio"])).first()
    kw = math.sqrt(3) * (221 + 218.5 + 220.2) / 3 * (31 + 44 + 20) / 3 * 0.72 / 1000
    assert row.estimated_kW == pytest.approx(kw) and row.rolling_15m_avg_kW == pytest.approx(kw)
    assert row.completeness_ratio == 1.0
    assert derive_features(rows_of(spark, {"completeness_ratio": None})).first().completeness_ratio == 0.0
    assert derive_features(rows_of(spark, {"completeness_ratio": -2.0})).first().completeness_ratio == 0.0
    whole = derive_features(rows_of(spark, {"avg_power_factor": 0.72})).first()
    assert whole.estimated_kW == pytest.approx(kw)
    keyed = rows_of(spark, {"completeness_ratio": None}).withColumn("keys", F.array(F.lit("event_count")))
    assert derive_features(keyed, "keys").first().completeness_ratio == 1.0


def test_validation(spark):
    df = rows_of(spark, {}, {"aggregation_level": "5m"}, {"aggregation_level": None})
    assert [r.is_valid for r in validate_rows(df).collect()] == [True, False, False]
    assert rejected_rows(df).count() == 2
    with pytest.raises(ValueError, match="event_count"):
        validate_rows(df.drop("event_count"))
    with pytest.raises(Exception, match="unsupported"):
        validate_rows(df, "fail").collect()


def test_scale_branches(spark):
    def scaled(rows, batch):
        df = spark.createDataFrame(rows, "aggregation_level string, iforest_score_raw double, p1 double, p99 double")
        return [r.iforest_score for r in combine.scale_iforest(df, batch).orderBy("iforest_score_raw").collect()]

    assert scaled([("15m", -0.5, -0.1, 0.0), ("15m", 0.05, -0.1, 0.0), ("15m", 0.5, -0.1, 0.0)], False) == [100.0, 50.0, 0.0]
    assert scaled([("15m", -1.0, None, None), ("15m", 0.0, None, None), ("15m", 1.0, None, None)], True) == [100.0, 50.0, 0.0]
    assert scaled([("15m", -0.1, None, 1.0)], True) == pytest.approx([75.0])
    assert scaled([("15m", 0.1, 1.0, 1.0)], False) == pytest.approx([25.0])


def test_actions(spark):
    cases = [("normal", 0, K.ACTION_ROUTINE), ("normal", 1, K.ACTION_FOREST_ONLY), ("what_high", 1, K.ACTION_UNKNOWN),
             ("kepco_30m_pf_low|what|avg_power_factor_low|kepco_30m_pf_low", 0,
              "누적 역률 저하 원인 점검; 역률 저하 및 무효전력 보상 상태 점검")]
    df = spark.createDataFrame(cases, "r string, i int, want string")
    got = df.select(combine.recommended_action(F.col("r"), F.col("i")).alias("got"), "want").collect()
    assert all(row.got == row.want for row in got)


def test_quality_flags(spark):
    df = rows_of(spark, {"event_count": 0.0, "completeness_ratio": 0.5}, {"event_count": 35.9}, {"event_count": 36.0},
                 {"completeness_ratio": 0.8})
    got = [r.data_quality_reason for r in combine.data_quality(df).collect()]
    assert got == ["event_count_missing_or_low|completeness_ratio_below_0.8", "event_count_missing_or_low", "normal", "normal"]


def test_weights_default_for_unknown_config(spark):
    config = combine.level_config(spark).filter("aggregation_level = '1m'")
    df = rows_of(spark, {"aggregation_level": "1m"}, {"aggregation_level": "15m"}, {"aggregation_level": "1d"})
    got = {r.aggregation_level: (r.rule_weight, r.iforest_weight, r.reference_only)
           for r in combine.with_level_config(df, config).collect()}
    assert got == {"1m": (0.55, 0.45, False), "15m": (0.55, 0.45, False), "1d": (0.6, 0.4, True)}


# --- forest ---------------------------------------------------------------------------


def history(spark, n=1500):
    """Normal rows of two levels and 5 planted outliers."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        far = i % (n // 5) == 7
        rows.append({
            "equipment_id": K.KNOWN_EQUIPMENT[i % 3], "window_end_time": str(datetime.fromtimestamp(1_700_000_000 + 900 * i)),
            "aggregation_level": "15m" if i % 2 else "1h", "avg_power_factor": float(rng.normal(95, 1)) - 60 * far,
            "avg_current_imbalance_rate": float(rng.normal(10, 2)) + 80 * far, "rolling_15m_peak_kW": float(rng.normal(20, 2)) + 90 * far,
            "carbon_emission_kg": float(rng.normal(3, 0.2)) + 20 * far, "dayofweek": 6.0 if far else float(i % 5),
        })
    return feature_vector(derive_features(rows_of(spark, *rows)))


@pytest.fixture(scope="module")
def fitted(spark):
    rows = history(spark).cache()
    return rows, fit_iforest(rows, ["equipment_id", "window_end_time"], trees=40, psi=64)


def test_average_path():
    assert average_path([0, 1, 2]).tolist() == [0.0, 0.0, 1.0]
    assert float(average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_forest_ranks_outliers_first(spark, fitted):
    rows, forest = fitted
    scored = score_iforest(rows, forest).select("aggregation_level", "avg_power_factor", "iforest_score_raw", "iforest_anomaly").toPandas()
    worst = scored.sort_values("iforest_score_raw").head(5)
    assert (worst["avg_power_factor"] < 60).all() and (worst["iforest_anomaly"] == 1).all()
    share = scored.groupby("aggregation_level")["iforest_anomaly"].mean()
    assert ((share > 0.001) & (share < 0.02)).all()


def test_forest_nodes_are_bounded(fitted):
    nodes = fitted[1].nodes.toPandas()
    per_tree = nodes.groupby(["aggregation_level", "tree"]).size()
    assert len(per_tree) == 80 and per_tree.max() <= 2 * 64 - 1
    assert fitted[1].calibration.count() == 2


def test_forest_is_reproducible_and_storable(spark, fitted, tmp_path):
    rows, forest = fitted
    again = fit_iforest(rows.repartition(7), ["equipment_id", "window_end_time"], trees=40, psi=64)
    key = ["aggregation_level", "tree", "node"]
    a, b = (f.nodes.toPandas().sort_values(key).reset_index(drop=True) for f in (forest, again))
    assert a[key + ["feature"]].equals(b[key + ["feature"]]) and np.allclose(a["split"], b["split"])
    forest.save(str(tmp_path / "m"))
    loaded = Forest.load(spark, str(tmp_path / "m"), 40, 64)
    one = lambda f: sorted(r[0] for r in score_iforest(rows, f).select("iforest_score_raw").collect())
    assert np.allclose(one(forest), one(loaded))


def test_calibration_puts_the_upper_percentile_at_zero(fitted):
    for row in fitted[1].calibration.collect():
        assert row.p99 == pytest.approx(0.0, abs=1e-9) and row.p1 < 0


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([("15m", [1.0, 5.0]), ("15m", [3.0, 5.0])], "aggregation_level string, features array<float>")
    row = fit_scaler(df).first()
    assert row["mean"] == [2.0, 5.0] and row["scale"] == [1.0, 1.0]


def test_whole_scoring_of_the_example(spark, fitted):
    rows, forest = fitted
    limits = fit_thresholds(rows)
    config = forest_config(combine.level_config(spark), forest)
    stamp = F.lit("2025-06-01 00:00:00").cast("timestamp_ntz")
    out = score(rows_of(spark, {}, {"aggregation_level": "1h"}, {"aggregation_level": "7d"}), limits, config, forest, created_at=stamp)
    assert out.columns == K.PREDICTION_COLUMNS and len(out.columns) == 27
    got = out.collect()
    assert len(got) == 2
    for row in got:
        assert 0 <= row.final_anomaly_score <= 100
        assert row.final_anomaly_level in {"normal", "watch", "warning", "critical"}
        assert row.rule_anomaly == 1 and "avg_power_factor_low" in row.rule_reason
        assert row.final_reason.startswith("13(3호기) 설비가 2025-04-15T23:45:00 기준 ")
        json.dumps(row.asDict(recursive=True), default=str)


def test_a_level_without_a_forest_stops_the_job(spark, fitted):
    df, forest = fitted
    other = df.withColumn("aggregation_level", F.lit("no such level"))
    with pytest.raises(Exception, match="no forest was fitted"):
        score_iforest(other, forest).collect()


def test_scoring_takes_the_extremes_of_a_batch_without_percentiles(spark):
    df = rows_of(spark, {"hour": 1.0}, {"hour": 2.0}).withColumn("iforest_score_raw", F.when(F.col("hour") == 1, 0.05).otherwise(-0.01))
    config = combine.level_config(spark).withColumn("p99", F.lit(None).cast("double"))
    limits = limits_of(spark, *ALL)
    points = lambda c: sorted(r.iforest_score for r in score(df, limits, c).collect())
    assert points(config) == [0.0, 100.0]
    assert points(combine.level_config(spark)) != [0.0, 100.0]


def test_reason_sentences(spark):
    base = {"iforest_score": 12.34, "iforest_anomaly": 0, "final_anomaly_level": "watch"}
    df = rows_of(spark).withColumns({k: F.lit(v) for k, v in base.items()})
    none = df.withColumn("triggered_features", F.array().cast("array<string>"))
    some = df.withColumn("triggered_features", F.array(F.lit("a"), F.lit("b")))
    said = lambda d: d.select(combine.final_reason()).first()[0]
    when = "2025-04-15T23:45:00"
    assert said(some) == K.REASON_RULE % ("13(3호기)", when, "a, b", 12.3, "watch")
    assert said(none) == K.REASON_NORMAL % ("13(3호기)", when, "watch")
    assert said(none.withColumn("iforest_anomaly", F.lit(1))) == K.REASON_FOREST % ("13(3호기)", when, "watch")


def test_scoring_by_joins_equals_the_arrow_path(spark):
    rows = history(spark, 600)
    forest = fit_iforest(rows, ["equipment_id", "window_end_time"], trees=12, psi=64)
    key = ["equipment_id", "window_end_time", "aggregation_level"]
    scores = isolation_by_joins(rows, forest, key)
    assert "Python" not in scores._jdf.queryExecution().executedPlan().toString()
    arrow = {(r.equipment_id, r.window_end_time, r.aggregation_level): r.iforest_score_raw for r in score_iforest(rows, forest).collect()}
    offset = {r.aggregation_level: r.offset for r in forest.calibration.collect()}
    got = {tuple(r)[:3]: -r._s - offset[r.aggregation_level] for r in scores.collect()}
    assert got.keys() == arrow.keys() and len(got) > 100 and all(abs(got[k] - arrow[k]) < 1e-12 for k in got)
    other = rows.limit(1).withColumn("aggregation_level", F.lit("5m"))
    with pytest.raises(Exception, match="no forest was fitted"):
        isolation_by_joins(other, forest, key).collect()
