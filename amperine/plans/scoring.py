"""Queries on thresholds, rules, the forest and the final score."""

from __future__ import annotations

from pyspark.sql import functions as F

from amperine import constants as K
from amperine.operators import combine
from amperine.operators.features import derive_features, feature_vector, one_hot, validate_rows
from amperine.operators.iforest import (
    Forest, average_path, calibrate, fit_iforest, fit_scaler, forest_config, isolation_by_joins, score_iforest,
)
from amperine.operators.rules import rule_score
from amperine.operators.scoring import score
from amperine.operators.thresholds import fallback_thresholds, fit_thresholds, with_thresholds
from amperine.plans import sql as S
from amperine.plans.derived import MODULES, rounded, scoring_rows, with_raw_decision
from amperine.session import level_join, settle
from amperine.sources.payloads import decode_payloads

RULE_K = 0.45  # narrow limits, so that many rows trigger; 0.5 would put limits on values of pairs
_ID = ["equipment_id", "window_end_time", "aggregation_level"]


def stored_rows(spark, sf_dir, levels=K.LEVELS):
    """The aggregates that fitting and scoring read several times, from stored states."""
    return scoring_rows(spark, sf_dir, levels, reread=True)


def ruled_rows(spark, sf_dir):
    rows = stored_rows(spark, sf_dir)
    limits = settle(fit_thresholds(rows, RULE_K))
    return rule_score(with_thresholds(with_raw_decision(derive_features(rows)), limits))


def predictions(spark, sf_dir, config=None):
    rows = stored_rows(spark, sf_dir)
    limits = settle(fit_thresholds(rows, RULE_K))
    as_of = F.lit("2025-06-01 00:00:00").cast("timestamp_ntz")
    return score(with_raw_decision(rows), limits, config or combine.level_config(spark), created_at=as_of)


def forest_rows(spark, sf_dir, columns=None):
    """Scoring rows with their vectors, stored; `columns` leaves out what is not needed."""
    rows = feature_vector(derive_features(scoring_rows(spark, sf_dir, ["1m", "15m", "1h", "1d"])), MODULES)
    return settle(rows.select(*columns) if columns else rows)


def vectors(spark, sf_dir):
    return forest_rows(spark, sf_dir, [*_ID, "features"])


def q_fit_thresholds(spark, sf_dir):
    return rounded(fit_thresholds(stored_rows(spark, sf_dir)))


def q_fallback_thresholds(spark, sf_dir):
    return rounded(fallback_thresholds(fit_thresholds(stored_rows(spark, sf_dir))))


def q_derive_features(spark, sf_dir):
    rows = derive_features(scoring_rows(spark, sf_dir))
    return rounded(rows.select(*_ID, "estimated_kW", "rolling_15m_avg_kW", "completeness_ratio"))


def q_one_hot(spark, sf_dir):
    rows = scoring_rows(spark, sf_dir, ["15m"])
    return rows.select("equipment_id", "window_end_time", *one_hot(F.col("equipment_id"), MODULES))


def q_one_hot_levels(spark, sf_dir):
    """`one_hot` over the windows of all levels."""
    return scoring_rows(spark, sf_dir).select(*_ID, *one_hot(F.col("equipment_id"), MODULES))


def _validated(rows):
    level = F.when(F.col("event_count") == 3, "5m").when(F.col("event_count") != 4, F.col("aggregation_level"))
    return validate_rows(rows.withColumn("aggregation_level", level))


def q_validate_rows(spark, sf_dir):
    return _validated(scoring_rows(spark, sf_dir, ["15m", "1h"])).select(*_ID, "is_valid", "error")


def q_validate_rows_levels(spark, sf_dir):
    """`validate_rows` over the windows of all levels, next to the level they come from."""
    rows = scoring_rows(spark, sf_dir).withColumn("level", F.col("aggregation_level"))
    return _validated(rows).select("level", *_ID, "is_valid", "error")


def q_scaler_stats(spark, sf_dir):
    stats = fit_scaler(feature_vector(derive_features(scoring_rows(spark, sf_dir)), MODULES), size=28)
    pairs = F.posexplode(F.arrays_zip("mean", "scale")).alias("position", "s")
    return rounded(stats.select("aggregation_level", pairs).select(
        "aggregation_level", "position", F.col("s.mean").alias("mean"), F.col("s.scale").alias("scale")))


def q_rule_score(spark, sf_dir):
    triggered = F.array_join("triggered_features", ", ").alias("triggered")
    return rounded(ruled_rows(spark, sf_dir).select(*_ID, "rule_anomaly", "rule_score", "rule_reason", triggered))


def q_rule_findings(spark, sf_dir):
    rows = ruled_rows(spark, sf_dir).withColumn("feature", F.explode("triggered_features"))
    at = lambda name: F.element_at(name, F.col("feature"))
    return rounded(rows.select(
        *_ID, "feature", at("triggered_feature_values").alias("value"),
        at("threshold_values")["lower"].alias("lower"), at("threshold_values")["upper"].alias("upper"),
        at("threshold_direction").alias("direction")))


def q_scale_iforest(spark, sf_dir):
    rows = combine.with_level_config(with_raw_decision(scoring_rows(spark, sf_dir)), combine.level_config(spark))
    return rounded(combine.scale_iforest(rows).select(*_ID, "iforest_score_raw", "iforest_score"))


def q_scale_iforest_batch(spark, sf_dir):
    config = combine.level_config(spark).withColumns({p: F.lit(None).cast("double") for p in ("p1", "p99")})
    rows = combine.with_level_config(with_raw_decision(stored_rows(spark, sf_dir)), config)
    return rounded(combine.scale_iforest(rows, batch_fallback=True).select(*_ID, "iforest_score"))


_SCORES = ["final_anomaly_score", "final_anomaly_level", "primary_anomaly_model", "model_vote_count",
           "strong_anomaly_candidate", "critical_candidate", "rule_contribution", "iforest_contribution", "reference_only"]


_BATCH_SCORES = ["iforest_score", "final_anomaly_level", "primary_anomaly_model", "model_vote_count"]


def q_combine_scores(spark, sf_dir):
    return rounded(predictions(spark, sf_dir).select(*_ID, *_SCORES))


def q_score_quality(spark, sf_dir):
    rows = combine.data_quality(derive_features(scoring_rows(spark, sf_dir)))
    return rows.select(*_ID, "data_quality_issue_flag", "data_quality_reason")


def q_recommended_action(spark, sf_dir):
    return predictions(spark, sf_dir).select(*_ID, "rule_reason", "iforest_anomaly", "recommended_action")


_FLAT = [c for c in K.PREDICTION_COLUMNS if not c.startswith(("triggered", "threshold")) and c != "created_at"]


def q_score_rows(spark, sf_dir):
    return rounded(predictions(spark, sf_dir).select(*_FLAT))


def q_score_rows_batch(spark, sf_dir):
    """Without percentiles in the configuration: every level is scaled by its extremes.

    Contributions and their sum are left to `score_rows`: with shares of the extremes they
    often are exact ties of rounding.
    """
    config = combine.level_config(spark).withColumns({p: F.lit(None).cast("double") for p in ("p1", "p99")})
    return rounded(predictions(spark, sf_dir, config).select(*_ID, *_BATCH_SCORES))


def q_iforest_properties(spark, sf_dir):
    """Per level: rows scored, and whether scores, share of anomalies and trees are in bounds."""
    rows = vectors(spark, sf_dir)
    forest = fit_iforest(rows, ["equipment_id", "window_end_time"])
    trees = forest.nodes.groupBy("aggregation_level", "tree").agg(F.count("*").alias("n")).groupBy("aggregation_level").agg(
        F.count("*").alias("trees"), F.max("n").alias("largest"))
    limits = trees.join(forest.calibration, "aggregation_level")
    score_of = -F.col("iforest_score_raw") - F.col("offset")
    scored = level_join(score_iforest(rows, forest), limits)
    counted = scored.groupBy("aggregation_level", "trees", "largest", "p99").agg(
        F.count("*").alias("scored"), F.min(score_of).alias("low"), F.max(score_of).alias("high"),
        F.sum("iforest_anomaly").alias("found"))
    return rounded(counted.select(
        "aggregation_level", "scored", ((F.col("low") > 0) & (F.col("high") <= 1)).alias("scores_fit"),
        (F.col("found") <= F.ceil(F.col("scored") * 0.01)).alias("share_fits"),
        ((F.col("trees") == forest.trees) & (F.col("largest") <= 2 * forest.psi - 1)).alias("nodes_fit"), "p99"))


# A small stored forest for comparison with SQL. The splits lie off the values of the data.
_FIXED_TREES, _FIXED_PSI = 6, 16
_FIXED_SPLITS = {0: 14.1371, 2: 5.03217, 4: 3.07131, 5: 30.14371, 6: 92.23713, 10: 2.53117, 12: 11.53713}


def fixed_nodes():
    """Rows of a node table: three levels of splits, odd trees with a leaf on the second."""
    rows = []
    for i, level in enumerate(K.LEVELS):
        for tree in range(_FIXED_TREES):
            for node in range(15):
                depth = (node + 1).bit_length() - 1
                leaf = depth == 3 or tree % 2 == 1 and node == 2
                if tree % 2 == 1 and node in (5, 6, 11, 12, 13, 14):
                    continue
                feature = list(_FIXED_SPLITS)[(tree + node) % len(_FIXED_SPLITS)]
                split = _FIXED_SPLITS[feature] * (1 + 0.11 * (node % 3) + 0.07 * i)
                path = depth + float(average_path(1 + (tree + node) % 5))
                rows.append((level, tree, node, -1 if leaf else feature, 0.0 if leaf else split, path if leaf else 0.0))
    return rows


def fixed_forest(spark):
    nodes = spark.createDataFrame(fixed_nodes(), "aggregation_level string, tree int, node int, feature int, split double, path double")
    plain = spark.createDataFrame(
        [(level, [0.0] * 28, [1.0] * 28) for level in K.LEVELS], "aggregation_level string, mean array<double>, scale array<double>")
    return Forest(nodes, plain, plain, _FIXED_TREES, _FIXED_PSI)


def _isolated(spark, sf_dir):
    return settle(isolation_by_joins(vectors(spark, sf_dir), fixed_forest(spark), _ID))


def q_iforest_fixed(spark, sf_dir):
    """Decision values of all windows under a stored forest, offset and calibration fitted to them."""
    scores = _isolated(spark, sf_dir)
    rows = level_join(scores, calibrate(scores).select("aggregation_level", "offset"))
    return rounded(rows.select(*_ID, F.col("_s").alias("isolation"), (-F.col("_s") - F.col("offset")).alias("iforest_score_raw")))


def q_iforest_calibration(spark, sf_dir):
    return rounded(calibrate(_isolated(spark, sf_dir)))


def q_iforest(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    forest = fit_iforest(rows, ["equipment_id", "window_end_time"])
    return score_iforest(rows, forest).select(*_ID, "iforest_score_raw", "iforest_anomaly")


def q_score_with_forest(spark, sf_dir):
    rows = forest_rows(spark, sf_dir)
    forest = fit_iforest(rows, ["equipment_id", "window_end_time"])
    limits = settle(fit_thresholds(rows))
    config = forest_config(combine.level_config(spark), forest)
    return score(rows.drop("features"), limits, config, forest, known=MODULES).select(*_FLAT)


def payload_bodies(spark, sf_dir, levels=K.LEVELS, key=_ID):
    """Scoring rows as request texts in the four accepted forms, and some broken ones."""
    rows = scoring_rows(spark, sf_dir, levels)
    fields = [F.col(c) if c != "window_end_time" else F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
              for c in K.REQUIRED_SCORING_COLUMNS]
    item = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    form = F.col("event_count") % 10
    body = (
        F.when(form == 0, item)
        .when(form == 1, F.concat(F.lit("["), item, F.lit("]")))
        .when(form == 2, F.concat(F.lit('{"data":['), item, F.lit("]}")))
        .when(form == 3, F.concat(item, F.lit("\n"), item, F.lit("\n")))
        .when(form == 4, F.concat(F.lit("["), item, F.lit(", 7]")))
        .when(form == 5, F.substring(item, 1, 40))
        .when(form == 6, F.concat(item, item))
        .when(form == 7, F.concat(item, F.lit(" x}")))
        .when(form == 8, F.concat(F.lit("["), item, F.lit("] ["), item, F.lit("]")))
        .otherwise(F.concat(item, F.lit("\n"), item, F.lit(" tail")))
    )
    return rows.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in key]).alias("message"), body.alias("body"))


def _decoded(bodies, *more):
    return rounded(decode_payloads(bodies).select(
        "message", "pos", "equipment_id", "window_end_time", *more, "event_count", "avg_power_factor", "carbon_emission_kg",
        F.array_contains("keys", "completeness_ratio").alias("sent_completeness"), F.col("error").isNotNull().alias("rejected")))


def q_decode_payloads(spark, sf_dir):
    return _decoded(payload_bodies(spark, sf_dir, ["15m"], _ID[:2]))


def q_decode_payloads_levels(spark, sf_dir):
    """`decode_payloads` over the windows of all levels; the message key holds the level."""
    return _decoded(payload_bodies(spark, sf_dir), "aggregation_level")


QUERIES = {
    "fit_thresholds": q_fit_thresholds,
    "fallback_thresholds": q_fallback_thresholds,
    "derive_features": q_derive_features,
    "one_hot": q_one_hot,
    "one_hot_levels": q_one_hot_levels,
    "validate_rows": q_validate_rows,
    "validate_rows_levels": q_validate_rows_levels,
    "scaler_stats": q_scaler_stats,
    "rule_score": q_rule_score,
    "rule_findings": q_rule_findings,
    "scale_iforest": q_scale_iforest,
    "scale_iforest_batch": q_scale_iforest_batch,
    "combine_scores": q_combine_scores,
    "score_quality": q_score_quality,
    "recommended_action": q_recommended_action,
    "score_rows": q_score_rows,
    "score_rows_batch": q_score_rows_batch,
    "iforest_properties": q_iforest_properties,
    "iforest": q_iforest,
    "iforest_fixed": q_iforest_fixed,
    "iforest_calibration": q_iforest_calibration,
    "score_with_forest": q_score_with_forest,
    "decode_payloads": q_decode_payloads,
    "decode_payloads_levels": q_decode_payloads_levels,
}

_IDS = ", ".join(_ID)
_LIMITS = ["lower", "upper", "iqr"]
_RULED = [*S.scoring_rows(), S.DERIVED, S.thresholds(RULE_K), S.FALLBACK, *S.rules()]
_VECTOR = [*[f'coalesce("{c}", 0)' for c in K.BASE_FEATURES],
           *[f"CASE WHEN equipment_id = '{m}' THEN 1.0 ELSE 0.0 END" for m in MODULES]]
_VECTOR = [v.replace('"rolling_15m_avg_kW"', '"estimated_kW"') for v in _VECTOR]
_DECIDED = [*S.scoring_rows(), S.DERIVED, S.RAW_DECISION]


def _reason(template: str, *args: str) -> str:
    """A printf template as a SQL concatenation."""
    parts = template.replace("%.1f", "%s").split("%s")
    out = [f"'{parts[0]}'"]
    for arg, part in zip(args, parts[1:]):
        out += [arg, f"'{part}'"]
    return "concat(" + ", ".join(out) + ")"


_WHEN = "CAST(window_end_time AS VARCHAR)"
_FINAL_REASON = (
    f"CASE WHEN rule_anomaly = 1 THEN {_reason(K.REASON_RULE, 'equipment_id', _WHEN, 'triggered', chr(39).join(['format(', '{:.1f}', ', round(iforest_score, 1))']), 'final_anomaly_level')} "
    f"WHEN iforest_anomaly = 1 THEN {_reason(K.REASON_FOREST, 'equipment_id', _WHEN, 'final_anomaly_level')} "
    f"ELSE {_reason(K.REASON_NORMAL, 'equipment_id', _WHEN, 'final_anomaly_level')} END AS final_reason"
)
_DOUBLES = {"rule_score", "iforest_score", "iforest_score_raw", "final_anomaly_score", "rule_contribution", "iforest_contribution"}


def _select(names, source):
    columns = [_FINAL_REASON if n == "final_reason" else S.r6(n) if n in _DOUBLES else n for n in names]
    return f"SELECT {', '.join(columns)} FROM {source}"


_WALK = [
    *S.scoring_rows(), S.DERIVED,
    "vectors AS (SELECT equipment_id, window_end_time, aggregation_level, ["
    + ", ".join(f"CAST(CAST({v} AS FLOAT) AS DOUBLE)" for v in _VECTOR) + "] AS f FROM derived)",
    "nodes(aggregation_level, tree, node, feature, split, path) AS (VALUES "
    + ", ".join(f"('{lv}', {t}, {n}, {f}, CAST({s!r} AS DOUBLE), CAST({p!r} AS DOUBLE))" for lv, t, n, f, s, p in fixed_nodes()) + ")",
    "walk AS (SELECT v.*, tree, node, feature, split, path FROM vectors v JOIN nodes USING (aggregation_level) WHERE node = 0 "
    "UNION ALL SELECT w.equipment_id, w.window_end_time, w.aggregation_level, w.f, c.tree, c.node, c.feature, c.split, c.path "
    "FROM walk w JOIN nodes c ON c.aggregation_level = w.aggregation_level AND c.tree = w.tree "
    "AND c.node = 2 * w.node + 1 + CAST(w.f[w.feature + 1] > w.split AS INTEGER) WHERE w.feature >= 0)",
    f"isolated AS (SELECT equipment_id, window_end_time, aggregation_level, pow(2.0, -avg(path) / CAST({float(average_path(_FIXED_PSI))!r} AS DOUBLE)) AS s "
    "FROM walk WHERE feature < 0 GROUP BY ALL)",
    'calibration AS (SELECT aggregation_level, -quantile_cont(s, 0.99) AS "offset", quantile_cont(s, 0.01) - quantile_cont(s, 0.99) AS p1, '
    "CAST(0 AS DOUBLE) AS p99 FROM isolated GROUP BY 1)",
]

SQL = {
    "iforest_fixed": S.with_(*_WALK).replace("WITH", "WITH RECURSIVE", 1)
    + f"SELECT {_IDS}, {S.r6('isolation', 's')}, " + S.r6("iforest_score_raw", '-s - "offset"')
    + " FROM isolated JOIN calibration USING (aggregation_level)",
    "iforest_calibration": S.with_(*_WALK).replace("WITH", "WITH RECURSIVE", 1)
    + f"SELECT aggregation_level, {S.r6('offset')}, {S.r6('p1')}, {S.r6('p99')} FROM calibration",
    "fit_thresholds": S.with_(*S.scoring_rows(), S.thresholds(1.5))
    + f"SELECT aggregation_level, feature, equipment_id, {', '.join(S.r6(c) for c in _LIMITS)}, direction FROM thresholds",
    "fallback_thresholds": S.with_(*S.scoring_rows(), S.thresholds(1.5), S.FALLBACK)
    + f"SELECT aggregation_level, feature, {', '.join(S.r6(c) for c in _LIMITS)}, direction FROM fallback",
    "derive_features": S.with_(*S.scoring_rows(), S.DERIVED)
    + f"SELECT {_IDS}, {S.r6('estimated_kW')}, {S.r6('rolling_15m_avg_kW', 'estimated_kW')}, {S.r6('completeness_ratio')} FROM derived",
    "one_hot": S.with_(*S.scoring_rows(["15m"]))
    + "SELECT equipment_id, window_end_time, "
    + ", ".join(f"CAST(CASE WHEN equipment_id = '{m}' THEN 1 ELSE 0 END AS DOUBLE) AS equipment_id_{m}" for m in MODULES)
    + " FROM scoring_rows",
    "one_hot_levels": S.with_(*S.scoring_rows())
    + f"SELECT {_IDS}, "
    + ", ".join(f"CAST(CASE WHEN equipment_id = '{m}' THEN 1 ELSE 0 END AS DOUBLE) AS equipment_id_{m}" for m in MODULES)
    + " FROM scoring_rows",
    "validate_rows": S.with_(*S.scoring_rows(["15m", "1h"]))
    + "SELECT equipment_id, window_end_time, CASE WHEN event_count = 3 THEN '5m' WHEN event_count <> 4 THEN aggregation_level END AS aggregation_level, "
    "event_count NOT IN (3, 4) AS is_valid, CASE event_count WHEN 3 THEN 'unsupported aggregation_level 5m' "
    "WHEN 4 THEN 'unsupported aggregation_level None' END AS error FROM scoring_rows",
    "validate_rows_levels": S.with_(*S.scoring_rows())
    + "SELECT aggregation_level AS level, equipment_id, window_end_time, "
    "CASE WHEN event_count = 3 THEN '5m' WHEN event_count <> 4 THEN aggregation_level END AS aggregation_level, "
    "event_count NOT IN (3, 4) AS is_valid, CASE event_count WHEN 3 THEN 'unsupported aggregation_level 5m' "
    "WHEN 4 THEN 'unsupported aggregation_level None' END AS error FROM scoring_rows",
    "scaler_stats": S.with_(*S.scoring_rows(), S.DERIVED)
    + " UNION ALL ".join(
        f"SELECT aggregation_level, {i} AS position, {S.r6('mean', f'avg(CAST(CAST({v} AS FLOAT) AS DOUBLE))')}, "
        + S.r6("scale", f"coalesce(nullif(stddev_pop(CAST(CAST({v} AS FLOAT) AS DOUBLE)), 0), 1.0)")
        + " FROM derived GROUP BY 1"
        for i, v in enumerate(_VECTOR)),
    "rule_score": S.with_(*_RULED) + _select([*_ID, "rule_anomaly", "rule_score", "rule_reason", "triggered"], "ruled"),
    "rule_findings": S.with_(*_RULED)
    + " UNION ALL ".join(
        f"SELECT {_IDS}, '{f}' AS feature, {S.r6('value', f'v{i}')}, {S.r6('lower', f'lower{i}')}, "
        f"{S.r6('upper', f'upper{i}')}, '{side}' AS direction FROM ruled WHERE hit{i}"
        for i, (f, side) in enumerate(K.RULE_DIRECTIONS.items())),
    "scale_iforest": S.with_(*_DECIDED, S.CONFIG)
    + f"SELECT {_IDS}, {S.r6('iforest_score_raw')}, "
    + S.r6("iforest_score", "least(greatest((-iforest_score_raw - p1) / (p99 - p1) * 100, 0.0), 100.0)")
    + " FROM decided JOIN config USING (aggregation_level)",
    "scale_iforest_batch": S.with_(
        *_DECIDED,
        "spans AS (SELECT aggregation_level, min(-iforest_score_raw) AS lo, max(-iforest_score_raw) AS hi FROM decided GROUP BY 1)",
    ) + f"SELECT {_IDS}, "
    + S.r6("iforest_score", "least(greatest(CASE WHEN hi > lo THEN (-iforest_score_raw - lo) / (hi - lo) * 100 "
           "ELSE 50 - iforest_score_raw * 250 END, 0.0), 100.0)")
    + " FROM decided JOIN spans USING (aggregation_level)",
    "combine_scores": S.with_(*S.scored_rows(RULE_K)) + _select([*_ID, *_SCORES], "predictions"),
    "score_quality": S.with_(*S.scoring_rows(), S.DERIVED, f"marked AS (SELECT *, {S.FEW} AS few, {S.LOW} AS low FROM derived)")
    + f"SELECT {_IDS}, {S.QUALITY} FROM marked",
    "recommended_action": S.with_(*S.scored_rows(RULE_K))
    + _select([*_ID, "rule_reason", "iforest_anomaly", "recommended_action"], "predictions"),
    "score_rows": S.with_(*S.scored_rows(RULE_K)) + _select(_FLAT, "predictions"),
    "score_rows_batch": S.with_(*S.scored_rows(RULE_K, batch=True)) + _select([*_ID, *_BATCH_SCORES], "predictions"),
    "iforest_properties": S.with_(*S.scoring_rows())
    + "SELECT aggregation_level, count(*) AS scored, true AS scores_fit, true AS share_fits, true AS nodes_fit, 0.0::DOUBLE AS p99 "
    "FROM scoring_rows GROUP BY 1",
    "decode_payloads": S.with_(
        *S.scoring_rows(["15m"]),
        "copies AS (SELECT *, event_count % 10 AS form FROM scoring_rows)",
        "placed AS (SELECT *, CASE WHEN form NOT BETWEEN 5 AND 8 THEN 0 END AS pos FROM copies UNION ALL SELECT *, 1 FROM copies WHERE form IN (3, 4, 9))",
    ) + f"SELECT concat(equipment_id, ' ', {_WHEN}) AS message, pos, CASE WHEN form < 4 THEN equipment_id END AS equipment_id, "
    f"CASE WHEN form < 4 THEN {_WHEN} END AS window_end_time, CASE WHEN form < 4 THEN CAST(event_count AS DOUBLE) END AS event_count, "
    + S.r6("avg_power_factor", "CASE WHEN form < 4 THEN avg_power_factor END") + ", "
    + S.r6("carbon_emission_kg", "CASE WHEN form < 4 THEN carbon_emission_kg END")
    + ", CASE WHEN form < 4 THEN false END AS sent_completeness, form >= 4 AS rejected FROM placed",
    "decode_payloads_levels": S.with_(
        *S.scoring_rows(),
        "copies AS (SELECT *, event_count % 10 AS form FROM scoring_rows)",
        "placed AS (SELECT *, CASE WHEN form NOT BETWEEN 5 AND 8 THEN 0 END AS pos FROM copies UNION ALL SELECT *, 1 FROM copies WHERE form IN (3, 4, 9))",
    ) + f"SELECT concat(equipment_id, ' ', {_WHEN}, ' ', aggregation_level) AS message, pos, CASE WHEN form < 4 THEN equipment_id END AS equipment_id, "
    f"CASE WHEN form < 4 THEN {_WHEN} END AS window_end_time, CASE WHEN form < 4 THEN aggregation_level END AS aggregation_level, "
    "CASE WHEN form < 4 THEN CAST(event_count AS DOUBLE) END AS event_count, "
    + S.r6("avg_power_factor", "CASE WHEN form < 4 THEN avg_power_factor END") + ", "
    + S.r6("carbon_emission_kg", "CASE WHEN form < 4 THEN carbon_emission_kg END")
    + ", CASE WHEN form < 4 THEN false END AS sent_completeness, form >= 4 AS rejected FROM placed",
}
