"""Forest scaling, level configuration, final score, level, texts and quality flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.numeric import clip, safe_double
from amperine.functions.text import fill
from amperine.operators.features import expected_events
from amperine.session import level_join

_CONFIG = (
    "aggregation_level string, rule_weight double, iforest_weight double, "
    "config_reference_only boolean, p1 double, p99 double"
)


def level_config(spark: SparkSession) -> DataFrame:
    """Weights and forest percentiles per level: four rows."""
    return spark.createDataFrame(K.LEVEL_CONFIG, _CONFIG)


def with_level_config(df: DataFrame, config: DataFrame) -> DataFrame:
    """Add weights, percentiles and `reference_only`, with defaults for unknown levels."""
    daily = F.col("aggregation_level") == "1d"
    default = lambda i: F.when(daily, K.DEFAULT_WEIGHTS_1D[i]).otherwise(K.DEFAULT_WEIGHTS[i])
    return (
        level_join(df, config)
        .withColumns(
            {
                "rule_weight": F.coalesce("rule_weight", default(0)),
                "iforest_weight": F.coalesce("iforest_weight", default(1)),
                "reference_only": F.coalesce("config_reference_only", daily),
            }
        )
        .drop("config_reference_only")
    )


def _usable_percentiles() -> Column:
    """Three comparisons, as the test is part of every row's score: NaN and infinities are not below infinity."""
    infinity = F.lit(float("inf"))
    return (F.abs("p1") < infinity) & (F.abs("p99") < infinity) & (F.col("p99") > F.col("p1"))


def lacks_percentiles(config: DataFrame) -> bool:
    """Whether a level of the configuration (four rows) has no usable percentiles."""
    return not config.filter(~F.coalesce(_usable_percentiles(), F.lit(False))).isEmpty()


def scale_iforest(df: DataFrame, batch_fallback: bool = False) -> DataFrame:
    """`iforest_score` 0..100 from the decision value `iforest_score_raw`.

    Uses the percentiles of the level. `batch_fallback` computes the minimum and maximum of
    each level over the rows at hand for levels without usable percentiles (an extra pass);
    without it, or where those are equal, the score is a fixed line around 50.
    """
    abnormal = -F.col("iforest_score_raw")
    score = F.when(_usable_percentiles(), (abnormal - F.col("p1")) / (F.col("p99") - F.col("p1")) * 100)
    if batch_fallback:
        known = F.when(~F.isnan("iforest_score_raw"), -F.col("iforest_score_raw"))
        spans = df.groupBy("aggregation_level").agg(F.min(known).alias("_lo"), F.max(known).alias("_hi"))
        df = level_join(df, spans)
        wide = F.col("_hi") > F.col("_lo")
        score = score.when(wide, (abnormal - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 100)
    score = score.otherwise(50 + abnormal * 250)
    return df.withColumn("iforest_score", clip(score, 0, 100)).drop("_lo", "_hi")


def final_level(score: Column) -> Column:
    return (
        F.when(score < K.WATCH_FROM, "normal")
        .when(score < K.WARNING_FROM, "watch")
        .when(score < K.CRITICAL_FROM, "warning")
        .otherwise("critical")
    )


def combine_scores(df: DataFrame) -> DataFrame:
    """Weighted final score, level, votes and flags."""
    rule, forest = F.col("rule_anomaly") == 1, F.col("iforest_anomaly") == 1
    df = df.withColumns(
        {
            "rule_contribution": F.col("rule_score") * F.col("rule_weight"),
            "iforest_contribution": F.col("iforest_score") * F.col("iforest_weight"),
            "model_vote_count": F.col("rule_anomaly") + F.col("iforest_anomaly"),
        }
    )
    total = clip(F.col("rule_contribution") + F.col("iforest_contribution"), 0, 100)
    df = df.withColumn("final_anomaly_score", total)
    score = F.col("final_anomaly_score")
    return df.withColumns(
        {
            "final_anomaly_level": final_level(score),
            "primary_anomaly_model": F.when(rule & forest, "rule_based+isolation_forest")
            .when(rule, "rule_based")
            .when(forest, "isolation_forest")
            .otherwise("none"),
            "strong_anomaly_candidate": F.when(F.col("model_vote_count") >= 2, 1).otherwise(0),
            "critical_candidate": F.when(score >= K.CRITICAL_FROM, 1).otherwise(0),
        }
    )


def recommended_action(rule_reason: Column, iforest_anomaly: Column) -> Column:
    """Distinct actions of the known reasons, in order, joined by '; '."""
    actions = F.create_map(*[F.lit(x) for pair in K.ACTIONS.items() for x in pair])
    named = F.array_distinct(
        F.array_compact(F.transform(F.split(rule_reason, r"\|"), lambda r: F.try_element_at(actions, r)))
    )
    by_rule = F.when(F.size(named) > 0, F.array_join(named, "; ")).otherwise(K.ACTION_UNKNOWN)
    given = rule_reason.isNotNull() & (rule_reason != "") & (rule_reason != "normal")
    return (
        F.when(given, by_rule)
        .when(iforest_anomaly == 1, K.ACTION_FOREST_ONLY)
        .otherwise(K.ACTION_ROUTINE)
    )


def final_reason() -> Column:
    """One sentence on why the row got its level."""
    when = F.col("window_end_time").cast("string")
    machine, level = F.col("equipment_id"), F.col("final_anomaly_level")
    features = F.array_join("triggered_features", ", ")
    return (
        F.when(
            F.size("triggered_features") > 0,
            fill(K.REASON_RULE, machine, when, features, F.col("iforest_score"), level),
        )
        .when(F.col("iforest_anomaly") == 1, fill(K.REASON_FOREST, machine, when, level))
        .otherwise(fill(K.REASON_NORMAL, machine, when, level))
    )


def data_quality(df: DataFrame) -> DataFrame:
    """Flag rows with too few events or low completeness."""
    events = safe_double(F.col("event_count"))
    expected = expected_events(F.col("aggregation_level"))
    few = (events <= 0) | F.coalesce(events < expected * K.LOW_EVENT_SHARE, F.lit(False))
    low = safe_double(F.col("completeness_ratio"), 1.0) < K.LOW_COMPLETENESS
    reasons = F.concat_ws(
        "|", F.when(few, "event_count_missing_or_low"), F.when(low, "completeness_ratio_below_0.8")
    )
    return df.withColumns(
        {
            "data_quality_issue_flag": F.when(few | low, 1).otherwise(0),
            "data_quality_reason": F.when(few | low, reasons).otherwise("normal"),
        }
    )
