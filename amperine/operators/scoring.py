"""Scoring input rows to predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.operators import combine
from amperine.operators.features import derive_features, feature_vector, validate_rows
from amperine.operators.iforest import Forest, score_iforest
from amperine.operators.rules import rule_score
from amperine.operators.thresholds import with_thresholds


def score(
    df: DataFrame, thresholds: DataFrame, config: DataFrame, forest: Forest | None = None,
    known: list[str] = K.KNOWN_EQUIPMENT, created_at: Column | None = None,
    on_error: str = "quarantine", present: str | None = None, keep: list[str] | None = None,
    batch_fallback: bool | None = None,
) -> DataFrame:
    """Prediction rows (27 columns, then `keep`) for the valid rows of `df`.

    Levels may be mixed. Without a forest the rows must bring `iforest_score_raw`. Apart
    from the small lookups the plan has no shuffle. `batch_fallback` scales levels without
    usable percentiles by the batch's extremes, which takes a second pass over the rows; by
    default it is on if the configuration has such a level.
    """
    if batch_fallback is None:
        batch_fallback = combine.lacks_percentiles(config)
    valid = validate_rows(df, on_error).filter("is_valid").drop("is_valid", "error")
    rows = derive_features(valid, present)
    if forest is not None:
        rows = score_iforest(feature_vector(rows, known), forest).drop("features")
    elif "iforest_anomaly" not in rows.columns:
        rows = rows.withColumn("iforest_anomaly", F.when(F.col("iforest_score_raw") < 0, 1).otherwise(0))
    rows = combine.with_level_config(rule_score(with_thresholds(rows, thresholds)), config)
    rows = combine.data_quality(combine.combine_scores(combine.scale_iforest(rows, batch_fallback)))
    rows = rows.withColumns(
        {
            "final_reason": combine.final_reason(),
            "recommended_action": combine.recommended_action(F.col("rule_reason"), F.col("iforest_anomaly")),
            "created_at": F.current_timestamp() if created_at is None else created_at,
        }
    )
    return rows.select(*K.PREDICTION_COLUMNS, *(keep or []))


def rejected_rows(df: DataFrame) -> DataFrame:
    """The rows `score` leaves out, with their error."""
    return validate_rows(df).filter(~F.col("is_valid")).drop("is_valid")
