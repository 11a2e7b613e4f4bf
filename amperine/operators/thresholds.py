"""Interquartile-range limits per level, feature and machine, and their lookup."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.operators.quantiles import ACCURACY, exact_quantiles
from amperine.session import level_join, lookup_join

FEATURES = list(K.RULE_DIRECTIONS)


def _direction(feature: Column) -> Column:
    high = [name for name, side in K.RULE_DIRECTIONS.items() if side == "high"]
    return F.when(feature.isin(high), "high").otherwise("low")


def fit_thresholds(
    df: DataFrame, k: float = 1.5, approximate: bool = False, accuracy: int = ACCURACY
) -> DataFrame:
    """Long table (level, feature, machine) with lower = q1 - k*iqr and upper = q3 + k*iqr.

    `df` is read twice; pass a stored table. `approximate` takes one pass with a sketch.
    """
    by = ["aggregation_level", "equipment_id"]
    if approximate:
        sketches = df.groupBy(*by).agg(
            *[F.percentile_approx(f, [0.25, 0.75], accuracy).alias(f) for f in FEATURES]
        )
        quartiles = sketches.unpivot(by, FEATURES, "feature", "quantiles").dropna(subset=["quantiles"])
    else:
        quartiles = exact_quantiles(df, by, FEATURES, [0.25, 0.75], accuracy)
    q1, q3 = F.element_at("quantiles", 1), F.element_at("quantiles", 2)
    iqr = q3 - q1
    return quartiles.select(
        "aggregation_level",
        "feature",
        "equipment_id",
        (q1 - k * iqr).alias("lower"),
        (q3 + k * iqr).alias("upper"),
        iqr.alias("iqr"),
        _direction(F.col("feature")).alias("direction"),
    )


def fallback_thresholds(thresholds: DataFrame) -> DataFrame:
    """Median limits per (level, feature) over the machines that have both limits.

    The input has one row per machine, so a group is as large as the machine count.
    """
    iqr = F.when(F.col("iqr") == 0, None).otherwise(F.col("iqr"))
    return (
        thresholds.filter(F.col("lower").isNotNull() & F.col("upper").isNotNull())
        .groupBy("aggregation_level", "feature")
        .agg(
            F.median("lower").alias("lower"),
            F.median("upper").alias("upper"),
            F.median(F.coalesce(iqr, F.lit(1.0))).alias("iqr"),
        )
        .withColumn("direction", _direction(F.col("feature")))
    )


def _limit(lower: Column, upper: Column, iqr: Column, side: Column) -> Column:
    """Limits in the form the row-wise rule needs.

    `bar` is the bound that triggers (an unreachable one instead of NaN) and `unit` the
    distance worth 100 points. Both are null where a limit is missing.
    """
    infinity = F.lit(float("inf"))
    usable = iqr.isNotNull() & (iqr != 0) & ~F.isnan(iqr) & (F.abs(iqr) != infinity)
    # unbounded widths become the largest number, so that no score turns into NaN
    width = F.least(F.abs(F.nanvl(upper - lower, infinity)), F.lit(sys.float_info.max))
    unit = F.when(usable, iqr).otherwise(F.greatest(width, F.lit(1e-9)))
    bar = F.when(side == "high", F.nanvl(upper, infinity)).otherwise(F.nanvl(lower, -infinity))
    limited = lower.isNotNull() & upper.isNotNull()
    return F.struct(
        lower.alias("lower"),
        upper.alias("upper"),
        F.when(limited, bar).alias("bar"),
        F.when(limited, unit).alias("unit"),
    )


def _wide(thresholds: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """One row per key with one struct of limits per feature."""
    side = _direction(F.col("feature"))
    limits = _limit(F.col("lower"), F.col("upper"), F.col("iqr"), side)
    return thresholds.groupBy(*keys).agg(
        *[F.max(F.when(F.col("feature") == f, limits)).alias(f"{prefix}{f}") for f in FEATURES]
    )


def with_thresholds(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Add one struct `limit_<feature>` (lower, upper, bar, unit) per rule feature.

    A machine without an entry takes the medians of its level; a feature without any entry
    takes the constants 0, 0 and 1. An entry whose limits are null stays null.
    """
    own = _wide(thresholds, ["aggregation_level", "equipment_id"], "_own_")
    shared = _wide(fallback_thresholds(thresholds), ["aggregation_level"], "_all_")
    constant = F.struct(
        F.lit(0.0).alias("lower"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("bar"), F.lit(1.0).alias("unit")
    )
    whole = lambda *prefixes: F.struct(
        *[F.coalesce(*[F.col(f"{p}{f}") for p in prefixes], constant).alias(f) for f in FEATURES])
    # gaps are filled in the small tables, so that a row takes one struct and builds none
    own = level_join(own, shared).select("aggregation_level", "equipment_id", whole("_own_", "_all_").alias("_own"))
    shared = shared.select("aggregation_level", whole("_all_").alias("_all"))
    df = lookup_join(df, own, ["aggregation_level", "equipment_id"])
    df = level_join(df, shared)
    none = F.struct(*[constant.alias(f) for f in FEATURES])
    df = df.withColumn("_limits", F.coalesce("_own", "_all", none))
    limits = {f"limit_{f}": F.col("_limits")[f] for f in FEATURES}
    return df.withColumns(limits).drop("_own", "_all", "_limits")
