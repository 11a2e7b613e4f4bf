"""Model-input rows: calendar features, validation, derived features, vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.numeric import safe_double
from amperine.operators.windows import ENERGY


def model_input(agg: DataFrame, level: str = "15m") -> DataFrame:
    """15-minute style aggregate to the scoring input row."""
    end = F.col("window_end_time")
    kept = [c for c in agg.columns if c.startswith("avg_") and c != "avg_activePower"]
    return agg.select(
        "equipment_id",
        "window_end_time",
        F.lit(level).alias("aggregation_level"),
        *kept,
        "event_count",
        F.col("max_activePower").alias("rolling_15m_peak_kW"),
        (F.col(f"`{ENERGY}`") * K.CARBON_KG_PER_KWH).alias("carbon_emission_kg"),
        F.col("avg_voltage_imbalance_rate").alias("kepco_10m_v_imb"),
        F.col("avg_current_imbalance_rate").alias("kepco_10m_c_imb"),
        F.col("avg_power_factor").alias("kepco_30m_pf"),
        F.hour(end).alias("hour"),
        F.weekday(end).alias("dayofweek"),
        F.when(F.dayofweek(end).isin(1, 7), 1).otherwise(0).alias("is_weekend"),
    )


def expected_events(level: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(0.0))
    for name in K.LEVELS:
        chain = chain.when(level == name, F.lit(float(K.EXPECTED_EVENTS[name])))
    return chain


def validate_rows(df: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """Add `is_valid` and `error`; with on_error='fail' the first bad row stops the job.

    A missing required column is an error of the whole table and is raised at once.
    """
    missing = [c for c in K.REQUIRED_SCORING_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    level = F.coalesce(F.col("aggregation_level"), F.lit("None"))
    error = F.when(
        ~level.isin(K.LEVELS), F.concat(F.lit("unsupported aggregation_level "), level)
    )
    if on_error == "fail":
        error = F.when(error.isNotNull(), F.raise_error(error).cast("string"))
    elif on_error != "quarantine":
        raise ValueError("on_error is 'quarantine' or 'fail'")
    return df.withColumn("error", error).withColumn("is_valid", F.col("error").isNull())


def derive_features(df: DataFrame, present: str | None = None) -> DataFrame:
    """Clean the numeric inputs and fill the optional features that were not sent.

    Only an absent field is derived; a field sent as null counts as 0. For rows decoded
    from JSON, `present` names the array column holding the keys each row came with.
    """
    optional = {}
    for name in K.OPTIONAL_SCORING_COLUMNS:
        if name not in df.columns:
            optional[name] = None
        elif present:
            sent = F.array_contains(F.col(present), name)
            optional[name] = F.when(sent, safe_double(F.col(name)))
        else:
            optional[name] = safe_double(F.col(name))
    numeric = [c for c in K.REQUIRED_SCORING_COLUMNS[3:]]
    df = df.withColumns({name: safe_double(F.col(name)) for name in numeric})

    voltage = (F.col("avg_voltage_r") + F.col("avg_voltage_s") + F.col("avg_voltage_t")) / 3.0
    current = (F.col("avg_current_r") + F.col("avg_current_s") + F.col("avg_current_t")) / 3.0
    factor = F.col("avg_power_factor")
    factor = F.when(factor > 1, factor / 100).otherwise(factor)
    estimated = F.sqrt(F.lit(3.0)) * voltage * current * factor / 1000
    ratio = F.col("event_count") / expected_events(F.col("aggregation_level"))

    def filled(name: str, derived: Column) -> Column:
        given = optional[name]
        return derived if given is None else F.coalesce(given, derived)

    df = df.withColumns(
        {
            "estimated_kW": filled("estimated_kW", estimated),
            "completeness_ratio": F.greatest(filled("completeness_ratio", ratio), F.lit(0.0)),
            "_avg_kw": optional["rolling_15m_avg_kW"]
            if optional["rolling_15m_avg_kW"] is not None
            else F.lit(None).cast("double"),
        }
    )
    return df.withColumn(
        "rolling_15m_avg_kW", F.coalesce(F.col("_avg_kw"), F.col("estimated_kW"))
    ).drop("_avg_kw")


def one_hot(equipment: Column, known: list[str] = K.KNOWN_EQUIPMENT) -> list[Column]:
    """One 0/1 column per known machine; an unknown machine is all zeros."""
    return [
        F.when(equipment == name, 1.0).otherwise(0.0).alias(f"equipment_id_{name}")
        for name in known
    ]


def feature_vector(
    df: DataFrame, known: list[str] = K.KNOWN_EQUIPMENT, output: str = "features"
) -> DataFrame:
    """Base features and one-hot machine in fixed order, as array<float>."""
    values = [safe_double(F.col(name)) for name in K.BASE_FEATURES]
    flags = one_hot(F.col("equipment_id"), known)
    return df.withColumn(output, F.array(*values, *flags).cast("array<float>"))
