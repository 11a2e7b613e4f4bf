"""Per-reading power-quality expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine.functions.numeric import try_double


def phase_mean(prefix: str) -> Column:
    """Mean over the three phases; null if one of them is null."""
    r, s, t = (try_double(F.col(prefix + phase)) for phase in "RST")
    return (r + s + t) / 3.0


def phase_max(prefix: str) -> Column:
    return F.greatest(*[try_double(F.col(prefix + phase)) for phase in "RST"])


def imbalance_rate(prefix: str) -> Column:
    """Distance of the highest phase from the phase mean in percent of the mean."""
    mean = phase_mean(prefix)
    return (phase_max(prefix) - mean) / F.nullif(mean, F.lit(0.0)) * 100.0


def phase_features(df: DataFrame) -> DataFrame:
    """Add the derived phase columns to raw readings."""
    return df.withColumns(
        {
            "v_avg": phase_mean("voltage"),
            "c_avg": phase_mean("current"),
            "v_max": phase_max("voltage"),
            "c_max": phase_max("current"),
            "pf_avg": phase_mean("powerFactor"),
            "v_imbalance": imbalance_rate("voltage"),
            "c_imbalance": imbalance_rate("current"),
            "active_power_kw": try_double(F.col("activePower")) / 1000.0,
        }
    )
