"""Labelled test data: an overload with low power factor at the middle timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.operators.quantiles import exact_quantiles
from amperine.session import settle


def inject_anomaly(df: DataFrame) -> DataFrame:
    """Disturb the rows of the middle distinct timestamp (rank n // 2) and label all rows."""
    stamps = settle(df.select("timestamp").distinct())
    middle = exact_quantiles(stamps, [], ["timestamp"], [0.5], pick="higher")
    # one row; the rank n // 2 is the upper median
    middle = middle.select(
        F.element_at("quantiles", 1).alias("timestamp"), F.lit(True).alias("_hit")
    )
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    scaled = {"activePower": K.INJECT_POWER}
    scaled |= {f"current{p}": K.INJECT_CURRENT for p in "RST"}
    scaled |= {f"powerFactor{p}": K.INJECT_POWER_FACTOR for p in "RST"}
    changed = {
        name: F.when(hit, F.col(name) * factor).otherwise(F.col(name))
        for name, factor in scaled.items()
    }
    changed["synthetic_anomaly"] = hit
    changed["synthetic_anomaly_type"] = F.when(hit, K.INJECT_LABEL).otherwise("normal")
    return df.join(F.broadcast(middle), "timestamp", "left").withColumns(changed).drop("_hit")
