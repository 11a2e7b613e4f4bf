"""Demand forecasts per machine."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Python workers get these functions by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEP = timedelta(minutes=15)
RESULT_COLUMNS = ["base_time", "target_time", "equipment_id", "model_name", "yhat", "created_at"]


def seasonal_naive(
    panel: DataFrame, base_time: datetime, horizon_steps: int = 96,
    season: timedelta = timedelta(days=1), step: timedelta = STEP,
) -> DataFrame:
    """The value one season (or as many as needed) before each target time.

    Each row of the last season is sent forward by whole seasons up to the horizon, so no
    join and no shuffle is needed. A target without a source row has no forecast.
    """
    start, end = F.lit(base_time - season), F.lit(base_time + horizon_steps * step)
    last = panel.filter((F.col("ds") > start) & (F.col("ds") <= F.lit(base_time)))
    repeats = -(-(horizon_steps * step) // season)
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(season.total_seconds()))
    moved = last.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    return moved.select("unique_id", (F.col("ds") + length * F.col("_k")).alias("ds"), F.col("y").alias("yhat")).filter(
        F.col("ds") <= end
    )


def until_midnight(forecast: DataFrame, base_time: datetime) -> DataFrame:
    """Keep targets up to the midnight after the base time, included."""
    midnight = datetime.combine(base_time.date(), datetime.min.time()) + timedelta(days=1)
    return forecast.filter(F.col("ds") <= F.lit(midnight))


def normalise_forecast(forecast: DataFrame, model: str, base_time: datetime, created_at=None) -> DataFrame:
    """Result rows from the first present of `<model>`, `<model>-median`, `yhat`."""
    value = next((c for c in (model, f"{model}-median", "yhat") if c in forecast.columns), None)
    if value is None:
        raise ValueError(f"no forecast column for {model} among {forecast.columns}")
    created = F.current_timestamp() if created_at is None else F.lit(created_at)
    return forecast.select(
        F.lit(base_time).cast("timestamp_ntz").alias("base_time"),
        F.col("ds").alias("target_time"),
        F.col("unique_id").alias("equipment_id"),
        F.lit(model).alias("model_name"),
        F.col(f"`{value}`").alias("yhat"),
        created.cast("timestamp_ntz").alias("created_at"),
    )


Forecaster = Callable[[pd.DataFrame, list[datetime]], pd.DataFrame]


def custom_forecast(
    panel: DataFrame, model: str, forecaster: Forecaster, base_time: datetime,
    horizon_steps: int = 96, step: timedelta = STEP,
) -> DataFrame:
    """Run `forecaster(history, target_times)` once per machine.

    It returns a frame with `ds` and one of the accepted value columns. Repeated times of a
    machine are averaged first, so a history is at most the panel's days on its time grid.
    """
    targets = [base_time + i * step for i in range(1, horizon_steps + 1)]
    names = [model, f"{model}-median", "yhat"]

    def run(history: pd.DataFrame) -> pd.DataFrame:
        history = history.sort_values("ds").reset_index(drop=True)
        out = forecaster(history, targets)
        value = next((c for c in names if c in out.columns), None)
        if value is None:
            raise ValueError(f"no forecast column for {model} among {list(out.columns)}")
        made = pd.DataFrame({"ds": out["ds"], "yhat": out[value].astype(float)})
        made.insert(0, "unique_id", history["unique_id"].iloc[0])
        return made

    measures = ["y", "currentR", "currentS", "currentT"]
    once = panel.groupBy("unique_id", "ds").agg(*[F.avg(c).alias(c) for c in measures])
    return once.groupBy("unique_id").applyInPandas(
        run, "unique_id string, ds timestamp_ntz, yhat double"
    )


def run_forecast(
    panel: DataFrame, base_time: datetime, horizon_steps: int = 96,
    seasons: dict[str, timedelta] | None = None, forecasters: dict[str, Forecaster] | None = None,
    created_at=None,
) -> DataFrame:
    """All models on one panel, cut at midnight, in one result table."""
    made = {
        name: seasonal_naive(panel, base_time, horizon_steps, season)
        for name, season in (seasons or {}).items()
    }
    for name, forecaster in (forecasters or {}).items():
        made[name] = custom_forecast(panel, name, forecaster, base_time, horizon_steps)
    if not made:
        raise ValueError("name at least one model")
    results = [
        normalise_forecast(until_midnight(df, base_time), name, base_time, created_at)
        for name, df in made.items()
    ]
    return reduce(DataFrame.unionByName, results)


def append_forecast(result: DataFrame, path: str) -> None:
    """Append to the forecast table, partitioned by base date. An empty result is an error."""
    if result.limit(1).count() == 0:
        raise ValueError("there is no forecast to store")
    dated = result.withColumn("base_date", F.to_date("base_time"))
    dated.write.mode("append").partitionBy("base_date").parquet(path)
