"""Previous row of a time series without putting one key's whole history into one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(
    df: DataFrame, keys: list[str], time_col: str, step: Column,
    measures: dict[str, tuple[Callable, Column]],
) -> DataFrame:
    """Runs of windows that follow each other without a gap: keys, start, end, windows, measures.

    `time_col` is the end of a window `step` seconds wide, a width that divides a day; each
    window comes once. `measures` name what is kept of a run: F.sum, F.min or F.max of a column.
    Runs are found inside (key, day). Only those that touch midnight, two a day at most, are
    then looked at per key to be joined over days, so no task holds the history of a key.
    """
    tick = F.expr("interval 1 microsecond")
    span = lambda seconds: F.make_interval(secs=seconds)
    named = {name: f"_m{i}" for i, name in enumerate(measures)}
    rows = df.withColumns({"_day": F.to_date(F.col(time_col) - tick), "_step": step.cast("long")})
    in_day = Window.partitionBy(*keys, "_day").orderBy(time_col)
    before = F.lag(time_col).over(in_day)
    rows = rows.withColumn("_new", F.coalesce(before + span(F.col("_step")) != F.col(time_col), F.lit(True)).cast("int"))
    rows = rows.withColumn("_run", F.sum("_new").over(in_day))
    runs = rows.groupBy(*keys, "_day", "_run", "_step").agg(
        F.min(time_col).alias("_first"), F.max(time_col).alias("_last"), F.count("*").alias("windows"),
        *[kind(column).alias(named[name]) for name, (kind, column) in measures.items()],
    )
    midnight = F.col("_day").cast("timestamp_ntz")
    touches = (F.col("_first") == midnight + span(F.col("_step"))) | (F.col("_last") == midnight + F.expr("interval 1 day"))
    runs = runs.withColumn("_touches", touches)
    over_days = Window.partitionBy(*keys).orderBy("_first")
    joined = runs.filter("_touches").withColumn(
        "_new", F.coalesce(F.lag("_last").over(over_days) + span(F.col("_step")) != F.col("_first"), F.lit(True)).cast("int")
    ).withColumn("_run", F.sum("_new").over(over_days))
    merged = joined.groupBy(*keys, "_run", "_step").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("windows").alias("windows"),
        *[kind(named[name]).alias(named[name]) for name, (kind, _) in measures.items()],
    )
    every = runs.filter(~F.col("_touches")).select(merged.columns).unionByName(merged)
    return every.select(
        *keys, (F.col("_first") - span(F.col("_step"))).alias("start"), F.col("_last").alias("end"), "windows",
        *[F.col(named[name]).alias(name) for name in measures],
    )


def previous_in_series(
    df: DataFrame, keys: list[str], time_col: str, columns: dict[str, Column]
) -> DataFrame:
    """Add `columns` evaluated on the previous row (by time) of the same key, at any gap.

    A plain lag would sort all rows of a key in one task. Here the lag runs inside
    (key, day), where the last row of the key's previous day is put before the rows of the day. So no
    table of days, which grows with the time span and the number of keys, is joined or broadcast.
    """
    names = list(columns)
    timed = df.withColumn("_day", F.to_date(time_col)).withColumn("_now", F.struct(*[
        expr.alias(name) for name, expr in columns.items()
    ]))
    days = timed.groupBy(*keys, "_day").agg(F.max_by("_now", time_col).alias("_last"))
    over_days = Window.partitionBy(*keys).orderBy("_day")
    carried = days.select(*keys, "_day", F.lag("_last").over(over_days).alias("_now"), F.lit(True).alias("_carried"))
    carried = carried.filter(F.col("_now").isNotNull())
    both = timed.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    in_day = Window.partitionBy(*keys, "_day").orderBy(F.col("_carried").desc(), time_col)
    return (
        both.withColumn("_before_row", F.lag("_now").over(in_day))
        .filter(~F.col("_carried"))
        .withColumns({name: F.col("_before_row")[name] for name in names})
        .drop("_day", "_now", "_carried", "_before_row")
    )
