"""Quality monitor over raw readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.operators.series import islands, previous_in_series
from amperine.operators.windows import tumbling, window_label
from amperine.session import settle


def quality_monitor(
    readings: DataFrame, level: str = "1h", duplicate_keys: list[str] | None = None,
    expected: int | None = None, jump: float = 0.5, time_col: str = "localtime_datetime",
) -> DataFrame:
    """Per machine and window: events against the expected count, duplicates, count jumps.

    `duplicate_keys` name what makes an event unique next to the machine. Readings without
    machine id form their own rows with `missing_id`. `count_ratio` compares with the
    machine's previous window that has data; `is_jump` marks a change above `jump`.
    """
    wanted = expected or K.EXPECTED_EVENTS[level]
    keys = duplicate_keys or ["timestamp"]
    # distinct events first: a repeated event collapses before the shuffle
    grouped = tumbling(
        readings.groupBy("module", time_col, *[k for k in keys if k != time_col]).agg(
            F.count(F.lit(1)).alias("_copies")
        ),
        K.LEVEL_WIDTHS[level], time_col,
    ).agg(
        F.sum("_copies").alias("event_count"),
        F.sum(F.col("_copies") - 1).alias("duplicate_count"),
    )
    windows = grouped.select(
        "equipment_id", window_label().alias("window_end_time"), "event_count", "duplicate_count"
    )
    windows = previous_in_series(
        settle(windows), ["equipment_id"], "window_end_time", {"previous_count": F.col("event_count")}
    )
    distinct = F.col("event_count") - F.col("duplicate_count")
    ratio = F.col("event_count") / F.col("previous_count")
    return windows.select(
        "equipment_id",
        "window_end_time",
        "event_count",
        "duplicate_count",
        F.greatest(F.lit(wanted) - distinct, F.lit(0)).alias("missing_count"),
        (F.least(distinct / F.lit(wanted), F.lit(1.0))).alias("completeness"),
        F.coalesce(F.trim("equipment_id") == "", F.lit(True)).alias("missing_id"),
        ratio.alias("count_ratio"),
        F.coalesce(F.abs(ratio - 1) > jump, F.lit(False)).alias("is_jump"),
    )


def window_grid(windows: DataFrame, level: str) -> DataFrame:
    """equipment_id and end of every window from a machine's first to its last one.

    Made per machine and day, so a task holds the windows of days, not of a history.
    """
    step = F.expr(f"interval {K.LEVEL_WIDTHS[level]}")
    tick = F.expr("interval 1 microsecond")
    spans = windows.groupBy("equipment_id").agg(F.min("window_end_time").alias("_first"), F.max("window_end_time").alias("_last"))
    day = F.explode(F.sequence(F.to_date(F.col("_first") - tick), F.to_date(F.col("_last") - tick))).alias("_day")
    days = spans.select("equipment_id", "_first", "_last", day).repartition("equipment_id", "_day")
    midnight = F.col("_day").cast("timestamp_ntz")
    ends = F.explode(F.sequence(midnight + step, midnight + F.expr("interval 1 day"), step)).alias("window_end_time")
    every = days.select("equipment_id", "_first", "_last", ends)
    return every.filter(F.col("window_end_time").between(F.col("_first"), F.col("_last"))).select("equipment_id", "window_end_time")


def quality_gaps(readings: DataFrame, level: str = "1h", time_col: str = "localtime_datetime") -> DataFrame:
    """Silent spells of every machine: windows between its first and last one without any event.

    gap_start, gap_end, silent_windows, missing_events and duration_minutes, one row per spell.
    """
    windows = settle(tumbling(readings, K.LEVEL_WIDTHS[level], time_col).count().select("equipment_id", window_label().alias("window_end_time")))
    seen = windows.toDF("_id", "_end")
    grid = window_grid(windows, level)
    absent = grid.join(seen, grid["equipment_id"].eqNullSafe(F.col("_id")) & (grid["window_end_time"] == F.col("_end")), "left_anti")
    seconds = F.lit(K.LEVEL_SECONDS[level])
    spells = islands(absent, ["equipment_id"], "window_end_time", seconds, {})
    return spells.select(
        "equipment_id", F.col("start").alias("gap_start"), F.col("end").alias("gap_end"),
        F.col("windows").alias("silent_windows"), (F.col("windows") * K.EXPECTED_EVENTS[level]).alias("missing_events"),
        (F.col("windows") * seconds / 60).cast("long").alias("duration_minutes"),
    )


def quality_lateness(
    readings: DataFrame, arrival: str = "ingest_ts", time_col: str = "localtime_datetime",
    edges: tuple[int, ...] = K.LATENESS_EDGES,
) -> DataFrame:
    """Histogram of the seconds from event to arrival, per machine.

    A bucket counts delays from `delay_from` to below `delay_to`; the first has no lower and the
    last no upper end. Events that arrive before they happen show as a bucket below 0, events
    without a delay (a time is null) as one without ends.
    """
    delay = F.unix_micros(F.col(arrival).cast("timestamp")) - F.unix_micros(F.col(time_col).cast("timestamp"))
    place = sum((delay >= edge * 1_000_000).cast("int") for edge in edges)
    counts = readings.groupBy(F.col("module").alias("equipment_id"), place.alias("bucket")).agg(
        F.count("*").alias("event_count"), F.max(delay).alias("_most"), F.sum(delay).alias("_sum"),
    )
    bound = F.array(F.lit(None).cast("long"), *[F.lit(e).cast("long") for e in edges], F.lit(None).cast("long"))
    return counts.select(
        "equipment_id", bound[F.col("bucket")].alias("delay_from"), bound[F.col("bucket") + 1].alias("delay_to"), "event_count",
        (F.col("_most") / 1e6).alias("max_delay_seconds"), (F.col("_sum") / F.col("event_count") / 1e6).alias("mean_delay_seconds"),
    )


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [name for name in required if name not in df.columns]
