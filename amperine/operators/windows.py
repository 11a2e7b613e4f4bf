"""Tumbling-window aggregates of readings, and roll-ups of finer aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.electrical import imbalance_rate, phase_mean
from amperine.functions.numeric import try_double
from amperine.functions.timestamps import floor_hour, label_offset

ENERGY = "15m_Total_kWh"
TICK = "interval 1 microsecond"
LINES = ("RS", "ST", "TR")
MEANS = [
    "avg_voltage_r", "avg_voltage_s", "avg_voltage_t",
    "avg_current_r", "avg_current_s", "avg_current_t",
    "avg_power_factor", "avg_voltage_imbalance_rate", "avg_current_imbalance_rate",
]


def with_event_time(
    df: DataFrame, time_col: str, delay: str | None = None, closed: str = "right"
) -> DataFrame:
    """Add the column `_event_time` that windows are built on.

    Spark windows are [start, end). Moving every time back by one microsecond turns them
    into (start, end] with the same end label. The watermark goes onto the moved column,
    because a window over any other expression would lose it. A stream that has the column
    already (from de-duplication) keeps it with its watermark.
    """
    if df.isStreaming and "_event_time" in df.columns:
        return df
    event_time = F.col(time_col)
    if df.isStreaming:
        event_time = event_time.cast("timestamp")  # watermarks need the zoned type
    if closed == "right":
        event_time = event_time - F.expr("interval 1 microsecond")
    df = df.withColumn("_event_time", event_time)
    return df.withWatermark("_event_time", delay) if delay else df


def tumbling(
    df: DataFrame, width: str, time_col: str = "localtime_datetime",
    delay: str | None = None, closed: str = "right", key: str = "module",
):
    """Group by machine and tumbling window; continue with `.agg(...)`."""
    timed = with_event_time(df, time_col, delay, closed)
    return timed.groupBy(
        F.col(key).alias("equipment_id"), F.window("_event_time", width).alias("window")
    )


def window_end(time: Column, width: str) -> Column:
    """End of the window (start, end] that a time lies in."""
    return F.window(time - F.expr(TICK), width)["end"].cast("timestamp_ntz")


def window_label(label_hours: int = 0) -> Column:
    return label_offset(F.col("window.end"), label_hours).cast("timestamp_ntz")


def reading_means() -> list[Column]:
    voltages = [F.avg(try_double(F.col(f"voltage{p}"))).alias(f"avg_voltage_{p.lower()}") for p in "RST"]
    currents = [F.avg(try_double(F.col(f"current{p}"))).alias(f"avg_current_{p.lower()}") for p in "RST"]
    return [
        *voltages,
        *currents,
        F.avg(phase_mean("powerFactor")).alias("avg_power_factor"),
        F.avg(imbalance_rate("voltage")).alias("avg_voltage_imbalance_rate"),
        F.avg(imbalance_rate("current")).alias("avg_current_imbalance_rate"),
    ]


def window_anomaly() -> Column:
    """1 if a line voltage fell to the limit or the mean power factor is at or below it.

    Comparisons with null count as false. The mean of the three phase means differs from
    the mean of row means when single phases are null.
    """
    lowest = [F.min(try_double(F.col(f"voltage{pair}"))) for pair in LINES]
    return _anomaly_flag(lowest, [F.avg(try_double(F.col(f"powerFactor{p}"))) for p in "RST"])


def _anomaly_flag(lowest: list[Column], factors: list[Column]) -> Column:
    dips = [low <= K.LINE_VOLTAGE_MIN for low in lowest]
    mean_factor = (factors[0] + factors[1] + factors[2]) / 3.0
    return (
        F.when(dips[0] | dips[1] | dips[2], 1)
        .when(mean_factor <= K.WINDOW_POWER_FACTOR_MIN, 1)
        .otherwise(0)
    )


def aggregate_readings(
    df: DataFrame, width: str, energy: bool = False, anomaly: bool = False,
    time_col: str = "localtime_datetime", delay: str | None = None,
    closed: str = "right", label_hours: int = 0, more: list[Column] | None = None,
) -> DataFrame:
    """One row per machine and window, in batch or streaming.

    All aggregates combine partially before the shuffle, so a hot machine costs the same
    as any other. `energy` adds power in kW and the energy counter difference (a counter
    reset inside a window shows as wrong energy). `anomaly` adds the window flag, `more` are
    aggregates of other columns of `df`.
    """
    wanted = reading_means()
    if anomaly:
        wanted.insert(0, window_anomaly().alias("is_anomaly"))
    if energy:
        power, counter = try_double(F.col("activePower")), try_double(F.col("accumActiveEnergy"))
        wanted += [
            (F.max(power) / 1000.0).alias("max_activePower"),
            (F.avg(power) / 1000.0).alias("avg_activePower"),
            (F.max(counter) - F.min(counter)).alias(ENERGY),
        ]
    wanted.append(F.count(F.lit(1)).alias("event_count"))
    wanted += more or []
    grouped = tumbling(df, width, time_col, delay, closed).agg(*wanted)
    metrics = [F.col(f"`{name}`") for name in grouped.columns if name not in ("equipment_id", "window")]
    return grouped.select("equipment_id", window_label(label_hours).alias("window_end_time"), *metrics)


def state_columns(energy: bool = True, anomaly: bool = False) -> list[str]:
    """The measures that `reading_states` reads."""
    phases = [f"{kind}{p}" for kind in ("voltage", "current", "powerFactor") for p in "RST"]
    power = ["activePower", "accumActiveEnergy"] if energy else []
    return [*phases, *power, *([f"voltage{pair}" for pair in LINES] if anomaly else [])]


def reading_states(
    df: DataFrame, width: str = "1 minute", energy: bool = True, anomaly: bool = False, dealt: bool = True, **timing
) -> DataFrame:
    """Mergeable states per machine and window: sums, counts and extremes.

    One pass over the readings serves every coarser window, see `from_states`. In a batch the
    readings, cut to what the states need, are dealt by machine and hour of their window: that
    is less to shuffle than states of sparse windows, no task combines more than its share of
    windows, and the windows of an hour lie together, so that coarser windows combine well
    before their own shuffle. Windows of many readings are better combined before they are
    shuffled (`dealt=False`). `energy` and `anomaly` are what `from_states` can give later.
    """
    values = {
        **{f"avg_voltage_{p.lower()}": try_double(F.col(f"voltage{p}")) for p in "RST"},
        **{f"avg_current_{p.lower()}": try_double(F.col(f"current{p}")) for p in "RST"},
        "avg_power_factor": phase_mean("powerFactor"),
        "avg_voltage_imbalance_rate": imbalance_rate("voltage"),
        "avg_current_imbalance_rate": imbalance_rate("current"),
    }
    extremes = {}
    if energy:
        values["avg_activePower"] = try_double(F.col("activePower"))
        # computed once below the aggregate, where each is used by a sum and a count
        extremes["counter"] = try_double(F.col("accumActiveEnergy"))
    if anomaly:
        values |= {f"factor_{p}": try_double(F.col(f"powerFactor{p}")) for p in "RST"}
        extremes |= {f"line_{pair}": try_double(F.col(f"voltage{pair}")) for pair in LINES}
    states = [
        column for name in values
        for column in (F.sum(f"_{name}").alias(f"sum_{name}"), F.count(f"_{name}").alias(f"n_{name}"))
    ]
    if energy:
        states += [
            F.max("_avg_activePower").alias("max_power"),
            F.min("_counter").alias("min_counter"),
            F.max("_counter").alias("max_counter"),
        ]
    if anomaly:
        states += [F.min(f"_line_{pair}").alias(f"min_line_{pair}") for pair in LINES]
    states.append(F.count(F.lit(1)).alias("event_count"))
    timed = with_event_time(df, **{"time_col": "localtime_datetime", **timing})
    window, label = F.window("_event_time", width), window_label()
    keys = [window.alias("window")]
    if not df.isStreaming:
        # the end alone names a window: one number in the shuffle and in the keys of the groups
        keys, label = ["_end"], F.col("_end").cast("timestamp_ntz")
        start = window["start"]
        hour = (F.unix_date(F.to_date(start)) * 24 + F.hour(start)).alias("_hour")
        timed = timed.select("module", window["end"].alias("_end"), *state_columns(energy, anomaly), *([hour] if dealt else []))
        if dealt:
            keys = ["_hour", "_end"]
            timed = timed.repartition("module", "_hour")
    timed = timed.withColumns({f"_{name}": value for name, value in (values | extremes).items()})
    grouped = timed.groupBy(F.col("module").alias("equipment_id"), *keys).agg(*states)
    names = [c for c in grouped.columns if c not in ("equipment_id", "window", "_hour", "_end")]
    return grouped.select("equipment_id", label.alias("window_end_time"), *names)


def merge_states(states: DataFrame, width: str) -> DataFrame:
    """States of coarser windows from those of windows that lie whole in them."""
    merge = {"max": F.max, "min": F.min}
    names = [c for c in states.columns if c not in ("equipment_id", "window_end_time")]
    merged = [merge.get(n.split("_")[0], F.sum)(n).alias(n) for n in names]
    if states.isStreaming:
        grouped, label = tumbling(states, width, "window_end_time", key="equipment_id"), window_label()
    else:
        timed = with_event_time(states, "window_end_time").withColumn("_end", F.window("_event_time", width)["end"])
        grouped, label = timed.groupBy("equipment_id", "_end"), F.col("_end").cast("timestamp_ntz")
    return grouped.agg(*merged).select("equipment_id", label.alias("window_end_time"), *names)


def from_states(states: DataFrame, width: str | None = None) -> DataFrame:
    """The aggregate from states, merged to `width` if given, with what they hold: power and energy, window flag."""
    if width is not None:
        states = merge_states(states, width)
    mean = lambda name: F.col(f"sum_{name}") / F.nullif(F.col(f"n_{name}"), F.lit(0))
    flag, power = [], []
    if "min_line_RS" in states.columns:
        lowest, factors = [F.col(f"min_line_{pair}") for pair in LINES], [mean(f"factor_{p}") for p in "RST"]
        flag = [_anomaly_flag(lowest, factors).alias("is_anomaly")]
    if "max_power" in states.columns:
        power = [
            (F.col("max_power") / 1000.0).alias("max_activePower"),
            (mean("avg_activePower") / 1000.0).alias("avg_activePower"),
            (F.col("max_counter") - F.col("min_counter")).alias(ENERGY),
        ]
    return states.select(
        "equipment_id", "window_end_time", *flag, *[mean(name).alias(name) for name in MEANS], *power, "event_count"
    )


def avg_current(df: DataFrame) -> DataFrame:
    """Add the mean of the three mean currents of an aggregate."""
    total = F.col("avg_current_r") + F.col("avg_current_s") + F.col("avg_current_t")
    return df.withColumn("avg_current", total / 3.0)


def rollup(
    agg: DataFrame, width: str, start=None, end=None, energy: bool = False
) -> DataFrame:
    """Coarser aggregate from finer ones, each mean weighted by its event count.

    Equal to aggregating the readings when no reading has a null. A given interval
    (start, end] of window ends can be re-run at any time and gives the same rows.
    """
    if start is not None:
        agg = agg.filter(F.col("window_end_time") > F.lit(start))
    if end is not None:
        agg = agg.filter(F.col("window_end_time") <= F.lit(end))
    weight = F.col("event_count")
    known = lambda name: F.when(F.col(name).isNotNull(), weight)
    columns = [
        (F.sum(F.col(name) * weight) / F.nullif(F.sum(known(name)), F.lit(0))).alias(name)
        for name in MEANS
    ]
    if energy:
        columns += [
            F.max("max_activePower").alias("max_activePower"),
            (F.sum(F.col("avg_activePower") * weight) / F.nullif(F.sum(known("avg_activePower")), F.lit(0)))
            .alias("avg_activePower"),
        ]
    columns.append(F.sum(weight).alias("event_count"))
    grouped = tumbling(agg, width, "window_end_time", key="equipment_id").agg(*columns)
    names = [c for c in grouped.columns if c not in ("equipment_id", "window")]
    return grouped.select("equipment_id", window_label().alias("window_end_time"), *names)


def base_time(df: DataFrame, time_col: str = "window_end_time") -> DataFrame:
    """One row: the latest time, cut to the hour. No rows in, error out."""
    newest = df.agg(floor_hour(F.max(time_col)).alias("base_time"))
    return newest.select(
        F.when(F.col("base_time").isNull(), F.raise_error(F.lit("no rows to take a base time from")))
        .otherwise(F.col("base_time"))
        .alias("base_time")
    )
