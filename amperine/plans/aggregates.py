"""Queries on readings, window aggregates and roll-ups."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.electrical import phase_features
from amperine.functions.timestamps import local_date, local_day_bounds, parse_localtime
from amperine.operators.injection import inject_anomaly
from amperine.operators.features import model_input
from amperine.operators.quality import quality_gaps, quality_lateness, quality_monitor
from amperine.operators.windows import MEANS, aggregate_readings, avg_current, base_time, rollup
from amperine.plans import sql as S
from amperine.plans.derived import aggregate, events, readings, rounded
from amperine.schemas import MEASURES
from amperine.session import scratch_path, settle
from amperine.sources.readings import decode_events, next_chunk, sample_readings, to_event_json
from amperine.sources.writers import DAY, replace_days, store_days

CHUNK = dict(last_timestamp=10_000, chunk_timestamps=20, end_timestamp=250_000,
             modules=["module_01", "module_02", "module_05"])


def q_sample_readings(spark, sf_dir):
    return sample_readings(readings(spark, sf_dir), 10, MEASURES)


def q_next_chunk(spark, sf_dir):
    return next_chunk(readings(spark, sf_dir), **CHUNK)


def q_parse_localtime(spark, sf_dir):
    df = readings(spark, sf_dir)
    return df.select("timestamp", "localtime", parse_localtime(F.col("localtime")).alias("parsed"))


def q_local_day_bounds(spark, sf_dir):
    bounds = local_day_bounds(F.col("ts"))
    return events(spark, sf_dir).select(
        "event_id", bounds["start_utc"].alias("start_utc"), bounds["end_utc"].alias("end_utc"),
        local_date(F.col("ts")).cast("string").alias("local_date"),
    )


def q_phase_features(spark, sf_dir):
    df = phase_features(readings(spark, sf_dir))
    return rounded(df.select("timestamp", "module", "v_avg", "c_avg", "v_max", "c_max", "pf_avg",
                             "v_imbalance", "c_imbalance", "active_power_kw"))


def q_event_json(spark, sf_dir):
    sent = to_event_json(readings(spark, sf_dir))
    return decode_events(sent).drop("_bad")


def _agg(level, **options):
    return lambda spark, sf_dir: rounded(aggregate(spark, sf_dir, level, **options))


def q_agg_2m(spark, sf_dir):
    return rounded(aggregate_readings(readings(spark, sf_dir), "2 minutes"))


def q_agg_1h_shifted(spark, sf_dir):
    df = aggregate(spark, sf_dir, "1h", label_hours=9)
    return rounded(df.select("equipment_id", "window_end_time", *MEANS, "event_count"))


def q_avg_current(spark, sf_dir):
    df = avg_current(aggregate(spark, sf_dir, "1m"))
    return rounded(df.select("equipment_id", "window_end_time", "avg_current"))


def _rollup(level):
    def query(spark, sf_dir):
        return rounded(rollup(aggregate(spark, sf_dir, "15m"), K.LEVEL_WIDTHS[level]))

    return query


def q_rollup_power_1h(spark, sf_dir):
    return rounded(rollup(aggregate(spark, sf_dir, "15m", energy=True), "1 hour", energy=True))


def q_rollup_rerun(spark, sf_dir):
    """Hours of every second machine, then the first day run again, twice, with all machines."""
    agg = settle(aggregate(spark, sf_dir, "15m"))
    path = scratch_path(spark, "hours")
    even = F.substring("equipment_id", 8, 2).cast("int") % 2 == 0
    store_days(rollup(agg.filter(even), "1 hour"), path)
    day, after = date(2025, 4, 1), date(2025, 4, 2)
    for _ in range(2):
        replace_days(rollup(agg, "1 hour", datetime(2025, 4, 1), datetime(2025, 4, 2)), path, day, after)
    return rounded(spark.read.parquet(path).drop(DAY))


def q_model_input(spark, sf_dir):
    return rounded(model_input(aggregate(spark, sf_dir, "15m", energy=True)))


def q_inject_anomaly(spark, sf_dir):
    df = inject_anomaly(readings(spark, sf_dir))
    changed = ["activePower", "currentR", "currentS", "currentT", "powerFactorR", "powerFactorS", "powerFactorT"]
    return rounded(df.select("timestamp", "module", *changed, "synthetic_anomaly", "synthetic_anomaly_type"))


def q_base_time(spark, sf_dir):
    return base_time(aggregate(spark, sf_dir, "15m"))


def q_quality_monitor(spark, sf_dir):
    return rounded(quality_monitor(readings(spark, sf_dir), "1h"))


def _gaps(level):
    return lambda spark, sf_dir: quality_gaps(readings(spark, sf_dir), level)


def q_quality_lateness(spark, sf_dir):
    """Arrival times from a minute before the event to over an hour behind it."""
    shift = F.make_interval(secs=F.col("activePower") % 4000 - 60)
    arrived = readings(spark, sf_dir).withColumn("ingest_ts", F.col("localtime_datetime") + shift)
    return rounded(quality_lateness(arrived))


QUERIES = {
    "sample_readings": q_sample_readings,
    "next_chunk": q_next_chunk,
    "parse_localtime": q_parse_localtime,
    "local_day_bounds": q_local_day_bounds,
    "phase_features": q_phase_features,
    "event_json": q_event_json,
    "agg_1m": _agg("1m", anomaly=True),
    "agg_2m": q_agg_2m,
    "agg_15m": _agg("15m", energy=True),
    "agg_1h": _agg("1h"),
    "agg_1d": _agg("1d"),
    "agg_1h_shifted": q_agg_1h_shifted,
    "avg_current": q_avg_current,
    "rollup_1h": _rollup("1h"),
    "rollup_1d": _rollup("1d"),
    "rollup_power_1h": q_rollup_power_1h,
    "rollup_rerun": q_rollup_rerun,
    "model_input": q_model_input,
    "inject_anomaly": q_inject_anomaly,
    "base_time": q_base_time,
    "quality_monitor": q_quality_monitor,
    "quality_gaps": _gaps("1m"),
    "quality_gaps_15m": _gaps("15m"),
    "quality_lateness": q_quality_lateness,
}


def _agg_sql(level, extra=(), power=False, shift=""):
    columns = ["equipment_id", f"window_end_time{shift} AS window_end_time", *extra, *[S.r6(c) for c in S.MEANS]]
    columns += [S.r6(c) for c in S.POWER] if power else []
    return (
        S.with_(S.READINGS, S.aggregate("a", S.WIDTHS[level]))
        + f"SELECT {', '.join(columns)}, event_count FROM a"
    )


def _gaps_sql(level, expected):
    width = S.WIDTHS[level]
    return S.with_(
        S.READINGS,
        f"seen AS (SELECT DISTINCT module, {S.window_end('localtime_datetime', width)} AS window_end_time FROM readings)",
        f"grid AS (SELECT module, unnest(generate_series(min(window_end_time), max(window_end_time), INTERVAL '{width}')) AS window_end_time "
        "FROM seen GROUP BY module)",
        f"absent AS (SELECT *, INTERVAL '{width}' AS step FROM (SELECT * FROM grid EXCEPT SELECT * FROM seen))",
        S.runs("marked", "absent", "module"),
    ) + (
        f"SELECT module AS equipment_id, min(window_end_time) - INTERVAL '{width}' AS gap_start, max(window_end_time) AS gap_end, "
        f"count(*) AS silent_windows, count(*) * {expected} AS missing_events, "
        f"date_diff('minute', min(window_end_time) - INTERVAL '{width}', max(window_end_time)) AS duration_minutes FROM marked GROUP BY module, run"
    )


_READING_COLUMNS = ", ".join(
    ['"timestamp"', '"localtime"', "module", "localtime_datetime", *[f'"{m}"' for m in S.MEASURES]]
)
_CHUNK_WHERE = (
    "\"timestamp\" > 10000 AND \"timestamp\" <= 250000 AND module IN ('module_01', 'module_02', 'module_05')"
)

SQL = {
    "sample_readings": S.with_(S.READINGS)
    + f'SELECT {_READING_COLUMNS} FROM readings ORDER BY "timestamp", module, '
    + ", ".join(f'"{m}"' for m in S.MEASURES) + " LIMIT 10",
    "next_chunk": S.with_(
        S.READINGS,
        f'picked AS (SELECT DISTINCT "timestamp" FROM readings WHERE {_CHUNK_WHERE} ORDER BY 1 LIMIT 20)',
    ) + f'SELECT {_READING_COLUMNS} FROM readings WHERE "timestamp" IN (SELECT "timestamp" FROM picked) AND {_CHUNK_WHERE}',
    "parse_localtime": S.with_(S.READINGS)
    + 'SELECT "timestamp", "localtime", strptime(CAST("localtime" AS VARCHAR), \'%Y%m%d%H%M%S\') AS parsed FROM readings',
    "local_day_bounds": """SELECT event_id,
  date_trunc('day', ts + INTERVAL 9 HOUR) - INTERVAL 33 HOUR AS start_utc,
  date_trunc('day', ts + INTERVAL 9 HOUR) - INTERVAL 9 HOUR AS end_utc,
  strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS local_date FROM events""",
    "phase_features": S.with_(S.READINGS) + "SELECT \"timestamp\", module, " + ", ".join(
        S.r6(name, expr) for name, expr in {
            "v_avg": S.mean("voltage"), "c_avg": S.mean("current"), "v_max": S.top("voltage"),
            "c_max": S.top("current"), "pf_avg": S.mean("powerFactor"), "v_imbalance": S.imbalance("voltage"),
            "c_imbalance": S.imbalance("current"), "active_power_kw": "activePower / 1000.0",
        }.items()) + " FROM readings",
    "event_json": S.with_(S.READINGS)
    + 'SELECT CAST("localtime" AS VARCHAR) AS event_time, "timestamp" AS source_timestamp, "localtime", module, '
    + ", ".join(f'"{m}"' for m in S.MEASURES)
    + ", false AS synthetic_anomaly, 'normal' AS synthetic_anomaly_type FROM readings",
    "agg_1m": _agg_sql("1m", extra=["is_anomaly"]),
    "agg_2m": _agg_sql("2m"),
    "agg_15m": _agg_sql("15m", power=True),
    "agg_1h": _agg_sql("1h"),
    "agg_1d": _agg_sql("1d"),
    "agg_1h_shifted": _agg_sql("1h", shift=" + INTERVAL 9 HOUR"),
    "avg_current": S.with_(S.READINGS, S.aggregate("a", "1 minute"))
    + "SELECT equipment_id, window_end_time, "
    + S.r6("avg_current", "(avg_current_r + avg_current_s + avg_current_t) / 3.0") + " FROM a",
    "rollup_1h": _agg_sql("1h"),
    "rollup_1d": _agg_sql("1d"),
    "rollup_rerun": _agg_sql("1h")
    + " WHERE window_end_time > timestamp '2025-04-01 00:00:00' AND window_end_time <= timestamp '2025-04-02 00:00:00' OR CAST(substr(equipment_id, 8, 2) AS INTEGER) % 2 = 0",
    "rollup_power_1h": S.with_(S.READINGS, S.aggregate("a", "1 hour"))
    + f"SELECT equipment_id, window_end_time, {', '.join(S.r6(c) for c in [*S.MEANS, *S.POWER[:2]])}, event_count FROM a",
    "model_input": S.with_(*S.scoring_rows(["15m"]))
    + "SELECT equipment_id, window_end_time, aggregation_level, "
    + ", ".join(S.r6(c) for c in S.MEANS)
    + ", event_count, "
    + ", ".join(S.r6(c) for c in ["rolling_15m_peak_kW", "carbon_emission_kg", "kepco_10m_v_imb", "kepco_10m_c_imb", "kepco_30m_pf"])
    + ', "hour", dayofweek, is_weekend FROM scoring_rows',
    "inject_anomaly": S.with_(
        S.READINGS,
        'stamps AS (SELECT DISTINCT "timestamp" FROM readings)',
        'ranked AS (SELECT "timestamp", row_number() OVER (ORDER BY "timestamp") - 1 AS i, count(*) OVER () AS n FROM stamps)',
        'hit AS (SELECT r.*, r."timestamp" = (SELECT "timestamp" FROM ranked WHERE i = n // 2) AS h FROM readings r)',
    ) + 'SELECT "timestamp", module, '
    + S.r6("activePower", "CASE WHEN h THEN activePower * 1.6 ELSE activePower END") + ", "
    + ", ".join(S.r6(f"current{p}", f"CASE WHEN h THEN current{p} * 1.4 ELSE current{p} END") for p in "RST") + ", "
    + ", ".join(S.r6(f"powerFactor{p}", f"CASE WHEN h THEN powerFactor{p} * 0.75 ELSE powerFactor{p} END") for p in "RST")
    + ", h AS synthetic_anomaly, CASE WHEN h THEN 'overload_low_power_factor' ELSE 'normal' END AS synthetic_anomaly_type FROM hit",
    "base_time": S.with_(S.READINGS, S.aggregate("a", "15 minutes"))
    + "SELECT date_trunc('hour', max(window_end_time)) AS base_time FROM a",
    "quality_monitor": S.with_(
        S.READINGS,
        'copies AS (SELECT module, "timestamp", localtime_datetime, count(*) AS c FROM readings GROUP BY ALL)',
        f"windows AS (SELECT module AS equipment_id, {S.window_end('localtime_datetime', '1 hour')} AS window_end_time, "
        "CAST(sum(c) AS BIGINT) AS event_count, CAST(sum(c - 1) AS BIGINT) AS duplicate_count FROM copies GROUP BY 1, 2)",
        "lagged AS (SELECT *, lag(event_count) OVER (PARTITION BY equipment_id ORDER BY window_end_time) AS prev FROM windows)",
    ) + "SELECT equipment_id, window_end_time, event_count, duplicate_count, "
    "greatest(720 - (event_count - duplicate_count), 0) AS missing_count, "
    + S.r6("completeness", "least((event_count - duplicate_count) / 720.0, 1.0)") + ", "
    "false AS missing_id, " + S.r6("count_ratio", "event_count / CAST(prev AS DOUBLE)") + ", "
    "coalesce(abs(event_count / CAST(prev AS DOUBLE) - 1) > 0.5, false) AS is_jump FROM lagged",
    "quality_gaps": _gaps_sql("1m", 12),
    "quality_gaps_15m": _gaps_sql("15m", 180),
    "quality_lateness": S.with_(
        S.READINGS,
        "late AS (SELECT module, CAST(\"activePower\" AS BIGINT) % 4000 - 60 AS delay FROM readings)",
        "bounds AS (SELECT * FROM (VALUES (CAST(NULL AS BIGINT), 0), (0, 1), (1, 5), (5, 60), (60, 300), (300, 900), (900, 3600), (3600, NULL)) v(delay_from, delay_to))",
    ) + "SELECT module AS equipment_id, CAST(delay_from AS BIGINT) AS delay_from, CAST(delay_to AS BIGINT) AS delay_to, count(*) AS event_count, "
    + S.r6("max_delay_seconds", "CAST(max(delay) AS DOUBLE)") + ", " + S.r6("mean_delay_seconds", "avg(delay)")
    + " FROM late JOIN bounds ON (delay_from IS NULL OR delay >= delay_from) AND (delay_to IS NULL OR delay < delay_to) GROUP BY 1, 2, 3",
}
