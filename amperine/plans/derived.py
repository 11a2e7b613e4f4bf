"""Telemetry inputs derived row by row from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.timestamps import format_localtime
from amperine.operators.features import model_input
from amperine.operators.windows import aggregate_readings, from_states, merge_states, reading_states
from amperine.session import settle

MODULES = [f"module_{i:02d}" for i in range(13)]


# Power means are whole watts / count / 1000; six digits would round exact ties.
NINE_DIGITS = {"avg_activePower", "daily_avg_active_power", "y", "yhat", "lower", "upper", "iqr"}


def digits_of(name: str) -> int:
    return 9 if name in NINE_DIGITS else 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded, so that the order of summation cannot show."""
    return df.select(
        *[
            F.round(F.col(f"`{name}`"), digits_of(name)).alias(name) if kind == "double" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def readings_of(lineitem: DataFrame) -> DataFrame:
    d = lambda text: F.expr(text).cast("double")
    event_time = F.expr("timestamp_ntz'2025-04-01 00:00:00' + interval '20' second * l_orderkey")
    return lineitem.select(
        F.expr("20 * l_orderkey").alias("timestamp"),
        format_localtime(event_time).alias("localtime"),
        F.expr("concat('module_', lpad(cast(l_suppkey % 13 as string), 2, '0'))").alias("module"),
        event_time.alias("localtime_datetime"),
        d("200 + l_quantity").alias("voltageR"),
        d("205 + l_partkey % 40").alias("voltageS"),
        d("210 + l_suppkey % 30").alias("voltageT"),
        d("358 + l_quantity").alias("voltageRS"),
        d("361 + l_partkey % 20").alias("voltageST"),
        d("362 + l_suppkey % 20").alias("voltageTR"),
        d("l_quantity").alias("currentR"),
        d("l_partkey % 50").alias("currentS"),
        d("l_linenumber * 5").alias("currentT"),
        d("1000 * l_linenumber + l_partkey").alias("activePower"),
        d("85 + l_linenumber * 2").alias("powerFactorR"),
        d("80 + l_partkey % 21").alias("powerFactorS"),
        d("90 + l_quantity % 10").alias("powerFactorT"),
        d("l_linenumber * 10").alias("reactivePowerLagging"),
        d("l_orderkey * cast(0.25 as double)").alias("accumActiveEnergy"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def aggregate(spark: SparkSession, sf_dir: str, level: str, **options) -> DataFrame:
    return aggregate_readings(readings(spark, sf_dir), K.LEVEL_WIDTHS[level], **options)


def scoring_rows(
    spark: SparkSession, sf_dir: str, levels: list[str] = K.LEVELS, reread: bool = False
) -> DataFrame:
    """Scoring input of several levels from one pass over the readings.

    The states of a level are written once; the next coarser level is merged from them, so the
    minute states are read for one merge only. With `reread` all states are written: the rows are
    a projection of stored tables, which may be read as often as a table of their own.
    """
    states = reading_states(readings(spark, sf_dir))
    parts = {}
    for level in sorted(levels, key=K.LEVEL_SECONDS.get):
        if level != "1m":
            states = merge_states(states, K.LEVEL_WIDTHS[level])
        if reread or len(parts) < len(levels) - 1:
            states = settle(states)
        parts[level] = model_input(from_states(states), level)
    return reduce(DataFrame.unionByName, [parts[level] for level in levels])


def one_minute_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = aggregate(spark, sf_dir, "1m", energy=True)
    return agg.withColumnRenamed("avg_activePower", "avg_active_power")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


_SEVERITY = (
    "CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'warning' "
    "WHEN 'signup' THEN 'recovery' WHEN 'view' THEN 'watch' ELSE 'normal' END"
)
_MACHINE = "concat('module_', lpad(cast(user_id % 13 as string), 2, '0'))"


def alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.expr(_MACHINE).alias("equipment_id"),
        F.col("event_type").alias("alert_type"),
        F.expr(_SEVERITY).alias("severity"),
        F.col("ts").alias("detected_at"),
    )


def alert_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = lambda text: F.expr(text)
    return events(spark, sf_dir).select(
        F.col("event_id").alias("alert_id"),
        e(_MACHINE).alias("equipment_id"),
        F.col("ts").alias("window_end_time"),
        e("upper(event_type)").alias("anomaly_type"),
        e(_SEVERITY).alias("severity"),
        F.lit("avg_power_factor").alias("metric_name"),
        F.col("value").alias("metric_value"),
        F.lit(90.0).alias("threshold_value"),
        e("value / 512").alias("anomaly_score"),
        e("value / 8").alias("rule_score"),
        e("value / 16").alias("iforest_score"),
        e("value / 32").alias("final_score"),
        e("cast(user_id % 60 as int)").alias("duration_minutes"),
        e("if(user_id % 2 = 0, '15m', cast(null as string))").alias("detection_window"),
        F.lit("OPEN").alias("status"),
        e("CASE event_id % 4 WHEN 1 THEN 'FAILED' WHEN 2 THEN 'SENT' ELSE 'PENDING' END").alias("notification_status"),
        e("cast(event_id % 5 as int)").alias("retry_count"),
        e("if(event_id % 4 = 1, 'timeout', cast(null as string))").alias("last_error_message"),
        F.col("props").alias("message"),
        F.col("ts").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("notified_at"),
    )


def dispatch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a delivery reported: alert_id and an error text, or null."""
    tried = events(spark, sf_dir).filter(F.col("event_type").isin("error", "purchase", "signup"))
    return tried.select(
        F.col("event_id").alias("alert_id"),
        F.expr("if(user_id % 3 = 0, repeat('gateway refused ', 80), cast(null as string))").alias("error"),
    )


def status_changes(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'Insert' WHEN 'O' THEN '0' ELSE 'Update' END").alias("operation"),
        F.expr("if(o_custkey % 7 = 0, cast(null as string), date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'))").alias("report_date"),
        F.expr("if(o_orderpriority = '1-URGENT', 'DONE', 'READY')").alias("status"),
        *map(F.expr, more),
    )


def send_attempts(spark: SparkSession, sf_dir: str, orderstatus: str) -> DataFrame:
    """Send-log rows, many per date: one per order of the given status."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.filter(F.col("o_orderstatus") == orderstatus).select(
        F.to_date("o_orderdate").alias("report_date"),
        F.expr("o_orderdate + interval '1' second * o_orderkey").alias("sent_at"),
        F.expr("CASE o_custkey % 3 WHEN 0 THEN 'SENT' WHEN 1 THEN 'WAITING' ELSE 'FAILED' END").alias("status"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("message"),
    )


def with_raw_decision(rows: DataFrame) -> DataFrame:
    """A stand-in decision value, so that scoring can be compared with SQL."""
    return rows.withColumn(
        "iforest_score_raw",
        (F.coalesce(F.col("avg_power_factor"), F.lit(0.0)) - 91.0123) / 151.7,
    )
