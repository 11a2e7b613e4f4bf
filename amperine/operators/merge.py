"""Keyed merge for tables without MERGE, and status rows derived from other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.functions.timestamps import report_date


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest by `order`. Combines partially, so hot keys are fine."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def merge_by_key(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `updates` replace those of `target` with the same key; others are kept.

    `updates` has at most one row per key (see `latest_by_key`). Write the result to a new
    version of the table.
    """
    rest = [c for c in target.columns if c not in keys]
    old = target.withColumn("_old", F.lit(True)).alias("t")
    new = updates.select(*keys, *rest, F.lit(True).alias("_new")).alias("u")
    joined = old.join(new, keys, "full_outer")
    fresh = F.col("u._new").isNotNull()
    return joined.select(
        *keys, *[F.when(fresh, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in rest]
    )


def not_sent(dates: DataFrame, log: DataFrame) -> DataFrame:
    """Dates without a SENT row in the send log."""
    sent = log.filter(F.col("status") == "SENT").select(F.col("report_date").cast("date").alias("_sent"))
    due = dates.withColumn("_day", F.col("report_date").try_cast("date"))
    return due.join(sent, F.col("_day") == F.col("_sent"), "left_anti").drop("_day")


def ready_status_rows(daily: DataFrame, existing: DataFrame) -> DataFrame:
    """One READY row per finished date of the daily aggregate that has no status row yet."""
    dates = daily.select(report_date(F.col("window_end_time")).alias("report_date")).distinct()
    known = existing.select(F.col("report_date").cast("date").alias("report_date"))
    return dates.join(known, "report_date", "left_anti").withColumn("status", F.lit("READY"))


def send_log_row(dates: DataFrame, status: str, message: str, as_of) -> DataFrame:
    """Log rows (report_date, sent_at, status, message) for the given dates."""
    return dates.select(
        F.col("report_date").cast("date").alias("report_date"),
        F.lit(as_of).cast("timestamp_ntz").alias("sent_at"),
        F.lit(status).alias("status"),
        F.lit(message).alias("message"),
    )


def cut_error(text):
    return F.substring(text, 1, K.ERROR_TEXT_LIMIT)
