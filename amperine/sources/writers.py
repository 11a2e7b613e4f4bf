"""Writes that may be repeated: days of an aggregate and versions of the alert queue."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperine.schemas import ALERT_QUEUE
from amperine.session import settle
from amperine.streaming.sinks import read_batches, write_batch

DAY = "window_day"


def day_of(time_col: str) -> Column:
    """The day a window lies in; a window that ends at midnight belongs to the day before."""
    return F.to_date(F.col(time_col) - F.expr("interval 1 microsecond"))


def store_days(rows: DataFrame, path: str, time_col: str = "window_end_time") -> None:
    """A new aggregate table with one folder per day."""
    rows.withColumn(DAY, day_of(time_col)).write.partitionBy(DAY).parquet(path)


def replace_days(
    rows: DataFrame, path: str, first: date, after: date, time_col: str = "window_end_time"
) -> None:
    """Replaces the days from `first` to before `after`; a repeat changes nothing.

    Rows of other days are not written. Readings are only ever added, so a stored day
    without any new row is a fault of the re-run and stops it before anything is replaced.
    """
    within = (F.col(DAY) >= F.lit(first)) & (F.col(DAY) < F.lit(after))
    new = settle(rows.withColumn(DAY, day_of(time_col)).filter(within))
    old = rows.sparkSession.read.parquet(path).filter(within).select(DAY).distinct()
    lost = old.join(new.select(DAY).distinct(), DAY, "left_anti").first()
    if lost is not None:
        raise ValueError(f"the new rows leave out {lost[0]}, which is stored")
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def replace_windows(
    rows: DataFrame, better: DataFrame, path: str, key: str = "equipment_id", time_col: str = "window_end_time"
) -> None:
    """Puts rows into a table by day in place of stored rows of the same key and time.

    A row of `better` wins over one of `rows`. Only the days that get a row are written, each
    as a whole, so a repeat changes nothing. Null keys are equal. A missing table is made.
    The rows of a day are brought together first, so that a day is few files however many tasks there are.
    """
    spark = rows.sparkSession
    better = settle(better)

    def without(df: DataFrame, others: DataFrame) -> DataFrame:
        names = others.select(F.col(key).alias("_key"), F.col(time_col).alias("_time"))
        same = df[key].eqNullSafe(F.col("_key")) & (df[time_col] == F.col("_time"))
        return df.join(names, same, "left_anti")

    new = settle(without(rows, better).unionByName(better).withColumn(DAY, day_of(time_col)))
    new.limit(0).write.mode("ignore").partitionBy(DAY).parquet(path)
    stored = spark.read.schema(new.schema).parquet(path)
    near = stored.join(new.select(DAY).distinct(), DAY, "left_semi")
    whole = settle(without(near, new).unionByName(new).repartition(DAY))
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def write_dispatch(done: dict[str, DataFrame], root: str, version: int) -> None:
    """Outbox, counts and new queue of a dispatch pass under `root`, the queue last.

    A pass that is repeated with its version number replaces what it wrote before. The
    input queue must be an earlier version.
    """
    for name in ("outbox", "counts", "queue"):
        write_batch(done[name], f"{root}/{name}", version)


def read_queue(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest version of the queue, or the newest one before `before`."""
    rows = read_batches(spark, f"{root}/queue", ALERT_QUEUE, before)
    newest = rows.agg(F.max("batch_id")).first()[0]
    return rows.filter(F.col("batch_id") == F.lit(newest)).drop("batch_id")
