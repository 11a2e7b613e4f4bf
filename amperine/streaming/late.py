"""Late readings: kept apart, and the windows they belong to aggregated again.

`start_split` stores every reading by day and sends it one of two ways. A reading whose
window of `width` was closed when its batch came (its end is at or before the newest event of
earlier batches less `delay`) goes to `late`, the others to `ontime`. A stream over `ontime`
with the same delay drops nothing, whatever batches it makes, because its watermark never runs
ahead of the mark that let the reading through. `merge_windows` then puts what that stream
published, and fresh aggregates of the windows with late readings, into a table by day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from amperine.operators.windows import TICK, aggregate_readings, window_end
from amperine.sources.writers import DAY, day_of, replace_windows
from amperine.streaming.sinks import mark, marked, publish, read_batches, read_published, start

NEWEST = T.StructType([T.StructField("newest", T.TimestampNTZType())])


def newest_before(spark: SparkSession, root: str, batch_id: int):
    """The newest event of all earlier batches, or None."""
    return read_batches(spark, f"{root}/newest", NEWEST, before=batch_id).agg(F.max("newest")).first()[0]


def start_split(
    readings: DataFrame, root: str, delay: str = "5 minutes", width: str = "1 minute",
    time_col: str = "localtime_datetime", every: str | None = None,
) -> StreamingQuery:
    """Readings to `ontime` and `late` under `root`, both with the day of their window.

    `width` is the narrowest window that is built on them. A repeated batch replaces what it
    wrote, and its mark and both tables become visible together.
    """
    spark = readings.sparkSession
    write_empty = spark.createDataFrame([], NEWEST)
    write_empty.write.mode("ignore").parquet(f"{root}/newest/batch_id=-1")

    def split(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        newest = newest_before(session, root, batch_id)
        limit = F.lit(newest).cast("timestamp_ntz") - F.expr(TICK) - F.expr(f"interval {delay}")
        is_late = F.coalesce(window_end(F.col(time_col), width) <= limit, F.lit(False))
        rows = batch.withColumn(DAY, day_of(time_col)).withColumn("_late", is_late).persist()
        try:
            tables = {
                "ontime": rows.filter(~F.col("_late")).drop("_late"), "late": rows.filter("_late").drop("_late"),
                "newest": rows.agg(F.max(F.col(time_col).cast("timestamp_ntz")).alias("newest")).dropna(),
            }
            publish(tables, root, batch_id, "split")
        finally:
            rows.unpersist()

    return start(readings, split, f"{root}/_checkpoint/split", every=every)


def stored_schema(readings: DataFrame) -> T.StructType:
    return T.StructType([*readings.schema.fields, T.StructField(DAY, T.DateType())])


def merge_windows(
    spark: SparkSession, root: str, schema: T.StructType, name: str, width: str, delay: str = "5 minutes",
    time_col: str = "localtime_datetime", flush: bool = False, **wanted,
) -> None:
    """Brings the table `{name}_days` under `root` up to what has been published and split so far.

    `schema` is that of the stored readings, `wanted` goes to `aggregate_readings`. Only
    windows with late readings that have not been merged yet, or that were published since,
    are aggregated again, from the stored readings of their days; with `flush` also those that are still open. A repeat
    gives the same table.

    Whether a window has such readings is found by the aggregate itself, which combines before its
    shuffle, so that no reading is shuffled or joined with a list of windows.
    """
    done = marked(spark, f"{root}/{name}_merged").distinct()
    late_done = marked(spark, f"{root}/{name}_late_merged").distinct()
    split = read_published(spark, root, "late", schema, "split")
    late = split.join(late_done, "batch_id", "left_anti")
    published = read_published(spark, root, name, aggregate_readings(split, width, time_col=time_col, **wanted).schema)
    new = published.join(done, "batch_id", "left_anti")
    new_days = new.select(day_of("window_end_time").alias(DAY)).distinct()
    end = window_end(F.col(time_col), width)
    day = F.to_date(end - F.expr(TICK)).alias(DAY)
    # a window may be published after its late readings have been merged
    days = late.select(day).union(split.join(F.broadcast(new_days), DAY, "left_semi").select(day))
    is_open = F.lit(False)
    if flush:
        newest = read_published(spark, root, "newest", NEWEST, "split").agg(F.max("newest")).first()[0]
        limit = F.lit(newest).cast("timestamp_ntz") - F.expr(TICK) - F.expr(f"interval {delay}")
        is_open = F.coalesce(end > limit, F.lit(False))
    ontime = read_published(spark, root, "ontime", schema, "split").drop("batch_id")
    if flush:
        # their readings lie on few days, the newest ones
        recent = F.col(DAY) >= F.to_date(limit - F.expr(f"interval {width}"))
        days = days.union(ontime.unionByName(split.drop("batch_id")).filter(recent & is_open).select(day))
    merged = late_done.select("batch_id", F.lit(True).alias("_merged"))
    noted = split.join(merged, "batch_id", "left").withColumns(
        {"_late": F.lit(True), "_now": F.col("_merged").isNull()}).drop("batch_id", "_merged")
    stored = ontime.withColumns({"_late": F.lit(False), "_now": F.lit(False)}).unionByName(noted)
    near = stored.join(F.broadcast(days.distinct()), DAY, "left_semi").withColumn("_now", F.col("_now") | is_open)
    flags = [F.max("_late").alias("_late"), F.max("_now").alias("_now")]
    again = aggregate_readings(near, width, time_col=time_col, **wanted, more=flags).filter("_late or _now")
    ends = new.select(F.col("equipment_id").alias("_id"), F.col("window_end_time").alias("_time")).distinct()
    both = again["equipment_id"].eqNullSafe(F.col("_id")) & (again["window_end_time"] == F.col("_time"))
    known = again.join(ends, both, "left")
    fresh = known.filter(F.col("_now") | F.col("_time").isNotNull()).drop("_late", "_now", "_id", "_time")
    batches = [r[0] for r in new.select("batch_id").distinct().collect()]
    late_batches = [r[0] for r in late.select("batch_id").distinct().collect()]
    replace_windows(new.drop("batch_id"), fresh, f"{root}/{name}_days")
    for path, ids in ((f"{root}/{name}_merged", batches), (f"{root}/{name}_late_merged", late_batches)):
        for batch_id in ids:
            mark(spark, path, batch_id)
