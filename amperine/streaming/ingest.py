"""Streaming inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amperine.functions.timestamps import parse_localtime
from amperine.operators.windows import with_event_time
from amperine.sources.readings import decode_events


def read_text_stream(spark: SparkSession, path: str | None = None, source: str = "text", **options) -> DataFrame:
    """A stream with one message text per row in `value` (files, or `source='kafka'`)."""
    reader = spark.readStream.format(source).options(**options)
    df = reader.load(path) if path else reader.load()
    kept = [c for c in ("timestamp",) if c in df.columns]  # arrival time of a message queue
    return df.select(F.col("value").cast("string").alias("value"), *[F.col(c).alias("ingest_ts") for c in kept])


def read_readings_stream(
    spark: SparkSession, path: str | None = None, source: str = "text", **options
) -> DataFrame:
    """Typed readings with `localtime_datetime` and `ingest_ts`; bad messages have `_bad`.

    `ingest_ts` is the queue's arrival time, or the processing time for files; windows over
    it follow arrival instead of event time.
    """
    raw = read_text_stream(spark, path, source, **options)
    if "ingest_ts" not in raw.columns:
        raw = raw.withColumn("ingest_ts", F.current_timestamp())
    df = decode_events(raw).withColumn("localtime_datetime", parse_localtime(F.col("localtime")))
    return df.withColumnRenamed("source_timestamp", "timestamp")


def good(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_bad").isNull()).drop("_bad")


def quarantine(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_bad").isNotNull()).select("_bad", "ingest_ts")


def replay(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A stored readings table as a stream, `max_files` files per micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def progress(query) -> dict:
    """Events sent so far and the state of the stream."""
    steps = query.recentProgress
    return {
        "sent_events": sum(step["numInputRows"] for step in steps),
        "batches": len(steps),
        "is_running": query.isActive,
        "watermark": steps[-1]["eventTime"].get("watermark") if steps else None,
    }


def without_duplicates(df: DataFrame, keys: list[str], delay: str, time_col: str = "localtime_datetime") -> DataFrame:
    """Drop repeats of `keys` that arrive within the watermark delay.

    The watermark stays on the moved event time, which later windows reuse.
    """
    return with_event_time(df, time_col, delay).dropDuplicatesWithinWatermark(keys)
