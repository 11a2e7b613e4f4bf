"""Table reads: samples, keyset chunks, time ranges, panels, change feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amperine.functions.numeric import try_double
from amperine.schemas import MEASURES, READING_EVENT
from amperine.sources.payloads import one_value


def sample_readings(df: DataFrame, limit: int = 10, tie_break: list[str] | None = None) -> DataFrame:
    """First rows by (timestamp, module); `tie_break` makes equal rows deterministic."""
    return df.orderBy("timestamp", "module", *(tie_break or [])).limit(limit)


def next_chunk(
    df: DataFrame, last_timestamp: int | None, chunk_timestamps: int,
    end_timestamp: int | None = None, modules: list[str] | None = None,
) -> DataFrame:
    """All rows of the next `chunk_timestamps` distinct timestamps.

    The pick is a distinct plus top-k of `chunk_timestamps` values, so its broadcast is
    bounded by that argument.
    """
    if last_timestamp is not None:
        df = df.filter(F.col("timestamp") > last_timestamp)
    if end_timestamp is not None:
        df = df.filter(F.col("timestamp") <= end_timestamp)
    if modules:
        df = df.filter(F.col("module").isin(modules))
    picked = df.select("timestamp").distinct().orderBy("timestamp").limit(chunk_timestamps)
    rows = df.join(_small(picked, chunk_timestamps), "timestamp", "left_semi")
    return rows.orderBy("timestamp", "module")


def _small(df: DataFrame, rows: int, limit: int = 1_000_000) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def in_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """Half-open time range; bounds are values or columns and reach the scan."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.filter((F.col(column) >= as_column(start)) & (F.col(column) < as_column(end)))


def daily_rows(df: DataFrame, report_date) -> DataFrame:
    """Daily aggregate rows of one report date, which are labelled with the next midnight.

    Written as a range on the stored column so that the scan can prune.
    """
    day = (report_date if isinstance(report_date, Column) else F.lit(report_date)).cast("date")
    first = F.date_add(day, 1).cast("timestamp_ntz")
    after = F.date_add(day, 2).cast("timestamp_ntz")
    return in_range(df, "window_end_time", first, after).orderBy("equipment_id")


def forecast_panel(df: DataFrame, base_time, days: int = 7) -> DataFrame:
    """Per-machine history for forecasting, both ends of the range included."""
    base = base_time if isinstance(base_time, Column) else F.lit(base_time).cast("timestamp_ntz")
    start = base - F.make_dt_interval(F.lit(days))
    end = F.col("window_end_time")
    panel = df.filter((end >= start) & (end <= base)).select(
        F.col("equipment_id").alias("unique_id"),
        end.alias("ds"),
        try_double(F.col("avg_activePower")).alias("y"),
        F.col("avg_current_r").alias("currentR"),
        F.col("avg_current_s").alias("currentS"),
        F.col("avg_current_t").alias("currentT"),
    )
    return panel.dropna(subset=["unique_id", "ds", "y"]).orderBy("unique_id", "ds")


def ready_dates(changes: DataFrame) -> DataFrame:
    """Report dates of inserted READY rows from a change feed (operation, report_date, status)."""
    inserted = F.col("operation").cast("string").isin("Insert", "0")
    day = F.substring(F.col("report_date").cast("string"), 1, 10)
    return changes.filter(
        inserted & (F.col("status") == "READY") & F.col("report_date").isNotNull()
    ).select(day.alias("report_date"))


def decode_changes(df: DataFrame, body: str = "value") -> DataFrame:
    """Change-feed texts to rows of operation, report_date and status.

    A text is a JSON list of objects with `Operation` and `Item`. One that is anything else
    gives a single row without values that keeps it in `_bad`; an empty list gives none.
    Fields that an entry lacks are null.
    """
    rest = [c for c in df.columns if c != body]
    parsed = df.select(*rest, F.col(body).cast("string").alias("_text")).withColumn("_whole", F.expr(one_value("_text")))
    items = F.expr(
        "CASE WHEN schema_of_variant(_whole) LIKE 'ARRAY%' THEN try_variant_get(_whole, '$', 'array<variant>') END"
    )
    bad = F.when(F.col("_items").isNull(), F.coalesce("_text", F.lit("")))
    listed = parsed.withColumn("_items", items).withColumn("_bad", bad).withColumn(
        "_item", F.explode(F.coalesce("_items", F.expr("array(cast(null as variant))")))
    )
    field = lambda path: F.try_variant_get("_item", path, "string")
    return listed.select(
        *rest, field("$.Operation").alias("operation"), field("$.Item.report_date").alias("report_date"),
        field("$.Item.status").alias("status"), "_bad",
    )


def event_schema() -> T.StructType:
    return T.StructType([*READING_EVENT.fields, T.StructField("_bad", T.StringType())])


def decode_events(df: DataFrame, body: str = "value") -> DataFrame:
    """JSON text to typed readings. Unreadable bodies keep their text in `_bad`.

    A body with anything after its JSON value is unreadable too.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = F.from_json(F.col(body).cast("string"), event_schema(), options)
    rest = [c for c in df.columns if c != body]
    decoded = df.select(*rest, F.col(body).cast("string").alias("_body"), parsed.alias("e"))
    unusable = F.col("e").isNull() | F.col("e._bad").isNotNull() | F.expr(one_value("_body")).isNull()
    fields = [F.col(f"e.{f.name}").alias(f.name) for f in READING_EVENT.fields]
    return decoded.select(*rest, *fields, F.when(unusable, F.col("_body")).alias("_bad"))


def to_event_json(df: DataFrame, as_of=None) -> DataFrame:
    """Readings to one JSON text per row, in column `value`.

    `as_of` is the send time; without it the event time is the reading's own local time.
    """
    if as_of is None:
        event_time = F.col("localtime").cast("string")
    else:
        event_time = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("string")
    flag = F.col("synthetic_anomaly") if "synthetic_anomaly" in df.columns else F.lit(None)
    label = F.col("synthetic_anomaly_type") if "synthetic_anomaly_type" in df.columns else F.lit(None)
    fields = [
        event_time.alias("event_time"),
        F.col("timestamp").cast("bigint").alias("source_timestamp"),
        F.col("localtime").cast("bigint").alias("localtime"),
        F.col("module").cast("string").alias("module"),
        *[F.col(name).cast("double").alias(name) for name in MEASURES],
        F.coalesce(flag.cast("boolean"), F.lit(False)).alias("synthetic_anomaly"),
        F.coalesce(label.cast("string"), F.lit("normal")).alias("synthetic_anomaly_type"),
    ]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


