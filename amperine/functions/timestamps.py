"""Local time, labels and day bounds. Times are zone-free unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_localtime(value: Column) -> Column:
    """Compact local time `yyyyMMddHHmmss` (integer or text) to a timestamp, else null.

    The parts are put into ISO form and cast, so no session time zone takes part.
    """
    text = value.cast("string")
    iso = F.regexp_replace(
        text, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"
    )
    return F.when(text.rlike(r"^\d{14}$"), iso.try_cast("timestamp_ntz"))


def format_localtime(value: Column) -> Column:
    return F.date_format(value, "yyyyMMddHHmmss").cast("bigint")


def label_offset(value: Column, hours: int = 0) -> Column:
    """Shift a window label by whole hours (0 keeps the event-time label)."""
    if hours == 0:
        return value
    return value + F.expr(f"make_dt_interval(0, {int(hours)}, 0, 0)")


def floor_hour(value: Column) -> Column:
    """Cut to the hour without passing through the session time zone."""
    return F.to_date(value).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(value))


def local_day_bounds(as_of_utc: Column, zone: str = "Asia/Seoul") -> Column:
    """UTC bounds [start_utc, end_utc) of the local day before `as_of_utc`."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), as_of_utc)
    midnight = F.to_date(local).cast("timestamp_ntz")
    start = midnight - F.expr("interval 1 day")
    return F.struct(
        F.convert_timezone(F.lit(zone), F.lit("UTC"), start).alias("start_utc"),
        F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight).alias("end_utc"),
    )


def local_date(value_utc: Column, zone: str = "Asia/Seoul") -> Column:
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), value_utc))


def report_date(window_end: Column) -> Column:
    """Daily rows carry the next midnight as label."""
    return F.to_date(window_end - F.expr("interval 1 day"))


def parse_naive(value: Column) -> Column:
    """ISO text to a zone-free timestamp. An offset is dropped, not applied."""
    text = F.trim(value.cast("string"))
    stripped = F.regexp_replace(
        text, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}.*?)(?:Z|[+-]\d{2}:?\d{2}(?::\d{2})?)$", "$1"
    )
    dated = stripped.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$")
    return F.when(dated, stripped.try_cast("timestamp_ntz"))
