"""Status changes to daily reports."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from amperine import constants as K
from amperine.functions.timestamps import report_date
from amperine.operators import report as R
from amperine.operators.merge import latest_by_key, not_sent
from amperine.schemas import SEND_LOG
from amperine.sources.readings import in_range, ready_dates
from amperine.streaming.sinks import read_batches, start, write_batch


def report_batch(
    changes: DataFrame, log: DataFrame, daily: DataFrame, as_of, expected: int = K.EXPECTED_EQUIPMENT,
    failures: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Reports for the READY dates in `changes` that were not sent yet.

    A date with fewer machines than expected waits for a new insert. `failures`
    (report_date, error) are dates whose delivery failed. Returns `log` (new log rows) and
    the report tables `header`, `equipment` and `insights`. All dates are done at once, so
    one failing date does not hold up the others.
    """
    due = not_sent(ready_dates(changes).distinct(), log)
    due = due.select(F.col("report_date").try_cast("date").alias("report_date")).dropna().distinct()
    # two dates, as literals that prune the scan of the daily table
    first, last = due.agg(F.min("report_date"), F.max("report_date")).first()
    if first is None:
        near = daily.filter(F.lit(False))
    else:
        near = in_range(
            daily, "window_end_time",
            datetime.combine(first + timedelta(days=1), time.min), datetime.combine(last + timedelta(days=2), time.min),
        )
    dated = near.withColumn("report_date", report_date(F.col("window_end_time")))
    rows = dated.join(due, "report_date", "left_semi")
    summary = R.with_completeness(R.daily_summary(rows), equipment=expected)
    counts = summary.select("report_date", "equipment_count")
    counted = due.join(counts, "report_date", "left").withColumn(
        "_actual", F.coalesce("equipment_count", F.lit(0).cast("bigint"))
    )
    failed = failures if failures is not None else due.limit(0).withColumn("error", F.lit(None).cast("string"))
    counted = counted.join(failed, "report_date", "left")
    waiting = F.col("_actual") < expected
    status = F.when(waiting, "WAITING").when(F.col("error").isNotNull(), "FAILED").otherwise("SENT")
    message = (
        F.when(waiting, F.format_string(K.REPORT_WAITING, F.col("report_date").cast("string"), "_actual", F.lit(expected)))
        .when(F.col("error").isNotNull(), F.col("error"))
        .otherwise(K.REPORT_SENT)
    )
    new_log = counted.select(
        "report_date", F.lit(as_of).cast("timestamp_ntz").alias("sent_at"), status.alias("status"), message.alias("message")
    )
    complete = summary.filter(F.col("equipment_count") >= expected)
    full = rows.join(complete.select("report_date"), "report_date", "left_semi")
    verdict = R.daily_status(complete).withColumnsRenamed({"status": "daily_status", "message": "status_message"})
    title = F.format_string(K.REPORT_TITLE, F.col("report_date").cast("string"))
    return {
        "log": new_log,
        "header": complete.withColumn("title", title).join(verdict, "report_date"),
        "equipment": R.equipment_rows(full),
        "insights": R.insights(complete, R.abnormal_equipment(full)),
    }


def send_log(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """Current log: the newest row per date."""
    rows = read_batches(spark, f"{root}/log", SEND_LOG, before)
    return latest_by_key(rows, ["report_date"], ["batch_id"]).select(*SEND_LOG.fieldNames())


def start_daily_report(
    changes: DataFrame, daily_path: str, root: str, as_of, expected: int = K.EXPECTED_EQUIPMENT,
    every: str | None = None,
) -> StreamingQuery:
    """Stream of status changes to log rows and report tables under `root`."""
    spark = changes.sparkSession
    write_batch(spark.createDataFrame([], SEND_LOG), f"{root}/log", -1)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        log = send_log(session, root, before=batch_id)
        made = report_batch(batch, log, session.read.parquet(daily_path), as_of, expected)
        # reports first: a crash before the log row makes the batch run again
        for name in ("header", "equipment", "insights", "log"):
            write_batch(made[name], f"{root}/{name}", batch_id)

    return start(changes, write, f"{root}/_checkpoint", every=every)
