import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from amperine import constants as K
from amperine.operators import combine
from amperine.operators.features import model_input
from amperine.operators.injection import inject_anomaly
from amperine.operators.iforest import fit_iforest
from amperine.operators.thresholds import fit_thresholds
from amperine.operators.windows import aggregate_readings
from amperine.plans.derived import scoring_rows
from amperine.plans.streams import q_stream_score
from amperine.schemas import MEASURES
from amperine.sources.readings import to_event_json
from amperine.streaming.aggregation import start_aggregations
from amperine.streaming.ingest import good, progress, quarantine, read_readings_stream, read_text_stream, replay
from amperine.streaming.reporting import report_batch, send_log, start_daily_report
from amperine.streaming.scoring import Model, score_batch, start_scoring
from amperine.streaming.sinks import start, write_batch
from test_scoring import EXAMPLE, history
from test_windows import as_rows

START = datetime(2025, 4, 1, 10)
AS_OF = datetime(2025, 6, 1)
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def readings(spark, n=240, step=20, machines=2):
    def one(i):
        when = START + timedelta(seconds=step * i)
        values = [200.0 + (i * 7 + k) % 13 for k in range(len(MEASURES))]
        return [(i, int(when.strftime("%Y%m%d%H%M%S")), f"m{m}", *values) for m in range(machines)]

    types = "timestamp bigint, localtime bigint, module string, " + ", ".join(f"{c} double" for c in MEASURES)
    return spark.createDataFrame([r for i in range(n) for r in one(i)], types)


def write_events(df, path, files=1):
    to_event_json(df).coalesce(files).write.mode("append").text(path)


def batch_aggregate(spark, df, width, **options):
    from amperine.functions.timestamps import parse_localtime

    return aggregate_readings(df.withColumn("localtime_datetime", parse_localtime(F.col("localtime"))), width, **options)


def test_stream_equals_batch_for_closed_windows(spark, tmp_path):
    df = readings(spark)
    write_events(df, str(tmp_path / "in"))
    (tmp_path / "in" / "bad.txt").write_text('{"module": \nnot json at all\n{"module": "m0", "voltageR": "high"}\n')
    stream = read_readings_stream(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for query in start_aggregations(good(stream), out, "5 minutes"):
        query.awaitTermination()
        assert progress(query)["sent_events"] > 0
    newest = START + timedelta(seconds=20 * 239)
    closed = F.col("window_end_time") <= F.lit(newest - timedelta(minutes=5, milliseconds=1))
    table = lambda name: spark.read.parquet(f"{out}/{name}").drop("batch_id")
    want = batch_aggregate(spark, df, "15 minutes", energy=True).filter(closed)
    assert want.count() > 0 and as_rows(table("15m")) == as_rows(want)
    assert as_rows(table("model_input")) == as_rows(model_input(want))
    assert as_rows(table("1m")) == as_rows(batch_aggregate(spark, df, "1 minute", anomaly=True).filter(closed))

    bad = str(tmp_path / "bad")
    start(quarantine(stream), lambda b, i: write_batch(b, bad, i), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(bad).count() == 3


def test_restart_continues_and_late_rows_are_dropped(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = readings(spark)
    early, rest = df.filter("timestamp < 120"), df.filter("timestamp >= 120")
    for part in (early, rest, early.limit(4)):  # the last part is far too late
        write_events(part, source)
        for query in start_aggregations(good(read_readings_stream(spark, source)), out, "1 minute"):
            query.awaitTermination()
    got = spark.read.parquet(f"{out}/15m").drop("batch_id")
    newest = START + timedelta(seconds=20 * 239)
    want = batch_aggregate(spark, df, "15 minutes", energy=True).filter(
        F.col("window_end_time") <= F.lit(newest - timedelta(minutes=1, milliseconds=1)))
    assert as_rows(got) == as_rows(want)


def test_duplicates_are_dropped_when_asked(spark, tmp_path):
    df = readings(spark, n=120)
    write_events(df.union(df), str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = good(read_readings_stream(spark, str(tmp_path / "in")))
    for query in start_aggregations(stream, out, "1 minute", dedup_keys=["module", "timestamp"]):
        query.awaitTermination()
    counts = {r.window_end_time: r.event_count for r in spark.read.parquet(f"{out}/15m").collect()}
    assert counts[START + timedelta(minutes=15)] == 45


def test_arrival_time_windows(spark, tmp_path):
    df = readings(spark, n=5).withColumn("ingest_ts", F.lit("2025-04-02 00:00:30").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = replay(spark, str(tmp_path / "in"), df.schema, max_files=1)
    late = df.limit(1).withColumn("ingest_ts", F.lit("2025-04-02 02:00:00").cast("timestamp"))
    late.write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for query in start_aggregations(stream, out, "1 minute", time_col="ingest_ts"):
        query.awaitTermination()
    rows = spark.read.parquet(f"{out}/1m").collect()
    assert {r.window_end_time for r in rows} == {datetime(2025, 4, 2, 0, 1)} and sum(r.event_count for r in rows) == 10


@pytest.fixture(scope="module")
def model(spark):
    rows = history(spark, 600)
    forest = fit_iforest(rows, ["equipment_id", "window_end_time"], trees=10, psi=32)
    return Model(fit_thresholds(rows), combine.level_config(spark), forest)


def test_scoring_stream_and_repeated_batch(spark, tmp_path, model):
    rows = [{**EXAMPLE, "avg_power_factor": v} for v in (20.0, 95.0)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([json.dumps(rows, ensure_ascii=False), "broken"]), encoding="utf-8")
    out = str(tmp_path / "out")
    start_scoring(read_text_stream(spark, str(tmp_path / "in")), model, out).awaitTermination()
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert read("predictions").drop("batch_id").columns == K.STORED_PREDICTION_COLUMNS
    assert read("predictions").count() == 2 and read("rejected").count() == 1
    assert read("predictions").first().window_end_time == datetime(2025, 4, 15, 23, 45)
    counts = read("counts").first()
    assert counts.sent_count == read("alerts").count() and counts.sent_count + counts.skipped_count == 2
    again = spark.createDataFrame([(json.dumps(rows),)], "value string")
    for _ in range(2):
        score_batch(again, 7, model, out)
    assert read("predictions").count() == 4


def daily_table(spark, machines):
    rows = [(f"x{m:02d}", datetime(2025, 5, 1 + d), 99.0, 1.0, 1.0, 17280) for d, n in machines.items() for m in range(n)]
    return spark.createDataFrame(rows, "equipment_id string, window_end_time timestamp_ntz, avg_power_factor double, "
                                 "avg_voltage_imbalance_rate double, avg_current_imbalance_rate double, event_count bigint")


CHANGE = "operation string, report_date string, status string"


def test_daily_report_stream(spark, tmp_path):
    daily, source, out = str(tmp_path / "daily"), str(tmp_path / "in"), str(tmp_path / "out")

    def send(*dates, operation="Insert"):
        rows = [(operation, d, "READY") for d in dates]
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(source)
        stream = replay(spark, source, spark.createDataFrame([], CHANGE).schema)
        start_daily_report(stream, daily, out, AS_OF).awaitTermination()
        return {str(r.report_date): r.status for r in send_log(spark, out).collect()}

    daily_table(spark, {1: 13, 2: 5}).write.parquet(daily)
    assert send("2025-05-01", "2025-05-02", "not a date") == {"2025-05-01": "SENT", "2025-05-02": "WAITING"}
    daily_table(spark, {2: 13}).filter("equipment_id >= 'x05'").write.mode("append").parquet(daily)
    assert send("2025-05-02", operation="Update")["2025-05-02"] == "WAITING"
    assert send("2025-05-01", "2025-05-02") == {"2025-05-01": "SENT", "2025-05-02": "SENT"}
    header = spark.read.parquet(f"{out}/header").orderBy("report_date").collect()
    assert [r.title for r in header] == [K.REPORT_TITLE % "2025-05-01", K.REPORT_TITLE % "2025-05-02"]
    assert spark.read.parquet(f"{out}/equipment").count() == 26


def test_failed_delivery_is_logged_for_its_date_only(spark):
    changes = spark.createDataFrame([("0", "2025-05-01", "READY"), ("Insert", "2025-05-02", "READY")], CHANGE)
    empty = spark.createDataFrame([], "report_date date, sent_at timestamp_ntz, status string, message string")
    failures = spark.createDataFrame([("2025-05-02", "boom")], "d string, error string").select(F.to_date("d").alias("report_date"), "error")
    made = report_batch(changes, empty, daily_table(spark, {1: 13, 2: 13}), AS_OF, failures=failures)
    assert {str(r.report_date): (r.status, r.message) for r in made["log"].collect()} == {
        "2025-05-01": ("SENT", K.REPORT_SENT), "2025-05-02": ("FAILED", "boom")}


def test_injection_marks_the_middle_timestamp(spark):
    df = readings(spark, n=8)
    got = inject_anomaly(df)
    hit = got.filter("synthetic_anomaly")
    assert {r.timestamp for r in hit.collect()} == {4} and hit.count() == 2
    a, b = hit.orderBy("module").first(), df.filter("timestamp = 4").orderBy("module").first()
    assert a.activePower == pytest.approx(b.activePower * 1.6) and a.currentS == pytest.approx(b.currentS * 1.4)
    assert a.powerFactorT == pytest.approx(b.powerFactorT * 0.75) and a.synthetic_anomaly_type == K.INJECT_LABEL
    assert {r.synthetic_anomaly_type for r in got.filter("not synthetic_anomaly").collect()} == {"normal"}
    event = json.loads(to_event_json(got, as_of="2025-06-01T00:00:00").filter("value like '%overload%'").first().value)
    assert event["event_time"] == "2025-06-01T00:00:00" and event["synthetic_anomaly"] is True and len(event) == 21


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_the_registered_stream_scores_every_window_of_every_level(spark):
    names = ["equipment_id", "window_end_time", "aggregation_level"]
    rows = scoring_rows(spark, SF_DIR).withColumn("form", F.col("event_count") % 10).filter("form < 4")
    sent = rows.unionByName(rows.filter("form = 3"))  # twice in its message
    count = lambda df: df.select(names[0], F.col(names[1]).cast("timestamp_ntz").alias(names[1]), names[2]).groupBy(*names).count()
    want, got = count(sent), count(q_stream_score(spark, SF_DIR))
    assert {r[0] for r in got.select(names[2]).distinct().collect()} == set(K.LEVELS)
    assert as_rows(got) == as_rows(want)
