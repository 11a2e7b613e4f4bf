"""Windows of streams whose open ones are a table; what a batch leaves on disk."""

import os
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from amperine.operators.features import model_input
from amperine.operators.windows import ENERGY, aggregate_readings
from amperine.plans import streams
from amperine.plans.derived import scoring_rows
from amperine.schemas import MEASURES
from amperine.session import freed_shuffles, settle
from amperine.streaming import scoring, windows
from amperine.streaming.aggregation import start_aggregations
from amperine.streaming.ingest import replay
from amperine.streaming.sinks import publish, read_published, write_batch
from amperine.streaming.windows import closed_windows

START = datetime(2025, 4, 1)
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = "localtime_datetime timestamp_ntz, module string, " + ", ".join(f"{c} double" for c in MEASURES)


def as_rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def rows_at(spark, *seconds):
    """Readings of three machines, one of them without a name; every fifth value of a measure is missing."""
    value = lambda s, m, k: None if (s + k) % 5 == 0 else 150.0 + (7 * s + 3 * m + k) % 90
    made = [(None if s is None else START + timedelta(seconds=s), name, *[value(s or 0, m, k) for k in range(len(MEASURES))])
            for s in seconds for m, name in enumerate(("a", "b", None))]
    return spark.createDataFrame(made, TYPES).repartition(2)


def test_batches_close_windows_once_and_keep_the_open_ones(spark, tmp_path):
    """Against a plain loop: two minutes of delay, windows over several batches, late and repeated rows."""
    lots = [[10, 60, 61, 200], [130, 199, 240, 250], [], [5, 100, 255, 301, 900], [None, 899], [1800, 700, 781]]
    kept, late, newest = [], [], None
    for lot in lots:
        for s in lot:
            end = None if s is None else -(-s // 60) * 60
            limit = None if newest is None else newest - 1 - 120  # a millisecond less, which whole seconds cannot tell
            if s is not None:
                (late if limit is not None and end <= limit else kept).append(s)
        newest = max([s for s in lot if s is not None] + ([newest] if newest is not None else []), default=None)
    assert late == [5, 100, 700]
    got, state = [], str(tmp_path / "state")
    for i, lot in enumerate(lots):
        batch = rows_at(spark, *lot)
        for _ in range(1 + (i == 3)):  # a batch that is run again
            found = as_rows(closed_windows(batch, i, "1 minute", state, "2 minutes", "localtime_datetime", energy=False, anomaly=True))
        got += found
    limit = F.lit(START + timedelta(seconds=newest - 121))
    want = aggregate_readings(rows_at(spark, *kept), "1 minute", anomaly=True).filter(F.col("window_end_time") <= limit)
    assert len(got) == len(set(map(str, got))) and sorted(got, key=str) == as_rows(want)
    left = spark.read.parquet(f"{state}/open/batch_id=5").filter(F.col("window_end_time") > limit)
    assert left.count() == 3  # the window of the newest event, of three machines


def stored_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    names = []
    while files.hasNext():
        names.append(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_a_stream_stores_no_closed_windows_as_state(spark, tmp_path):
    df, out = rows_at(spark, *range(0, 7200, 20)), str(tmp_path / "out")
    df.write.parquet(str(tmp_path / "in"))
    for query in start_aggregations(replay(spark, str(tmp_path / "in"), df.schema), out, "5 minutes"):
        query.awaitTermination()
    assert spark.read.parquet(f"{out}/1m").count() > 300 and ENERGY in spark.read.parquet(f"{out}/15m").columns
    assert not [p for p in (tmp_path / "out" / "_checkpoint").rglob("*.delta")]
    assert spark.read.parquet(f"{out}/_open/1m/open").count() <= 3 * 6  # the minutes of the delay


def test_the_second_table_is_made_from_the_first_as_written(spark, tmp_path):
    root, read = str(tmp_path), lambda name, schema: read_published(spark, root, name, schema).drop("batch_id")
    rows = spark.range(50).withColumn("drawn", F.rand())  # other numbers each time it is computed
    publish({"a": rows, "b": lambda a: a.withColumn("twice", F.col("drawn") * 2)}, root, 0)
    b = read("b", rows.withColumn("twice", F.lit(0.0)).schema)
    assert sorted(map(tuple, b.select("id", "drawn").collect())) == sorted(map(tuple, read("a", rows.schema).collect()))
    publish({"a": rows, "b": lambda a: a}, root, 0, remake=False)
    assert read("a", rows.schema).count() == 50


def test_shuffles_of_a_stored_table_are_freed(spark, tmp_path):
    before = stored_files(spark)
    kept = settle(spark.range(1000).repartition(5, "id"))
    write_batch(spark.range(1000).repartition(5, "id"), str(tmp_path / "t"), 0)
    for _ in range(100):  # they go in the background
        if not stored_files(spark) - before:
            break
        time.sleep(0.1)
    assert not stored_files(spark) - before and kept.count() == 1000
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with freed_shuffles(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == "false"


def test_a_stream_is_handed_over_with_the_columns_its_windows_need(spark, tmp_path, monkeypatch):
    seen = {}
    monkeypatch.setattr(windows, "closed_windows", lambda batch, i, width, *a, **k: seen.update({width: batch.columns}) or spark.range(1))
    df = rows_at(spark, 20).withColumn("localtime", F.lit("a text that costs time"))
    df.write.parquet(str(tmp_path / "in"))
    stream = replay(spark, str(tmp_path / "in"), df.schema)
    for width, wanted in (("1 minute", dict(energy=False, anomaly=True)), ("15 minutes", {})):
        windows.start_windows(stream, width, lambda *a: None, str(tmp_path / f"c{width}"), str(tmp_path / "s"), **wanted).awaitTermination()
    assert "localtime" not in seen["1 minute"] + seen["15 minutes"] and "activePower" not in seen["1 minute"]
    assert {"voltageRS", "localtime_datetime", "module"} <= set(seen["1 minute"]) and "accumActiveEnergy" in seen["15 minutes"]


def test_scoring_keeps_nothing_in_memory_and_bounds_its_batches(spark, tmp_path, monkeypatch):
    kept = []

    def watched(df, path, batch_id):
        write_batch(df, path, batch_id)
        kept.append([(i.memSize(), i.diskSize()) for i in spark._jsc.sc().getRDDStorageInfo()])

    monkeypatch.setattr(scoring, "write_batch", watched)
    monkeypatch.setattr(streams, "BATCH_BYTES", 150_000)
    monkeypatch.setattr(streams, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = streams.q_stream_score(spark, SF_DIR)
    rows = scoring_rows(spark, SF_DIR).filter("event_count % 10 < 4")
    assert got.count() == rows.count() + rows.filter("event_count % 10 = 3").count()
    assert len([*(tmp_path / "stream-score" / "out" / "predictions").glob("batch_id=*")]) > 1
    sizes = [s for each in kept for s in each]
    assert any(disk for _, disk in sizes) and not any(memory for memory, _ in sizes)
