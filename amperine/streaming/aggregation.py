"""Readings stream to 1-minute rows, 15-minute rows and scoring input."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from amperine.operators.features import model_input
from amperine.streaming.ingest import without_duplicates
from amperine.streaming.sinks import publish, write_batch
from amperine.streaming.windows import start_windows


def start_aggregations(
    readings: DataFrame, root: str, delay: str = "5 minutes", every: str | None = None,
    time_col: str = "localtime_datetime", dedup_keys: list[str] | None = None,
) -> list[StreamingQuery]:
    """Two queries for three outputs under `root`: `1m`, `15m` and `model_input`.

    The 15-minute batch is computed once, written to both of its tables and published with
    one mark (`sinks.read_published`). Rows later than `delay` behind the newest event are
    dropped; `streaming.late` keeps them and corrects their windows.
    """
    if dedup_keys:
        readings = without_duplicates(readings, dedup_keys, delay, time_col)

    turn = Lock()

    def windows(name: str, width: str, write, **wanted) -> StreamingQuery:
        return start_windows(
            readings, width, write, f"{root}/_checkpoint/{name}", f"{root}/_open/{name}", delay, every, time_col,
            keep=bool(dedup_keys), turn=turn, **wanted)

    def write_quarter(batch: DataFrame, batch_id: int) -> None:
        publish({"15m": batch, "model_input": model_input}, root, batch_id, remake=False)

    return [
        windows("1m", "1 minute", lambda df, i: write_batch(df, f"{root}/1m", i), energy=False, anomaly=True),
        windows("15m", "15 minutes", write_quarter, dealt=False),
    ]
