"""Windows of a stream whose open ones are kept as a table.

A stateful aggregation holds every window of its state in the memory of executors and writes it to the
checkpoint, also those that are closed in the same step; a replay of stored readings comes as
few batches, so that was all windows. Here a batch is aggregated as a table, and only windows that
it cannot close, and those that were open before it, are stored with its number.

Rules are those of a watermark. After a batch the watermark is the newest event so far, less one
microsecond, in whole milliseconds, less `delay`. Windows that end at or before it are closed and
given out with the batch that closes them; a reading of a window that an earlier batch closed is
dropped. A repeated batch replaces what it stored and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager, nullcontext
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from amperine.operators.windows import from_states, merge_states, reading_states, state_columns, window_end
from amperine.streaming.sinks import start, write_batch

NEWEST = T.StructType([T.StructField("newest", T.TimestampNTZType())])


def start_windows(
    readings: DataFrame, width: str, write: Callable[[DataFrame, int], None], checkpoint: str, state: str,
    delay: str = "5 minutes", every: str | None = None, time_col: str = "localtime_datetime", keep: bool = False,
    turn: AbstractContextManager | None = None, **wanted,
) -> StreamingQuery:
    """Runs `write` on the windows that each batch closes, as `aggregate_readings` gives them.

    `state` is the folder of open windows, which belongs to `checkpoint` as its own folders do. `wanted` goes to
    `reading_states`. A batch is read three times: for its newest event, for windows at its edges
    and for those between; with `keep`, for streams that are not free to make again, its rows are kept meanwhile.
    Queries that are given one lock as `turn` do their batches in turns, so that the shuffles of one are gone when
    another one begins.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        with turn or nullcontext():
            rows = batch.persist(StorageLevel.DISK_ONLY) if keep else batch
            try:
                write(closed_windows(rows, batch_id, width, state, delay, time_col, **wanted), batch_id)
            finally:
                if keep:
                    rows.unpersist()

    # a batch is handed over with all its columns made
    used = {"module": None, time_col: None, **dict.fromkeys(state_columns(wanted.get("energy", True), wanted.get("anomaly", False)))}
    return start(readings.select(*used), step, checkpoint, every=every)


def closed_windows(
    batch: DataFrame, batch_id: int, width: str, state: str, delay: str, time_col: str, **wanted
) -> DataFrame:
    """The windows that a batch closes; stores the open ones and the newest event."""
    session = batch.sparkSession
    before = None if batch_id == 0 else _stored(session, f"{state}/newest", batch_id - 1, NEWEST).first()[0]
    seen = batch.agg(F.max(F.col(time_col).cast("timestamp_ntz"))).first()[0]
    newest = max((t for t in (before, seen) if t is not None), default=None)
    was_closed, last = _marks(session, before, delay, width)
    closed, _ = _marks(session, newest, delay, width)
    states = lambda rows: reading_states(rows.drop("_window_end"), width, time_col=time_col, **wanted)
    end, label = F.col("_window_end"), F.col("window_end_time")
    rows = batch.withColumn("_window_end", window_end(F.col(time_col), width))
    # windows up to the last one that was open may have a stored part, later ones have none
    inside = F.lit(False)
    if before is None and newest is not None:
        inside = end <= _at(closed)
    elif before is not None and closed > last:
        inside = (end <= _at(closed)) & (end > _at(last))
    edge = states(rows.filter(~inside) if was_closed is None else rows.filter(~inside & (end > _at(was_closed))))
    if before is not None:
        old = _stored(session, f"{state}/open", batch_id - 1, edge.schema).filter(label > _at(was_closed))
        edge = merge_states(edge.unionByName(old), width)
    write_batch(edge, f"{state}/open", batch_id)
    write_batch(session.createDataFrame([(newest,)], NEWEST).coalesce(1), f"{state}/newest", batch_id)
    made = states(rows.filter(inside))
    if newest is not None:
        stored = _stored(session, f"{state}/open", batch_id, edge.schema)
        made = made.unionByName(stored.filter(label <= _at(closed)))
    return from_states(made)


def _at(time: datetime) -> Column:
    return F.lit(time).cast("timestamp_ntz")


def _stored(session: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    return session.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")


def _marks(session: SparkSession, newest: datetime | None, delay: str, width: str) -> tuple:
    """The watermark behind a newest event, and the end of the window that this event lies in."""
    if newest is None:
        return None, None
    last = newest - timedelta(microseconds=1)
    last = _at(last.replace(microsecond=last.microsecond // 1000 * 1000))
    return tuple(session.range(1).select(
        (last - F.expr(f"interval {delay}")).alias("closed"), window_end(_at(newest), width).alias("end")).first())
