"""Session set-up and the shared folder used for checkpoints and working tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amperine.constants import LEVELS

# Rows of a lookup table that may be broadcast. A threshold row is about 300 bytes wide.
BROADCAST_ROWS = 100_000
SALTS = 16


def build_session(cores: str | int = "*", app: str = "amperine", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("AMPERINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Settings the wide row-wise stages profit from on any cluster.

    The JVM does not compile methods above 8000 bytes of code; above that size Spark had
    better split the expressions into small methods than fuse the whole stage.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the cluster; a fresh local one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="amperine-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a table written in here go when it is written.

    Else they stay until the driver collects its garbage, so that the files of all steps of a job lie on disk together.
    """
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def settle(df: DataFrame) -> DataFrame:
    """Write the rows to a table in the shared folder and read that instead.

    Later passes then neither recompute the rows nor read columns they do not need, and
    losing an executor loses nothing. The folder is the cluster's checkpoint folder, whose
    contents are temporary.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup_join(
    df: DataFrame, table: DataFrame, on: list[str], max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join to a table with one row per key, whatever the share of the hottest key.

    Null keys match null keys.

    The table is settled and counted. Up to `max_rows` it is broadcast and `df` is not
    shuffled. Beyond that every table row is repeated once per salt, so the rows of one
    hot key spread over all salts. These copies are never broadcast, however small the files of the
    table are: they would be put together in the driver's memory.
    """
    table = settle(table).withColumnsRenamed({name: f"_{name}_key" for name in on})
    same = reduce(and_, [F.col(f"`{name}`").eqNullSafe(F.col(f"`_{name}_key`")) for name in on])
    keys = [f"_{name}_key" for name in on]
    if table.limit(max_rows + 1).count() <= max_rows:
        return df.join(F.broadcast(table), same, "left").drop(*keys)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*_hashable(df)), F.lit(SALTS)))
    copies = table.withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    )
    return salted.join(copies.hint("merge"), same & (F.col("_salt") == F.col("_copy")), "left").drop("_salt", "_copy", *keys)


def level_join(df: DataFrame, table: DataFrame, level: str = "aggregation_level") -> DataFrame:
    """Left join to a table with one row per aggregation level: at most four rows."""
    return df.join(F.broadcast(table.filter(F.col(level).isin(LEVELS))), level, "left")


def _hashable(df: DataFrame) -> list[str]:
    simple = ("map<", "variant")
    return [
        f"`{name}`" for name, kind in df.dtypes if not any(part in kind for part in simple)
    ]
