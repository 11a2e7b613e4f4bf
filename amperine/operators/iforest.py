"""Isolation forest (Liu, Ting and Zhou, ICDM 2008), one forest per aggregation level.

Fitting draws a bounded pool of rows per level by hash, deals it to the trees, and grows
each tree from at most `psi` rows in its own task. The forest is a node table whose size
depends on `trees` and `psi` only, so it is broadcast for scoring.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amperine.constants import LEVELS
from amperine.operators.quantiles import exact_quantiles
from amperine.session import level_join, settle

# Python workers get these functions by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEVEL = "aggregation_level"
_NODES = "aggregation_level string, tree int, node int, feature int, split double, path double"
_EULER = 0.5772156649015329


def average_path(n):
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    big = np.where(n > 2, n, 3.0)
    depth = 2.0 * (np.log(big - 1.0) + _EULER) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, depth, np.where(n == 2, 1.0, 0.0))


# --- scaling --------------------------------------------------------------------------


def fit_scaler(df: DataFrame, vector: str = "features", size: int | None = None,
               by: list[str] | None = None) -> DataFrame:
    """Mean and population deviation per vector position (zero deviation becomes 1).

    Counts, means and squared deviations are taken batch by batch; they are one array of three
    numbers per position, group and batch, and are put together by Spark.
    """
    size = size or len(df.select(vector).first()[0])
    by = by or [LEVEL]
    rows = df.select(*by, F.col(vector).cast("array<double>").alias("_vector"))
    kept = [f for f in rows.schema.fields if f.name != "_vector"]
    numbers = [T.StructField(name, T.ArrayType(T.DoubleType())) for name in ("_n", "_mean", "_m2")]
    parts = rows.mapInArrow(_moments(by, size), T.StructType([*kept, *numbers]))
    each = parts.select(*by, F.posexplode(F.arrays_zip("_n", "_mean", "_m2")).alias("_pos", "_p")).select(*by, "_pos", "_p.*")
    place = Window.partitionBy(*by, "_pos")
    total = F.nullif(F.sum("_n").over(place), F.lit(0.0))
    weighed = F.when(F.col("_n") > 0, F.col("_n") * F.col("_mean"))
    each = each.withColumns({"_total": total, "_all": F.sum(weighed).over(place) / total})
    spread = F.when(F.col("_n") > 0, F.col("_m2") + F.col("_n") * F.pow(F.col("_mean") - F.col("_all"), 2.0))
    stats = each.groupBy(*by, "_pos").agg(
        F.max("_all").alias("mean"), F.sqrt(F.sum(spread) / F.max("_total")).alias("scale")
    )
    scale = F.when((F.col("scale") == 0) | F.col("scale").isNull(), 1.0).otherwise(F.col("scale"))
    in_order = F.sort_array(F.collect_list(F.struct("_pos", "mean", scale.alias("scale"))))
    return stats.groupBy(*by).agg(in_order.alias("_s")).select(
        *by, F.col("_s.mean").alias("mean"), F.col("_s.scale").alias("scale")
    )


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of a matrix; null entries become NaN."""
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    return values.astype(float, copy=False).reshape(len(vectors), -1)


def _moments(by: list[str], size: int):
    def moments(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            names = table.select(by).to_pandas()
            groups = names.groupby(by, dropna=False, sort=False).indices if len(by) > 1 else names.groupby(by[0], dropna=False, sort=False).indices
            for rows in groups.values():
                part = table.take(pa.array(rows))
                vectors = part["_vector"].combine_chunks().drop_null()
                if len(vectors) == 0:
                    count = mean = m2 = np.zeros(size)
                else:
                    x = _matrix(vectors)[:, :size]
                    there = np.ones(x.shape, dtype=bool)
                    if vectors.flatten().null_count:
                        there = vectors.flatten().is_valid().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)[:, :size]
                    count = there.sum(axis=0).astype(float)
                    mean = np.where(there, x, 0.0).sum(axis=0) / np.maximum(count, 1.0)
                    m2 = np.where(there, (x - mean) ** 2, 0.0).sum(axis=0)
                arrays = [pa.array([a.tolist()], pa.list_(pa.float64())) for a in (count, mean, m2)]
                keys = [part[name].combine_chunks().slice(0, 1) for name in by]
                yield pa.RecordBatch.from_arrays([*keys, *arrays], names=[*by, "_n", "_mean", "_m2"])

    return moments


def standardise(df: DataFrame, scaler: DataFrame, vector: str = "features") -> DataFrame:
    joined = level_join(df, scaler)
    centred = F.zip_with(vector, "mean", lambda x, m: x.cast("double") - m)
    return joined.withColumn(vector, F.zip_with(centred, "scale", lambda x, s: x / s)).drop("mean", "scale")


# --- growing --------------------------------------------------------------------------


def _pool(df: DataFrame, key: list[str], trees: int, psi: int, seed: int) -> DataFrame:
    """A sample of about 2 * trees * psi rows per level by a hash of the key.

    The same on every run, without ranking a level's rows anywhere.
    """
    counts = df.groupBy(LEVEL).agg(F.count(F.lit(1)).alias("_rows"))
    rows = level_join(df, counts)
    keep = F.least(F.lit(1.0), F.lit(2.0 * trees * psi) / F.col("_rows"))
    return rows.filter(_uniform(key, seed) < keep).drop("_rows")


def _uniform(key: list[Column | str], seed: int) -> Column:
    """Hash of the key as a number in [0, 1)."""
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 53)).cast("double") / float(1 << 53)


def _deal(pool: DataFrame, key: list[str], trees: int, psi: int, seed: int) -> DataFrame:
    """Deal every pool row to as many trees as give each tree about 1.5 * psi rows.

    Large levels deal each row once; small ones deal it several times, up to all trees.
    """
    sizes = pool.groupBy(LEVEL).agg(F.count(F.lit(1)).alias("_pool"))
    rows = level_join(pool, sizes)
    times = F.ceil(F.lit(1.5 * trees * psi) / F.col("_pool")).cast("int")
    dealt = F.transform(
        F.sequence(F.lit(1), times),
        lambda i: F.pmod(F.xxhash64(*key, i, F.lit(seed + 1)), F.lit(trees)).cast("int"),
    )
    return rows.select(LEVEL, *key, "features", F.explode(F.array_distinct(dealt)).alias("tree")).select(
        LEVEL, "features", "tree", _uniform([*key, "tree"], seed + 2).alias("draw")
    )


def _grow_tree(x: np.ndarray, psi: int, rng: np.random.Generator) -> list[tuple]:
    """Heap-ordered nodes (node, feature, split, path); feature -1 marks a leaf."""
    limit = int(np.ceil(np.log2(max(psi, 2))))
    nodes, work = [], [(0, np.arange(len(x)), 0)]
    while work:
        node, rows, depth = work.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(varied) == 0:
            nodes.append((node, -1, 0.0, depth + float(average_path(len(rows)))))
            continue
        feature = int(rng.choice(varied))
        split = float(rng.uniform(low[feature], high[feature]))
        left = x[rows, feature] <= split
        if left.all():  # the draw hit the upper end
            left = x[rows, feature] < high[feature]
        nodes.append((node, feature, split, 0.0))
        work.append((2 * node + 1, rows[left], depth + 1))
        work.append((2 * node + 2, rows[~left], depth + 1))
    return nodes


def _grower(psi: int, seed: int):
    def grow(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        level, tree = key
        rows = rows.sort_values("draw").head(psi)  # the sampling operator: psi rows a tree
        x = np.array(rows["features"].tolist(), dtype=float)
        level_no = sum(str(level).encode())
        nodes = _grow_tree(x, psi, np.random.default_rng([seed, level_no, int(tree)]))
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "path"])
        out.insert(0, "tree", int(tree))
        out.insert(0, LEVEL, level)
        return out

    return grow


# --- model ----------------------------------------------------------------------------


@dataclass
class Forest:
    """Node table, per-level scaler, and per-level offset and percentiles of -decision."""

    nodes: DataFrame
    scaler: DataFrame
    calibration: DataFrame
    trees: int
    psi: int
    _shared: dict = field(default_factory=dict, repr=False)

    def save(self, path: str) -> None:
        for name in ("nodes", "scaler", "calibration"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str, trees: int, psi: int) -> "Forest":
        parts = [spark.read.parquet(f"{path}/{n}") for n in ("nodes", "scaler", "calibration")]
        return Forest(*parts, trees=trees, psi=psi)

    def arrays(self) -> dict:
        """Broadcast arrays per level, shape (trees, nodes). Bounded by trees and psi."""
        if "b" not in self._shared:
            width = 2 ** (int(np.ceil(np.log2(max(self.psi, 2)))) + 1) - 1
            scales = {r[LEVEL]: (np.array(r["mean"]), np.array(r["scale"])) for r in self.scaler.collect()}
            model = {}
            for level, part in self.nodes.toPandas().groupby(LEVEL):
                trees = {t: i for i, t in enumerate(sorted(part["tree"].unique()))}
                at = part["tree"].map(trees).to_numpy(), part["node"].to_numpy()
                feature = np.full((len(trees), width), -1, dtype=np.int32)
                split, depth = np.zeros((len(trees), width)), np.zeros((len(trees), width))
                feature[at], split[at], depth[at] = part["feature"], part["split"], part["path"]
                model[level] = (*_steps(feature, split), depth, *scales[level])
            self._shared["b"] = self.nodes.sparkSession.sparkContext.broadcast(model)
        return self._shared["b"]


def _steps(feature: np.ndarray, split: np.ndarray) -> tuple:
    """Feature, split and left child per node, and the depth of every tree.

    A leaf is its own left child behind a split nothing lies above, so a walk of the depth of
    the tree needs no test for leaves.
    """
    leaf, node = feature < 0, np.arange(feature.shape[1])
    inner = np.where(leaf, -1, node)
    deepest = np.frexp(inner.max(axis=1) + 1)[1]  # 0 for a tree without a split
    return np.where(leaf, 0, feature).astype(np.int64), np.where(leaf, np.inf, split), np.where(leaf, node, 2 * node + 1), deepest


BLOCK = 8192  # rows walked down at a time, so that they stay in the processor's cache


def _mean_path(x: np.ndarray, model: tuple) -> np.ndarray:
    total = np.zeros(len(x))
    features, splits, lefts, deepest, depths = model
    for first in range(0, len(x), BLOCK):
        block = np.ascontiguousarray(x[first:first + BLOCK])
        values, rows = block.ravel(), np.arange(len(block)) * block.shape[1]
        sums = total[first:first + BLOCK]
        for feature, split, left, deep, depth in zip(features, splits, lefts, deepest, depths):
            at = np.zeros(len(block), dtype=np.int64)
            for _ in range(deep):
                value = values.take(feature.take(at, mode="clip") + rows, mode="clip")
                right = value > split.take(at, mode="clip")
                at = left.take(at, mode="clip") + right
            sums += depth.take(at, mode="clip")
    return total / len(features)


def _anomaly(df: DataFrame, forest: Forest) -> DataFrame:
    """Add `_s`, the isolation score in (0, 1] of unscaled `features`; higher is more isolated.

    Scaling is done next to the walk, on whole blocks. A row of a level without a fitted forest stops the job.
    """
    shared, unit = forest.arrays(), float(average_path(forest.psi))

    @F.arrow_udf("double")
    def isolation(level: pa.Array, features: pa.Array) -> pa.Array:
        out = np.full(len(level), np.nan)
        named, every = level.to_numpy(zero_copy_only=False), _matrix(features)
        for name in level.unique().to_pylist():
            if name not in shared.value:
                raise ValueError(f"no forest was fitted for level {name}")
            at = np.flatnonzero(named == name)
            *model, mean, scale = shared.value[name]
            x = (every[at] - mean) / scale
            out[at] = np.power(2.0, -_mean_path(x, model) / unit)
        return pa.array(out)

    return df.withColumn("_s", isolation(F.col(LEVEL), F.col("features")))


def isolation_by_joins(df: DataFrame, forest: Forest, key: list[str]) -> DataFrame:
    """`key`, level and `_s` as `_anomaly` gives it, without Python.

    Every row is put at the root of every tree and goes down one level per join with the node
    table, which is bounded by trees and psi and so broadcast. The paths of a row are summed in
    the task that holds it before anything is shuffled. A row of a level without a fitted
    forest stops the job.
    """
    nodes = forest.nodes.select(F.col(LEVEL).alias("_level"), "tree", "node", "feature", "split", "path")
    roots = nodes.filter("node = 0").drop("node")
    scaled = standardise(df.select(*dict.fromkeys([*key, LEVEL, "features"])), forest.scaler)
    fitted = [r[0] for r in forest.nodes.select(LEVEL).distinct().collect()]
    missing = F.raise_error(F.format_string("no forest was fitted for level %s", LEVEL))
    checked = scaled.withColumn("_checked", F.when(F.col(LEVEL).isin(fitted), F.col(LEVEL)).otherwise(missing))
    at = checked.join(F.broadcast(roots), F.col("_checked") == F.col("_level")).drop("_checked").withColumn("node", F.lit(0))
    for _ in range(int(np.ceil(np.log2(max(forest.psi, 2))))):
        right = (F.element_at("features", F.col("feature") + 1) > F.col("split")).cast("int")
        there = at.withColumn("_next", F.when(F.col("feature") >= 0, 2 * F.col("node") + 1 + right).otherwise(F.col("node")))
        below = F.broadcast(nodes.withColumnsRenamed({"_level": "_l", "tree": "_t", "node": "_n"}))
        same = (F.col("_level") == F.col("_l")) & (F.col("tree") == F.col("_t")) & (F.col("_next") == F.col("_n"))
        at = there.drop("node", "feature", "split", "path").join(below, same).drop("_l", "_t", "_next").withColumnRenamed("_n", "node")
    names = list(dict.fromkeys([*key, LEVEL]))
    mean = F.sum("path") / F.count("path")
    return at.groupBy(*names).agg(F.pow(F.lit(2.0), -mean / F.lit(float(average_path(forest.psi)))).alias("_s"))


def calibrate(scores: DataFrame, contamination: float = 0.01) -> DataFrame:
    """Offset and 1st/99th percentile of -decision per level from isolation scores `_s`.

    The decision value is -s - offset with the offset at the `contamination` quantile of
    -s, so -decision is s minus its (1 - contamination) quantile.
    """
    quantiles = exact_quantiles(scores, [LEVEL], ["_s"], [0.01, 0.99, 1.0 - contamination])
    at = lambda i: F.element_at("quantiles", i)
    return quantiles.select(
        LEVEL,
        (-at(3)).alias("offset"),
        (at(1) - at(3)).alias("p1"),
        (at(2) - at(3)).alias("p99"),
    )


def fit_iforest(
    df: DataFrame, key: list[str], trees: int = 100, psi: int = 256, seed: int = 7,
    contamination: float = 0.01,
) -> Forest:
    """Fit on rows with `features`; `key` names the columns that identify a row."""
    scaler = settle(fit_scaler(df))
    rows = df.select(LEVEL, *[k for k in key if k != LEVEL], "features")
    pool = settle(standardise(_pool(rows, key, trees, psi, seed), scaler))
    # a fixed number of partitions: growing costs time, not bytes, so coalescing would idle cores
    tasks = min(len(LEVELS) * trees, df.sparkSession.sparkContext.defaultParallelism)
    dealt = _deal(pool, key, trees, psi, seed).repartition(tasks, LEVEL, "tree")
    nodes = settle(dealt.groupBy(LEVEL, "tree").applyInPandas(_grower(psi, seed), _NODES))
    forest = Forest(nodes, scaler, calibration=scaler, trees=trees, psi=psi)
    scores = settle(_anomaly(rows, forest).select(LEVEL, "_s"))
    forest.calibration = settle(calibrate(scores, contamination))
    return forest


def score_iforest(df: DataFrame, forest: Forest) -> DataFrame:
    """Add `iforest_score_raw` (decision value) and `iforest_anomaly`; keeps `features`."""
    scored = level_join(_anomaly(df, forest), forest.calibration.select(LEVEL, "offset"))
    decision = -F.col("_s") - F.col("offset")
    return (
        scored.withColumn("iforest_score_raw", decision)
        .withColumn("iforest_anomaly", F.when(F.col("iforest_score_raw") < 0, 1).otherwise(0))
        .drop("_s", "offset")
    )


def forest_config(config: DataFrame, forest: Forest) -> DataFrame:
    """Level configuration with the percentiles of a fitted forest in place of the fixed ones."""
    fitted = forest.calibration.select(LEVEL, "p1", "p99")
    return config.drop("p1", "p99").join(fitted, LEVEL, "left")
