"""Whitening of embeddings by the leading eigenvectors of their covariance, by Jacobi-Davidson.

The covariance is never formed. Vectors lie in a written table of packed blocks; Spark
multiplies the centred blocks with a thin matrix (`Blocks.product`) and adds the partial
products up in a tree, so the driver sees matrices of dimension x block size only.

`leading` keeps an orthonormal search space. Each turn takes the largest Ritz pairs of the
space (Rayleigh-Ritz), locks those whose residual is at double precision, and for the next
BLOCK others solves the correction equation

    (I - QQ')(V - theta I)(I - QQ') t = -r,    Q: locked and current vectors,

with a few steps of MINRES, all right-hand sides in lock-step, one distributed product a
step. The corrections enlarge the space; at SPACE vectors it is restarted from its best ones.
It ends when the wanted largest pairs of locked and open ones together are all locked.

Entries c become floor(64 c) + 1000000, kept less the million. Entries beyond 2**40 in
size count as 2**40.

Defined results: rows with a null vector, or a null or non-finite entry, are dropped; so are
vectors of another length than the most frequent one (of ties the longest) and empty ones.
A null or repeated key is kept, row for row. Directions without variance have no whitened
value and no row, so one vector, or equal ones, give none; nor does an empty table. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amperine.session import settle

SCALE, SHIFT, LIMIT = 64, 1_000_000, 2.0**40
BLOCK, SPACE, INNER, TURNS = 16, 96, 8, 200
BLOCK_VALUES = 1 << 18
FAN = 64
TINY = np.finfo(float).eps


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose vector holds numbers only, their lengths, and all their integer entries."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    bad = np.bincount(row[~np.isfinite(values)], minlength=len(column)) > 0
    good = ~bad & (lengths > 0)
    entries = np.floor(SCALE * np.clip(values[good[row]], -LIMIT / SCALE, LIMIT / SCALE)).astype(np.int64)
    return np.flatnonzero(good), lengths[good], entries


class Blocks:
    """Written vectors as integer matrices, with their number and exact sums."""

    def __init__(self, df: DataFrame, key: str, vector: str):
        self.spark = df.sparkSession
        kind = df.schema[key].dataType
        schema = T.StructType([
            T.StructField("dimension", T.LongType()), T.StructField("n", T.LongType()),
            T.StructField("keys", T.ArrayType(kind)), T.StructField("sums", T.BinaryType()),
            T.StructField("entries", T.BinaryType()),
        ])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, lengths, entries = usable(batch.column(1))
                ends = np.cumsum(lengths)
                for dim in np.unique(lengths):
                    mine = np.flatnonzero(lengths == dim)
                    step = max(1, BLOCK_VALUES // int(dim))
                    for at in range(0, len(mine), step):
                        part = mine[at : at + step]
                        matrix = entries[(ends[part] - dim)[:, None] + np.arange(dim)]
                        keys = batch.column(0).take(pa.array(rows[part]))
                        # a sum of 2**18 entries below 2**41 fits a long
                        yield pa.RecordBatch.from_arrays([
                            pa.array([int(dim)], pa.int64()), pa.array([len(part)], pa.int64()),
                            pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                            pa.array([matrix.sum(0).tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary()),
                        ], schema.names)

        packed = settle(df.select(key, vector).mapInArrow(pack, schema))
        sizes = packed.groupBy("dimension").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dimension")).first()
        self.dimension, self.n = (sizes["dimension"], sizes["n"]) if sizes else (0, 0)
        self.rows = packed.filter(F.col("dimension") == self.dimension)
        self.key, self.kind = key, kind
        self.sums = [0] * self.dimension
        if self.n:
            self.sums = self._added(self.rows.select("sums"), lambda m, _: m[0].astype(object), np.int64).tolist()

    def _added(self, rows: DataFrame, count, dtype=float):
        """Sum of count(block, number of its vectors) over all blocks, added in a tree of fixed order."""
        dim = self.dimension

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for data in batch.column(0):
                    matrix = np.frombuffer(data.as_buffer(), dtype).reshape(-1, dim)
                    part = count(matrix, len(matrix))
                    total = part if total is None else total + part
            if total is not None:
                yield _sent(TaskContext.get().partitionId(), total)

        parts = rows.mapInArrow(partial, "place long, shape array<long>, data binary, text array<string>")
        tasks = rows.rdd.getNumPartitions()
        while tasks > FAN:
            fan = max(FAN // 2, isqrt(tasks))
            parts = parts.groupBy(F.floor(F.col("place") / fan).alias("group")).applyInArrow(_add_group, parts.schema)
            tasks = -(-tasks // fan)
        got = sorted(parts.collect(), key=lambda r: r.place)
        return sum(_got(r.shape, r.data, r.text) for r in got[1:]) + _got(*got[0][1:]) if got else None

    def product(self, thin: np.ndarray) -> np.ndarray:
        """Covariance times a thin matrix."""
        n, sums = self.n, self.means()

        def multiply(matrix: np.ndarray, _: int) -> np.ndarray:
            centred = matrix - sums
            return centred.T @ (centred @ thin)

        return self._added(self.rows.select("entries"), multiply, np.int64) / n

    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def trace(self) -> float:
        means = self.means()
        total = self._added(self.rows.select("entries"), lambda m, _: np.atleast_1d(((m - means) ** 2).sum()), np.int64)
        return float(total[0]) / self.n

    def whitened_error(self, basis: np.ndarray) -> float:
        """Largest entry of the covariance of the whitened vectors less the identity."""
        means = self.means()
        rows, k = self.rows.select("entries"), basis.shape[1]
        centre = self._added(rows, lambda m, _: ((m - means) @ basis).sum(0), np.int64) / self.n

        def square(matrix: np.ndarray, _: int) -> np.ndarray:
            white = (matrix - means) @ basis - centre
            return white.T @ white

        return float(np.abs(self._added(rows, square, np.int64) / self.n - np.eye(k)).max())


def _sent(place: int, total: np.ndarray) -> pa.RecordBatch:
    """Doubles travel as bytes, exact sums as decimal text."""
    exact = total.dtype == object
    return pa.RecordBatch.from_arrays([
        pa.array([place], pa.int64()), pa.array([list(total.shape)], pa.list_(pa.int64())),
        pa.array([None if exact else total.astype(float).tobytes()], pa.binary()),
        pa.array([[str(x) for x in total.ravel()] if exact else None], pa.list_(pa.string())),
    ], ["place", "shape", "data", "text"])


def _got(shape, data, text) -> np.ndarray:
    if data is None:
        return np.array([int(x) for x in text], object).reshape(shape)
    return np.frombuffer(bytes(data)).reshape(shape)


def _add_group(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
    total = None
    for row in sorted(rows.to_pylist(), key=lambda r: r["place"]):
        part = _got(row["shape"], row["data"], row["text"])
        total = part if total is None else total + part
    return pa.Table.from_batches([_sent(key[0].as_py(), total)])


def _orthonormal(fresh: np.ndarray, *held: np.ndarray) -> np.ndarray:
    """Directions of `fresh` that are orthogonal to `held`, which are orthonormal."""
    for _ in range(3):
        for basis in held:
            fresh = fresh - basis @ (basis.T @ fresh)
        size = np.linalg.norm(fresh, axis=0)
        fresh = fresh[:, size > 0] / size[size > 0]
        left, weight, _ = np.linalg.svd(fresh, full_matrices=False)
        fresh = left[:, weight > 1e-8]
    return fresh


def minres(apply, right: np.ndarray, steps: int, shrink: float) -> np.ndarray:
    """Solutions of apply(t) = right, one for each column, by at most `steps` Lanczos steps.

    apply: symmetric, the same operator up to a shift of each column. Columns run in lock-step.
    """
    size = np.linalg.norm(right, axis=0)
    beta, v_old = size.copy(), np.zeros_like(right)
    v = right / np.where(size > 0, size, 1)
    x = np.zeros_like(right)
    d_old, d_older = np.zeros_like(right), np.zeros_like(right)
    c_old = c_older = np.ones(right.shape[1])
    s_old = s_older = np.zeros(right.shape[1])
    left = size.copy()
    for _ in range(steps):
        z = apply(v)
        alpha = (z * v).sum(0)
        z = z - alpha * v - beta * v_old * (np.linalg.norm(v_old, axis=0) > 0)
        below = np.linalg.norm(z, axis=0)
        # apply the two earlier rotations, then a new one, to the last column of the tridiagonal
        epsilon = s_older * beta
        delta = c_old * (c_older * beta) + s_old * alpha
        gamma_bar = c_old * alpha - s_old * (c_older * beta)
        gamma = np.hypot(gamma_bar, below)
        safe = np.where(gamma > 0, gamma, 1)
        c, s = np.where(gamma > 0, gamma_bar / safe, 1.0), np.where(gamma > 0, below / safe, 0.0)
        d = (v - delta * d_old - epsilon * d_older) / safe
        x = x + np.where(gamma > 0, c * left, 0.0) * d
        left = -s * left
        d_older, d_old, c_older, c_old, s_older, s_old = d_old, d, c_old, c, s_old, s
        v_old, beta = v, below
        v = np.where(below > TINY * size, z / np.where(below > 0, below, 1), 0.0)
        if (np.abs(left) <= shrink * size).all() or not v.any():
            break
    return x


def leading(product, dimension: int, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, their unit vectors as columns, and their residuals.

    product: thin matrix to covariance times it. A pair is locked when its residual is at most
    dimension * eps * the largest eigenvalue, or, where rounding in the sums is larger than
    that, when three more turns leave the residual as it is.
    """
    wanted = min(wanted, dimension)
    rng = np.random.default_rng(seed)
    space = _orthonormal(rng.standard_normal((dimension, min(dimension, BLOCK))))
    image = product(space)
    locked, values = np.zeros((dimension, 0)), np.zeros(0)
    residuals = np.zeros(0)
    lowest, stale = np.inf, 0
    for _ in range(TURNS):
        small = space.T @ image
        theta, mix = np.linalg.eigh((small + small.T) / 2)
        theta, mix = theta[::-1], mix[:, ::-1]
        ritz, ritz_image = space @ mix, image @ mix
        residual = ritz_image - theta * ritz
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        top = max([*values, *theta[:1]])
        need = np.sort(np.concatenate([values, theta]))[::-1][:wanted][-1]
        # open pairs among the wanted ones; the space is complete when it fills the dimension
        want = theta >= need
        whole = space.shape[1] + locked.shape[1] == dimension
        lowest, stale = (size[want].max(), 0) if want.any() and size[want].max() < 0.5 * lowest else (lowest, stale + 1)
        floor = dimension * TINY * top if stale < 3 else 1e3 * dimension * TINY * top
        done = want & ((size <= floor) | whole)
        if done.any():
            locked = np.concatenate([locked, ritz[:, done]], 1)
            values, residuals = np.append(values, theta[done]), np.append(residuals, size[done])
            ritz, ritz_image, theta, residual, size = (
                ritz[:, ~done], ritz_image[:, ~done], theta[~done], residual[:, ~done], size[~done])
            space, image, lowest, stale = ritz, ritz_image, np.inf, 0
        if len(values) >= wanted and (not len(theta) or np.sort(values)[::-1][wanted - 1] >= theta[0]):
            break
        if whole:
            continue
        take = min(BLOCK, dimension - locked.shape[1] - space.shape[1], max(1, len(theta)))
        if space.shape[1] + take > SPACE:
            space, image = ritz[:, : SPACE // 2], ritz_image[:, : SPACE // 2]
        head = min(take, len(theta))
        fresh = np.zeros((dimension, 0))
        if head:
            shift, current = theta[:head], np.concatenate([locked, ritz[:, :head]], 1)

            def projected(t: np.ndarray) -> np.ndarray:
                t = t - current @ (current.T @ t)
                t = product(t) - shift * t
                return t - current @ (current.T @ t)

            fresh = minres(projected, -residual[:, :head], INNER, 0.05)
        fresh = _orthonormal(np.concatenate([fresh, rng.standard_normal((dimension, take - head))], 1), locked, space)
        if not fresh.shape[1]:
            fresh = _orthonormal(rng.standard_normal((dimension, take)), locked, space)
        space, image = np.concatenate([space, fresh], 1), np.concatenate([image, product(fresh)], 1)
    else:
        raise ArithmeticError(f"residuals {size[:wanted]} after {TURNS} turns")
    order = np.argsort(-values)[:wanted]
    return values[order], locked[:, order], residuals[order]


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """Key, component, n, deviation, whitened, explained and identity_error, per vector and component.

    deviation is decimal(38, 0) and null where it has more digits.
    """
    kind = df.schema[key].dataType
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    blocks = Blocks(df, key, vector)
    trace = blocks.trace() if blocks.n else 0.0
    if not trace > 0:
        return df.sparkSession.createDataFrame([], schema)
    values, vectors, _ = leading(blocks.product, blocks.dimension, components)
    real = values > blocks.dimension * TINY * values[0]
    values, vectors = values[real], vectors[:, real]
    basis, explained = vectors / np.sqrt(values), values / trace
    error = blocks.whitened_error(basis)
    n, sums, means, dim = blocks.n, blocks.sums, blocks.means(), blocks.dimension
    k = len(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, data in zip(batch.column(0), batch.column(1)):
                matrix = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, dim)
                white = (matrix - means) @ basis
                size = len(matrix)
                yield pa.RecordBatch.from_arrays([
                    keys.values.take(pa.array(np.repeat(np.arange(size), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)), pa.array(np.full(size * k, n)),
                    pa.array(deviations(matrix, n, sums), pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(size), k))),
                    pa.array(white.ravel()), pa.array(np.tile(explained, size)), pa.array(np.full(size * k, error)),
                ], schema.names)

    return blocks.rows.select("keys", "entries").mapInArrow(project, schema)


def deviations(matrix: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)**2, which the shift of x leaves as it is."""
    reach = n * int(np.abs(matrix).max(initial=0)) + max(map(abs, sums))
    if reach**2 * len(sums) < 2**63:
        off = n * matrix - np.array(sums, np.int64)
        return (off * off).sum(1).tolist()
    off = n * matrix.astype(object) - np.array(sums, object)
    return [d if d < 10**38 else None for d in (off * off).sum(1)]
