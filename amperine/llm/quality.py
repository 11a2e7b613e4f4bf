"""Quality scores: random-indexing word vectors, pooled per document, and a small network.

Every token bucket has a sparse random index vector of +1 and -1, made from a seed. The
vector of a bucket is the sum of the index vectors found within two places of it, over all
documents; the sums are whole numbers, so the order of tasks does not matter. A document is
the mean of the unit vectors of its tokens. A network of two layers in numpy is trained on
a bounded sample of labelled rows, a fifth of which sets the temperature of its
probabilities.

Buckets: words by hash, and a reserved part for signs, numbers, words in upper case and
words equal to the one before.

Defined results: a null or empty text has the zero vector and the network's score for it;
without labelled rows every score is 0.5; a null label is not trained on, of several labels
of one key the largest counts; a null key is never labelled; repeated rows get equal scores;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperine.llm.common import by_text, crc_fold, labelled_sample, labelled_texts
from amperine.llm.tokens import DIGIT, LETTER, SIGN, temperature, tokens

BUCKETS = 4096
RESERVED = 256
WIDTH = 32
NONZERO = 4
BLOCK = 256
SHOUTED, NUMBER, REPEATED, FIRST_SIGN = 0, 1, 2, 3
SAMPLE_ROWS = 6000
HIDDEN = 16
EPOCHS = 60
FOLDS, HELD_OUT = 3, 1


class Network(NamedTuple):
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    centre: np.ndarray
    scale: np.ndarray
    temperature: float


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(7)
    out = np.zeros((BUCKETS, WIDTH), np.int64)
    for row in out:
        row[rng.choice(WIDTH, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


def buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every token, in order."""
    got = tokens(texts)
    words = np.uint64(BUCKETS - RESERVED)
    signs = np.uint64(RESERVED - FIRST_SIGN)
    place = (RESERVED + (got.hash % words).astype(np.int64))
    place[got.shouted] = SHOUTED
    place[got.kind == DIGIT] = NUMBER
    again = np.zeros(len(place), bool)
    again[1:] = (got.hash[1:] == got.hash[:-1]) & (got.text[1:] == got.text[:-1])
    place[again & (got.kind == LETTER)] = REPEATED
    sign = got.kind == SIGN
    place[sign] = FIRST_SIGN + (got.hash[sign] % signs).astype(np.int64)
    return place, got.text


def context_sums(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Sum of neighbouring index vectors for every bucket, over all documents.

    Every task adds up its own documents and emits blocks of whole numbers, which are added
    in groups of at most 64 tasks, then 64 groups, then all.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sums = index_vectors(), np.zeros((BUCKETS, WIDTH), np.int64)

        def near(texts: list[str]) -> np.ndarray:
            place, owner = buckets(texts)
            context = np.zeros((len(place), WIDTH), np.int64)
            for gap in (1, 2):
                if len(place) > gap:
                    same = (owner[gap:] == owner[:-gap])[:, None]
                    context[gap:] += index[place[:-gap]] * same
                    context[:-gap] += index[place[gap:]] * same
            if len(place):
                order = np.argsort(place, kind="stable")
                starts = np.flatnonzero(np.diff(place[order], prepend=-1))
                sums[place[order][starts]] += np.add.reduceat(context[order], starts)
            return np.zeros(0)

        for batch in batches:
            for _ in by_text(batch.column(0).to_pylist(), near, chars=1 << 18):
                pass
        task = TaskContext.get().partitionId()
        blocks = [(b, sums[b * BLOCK : (b + 1) * BLOCK]) for b in range(BUCKETS // BLOCK)]
        blocks = [(b, part) for b, part in blocks if part.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in blocks], pa.int32()), pa.array([task] * len(blocks), pa.int32()),
             pa.array([part.tobytes() for _, part in blocks], pa.binary())],
            ["block", "task", "sums"],
        )

    def merge(group: pa.Table) -> pa.Table:
        parts = group.column("sums").to_pylist()
        total = sum(np.frombuffer(p, np.int64) for p in parts)
        return group.slice(0, 1).select(["block", "task"]).append_column(
            "sums", pa.array([total.tobytes()], pa.binary())
        )

    schema = "block int, task int, sums binary"
    rows = docs.select(text).mapInArrow(add, schema)
    for tasks in (64, 64, None):
        onto = F.lit(0) if tasks is None else F.floor(F.col("task") / tasks).cast("int")
        rows = rows.withColumn("task", onto).groupBy("block", "task").applyInArrow(merge, schema)
    out = np.zeros((BUCKETS, WIDTH), np.int64)
    for row in rows.collect():  # BUCKETS x WIDTH numbers, whatever the input
        out[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(row.sums, np.int64).reshape(-1, WIDTH)
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit vectors, after the direction that all buckets share is taken out."""
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = sums / np.maximum(1, length)
    unit = np.where(length > 0, unit - unit[length[:, 0] > 0].mean(0) if (length > 0).any() else 0.0, 0.0)
    return unit / np.maximum(1e-9, np.linalg.norm(unit, axis=1, keepdims=True))


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """Mean word vector of every text; zero where there is no token."""
    def total(run: list[str]) -> np.ndarray:
        place, owner = buckets(run)
        out = np.zeros((len(run), WIDTH + 1))
        if len(place):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[starts], :WIDTH] = np.add.reduceat(vectors[place], starts)
            out[:, WIDTH] = np.bincount(owner, minlength=len(run))
        return out

    runs = [np.zeros((0, WIDTH + 1)), *by_text(texts, total, chars=1 << 18)]
    sums = np.concatenate(runs)
    return sums[:, :WIDTH] / np.maximum(1, sums[:, WIDTH:])


def train(features: np.ndarray, labels: np.ndarray) -> Network | None:
    """Adam on the log loss of four fifths of the rows; the rest sets the temperature."""
    if len(np.unique(labels)) < 2:
        return None
    rng = np.random.default_rng(0)
    order = rng.permutation(len(labels))
    kept, own = order[: len(order) // 5], order[len(order) // 5 :]
    centre, scale = features[own].mean(0), features[own].std(0) + 1e-6
    x, y = (features - centre) / scale, labels.astype(float)
    weights = [rng.normal(0, 0.3, (WIDTH, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    first, second, step = [0.0] * 4, [0.0] * 4, 0
    for epoch in range(EPOCHS):
        rng.shuffle(own)
        for at in range(0, len(own), 64):
            rows = own[at : at + 64]
            inner = np.tanh(x[rows] @ weights[0] + weights[1])
            slope = (_logistic(inner @ weights[2] + weights[3]) - y[rows]) / len(rows)
            back = np.outer(slope, weights[2]) * (1 - inner**2)
            grads = [x[rows].T @ back + 1e-4 * weights[0], back.sum(0), inner.T @ slope + 1e-4 * weights[2], slope.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] = weights[i] - 0.01 * (1 - epoch / EPOCHS) * (first[i] / (1 - 0.9**step)) / (
                    np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
                )
    model = Network(*weights[:3], float(weights[3][0]), centre, scale, 1.0)
    z = logits(model, features[kept])
    return model._replace(temperature=temperature(np.stack([0 * z, z], 1), labels[kept].astype(int)))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def logits(model: Network, features: np.ndarray) -> np.ndarray:
    inner = np.tanh((features - model.centre) / model.scale @ model.inner + model.inner_bias)
    return inner @ model.outer + model.outer_bias


def training_labels(labels: DataFrame, label: str, key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """A bounded sample of key and label outside the held-out fold, one row per key."""
    own = labels.filter(F.col(label).isNotNull() & (crc_fold(key, FOLDS) != HELD_OUT))
    return labelled_sample(own.groupBy(key).agg(F.max(label).cast("int").alias("label")), key, sample_rows)


def score_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """key, held_out, score and predicted for every row."""
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(context_sums(docs, text)))
    sample = labelled_texts(docs, training_labels(labels, label, key, sample_rows), key, text)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pooled(batch.column(0).to_pylist(), vectors.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([r.tobytes() for r in rows], pa.binary())], ["label", "features"]
            )

    got = sorted(
        ((bytes(r.features), r.label) for r in
         sample.select(text, "label").mapInArrow(featurise, "label int, features binary").collect())
    )
    features = np.frombuffer(b"".join(f for f, _ in got), np.float64).reshape(-1, WIDTH)
    model = context.broadcast(train(features, np.array([y for _, y in got], np.int64)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pooled(batch.column(1).to_pylist(), vectors.value)
            chance = np.full(len(rows), 0.5)
            if model.value is not None:
                chance = _logistic(logits(model.value, rows) / model.value.temperature)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chance)], [key, "score"])

    kind = dict(docs.dtypes)[key]
    scored = docs.select(key, text).mapInArrow(score, f"`{key}` {kind}, score double")
    held = F.coalesce(crc_fold(key, FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(
        key, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
