"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its character pairs and triples within words
(word ends count as a character), hashed to BUCKETS rows. Embeddings and softmax are trained
by stochastic gradient descent in numpy on a bounded sample of labelled rows. A fifth of the
sample is not trained on; it sets the temperature of the probabilities and the rejection
threshold, below which FALSE_REJECT of its rightly recognised texts lie.

Defined results: a text that is null, empty or without letters is `und` with score 0 and
rejected; without any labelled row all texts are; a null key is kept; repeated rows get
equal results; an empty table gives no rows; other columns are not read by `predict` and
pass unchanged through `keep_recognised`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperine.llm.common import by_text, crc_fold, labelled_sample
from amperine.llm.tokens import LETTER, mixed, spell, temperature

BUCKETS = 4096
WIDTH = 16
SAMPLE_ROWS = 4000
EPOCHS = 30
RATE = 4.0
FALSE_REJECT = 0.0005
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"


class Model(NamedTuple):
    """`vectors` holds an embedding times the softmax weights: buckets by languages."""

    languages: list[str]
    vectors: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def subwords(texts: list[str]) -> np.ndarray:
    """Counts of hashed character pairs and triples: texts by buckets."""
    kinds, codes, _, text = spell(texts)
    letter = kinds == LETTER
    held = letter.copy()
    held[1:] |= letter[:-1]
    held[:-1] |= letter[1:]
    codes = np.where(letter, codes, 0)[held].astype(np.uint64)
    text = text[held]
    a, b = codes[:-1], codes[1:]
    pair = (a | b) > 0
    triple = (b[:-1] > 0) & ((a[:-1] | codes[2:]) > 0)
    same = text[:-2] == text[1:-1]
    two = mixed(a << np.uint64(21) | b)[pair]
    three = mixed((a[:-1] << np.uint64(42) | b[:-1] << np.uint64(21) | codes[2:]) + np.uint64(1 << 63))[triple & same]
    # a pair belongs to the text of its letter
    owner = np.where(a > 0, text[:-1], text[1:])[pair]
    cells = np.concatenate([owner, text[1:-1][triple & same]]) * BUCKETS + (
        np.concatenate([two, three]) % np.uint64(BUCKETS)
    ).astype(np.int64)
    return np.bincount(cells, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)


def averages(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Averaged subword counts for runs of texts; all 0 for a text without letters."""
    for counts in by_text(texts, subwords):
        yield counts / np.maximum(1, counts.sum(1, keepdims=True))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from a sample of the rows with a language; the caller leaves out held-out rows."""
    sample = labelled_sample(docs.filter(F.col(lang).isNotNull()).select(key, lang, text), key, sample_rows)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for rows in averages(batch.column(2).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(start, len(rows)),
                     pa.array([r.astype(np.float16).tobytes() for r in rows], pa.binary())],
                    ["lang", "features"],
                )
                start += len(rows)

    got = sorted(
        ((r.lang, bytes(r.features)) for r in sample.mapInArrow(featurise, "lang string, features binary").collect()),
        key=lambda r: (r[1], r[0]),
    )
    languages = sorted({name for name, _ in got})
    features = np.frombuffer(b"".join(f for _, f in got), np.float16).reshape(-1, BUCKETS)
    return train(features, np.array([languages.index(name) for name, _ in got], np.int64), languages)


def train(features: np.ndarray, labels: np.ndarray, languages: list[str]) -> Model:
    """Stochastic gradient descent on four fifths of the rows, calibration on the rest."""
    rng = np.random.default_rng(0)
    order = rng.permutation(len(labels))
    kept, own = order[: len(order) // 5], order[len(order) // 5 :]
    n = max(1, len(languages))
    embed = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    soft, bias = np.zeros((WIDTH, n), np.float32), np.zeros(n, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        rng.shuffle(own)
        for at in range(0, len(own), 32):
            rows = own[at : at + 32]
            x = features[rows].astype(np.float32)
            hidden = x @ embed
            slope = _softmax(hidden @ soft + bias)
            slope[np.arange(len(rows)), labels[rows]] -= 1
            slope /= len(rows)
            back = slope @ soft.T
            soft -= rate * hidden.T @ slope
            bias -= rate * 0.1 * slope.sum(0)
            used = np.flatnonzero(x.any(0))
            embed[used] -= rate * 50 * x[:, used].T @ back
    model = Model(languages, embed @ soft, bias, 1.0, 0.0)
    if not len(kept):
        return model
    logits = features[kept].astype(np.float32) @ model.vectors + bias
    model = model._replace(temperature=temperature(logits, labels[kept]))
    sure = _softmax(logits / model.temperature)
    right = sure.max(1)[sure.argmax(1) == labels[kept]]
    # no threshold above even chances: what is likelier right than wrong stays
    low = float(np.quantile(right, FALSE_REJECT, method="lower")) if len(right) else 0.0
    return model._replace(threshold=min(low, 0.5) * 0.999)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def probabilities(model: Model, texts: list[str | None]) -> np.ndarray:
    """Calibrated probability of every language; all 0 where there is no letter."""
    out = [np.zeros((0, max(1, len(model.languages))))]
    for rows in averages(texts):
        chances = _softmax((rows @ model.vectors + model.bias) / model.temperature)
        chances[~rows.any(1)] = 0
        out.append(chances)
    return np.concatenate(out)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score and rejected for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            chances = probabilities(model, batch.column(1).to_pylist())
            best = np.clip(chances.max(1), 0, 1)
            known = (best > 0) & bool(model.languages)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[np.where(known, chances.argmax(1), -1)], pa.string()),
                 pa.array(np.where(known, best, 0.0)), pa.array(~known | (best < model.threshold))],
                [key, "lang_pred", "score", "rejected"],
            )

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(
        score, f"`{key}` {kind}, lang_pred string, score double, rejected boolean"
    )


def keep_recognised(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose language is recognised, with their columns as they came."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            best = probabilities(model, batch.column(place).to_pylist()).max(1)
            known = (best > 0) & (best >= model.threshold) & bool(model.languages)
            yield batch.filter(pa.array(known))

    return docs.mapInArrow(keep, docs.schema)


def training_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows outside the held-out fold; rows without key are not trained on."""
    return docs.filter(crc_fold(key, FOLDS) != HELD_OUT)


def identify(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Fit on the training rows, predict all: key, held_out, lang_pred, score, rejected."""
    rows = predict(docs, fit(training_rows(docs, key), key), key)
    held = F.coalesce(crc_fold(key, FOLDS) == HELD_OUT, F.lit(False))
    return rows.select(key, held.alias("held_out"), "lang_pred", "score", "rejected")
