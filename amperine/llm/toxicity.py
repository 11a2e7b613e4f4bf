"""Toxicity by a classifier chain over categories.

A category is a 0/1 label column. The terms a model may use are words and word beginnings
whose presence differs most between positive and negative labelled documents. A document is
the set of terms it holds. The first category gets a linear model of the terms; every later
one a linear model of the terms and of the probabilities of the categories before it. What
a later model is trained on are out-of-fold probabilities, so that it learns how far they
can be trusted; documents are scored with models of all labelled rows.

Defined results: a null or empty text holds no term and gets the models' base rates; a
category without both labels has probability 0; a null label is not trained on, of several
labels of one key the largest counts; a null key is never labelled; repeated rows get equal
results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperine.llm.common import by_text, labelled_sample, labelled_texts
from amperine.llm.tokens import LETTER, PREFIX, tokens

SAMPLE_ROWS = 10_000
TERMS = 512
LEAST_DOCS = 5
FOLDS = 5
RIDGE = 0.1


class Link(NamedTuple):
    """Weights of the terms, of earlier probabilities, and the bias; None without both labels."""

    weights: np.ndarray | None


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every word and word beginning, each once per text."""
    got = tokens(texts)
    word = got.kind == LETTER
    long = word & (got.length > PREFIX)
    mark = np.uint64(0x5555555555555555)
    hashes = np.concatenate([got.hash[word], got.prefix[long] ^ mark])
    owner = np.concatenate([got.text[word], got.text[long]])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new].view(np.int64), owner[new]


def telling_terms(sample: DataFrame, categories: list[str], text: str = "text", most: int = TERMS) -> np.ndarray:
    """Sorted hashes of the `most` terms with the largest chi-square for any category."""
    schema = "term long, docs long, " + ", ".join(f"`{c}` long" for c in categories)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.stack([np.asarray(batch.column(i).fill_null(0)) for i in range(1, 1 + len(categories))], 1)
            start = 0
            for at in range(0, len(batch), 128):
                texts = [(t or "") for t in batch.column(0).slice(at, 128).to_pylist()]
                found, owner = terms(texts)
                names, where = np.unique(found, return_inverse=True)
                columns = [np.bincount(where, minlength=len(names))]
                for c in range(len(categories)):
                    columns.append(np.bincount(where, marks[at + owner, c], len(names)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v.astype(np.int64)) for v in [names, *columns]], ["term", "docs", *categories]
                )
                start += len(texts)

    counts = sample.select(text, *categories).mapInArrow(count, schema).groupBy("term").agg(
        *[F.sum(c).alias(c) for c in ("docs", *categories)]
    )
    size, *sums = sample.agg(F.count("*"), *[F.coalesce(F.sum(c), F.lit(0)) for c in categories]).first()
    chi = F.lit(0.0)
    for name, positive in zip(categories, sums):
        with_term, rest = F.col(name), F.col("docs")
        gap = with_term * size - rest * positive
        spread = rest * (size - rest) * positive * (size - positive)
        chi = F.greatest(chi, F.when(spread > 0, gap.cast("double") * gap * size / spread).otherwise(0.0))
    best = counts.filter(F.col("docs") >= LEAST_DOCS).select("term", chi.alias("chi")).orderBy(F.desc("chi"), "term")
    return np.array(sorted(r.term for r in best.limit(most).collect()), np.int64)


def held_terms(texts: list[str | None], chosen: np.ndarray) -> np.ndarray:
    """Which chosen terms a text holds: texts by terms, 0 or 1."""
    def held(run: list[str]) -> np.ndarray:
        out = np.zeros((len(run), len(chosen)), np.float32)
        found, owner = terms(run)
        if len(chosen):
            at = np.minimum(np.searchsorted(chosen, found), len(chosen) - 1)
            hit = chosen[at] == found
            out[owner[hit], at[hit]] = 1
        return out

    runs = [np.zeros((0, len(chosen)), np.float32), *by_text(texts, held)]
    return np.minimum(np.concatenate(runs), 1)


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 200) -> np.ndarray | None:
    """Logistic regression with a ridge, by accelerated gradient steps; the last weight is the bias."""
    if len(np.unique(y)) < 2:
        return None
    # rare terms are as wide as common ones after this, so that the steps suit both
    centre, scale = x.mean(0), x.std(0) + np.float32(1e-3)
    x1 = np.concatenate([(x - centre) / scale, np.ones((len(x), 1), np.float32)], 1)
    y = y.astype(np.float32)
    ridge = np.full(x1.shape[1], RIDGE / len(y), np.float32)
    ridge[-1] = 0
    v = np.ones(x1.shape[1], np.float32)
    for _ in range(20):  # largest eigenvalue by power iteration
        v = x1.T @ (x1 @ v)
        v /= np.linalg.norm(v)
    step = np.float32(1 / (0.25 * float(v @ (x1.T @ (x1 @ v))) / len(y) * 1.05 + RIDGE / len(y)))
    w = ahead = np.zeros(x1.shape[1], np.float32)
    for i in range(steps):
        grad = x1.T @ (_logistic(x1 @ ahead) - y) / len(y) + ridge * ahead
        new = ahead - step * grad
        ahead = new + np.float32(i / (i + 3)) * (new - w)
        w = new
    weights = w[:-1] / scale
    return np.append(weights, w[-1] - weights @ centre)


def chance(x: np.ndarray, w: np.ndarray | None) -> np.ndarray:
    return np.zeros(len(x)) if w is None else _logistic(x @ w[:-1] + w[-1])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit_chain(x: np.ndarray, labels: np.ndarray) -> list[Link]:
    """One link per column of labels (-1: unknown), in order."""
    fold = np.random.default_rng(0).permutation(len(x)) % FOLDS
    links = []
    for y in labels.T:
        known = y >= 0
        out_of_fold = np.zeros(len(x))
        for f in range(FOLDS):
            rest = known & (fold != f)
            out_of_fold[fold == f] = chance(x[fold == f], fit_linear(x[rest], y[rest]))
        links.append(Link(fit_linear(x[known], y[known])))
        x = np.concatenate([x, out_of_fold[:, None].astype(np.float32)], 1)
    return links


def run_chain(x: np.ndarray, links: list[Link]) -> np.ndarray:
    """Probability of every category: rows by categories."""
    for link in links:
        x = np.concatenate([x, chance(x, link.weights)[:, None].astype(np.float32)], 1)
    return x[:, x.shape[1] - len(links) :].astype(float)


def classify(
    docs: DataFrame, labels: DataFrame, categories: list[str], key: str = "doc_id",
    text: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """key and the probability of every category, in columns p_<category>, for every row.

    `labels` has the key and a 0/1 column per category. The chain runs in their order.
    """
    context = docs.sparkSession.sparkContext
    marks = labels.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.max(c).cast("long").alias(c) for c in categories])
    sample = labelled_texts(docs, labelled_sample(marks, key, sample_rows), key, text)
    chosen = telling_terms(sample, categories, text)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.packbits(held_terms(batch.column(0).to_pylist(), chosen).astype(bool), axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([b.tobytes() for b in bits], pa.binary())], [*categories, "bits"]
            )

    schema = ", ".join(f"`{c}` long" for c in categories) + ", bits binary"
    got = sample.select(text, *categories).mapInArrow(featurise, schema).collect()
    got.sort(key=lambda r: (bytes(r.bits), *[-1 if v is None else v for v in r[:-1]]))
    bits = np.frombuffer(b"".join(bytes(r.bits) for r in got), np.uint8).reshape(len(got), -(-len(chosen) // 8))
    x = np.unpackbits(bits, axis=1)[:, : len(chosen)].astype(np.float32)
    y = np.array([[-1 if v is None else v for v in r[:-1]] for r in got], np.int64).reshape(-1, len(categories))
    model = context.broadcast((chosen, fit_chain(x, y)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, links = model.value
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                chances = run_chain(held_terms(part.column(1).to_pylist(), chosen), links)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c) for c in chances.T]], [key, *[f"p_{c}" for c in categories]]
                )

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(
        score, f"`{key}` {kind}, " + ", ".join(f"p_{c} double" for c in categories)
    )
