"""Quality rules: base statistics of whole texts and a learned decision list.

Sequential covering: on two thirds of the labelled rows a conjunction of thresholds is grown
by FOIL gain until it holds no good row, on the last third its end is pruned, and the rule
is kept if it is precise there; the rows it covers are removed and the next rule is grown.
The list is emitted as one ordered conditional expression. A document that fails the base
rules, or is caught by a rule of the list, goes.

Defined results: a null or empty text has all statistics 0 and fails the base rules; without
labelled rows the list is empty and the base rules decide; a null label is not learned from,
of several labels of one key the largest counts; a null key is never labelled; repeated rows
get equal results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine.llm.common import crc_fold, labelled_sample, labelled_texts

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_ROWS = 12_000
FOLDS, HELD_OUT = 3, 1
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.95
LEAST_COVER = 5
CUTS = 64

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_alpha", "n_lines"]
#: Features of the list: shares, so that long and short documents are judged alike.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "n_alpha"),
    "alpha_share": ("n_alpha", "word_chars"),
    "mean_word": ("word_chars", "n_words"),
}

_WORDS = re.compile(r"[^ \t-\r]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one whole text."""
    text = text or ""
    words = _WORDS.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        end = 0  # words before this place are counted
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    lines = [line for line in text.split("\n") if _WORDS.search(line)]
    upper = sum(map(str.isupper, text))
    alpha = sum(map(str.isalpha, text))
    return (
        len(words), sum(map(len, words)), len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)),
        repeated, upper, alpha, len(lines),
    )


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] = ()) -> DataFrame:
    """key, `carry` and COUNTS for every row."""
    kinds = dict(docs.dtypes)
    names = [key, *carry]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([text_counts(t.as_py()) for t in batch.column(len(names))], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *[pa.array(c) for c in got.reshape(-1, len(COUNTS)).T]],
                [*names, *COUNTS],
            )

    schema = ", ".join([f"`{n}` {kinds[n]}" for n in names] + [f"{c} long" for c in COUNTS])
    return docs.select(*names, text).mapInArrow(count, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def feature(name: str) -> Column:
    part, whole = FEATURES[name]
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def verdict(rules: list[list[Condition]]) -> Column:
    """The ordered conditional expression: 0 if the base rules fail, the number of the first
    rule that fits, null if the document stays."""
    out = F.when(base_failed(), F.lit(0))
    for number, rule in enumerate(rules, 1):
        fits = F.lit(True)
        for c in rule:
            value = feature(c.feature)
            fits = fits & ((value > c.threshold) if c.above else (value <= c.threshold))
        out = out.when(fits, F.lit(number))
    return out


def holds(rule: list[Condition], x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        out &= x[c.feature] > c.threshold if c.above else x[c.feature] <= c.threshold
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """Adds the condition of the largest FOIL gain until only bad rows are left."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < MOST_CONDITIONS and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        best, best_gain = None, 1e-9
        for name, values in x.items():
            own = values[inside]
            for cut in np.unique(np.quantile(own, np.linspace(0, 1, CUTS), method="lower")):
                over = own > cut
                for above in (True, False):
                    side = over if above else ~over
                    p1 = (side & bad[inside]).sum()
                    n1 = side.sum() - p1
                    if p1:
                        gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                        if gain > best_gain:
                            best, best_gain = Condition(name, above, float(cut)), gain
        if best is None:
            break
        rule.append(best)
        inside &= holds([best], x)
    return rule


def _worth(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, float, int]:
    """(p - n) / (p + n), precision and number of covered bad rows."""
    inside = holds(rule, x)
    p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
    return ((p - n) / (p + n) if p + n else -1.0), (p / (p + n) if p + n else 0.0), p


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[list[Condition]]:
    """Ordered rules that find bad rows."""
    rng = np.random.default_rng(0)
    left = np.ones(len(bad), bool)
    rules: list[list[Condition]] = []
    while (left & bad).sum() >= LEAST_COVER:
        draw = rng.random(len(bad)) < 2 / 3
        grow, prune = left & draw, left & ~draw
        def part(rows: np.ndarray) -> dict[str, np.ndarray]:
            return {k: v[rows] for k, v in x.items()}

        rule = _grow(part(grow), bad[grow])
        while len(rule) > 1 and _worth(rule[:-1], part(prune), bad[prune])[0] >= _worth(rule, part(prune), bad[prune])[0]:
            rule = rule[:-1]
        _, precision, cover = _worth(rule, part(prune), bad[prune])
        if not rule or precision < LEAST_PRECISION or cover < LEAST_COVER:
            break
        rules.append(rule)
        left &= ~holds(rule, x)
    return rules


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> list[list[Condition]]:
    """The list from a bounded sample of labelled rows that pass the base rules."""
    own = labels.filter(F.col(label).isNotNull() & (crc_fold(key, FOLDS) != HELD_OUT))
    marks = labelled_sample(own.groupBy(key).agg(F.max(label).cast("int").alias("_label")), key, sample_rows)
    sample = statistics(labelled_texts(docs, marks, key, text), key, text, ["_label"]).filter(~base_failed())
    got = sample.select("_label", *[feature(f).alias(f) for f in FEATURES]).collect()
    if not got:
        return []
    rows = np.array(sorted(tuple(r) for r in got), float)
    return learn({f: rows[:, i] for i, f in enumerate(FEATURES, 1)}, rows[:, 0] == 0)


def judge(docs: DataFrame, rules: list[list[Condition]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, COUNTS, base_failed, rule and kept for every row."""
    rows = statistics(docs, key, text).withColumn("rule", verdict(rules))
    return rows.withColumns({"base_failed": base_failed(), "kept": F.col("rule").isNull()})
