"""Helpers the corpus operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine.session import scratch_path

# A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
_BLANK = re.compile(r"\s")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Writes rows with whole texts to the shared folder, well packed, and reads them back."""
    path = scratch_path(df.sparkSession, "texts")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`: the split into training and held-out rows."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def labelled_sample(rows: DataFrame, key: str, bound: int, seed: int = 1) -> DataFrame:
    """About `bound` rows for fitting and at most twice as many, picked by a hash of the key.

    Every row passes the same test, so nothing is sorted or gathered and reruns agree. The
    limit is reached only if one key holds a large part of all rows.
    """
    share = min(1.0, bound / max(1, rows.count()))
    return rows.filter(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(2**30)) < int(share * 2**30)).limit(2 * bound)


def labelled_texts(docs: DataFrame, marks: DataFrame, key: str, text: str) -> DataFrame:
    """`marks`, a bounded sample with one row per key, each with the least text of its key.

    However many rows repeat a key, one comes back, and they combine before the shuffle.
    """
    named = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    own = marks.withColumnRenamed(key, "_key")
    joined = named.join(F.broadcast(own), "_key").groupBy(*own.columns).agg(F.min("_text").alias("_text"))
    return joined.withColumnsRenamed({"_key": key, "_text": text})


def spread_lookup(
    rows: DataFrame, lookup: DataFrame, key: str, weight: str, share: int = 1000
) -> DataFrame:
    """Left join of `rows` to `lookup`, which has one row per key and the key's row count.

    A key with more than 1/share of all counted rows is served from a broadcast, of which
    there are fewer than `share` keys whatever the size of the data; the others are joined
    by shuffle, where none can overfill a task. Both inputs should be written tables.
    """
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * share > total
    heavy, light = lookup.filter(hot), lookup.filter(~hot)
    served = rows.join(F.broadcast(heavy), key)
    others = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return served.unionByName(others.join(light, key, "left").select(served.columns))


def pieces(text: str, chars: int) -> Iterator[str]:
    """A text in parts of at most `chars` characters that end at blanks.

    A word longer than that is a part of its own with what stands before it.
    """
    at = 0
    while len(text) - at > chars:
        stop = max(text.rfind(blank, at + 1, at + chars) for blank in " \n\t\r")
        if stop < 0:
            found = _BLANK.search(text, at + chars)
            stop = found.start() if found else len(text)
        yield text[at:stop]
        at = stop
    yield text[at:]


def by_text(
    texts: list[str | None], count: Callable[[list[str]], np.ndarray],
    chars: int = 1 << 20, most: int = 256,
) -> Iterator[np.ndarray]:
    """count(texts), one row per text, for runs of a batch's texts in order.

    A run has at most `most` texts and about `chars` characters, so memory is bounded. A
    longer text is a run of its own, the sum of the counts of its pieces, which are cut at
    blanks, so no word is cut; a count of neighbours misses those across a cut.
    """
    run: list[str] = []
    held = 0
    for value in texts:
        value = value or ""
        if run and (held + len(value) > chars or len(run) == most):
            yield count(run)
            run, held = [], 0
        if len(value) > chars:
            yield sum(count([piece]) for piece in pieces(value, chars))
        else:
            run.append(value)
            held += len(value)
    if run:
        yield count(run)
