"""Groups spelling variants of the words of a corpus by an index of variable-length grams.

Words at edit distance one are found without comparing all words. A dictionary of grams is
grown from frequent grams only: every gram of GRAM_LEAST characters is in it, a longer one
if it occurs and the gram without its last character occurs more than `frequent` times. A
word is decomposed into the longest dictionary gram at each place, without grams that lie
inside an earlier one. One edit affects only grams near it, at most `affected` of them, so
two near words share all but that many of either's grams, and with grams in one order, the
rarest first, they share one of each word's `affected` + 1 rarest. The lists of words under
those grams are merged and every pair that meets is verified.

A shared gram left of the edit has the same distance from the start in both words, one right
of it the same distance from the end. Lists are therefore kept by gram and such a distance.
They are also kept by the length of the longer word of a pair: each word is decomposed once as
the longer or an equally long one, and once as the shorter one. Grams in the lists of length m
have at most m // 2 characters, so that the first or the last gram always survives an edit.
No pair is lost, whatever the dictionary holds.

Defined results: a null or empty text has no word; a null doc_id counts as the empty text in
the hash; repeated rows count again; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine.session import settle

LETTER = r"[A-Za-zÀ-ÿ]"
SHORTEST = 6
OCCURRENCES = 5
RATIO = 5
SPOIL = 199
GRAM_LEAST, GRAM_MOST = 2, 6
FREQUENT = 32
DICTIONARY = 200_000
PIECE = 1 << 20
HELD = 200_000
_RUN = re.compile(rf"[a-zÀ-ÿ]{{{SHORTEST},}}")
_END = re.compile(r"[^a-zÀ-ÿ]")


def _pieces(text: str) -> Iterator[str]:
    """Parts of a text of about PIECE characters, cut where no run is cut."""
    at = 0
    while len(text) - at > PIECE:
        end = _END.search(text, at + PIECE)
        stop = end.start() if end else len(text)
        yield text[at:stop]
        at = stop
    yield text[at:]


def words_of(doc_id: object, text: str | None) -> Counter:
    """Words of at least SHORTEST letters of a text, lower-cased and spoilt as the contract says."""
    found: Counter = Counter()
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    for piece in _pieces(lowered):
        for run, n in Counter(_RUN.findall(piece)).items():
            h = zlib.crc32(run.encode(), seed)
            if h % SPOIL == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < SHORTEST:
                    continue
            found[run] += n
    return found


def _flush(held: Counter, names: list[str]) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names)
    held.clear()
    return batch


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = OCCURRENCES) -> DataFrame:
    """word and n of every word with at least `least` occurrences; counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                held.update(words_of(doc_id.as_py(), value.as_py()))
                if len(held) > HELD:
                    yield _flush(held, ["word", "n"])
        yield _flush(held, ["word", "n"])

    counts = docs.select(key, text).mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def gram_counts(words: DataFrame) -> DataFrame:
    """gram and freq of all grams of GRAM_LEAST to GRAM_MOST characters over distinct words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                word = value.as_py()
                for q in range(GRAM_LEAST, GRAM_MOST + 1):
                    held.update(word[p : p + q] for p in range(len(word) - q + 1))
                if len(held) > HELD:
                    yield _flush(held, ["gram", "freq"])
        yield _flush(held, ["gram", "freq"])

    return words.select("word").mapInArrow(count, "gram string, freq long").groupBy("gram").agg(F.sum("freq").alias("freq"))


def gram_dictionary(grams: DataFrame, most: int = DICTIONARY, frequent: int = FREQUENT) -> dict[str, int]:
    """Grams and their counts: the shortest ones, and longer ones behind a frequent shorter one.

    At most `most` grams, so it may be broadcast: where more would pass, the bound on
    frequent grams is doubled until they fit. That costs time only, no pair.
    """
    size = F.length("gram")
    longer = grams.filter(size > GRAM_LEAST).withColumn("before", F.expr("left(gram, length(gram) - 1)"))
    shorter = grams.filter(size < GRAM_MOST).select(F.col("gram").alias("before"), F.col("freq").alias("above"))
    grown = settle(longer.join(shorter.filter(F.col("above") > frequent), "before"))
    steps = {r["step"]: r["count"] for r in grown.groupBy(
        F.floor(F.log2((F.col("above") - 1) / frequent)).alias("step")
    ).count().collect()}
    base = grams.filter(size == GRAM_LEAST)
    room, doublings = most - base.count(), 0
    while sum(n for step, n in steps.items() if step >= doublings) > room and doublings <= max(steps):
        doublings += 1
    grown = grown.filter(F.col("above") > frequent * 2**doublings)
    return {r["gram"]: r["freq"] for r in base.select("gram", "freq").union(grown.select("gram", "freq")).collect()}


def decompose(word: str, known: dict[str, int], most: int) -> list[tuple[int, int]]:
    """Start and length of the word's grams of at most `most` characters."""
    out, end = [], 0
    for p in range(len(word) - GRAM_LEAST + 1):
        q = GRAM_LEAST
        while q < most and word[p : p + q + 1] in known and p + q < len(word):
            q += 1
        if p + q > end:
            end = p + q
            out.append((p, q))
    return out


def safe_sides(p: int, q: int, i: int, j: int, most: int) -> tuple[bool, bool]:
    """Whether a gram survives an edit of the characters i to j, left of it and right of it.

    Left: it and all before it are decided by characters before the edit. Right: it starts
    behind the edit and reaches further than any gram that starts before.
    """
    return p + most <= i, p >= j and p + q - j >= most


def edits(length: int, shorter: bool) -> list[tuple[int, int]]:
    """Spans that one edit can replace: the shorter word of a pair only takes an insertion."""
    return [(i, i) for i in range(length + 1)] if shorter else [(i, i + 1) for i in range(length)]


def affected(grams: list[tuple[int, int]], length: int, most: int, shorter: bool) -> int:
    """The most grams that one edit of the word can change or hide."""
    return max(sum(not any(safe_sides(p, q, i, j, most)) for p, q in grams) for i, j in edits(length, shorter))


def index_keys(word: str, known: dict[str, int]) -> Iterator[tuple[str, bool]]:
    """List and role (shorter word of its pairs) under which the word is kept."""
    length = len(word)
    for longest in (length, length + 1):
        shorter, most = longest > length, min(GRAM_MOST, longest // 2)
        grams = decompose(word, known, most)
        bound = affected(grams, length, most, shorter)
        grams.sort(key=lambda g: (known.get(word[g[0] : g[0] + g[1]], 0), word[g[0] : g[0] + g[1]], g[0]))
        first, last = edits(length, shorter)[0], edits(length, shorter)[-1]
        for p, q in grams[: bound + 1]:
            gram = word[p : p + q]
            # the last edit leaves most on the left, the first one most on the right
            if safe_sides(p, q, *last, most)[0]:
                yield f"{longest}<{p}:{gram}", shorter
            if safe_sides(p, q, *first, most)[1]:
                yield f"{longest}>{length - p - q}:{gram}", shorter


def letters(word: str) -> int:
    """Set of the word's letters as bits of a long; one edit changes two of them at most."""
    bits = 0
    for c in word:
        bits |= 1 << ord(c) % 63
    return bits


def near_pairs(words: DataFrame, known: dict[str, int]) -> DataFrame:
    """word, n, near, near_n of all words at edit distance one, in both directions."""
    shared = words.sparkSession.sparkContext.broadcast(known)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                rows = [(k, s, i) for i, w in enumerate(part.column(0)) for k, s in index_keys(w.as_py(), shared.value)]
                keys, short, places = zip(*rows) if rows else ((), (), ())
                bits = pa.array([letters(w.as_py()) for w in part.column(0)], pa.int64())
                own = pa.RecordBatch.from_arrays([*part.columns, bits], ["word", "n", "bits"]).take(pa.array(places, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array(short, pa.bool_()), *own.columns],
                    ["list", "shorter", "word", "n", "bits"],
                )

    schema = "list string, shorter boolean, word string, n long, bits long"
    kept = settle(words.select("word", "n").mapInArrow(lists, schema).withColumn("list", F.xxhash64("list")))
    other = kept.toDF("list", "other_shorter", "near", "near_n", "other_bits")
    # the condition is part of the join: only verified pairs leave a list
    meets = (
        (kept["list"] == other["list"]) & (F.col("word") < F.col("near")) & ~(F.col("shorter") & F.col("other_shorter"))
        & (F.bit_count(F.col("bits").bitwiseXOR(F.col("other_bits"))) <= 2) & (F.levenshtein("word", "near", 1) == 1)
    )
    pairs = kept.hint("merge").join(other, meets).select("word", "n", "near", "near_n").distinct()
    pairs = settle(pairs)
    return pairs.unionByName(pairs.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")
    ))


def roots(forms: DataFrame) -> DataFrame:
    """word and root from word and form, by doubling; forms gain in count, so there is no circle."""
    ends = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settle(ends.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        if moved.filter("next IS NOT NULL").isEmpty():
            return moved.select("word", "root")
        ends = moved.select("word", "root")


def variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ratio: int = RATIO, least: int = OCCURRENCES
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the corpus."""
    words = settle(word_counts(docs, key, text, least))
    pairs = near_pairs(words, gram_dictionary(settle(gram_counts(words))))
    best: Column = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    stats = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.first("n").alias("own"))
    wins = -F.col("best.less") >= ratio * F.col("own")
    stats = settle(stats.select(
        "word", "n_near", F.when(wins, F.col("best.near")).alias("form"), F.when(wins, -F.col("best.less")).alias("form_n")
    ))
    ends = roots(stats.filter("form IS NOT NULL"))
    return words.join(stats, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
