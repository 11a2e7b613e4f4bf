"""Near-duplicates by MinHash with sequential Bayesian verification.

A document is the set of its word shingles. Documents with equal sets form a class and one of
them stands for all. Classes that agree in one of BANDS bands of ROWS MinHash values meet in
a bucket. Candidates are compared batch after batch of their signatures; a pair is given up
as soon as the posterior probability that its similarity reaches the threshold is below
MISS (uniform prior). What is left is confirmed on the full sets, made from the texts.

Not all pairs of a bucket are needed to know the groups. A bucket's members are first
compared with one of them, again with another, and only members that are in different
groups after that are compared with each other, in blocks of BLOCK members spread over the
tasks. These comparisons end in the block: only links that join groups leave it. So large
groups of copies cost a few comparisons per member, and no candidate pair that could join
two groups is left out.

Defined results: a null or empty text, or one of blanks, has no shingle and no link; so has a
null key, which is its own group with a null component; repeated rows are in one group, all
with the smallest key being `kept`; an empty table gives no rows; other columns are carried
in a struct and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amperine.llm.common import spread_lookup, stored
from amperine.llm.components import components
from amperine.llm.tokens import mixed
from amperine.session import settle

SHINGLE = 5
PERCENT = 80
BANDS = 32
ROWS = 5
HASHES = BANDS * ROWS
BATCH = 32
MISS = 1e-6
STAR_TURNS = 2
BLOCK = 512
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

_draw = np.random.default_rng(11)
_FACTORS = _draw.integers(1, 2**64, HASHES, np.uint64) | np.uint64(1)
_OFFSETS = _draw.integers(0, 2**64, HASHES, np.uint64)
_MIX = _draw.integers(1, 2**64, 64, np.uint64) | np.uint64(1)


def words(text: str | None) -> list[bytes]:
    """Words of the text, A-Z in lower case; blanks are the six ASCII ones."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingles(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """The exact set: distinct runs of `size` words; all words if they are fewer."""
    own = words(text)
    if len(own) < size:
        return {tuple(own)} if own else set()
    return set(zip(*(own[i:] for i in range(size))))


def hashed_shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the set."""
    own = words(text)
    if not own:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    size = min(size, len(own))
    runs = np.zeros(len(own) - size + 1, np.uint64)
    for i in range(size):
        runs = mixed(runs * _MIX[0] + h[i : len(own) - size + 1 + i])
    return np.unique(runs)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set that is not empty."""
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 4096):
        values = hashes[at : at + 4096, None] * _FACTORS + _OFFSETS
        np.minimum(least, values.min(0), out=least)
    return least >> np.uint64(32)


def bands(least: np.ndarray) -> np.ndarray:
    """One hash per band, different for each band."""
    rows = (least.reshape(BANDS, ROWS) * _MIX[1 : ROWS + 1]).sum(1, dtype=np.uint64)
    return mixed(rows + np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[0]).view(np.int64)


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared, matches below which a pair is given up).

    With a uniform prior the similarity after m matches in n is Beta(m + 1, n - m + 1), and
    its chance to reach s is that of at most m successes in n + 1 draws of chance s.
    """
    s, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
        out.append((n, m))
    return out


_LEAST = least_matches()


def still_likely(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the pairs of signatures (rows of a and b) that pass every batch."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, least in _LEAST:
        matches = matches + (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(1)
        alive, matches = alive[matches >= least], matches[matches >= least]
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), HASHES)


def signed(docs: DataFrame, text: str, size: int) -> DataFrame:
    """Written table of row, n_shingles, digest, signature, bands and all of docs' columns.

    The text is the field `text` of the struct `_doc`. `row` differs from row to row.
    """
    fields = [("row", T.LongType()), ("n_shingles", T.LongType()), ("digest", T.BinaryType()),
              ("signature", T.BinaryType()), ("bands", T.ArrayType(T.LongType()))]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(*f) for f in fields]])
    place = docs.columns.index("_doc")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                out = []
                for value in part.column(place).field(text):
                    hashes = hashed_shingles(value.as_py(), size)
                    row += 1
                    if len(hashes):
                        least = signature(hashes)
                        out.append((row, len(hashes), xxhash.xxh3_128_digest(hashes.tobytes()),
                                    least.astype("<u2").tobytes(), bands(least)))
                    else:
                        out.append((row, 0, None, None, None))
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
                    [f.name for f in schema.fields],
                )

    return stored(docs.mapInArrow(sign, schema))


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs a, b that pass the size bound and the batches of the Bayesian test."""
    one = classes.select("row", "signature", "n_shingles")
    both = pairs.hint("merge").join(one.toDF("b", "sig_b", "n_b"), "b").hint("merge").join(
        one.toDF("a", "sig_a", "n_a"), "a"
    )
    sized = both.filter(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                keep = still_likely(_matrix(batch.column(2)), _matrix(batch.column(3)))
                yield batch.take(pa.array(keep)).select(["a", "b"])

    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(compare, "a long, b long")


def _linked(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Pairs whose full sets are similar enough; `texts` has row and text."""
    both = pairs.hint("merge").join(texts.toDF("b", "text_b"), "b").hint("merge").join(
        texts.toDF("a", "text_a"), "a"
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            keep = []
            for i in range(len(batch)):
                a = batch.column(0)[i].as_py()
                if a != last:
                    last, held = a, shingles(batch.column(2)[i].as_py(), size)
                other = shingles(batch.column(3)[i].as_py(), size)
                common = len(held & other)
                keep.append(100 * common >= PERCENT * (len(held) + len(other) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return settle(both.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a long, b long"))


def _members(classes: DataFrame) -> DataFrame:
    """Buckets with two or more classes: band, bucket, row, n (classes of the bucket)."""
    every = classes.select("row", F.posexplode("bands").alias("band", "bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    return settle(every.join(shared, "bucket"))


def _star(members: DataFrame, order: int) -> DataFrame:
    """Each member with one member of its bucket; another one for another `order`."""
    place = F.xxhash64(F.lit(order), "row")
    centres = members.groupBy("bucket").agg(
        F.min(F.struct(place.alias("o"), F.col("row").alias("a"), F.col("label").alias("own"))).alias("c")
    )
    return members.join(centres, "bucket").filter("label <> c.own").select(
        F.least("row", "c.a").alias("a"), F.greatest("row", "c.a").alias("b")
    ).distinct()


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their group, of buckets of three or more in more than one group.

    The one pair of a bucket of two has been compared in the first turn.
    """
    named = labels.select(F.col("node").alias("row"), "label")
    rows = settle(members.filter("n > 2").join(named, "row", "left").withColumn("label", F.coalesce("label", "row")))
    several = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return settle(rows.join(several.select("bucket"), "bucket", "left_semi"))


def _between(members: DataFrame, classes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Links between the groups of a bucket, from comparing its members in blocks.

    Members come with signature and full hashed set. A block emits a link only if it joins
    two groups that nothing in the block has joined before: fewer links than members. A
    pair is compared in the first band it shares.
    """
    def hash_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [hashed_shingles(t.as_py(), size).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["row", "set"])

    rows = members.select("row").distinct()
    sets = texts.join(rows, "row", "left_semi").select("row", "text").mapInArrow(hash_sets, "row long, set binary")
    details = settle(
        sets.join(classes.select("row", "signature", "bands"), "row").withColumnRenamed("row", "_row")
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("row"), blocks.cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    dealt = members.withColumn("own", own).select("*", other).select(
        "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "band", "row", "label",
    )
    place = ["bucket", "i", "j"]
    full = dealt.hint("merge").join(details, F.col("row") == F.col("_row")).repartition(*place).sortWithinPartitions(*place)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _runs(batches):
            found = _joining(block)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return full.select(*place, "band", "row", "label", "signature", "bands", "set").mapInArrow(
        compare, "a long, b long"
    ).distinct()


def _joining(block: pa.Table) -> list[tuple[int, int]]:
    """Links of a block that join groups, at most one less than it has groups."""
    row, band = block.column("row").to_numpy(), block.column("band")[0].as_py()
    _, group = np.unique(block.column("label").to_numpy(), return_inverse=True)
    if not group.any():
        return []
    sig = _matrix(block.column("signature"))
    lower = np.array(block.column("bands").to_pylist(), np.int64)[:, :band]
    sets = [np.frombuffer(s, np.uint64) for s in block.column("set").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    found = []
    for k in range(len(row) - 1):
        rest = k + 1 + np.flatnonzero(group[k + 1 :] != group[k])
        rest = rest[100 * np.minimum(sizes[rest], sizes[k]) >= PERCENT * np.maximum(sizes[rest], sizes[k])]
        rest = rest[~(lower[rest] == lower[k]).any(1)]
        rest = rest[still_likely(np.broadcast_to(sig[k], (len(rest), HASHES)), sig[rest])]
        for other in rest:
            if group[other] != group[k]:
                common = _common(sets[k], sets[other])
                if 100 * common >= PERCENT * (sizes[k] + sizes[other] - common):
                    found.append((min(row[k], row[other]), max(row[k], row[other])))
                    group[group == group[other]] = group[k]
    return found


def _common(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int((a[at] == b).sum())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows with equal first three columns, from batches that are sorted by them."""
    left: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if left is None else pa.concat_tables([left, rows])
        keys = np.stack([rows.column(i).to_numpy() for i in range(3)], 1)
        cut = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist()]
        for start, end in zip(cut, cut[1:]):
            if end - start > 1:
                yield rows.slice(start, end - start)
        left = rows.slice(cut[-1]) if len(rows) else left
    if left is not None and len(left) > 1:
        yield left


def links(classes: DataFrame, table: DataFrame, size: int) -> DataFrame:
    """node and label of every class that is linked; `table` has row and text."""
    members = _members(classes)
    pairs = settle(_likely(_star(members.withColumn("label", F.col("row")), 0), classes))
    # every text that any later step compares, in one pass over the texts
    needed = pairs.select(F.explode(F.array("a", "b")).alias("row")).union(members.filter("n > 2").select("row"))
    texts = stored(table.join(needed.distinct().hint("shuffle_hash"), "row", "left_semi"))
    found, tested = _linked(pairs, texts, size), pairs
    labels = components(found)
    for turn in range(1, STAR_TURNS):
        pairs = _star(_open(members, labels), turn).join(tested, ["a", "b"], "left_anti")
        pairs = settle(_likely(pairs, classes))
        if pairs.isEmpty():
            break
        found, tested = found.unionByName(_linked(pairs, texts, size)), tested.unionByName(pairs)
        labels = components(found)
    between = settle(_between(_open(members, labels), classes, texts, size))
    return components(found.unionByName(_linked(between, texts, size)))


def grouped(docs: DataFrame, key: str, text: str, size: int) -> tuple[DataFrame, DataFrame]:
    """The signed table, and digest, component, keep_row and copies of all its sets."""
    table = signed(docs, text, size)
    # one row per distinct set: copies are put together before anything is compared
    sets = table.filter(F.col("digest").isNotNull() & F.col(key).isNotNull()).groupBy("digest").agg(
        F.min(F.struct(F.col(key).alias("id"), "row", "signature", "bands", "n_shingles")).alias("s"),
        F.count("*").alias("copies"),
    )
    classes = settle(sets.select("digest", "copies", "s.*"))
    labels = links(classes, table.select("row", F.col("_doc")[text].alias("text")), size)
    named = classes.select("digest", "copies", "row", "id").join(
        labels.select(F.col("node").alias("row"), "label"), "row", "left"
    ).withColumn("label", F.coalesce("label", "row"))
    named = settle(named)
    firsts = named.groupBy("label").agg(F.min(F.struct("id", "row")).alias("first"))
    return table, settle(named.join(firsts, "label").select(
        "digest", "copies", F.col("first.id").alias("component"), F.col("first.row").alias("keep_row")
    ))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row per document: key, n_shingles, component_id and kept."""
    table, groups = grouped(docs.select(F.col(key).alias("_key"), F.struct(text).alias("_doc")), "_key", text, size)
    rows = _with_group(table.select("row", "_key", "n_shingles", "digest"), "_key", groups)
    return rows.select(
        F.col("_key").alias(key), "n_shingles", F.coalesce("component", "_key").alias("component_id"),
        (F.col("component").isNull() | (F.col("component") == F.col("_key"))).alias("kept"),
    )


def _with_group(rows: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """Adds component and keep_row, null for a row without key or shingle."""
    fits = F.col("digest").isNotNull() & F.col(key).isNotNull()
    member = spread_lookup(rows.filter(fits), groups, "digest", "copies")
    return member.unionByName(rows.filter(~fits), allowMissingColumns=True)


def keep_one_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """The documents without the near copies of another, with their columns as they came."""
    held = docs.select(F.col(key).alias("_key"), F.struct("*").alias("_doc"))
    table, groups = grouped(held, "_key", text, size)
    gone = _with_group(table.select("row", "_key", "digest"), "_key", groups).filter("keep_row <> row")
    return table.join(gone.select("row"), "row", "left_anti").select("_doc.*")
