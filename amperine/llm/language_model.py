"""Scores texts by an interpolated 3-gram model held in Elias-Fano tries.

With start marks before a text and the end token behind it, token w after a, b has

    p(w | a, b) = (c(a b w) + M3 p(w | b)) / (c(a b) + M3)
    p(w | b)    = (c(b w) + M2 p(w)) / (c(b) + M2),   p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)),

where c counts training texts. Each level sums to one. A trie stores for every 3-gram and
2-gram its own share c / (c(context) + M), and for every context the share M / (c + M) it
leaves to the lower level, as 16-bit codes of their logarithm (step 1 / STEPS).

1. Texts become words as 64-bit hashes and are written in blocks of about BLOCK entries, an
   entry being three tokens in a row. Texts are whole: a long one goes on in the next block.
2. Every block sends its distinct entries, with their training counts, to the shards of their
   first word, GROUP of them at a time with one word list. A word of the COMMON most frequent
   ones is sent as its number, any other as its hash, so the bytes of an entry hardly grow when
   the entries of a block go to more shards. A shard adds the counts up, builds
   its trie in a memory-mapped file and answers the entries of every block from it. Each count, of any order, comes from the trie
   node of a context, so nothing else is gathered. The number of shards grows with the input,
   and all parts of the model with it; nothing is pruned.
3. Each block meets its answers and adds up the scores of its texts.

A first word with more than 1 / HEAVY of all entries is dealt by its first two words, such a
pair by all three; their totals are counted apart. So no shard holds all of a hot context.

Two words of equal 64-bit hash would count as one: of 10**8 different words some two do so
with a chance of 3 in 10,000.

Defined results: a null or empty text has only the end token; a null doc_id counts as the
empty text when folds are dealt; repeated rows are trained on and scored one by one; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amperine.llm.elias_fano import Trie
from amperine.session import scratch_path, settle

M2, M3 = 10_000.0, 16.0
STEPS = 4096
BLOCK = 1_000_000
SHARD = 1 << 19
GROUP = 10
LOT = 1 << 17
HEAVY = 256
# Words with a number of their own in what blocks send: at most COMMON, of those seen SEEN times in a block.
COMMON = 1 << 17
SEEN = 5
CHARS = 1 << 20
START, END, NIL = 1, 2, 3
_LONG = 512
_MMAP_THRESHOLD = -3  # M_MMAP_THRESHOLD of malloc.h
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BLANKS = bytes([0x20, *range(0x09, 0x0E)])


def _lean() -> None:
    """Makes a Python worker give freed arrays back, whatever it ran before.

    glibc otherwise raises the size from which an array has pages of its own to 32 MB, and
    holes left by smaller arrays stay with the worker.
    """
    try:
        ctypes.CDLL(None).mallopt(_MMAP_THRESHOLD, 1 << 20)
    except (AttributeError, OSError):
        pass  # another C library
    pa.default_memory_pool().release_unused()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of UTF-8 text, A-Z as a-z."""
    low = data.lower()
    padded = low + bytes(16)
    codes = np.frombuffer(low, np.uint8)
    edge = np.diff(_WORD[codes].astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = ends - starts
    lanes = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    active, k = np.arange(len(size)), 0
    while len(active):
        rest = np.minimum(size[active] - 8 * k, 8).astype(np.uint64)
        lane = lanes[starts[active] + 8 * k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - 8 * rest))
        h[active] = mixed((h[active] ^ lane) * np.uint64(0xFF51AFD7ED558CCD))
        k += 1
        active = active[size[active] > 8 * k]
        if 8 * k >= _LONG:
            for i in active:
                h[i] = xxhash.xxh3_64_intdigest(low[starts[i] : ends[i]])
            break
    return np.where(h <= NIL, h + np.uint64(NIL + 1), h), starts


def _parts(data: bytes) -> Iterator[bytes]:
    """Parts of a text of about CHARS bytes, cut at blanks."""
    at = 0
    while len(data) - at > CHARS:
        stop = at + CHARS
        while stop < len(data) and data[stop] not in _BLANKS:
            stop += 1
        yield data[at:stop]
        at = stop
    yield data[at:]


def texts_as_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The word hashes of each text, runs of short texts at a time."""
    run: list[bytes] = []

    def hashed() -> Iterator[np.ndarray]:
        if run:
            h, starts = word_hashes(b"\n".join(run))
            ends = np.cumsum([len(t) + 1 for t in run])
            yield from np.split(h, np.searchsorted(starts, ends)[:-1])

    held = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if run and held + len(data) > CHARS:
            yield from hashed()
            run, held = [], 0
        if len(data) > CHARS:
            yield np.concatenate([word_hashes(part)[0] for part in _parts(data)])
        else:
            run.append(data)
            held += len(data)
    yield from hashed()


def packed(array: np.ndarray, kind: str, rising: bool = False) -> bytes:
    """Integers as compressed byte planes, of a sorted array the differences."""
    array = array.astype(kind)
    if rising and len(array):
        array = np.concatenate([array[:1], np.diff(array)])
    planes = array.view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, kind: str, rising: bool = False) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    planes = planes.reshape(width, len(planes) // width)
    array = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(array, dtype=kind) if rising else array


def code(share: np.ndarray) -> np.ndarray:
    """16-bit code of numbers from 0 to 1; 0 stands for 0."""
    logs = -np.log10(np.where(share > 0, share, 1))
    return np.where(share > 0, np.minimum(1 + np.rint(logs * STEPS), 65535), 0).astype(np.uint16)


def decode(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** ((1 - codes.astype(float)) / STEPS), 0.0)


# a run of tokens of one text in a block: length, entries that count, entries that are scored, training
SEGMENT = ("length", "counted", "scored", "train")


def segments(words: np.ndarray, train: bool) -> Iterator[tuple[np.ndarray, tuple[int, ...]]]:
    """A text's tokens with marks, in runs of at most BLOCK entries and two to look ahead."""
    tokens = np.concatenate([[START, START], words, [END, NIL, NIL]]).astype(np.uint64)
    entries, scored = len(tokens) - 2, len(words) + 1
    for lo in range(0, entries, BLOCK):
        hi = min(lo + BLOCK, entries)
        run = tokens[lo : hi + 4]
        yield run, (len(run), hi - lo, max(0, min(hi, scored) - lo), int(train))


def blocks(docs: DataFrame, key: str, text: str, train: Column) -> str:
    """Writes blocks of texts as tokens, with their frequent contexts, to a table and returns its name."""
    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(T.LongType())),
        T.StructField("keys", T.ArrayType(kind)), T.StructField("entries", T.LongType()),
        T.StructField("train_tokens", T.LongType()), T.StructField("segments", T.BinaryType()),
        T.StructField("words", T.BinaryType()), T.StructField("tokens", T.BinaryType()),
        T.StructField("contexts", T.ArrayType(T.ArrayType(T.LongType()))),
    ])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _lean()
        held: list = []
        size = 0

        def written() -> pa.RecordBatch:
            rows, keys, runs, notes = zip(*held)
            words, tokens = np.unique(np.concatenate(runs), return_inverse=True)
            notes = np.array(notes, np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([rows[0]], pa.int64()), pa.array([rows], pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.concat_arrays([k for k in keys])),
                pa.array([int(notes[:, 1].sum())], pa.int64()), pa.array([int((notes[:, 2] * notes[:, 3]).sum())], pa.int64()),
                pa.array([packed(notes.ravel(), "<i8")], pa.binary()), pa.array([packed(words, "<u8", True)], pa.binary()),
                pa.array([packed(tokens, "<u4")], pa.binary()),
                pa.array([_frequent(words, tokens, notes)], pa.list_(pa.list_(pa.int64()))),
            ], schema.names)

        for batch in batches:
            names = batch.column(2)
            for i, words in enumerate(texts_as_hashes(batch.column(3).to_pylist())):
                for run, note in segments(words, batch.column(1)[i].as_py()):
                    if held and (size + note[1] > BLOCK or held[-1][0] == batch.column(0)[i].as_py()):
                        yield written()
                        held, size = [], 0
                    held.append((batch.column(0)[i].as_py(), names.slice(i, 1), run, note))
                    size += note[1]
        if held:
            yield written()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), train.alias("train"), key, text)
    spark, name = docs.sparkSession, f"blocks_{uuid.uuid4().hex}"
    # bucketed, so that only the answers move when a block meets them
    rows.mapInArrow(pack, schema).withColumn("block", F.monotonically_increasing_id()).write.bucketBy(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "block"
    ).option("path", scratch_path(spark, "blocks")).saveAsTable(name)
    return name


def _entries(tokens: np.ndarray, notes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First places of all entries of a block, their segment, and their place in it."""
    lengths = notes[:, 0]
    segment = np.repeat(np.arange(len(notes), dtype=np.int32), lengths - 2)
    first = np.cumsum(lengths - 2) - (lengths - 2)
    place = np.arange(len(segment), dtype=np.int32) - first.astype(np.int32)[segment]
    return (np.cumsum(lengths) - lengths).astype(np.int32)[segment] + place, segment, place


def _frequent(words: np.ndarray, tokens: np.ndarray, notes: np.ndarray) -> list[list[int]]:
    """Contexts with more than half of 1 / HEAVY of a block's entries: first word, second word or -1, entries."""
    at, segment, place = _entries(tokens, notes)
    at = at[place < notes[segment, 1]]
    least, out = len(at) // (2 * HEAVY), []
    count = np.bincount(tokens[at], minlength=len(words))
    hot = np.flatnonzero(count > least)
    out += [[int(w), -1, int(n)] for w, n in zip(words[hot].astype(np.int64), count[hot])]
    pairs, n = np.unique(tokens[at] * len(words) + tokens[at + 1], return_counts=True)
    for pair, k in zip(pairs[n > least], n[n > least]):
        out.append([int(words[pair // len(words)].astype(np.int64)), int(words[pair % len(words)].astype(np.int64)), int(k)])
    return out


def _stream(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Notes on its segments, words and tokens of a written block."""
    notes = unpacked(row["segments"], "<i8").reshape(-1, len(SEGMENT))
    return notes, unpacked(row["words"], "<u8", True), unpacked(row["tokens"], "<u4").astype(np.int64)


class Block:
    """A block's distinct entries in order, with counts, shards and the place of each in the text.

    Common words come first in its word list; `numbers` are their places in `common`.
    """

    def __init__(self, row: dict, shards: int, heavy: set, common: np.ndarray):
        self.notes, words, tokens = _stream(row)
        at, segment, place = _entries(tokens, self.notes)
        number = np.searchsorted(common, words)
        known = np.append(common, np.uint64(0))[number] == words
        order = np.concatenate([np.flatnonzero(known), np.flatnonzero(~known)])
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        self.words, self.numbers, tokens = words[order], number[known], rank[tokens]
        key = tokens[at] << 21
        key |= tokens[at + 1]
        key <<= 21
        key |= tokens[at + 2]
        del tokens, at, words, number, known, rank
        distinct, inverse = np.unique(key, return_inverse=True)
        self.inverse = inverse.astype(np.int32)
        del key, inverse
        counted = (place < self.notes[segment, 1]) & (self.notes[segment, 3] > 0)
        self.counts = np.bincount(self.inverse[counted], minlength=len(distinct))
        self.segment, self.place = segment, place
        mask = (1 << 21) - 1
        self.a, self.b, self.c = (part.astype(np.int32) for part in (distinct >> 42, distinct >> 21 & mask, distinct & mask))
        del distinct
        self.shard = self._shard(shards, heavy)

    def groups(self) -> Iterator[tuple[int, np.ndarray]]:
        """The groups of shards it has entries for, with their places, shard by shard."""
        order = np.argsort(self.shard, kind="stable").astype(np.int32)
        group = self.shard[order] // GROUP
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, stop in zip(starts, [*starts[1:], len(order)]):
            yield int(group[start]), order[start:stop]

    def _shard(self, shards: int, heavy: set) -> np.ndarray:
        h = mixed(self.words[self.a] * np.uint64(0x9E3779B97F4A7C15))
        words = self.words.astype(np.int64)
        single = [int(i) for i in np.flatnonzero(np.isin(words, [x for x, y in heavy if y == -1]))]
        if single:
            deep = np.isin(self.a, single)
            h[deep] = mixed(h[deep] ^ self.words[self.b[deep]])
            where = {int(w): i for i, w in enumerate(words)}
            pairs = [where[x] * len(words) + where[y] for x, y in heavy if y != -1 and x in where and y in where]
            deeper = np.isin(self.a.astype(np.int64) * len(words) + self.b, pairs)
            h[deeper] = mixed(h[deeper] ^ self.words[self.c[deeper]])
        return (h % np.uint64(shards)).astype(np.int32)


def heavy_contexts(table: DataFrame, total: int) -> dict[tuple[int, int], int]:
    """Training counts of contexts with more than 1 / HEAVY of all entries: 2 * HEAVY at most."""
    each = table.select(F.explode("contexts").alias("c")).select(
        F.col("c")[0].alias("a"), F.col("c")[1].alias("b"), F.col("c")[2].alias("n")
    ).groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") * 2 * HEAVY > total)
    found = sorted((r.a, r.b) for r in each.collect())
    # a pair is dealt apart only if its first word is
    found = [c for c in found if c[1] == -1 or (c[0], -1) in set(found)]
    if not found:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                notes, words, tokens = _stream(row)
                at, segment, place = _entries(tokens, notes)
                at = at[(place < notes[segment, 1]) & (notes[segment, 3] > 0)]
                where = {int(w): i for i, w in enumerate(words.astype(np.int64))}
                singles = np.bincount(tokens[at], minlength=len(words))
                pairs = {}
                for x in {x for x, y in found if y != -1 and x in where}:
                    pairs[x] = np.bincount(tokens[at[tokens[at] == where[x]] + 1], minlength=len(words))
                sums = [0 if x not in where else int(singles[where[x]]) if y == -1 else int(pairs[x][where[y]]) if y in where else 0
                        for x, y in found]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int32()), pa.array(sums, pa.int64())], ["i", "n"])

    sums = table.select("segments", "words", "tokens").mapInArrow(count, "i int, n long").groupBy("i").agg(F.sum("n").alias("n"))
    return {found[r.i]: r.n for r in sums.collect()}


def _joined(pieces: list[bytes]) -> bytes:
    return np.array([len(pieces), *map(len, pieces)], "<i8").tobytes() + b"".join(pieces)


def _parted(data: bytes) -> list[memoryview]:
    data = memoryview(data)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.frombuffer(data, "<i8", n + 1)[1:])
    return [data[start:end] for start, end in zip([8 * (n + 1), *ends[:-1]], ends)]


def common_words(table: DataFrame) -> np.ndarray:
    """Hashes of the most frequent words, COMMON at most, in rising order.

    They only shorten what is sent: any list gives the same scores.
    """

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _lean()
        for batch in batches:
            for row in batch.to_pylist():
                words = unpacked(row["words"], "<u8", True)
                n = np.bincount(unpacked(row["tokens"], "<u4"), minlength=len(words))
                yield pa.RecordBatch.from_arrays([
                    pa.array(words[n >= SEEN].astype(np.int64)), pa.array(n[n >= SEEN].astype(np.int64))
                ], ["word", "n"])

    sums = settle(table.select("words", "tokens").mapInArrow(often, "word long, n long").groupBy("word").agg(
        F.floor(8 * F.log2(F.sum("n"))).alias("band")
    ))
    least, held = None, 0
    for band, n in sorted((tuple(r) for r in sums.groupBy("band").count().collect()), reverse=True):
        held += n
        if held > COMMON:
            break
        least = band
    if least is None:
        return np.zeros(0, np.uint64)
    words = sums.filter(F.col("band") >= least).select("word").toArrow().column(0).to_numpy()
    return np.sort(words.astype(np.uint64))


def _payload(block: Block, group: int, places: np.ndarray, table: np.ndarray) -> bytes:
    """Distinct entries of a block that belong to a group of shards, with their own word list.

    table: room for a number per word of the block.
    """
    columns = [x[places] for x in (block.a, block.b, block.c)]
    used = np.unique(np.concatenate(columns))
    table[used] = np.arange(len(used), dtype=np.int32)
    split = int(np.searchsorted(used, len(block.numbers)))
    sizes = np.bincount(block.shard[places] - group * GROUP, minlength=GROUP)
    return _joined([
        packed(block.numbers[used[:split]], "<u4", True), packed(block.words[used[split:]], "<u8", True), packed(sizes, "<i8"),
        packed(table[columns[0]], "<u4", True), *(packed(table[x], "<u4") for x in columns[1:]),
        packed(block.counts[places], "<u4"),
    ])


class Shard:
    """The trie of all entries of a shard, from first, second and third word ids and counts by block.

    vocabulary: the words by id, in rising order.
    """

    def __init__(
        self, entries: list[list[np.ndarray]], vocabulary: np.ndarray, heavy: dict[tuple[int, int], int], m2: float, m3: float
    ):
        size = len(vocabulary)
        pair, last, count = [], [], []
        for a, b, c, n in entries:
            seen = n > 0
            pair.append(a[seen].astype(np.int64) * size + b[seen])
            last.append(c[seen])
            count.append(n[seen].astype(np.int64))
        pairs, of_pair = np.unique(np.concatenate(pair), return_inverse=True)
        keys, of_key = np.unique(of_pair * size + np.concatenate(last), return_inverse=True)
        del pair, last
        c3 = np.bincount(of_key, np.concatenate(count), len(keys))
        three_of, three = keys // size, keys % size
        c2 = np.bincount(three_of, c3, len(pairs))
        firsts, two_of = np.unique(pairs // size, return_inverse=True)
        c1 = np.bincount(two_of, c2, len(firsts))
        known = vocabulary.astype(np.int64)
        for (x, y), n in heavy.items():
            if y == -1:
                c1[known[firsts] == x] = n
            else:
                c2[(known[pairs // size] == x) & (known[pairs % size] == y)] = n
        self.known = int(((known[firsts] != START) & (known[firsts] != NIL) & ~np.isin(
            known[firsts], [x for x, y in heavy if y == -1])).sum())
        self.trie = Trie(firsts, pairs % size, three, two_of, three_of, {
            "own3": code(c3 / (c2[three_of] + m3)), "rest3": code(m3 / (c2 + m3)),
            "own2": code(c2 / (c1[two_of] + m2)), "count": c1.astype(np.int64),
        })
        self.size = size

    def answer(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
        """Codes and counts of entries in their order; what is not in the trie counts zero."""
        firsts, of_first = np.unique(a, return_inverse=True)
        place1, found1 = self.trie.word(firsts)
        pairs, of_pair = np.unique(of_first * self.size + b, return_inverse=True)
        parent, child = pairs // self.size, pairs % self.size
        place2, found2 = np.zeros(len(pairs), np.int64), found1[parent]
        live = np.flatnonzero(found2)
        place2[live], found2[live] = self.trie.child("two", place1[parent[live]], child[live])
        place3, found3 = np.zeros(len(a), np.int64), found2[of_pair]
        live = np.flatnonzero(found3)
        place3[live], found3[live] = self.trie.child("three", place2[of_pair[live]], c[live])

        def values(name: str, place: np.ndarray, found: np.ndarray, other: int) -> np.ndarray:
            stored = self.trie[name]
            return np.where(found, stored[np.where(found, place, 0)], other) if len(stored) else np.full(len(place), other)

        # an unseen context leaves all to the lower level: code 1 stands for 1
        return [
            values("own3", place3, found3, 0), values("rest3", place2, found2, 1)[of_pair],
            values("own2", place2, found2, 0)[of_pair], values("count", place1, found1, 0)[of_first],
        ]


def _union(lists: Iterator[np.ndarray]) -> np.ndarray:
    """Distinct values of sorted arrays, a few arrays at a time."""
    whole = np.zeros(0, np.uint64)
    held: list[np.ndarray] = []
    for values in lists:
        held.append(values)
        if len(held) == 8:
            whole, held = _distinct([whole, *held]), []
    return _distinct([whole, *held])


def _distinct(arrays: list[np.ndarray]) -> np.ndarray:
    values = np.concatenate(arrays)
    values.sort(kind="stable")  # runs that are sorted already are merged
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _reply(own3: np.ndarray, rest3: np.ndarray, own2: np.ndarray, count: np.ndarray) -> bytes:
    """Answers of a payload: the distinct triples of codes, which of them each entry has, and the counts."""
    codes = own3.astype(np.int64) << 32 | rest3.astype(np.int64) << 16 | own2
    triples, which = np.unique(codes, return_inverse=True)
    return _joined([packed(triples, "<u8", True), packed(which, "<u4"), packed(count, "<u8")])


def _replied(data: bytes) -> list[np.ndarray]:
    """Own share of a 3-gram, rest of its context, own share of its first two words, count of the first."""
    triples, which, count = (unpacked(p, *k) for p, k in zip(_parted(data), (("<u8", True), ("<u4",), ("<u8",))))
    whole = triples[which]
    return [(whole >> np.uint64(k)).astype(np.uint16) for k in (32, 16, 0)] + [count]


def answers(table: DataFrame, shards: int, heavy: dict, common: np.ndarray, m2: float, m3: float) -> DataFrame:
    """Written block, group, answer and known (distinct words, on rows without a block)."""
    apart = set(heavy)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _lean()
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, shards, apart, common)
                numbers = np.empty(len(block.words), np.int32)
                for group, places in block.groups():
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["block"]], pa.int64()), pa.array([group], pa.int64()),
                        pa.array([_payload(block, group, places, numbers)], pa.binary()),
                    ], ["block", "group", "payload"])

    def reply(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        _lean()
        payloads = [_parted(x.as_buffer()) for x in rows.column("payload")]

        def words(payload: list[memoryview]) -> np.ndarray:
            return np.concatenate([common[unpacked(payload[0], "<u4", True)], unpacked(payload[1], "<u8", True)])

        vocabulary = _union(words(p) for p in payloads)
        # 32 bits, and the word lists unpacked twice: a group's memory is what bounds its size
        held, bounds, results = [], [], []
        for p in payloads:
            ids = np.searchsorted(vocabulary, words(p)).astype(np.int32)
            held.append([*(ids[unpacked(x, "<u4", i == 0)] for i, x in enumerate(p[3:6])), unpacked(p[6], "<u4")])
            bounds.append(np.concatenate([[0], np.cumsum(unpacked(p[2], "<i8"))]))
            results.append([np.empty(bounds[-1][-1], kind) for kind in ("<u2", "<u2", "<u2", "<u8")])
        known = 0
        for k in range(GROUP):
            own = [slice(b[k], b[k + 1]) for b in bounds]
            shard = Shard([[x[at] for x in columns] for columns, at in zip(held, own)], vocabulary, heavy, m2, m3)
            known += shard.known
            # entries of many blocks are looked up together, LOT or a block's at a time
            ends = np.cumsum([at.stop - at.start for at in own])
            for lot in np.split(np.arange(len(own)), np.flatnonzero(np.diff(ends // LOT)) + 1):
                found = shard.answer(*(np.concatenate([held[i][x][own[i]] for i in lot]) for x in range(3)))
                cuts = ends[lot[:-1]] - (ends[lot[0]] - (own[lot[0]].stop - own[lot[0]].start))
                for x, values in enumerate(found):
                    for i, part in zip(lot, np.split(values, cuts)):
                        results[i][x][own[i]] = part
            del shard, found
        del held
        replies = []
        while results:
            replies.append(_reply(*results.pop(0)))
        return pa.table({
            "block": pa.array([*rows.column("block").to_pylist(), None], pa.int64()),
            "group": pa.array([key[0].as_py()] * (len(rows) + 1), pa.int64()),
            "answer": pa.array([*replies, None], pa.binary()),
            "known": pa.array([*[None] * len(rows), known], pa.int64()),
        })

    sent = table.select("block", "segments", "words", "tokens").mapInArrow(deal, "block long, group long, payload binary")
    return settle(sent.groupBy("group").applyInArrow(reply, "block long, group long, answer binary, known long"))


def _scores(block: Block, replies: dict[int, bytes], total: int, known: int, m2: float) -> list[np.ndarray]:
    """Tokens, known tokens, base and model log10 probability of each segment of a block."""
    size = len(block.a)
    own3, rest3, own2, count = (np.zeros(size, kind) for kind in ("<u2", "<u2", "<u2", "<u8"))
    for group, places in block.groups():
        if group not in replies:
            raise ValueError(f"no answer of group {group} for a block")
        for whole, part in zip((own3, rest3, own2, count), _replied(replies.pop(group))):
            whole[places] = part
    scored = np.flatnonzero(block.place < block.notes[block.segment, 2])
    now, after, last = block.inverse[scored], block.inverse[scored + 1], block.inverse[scored + 2]
    c = count[last].astype(float)
    p1 = (c + 0.5) / (total + 0.5 * (known + 1))
    p2 = decode(own2[after]) + m2 / (count[after].astype(float) + m2) * p1
    p3 = decode(own3[now]) + decode(rest3[now]) * p2
    segment, n = block.segment[scored], len(block.notes)
    return [
        np.bincount(segment, minlength=n), np.bincount(segment, c > 0, n).astype(np.int64),
        np.bincount(segment, np.log10(p1), n), np.bincount(segment, np.log10(np.minimum(p3, 1.0)), n),
    ]


def score(
    docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", m2: float = M2, m3: float = M3
) -> DataFrame:
    """Key, n_tokens, n_known, train_tokens, base_score and score of every text.

    The model is learned from the rows for which `train` is true.
    """
    kind = docs.schema[key].dataType
    spark, name = docs.sparkSession, blocks(docs, key, text, train)
    table = spark.table(name)
    sums = table.agg(F.sum("entries"), F.sum("train_tokens")).first()
    entries, total = sums[0] or 0, sums[1] or 0
    shards = max(1, -(-entries // SHARD))
    heavy = heavy_contexts(table, entries)
    apart = set(heavy)
    common = common_words(table)
    replies = answers(table, shards, heavy, common, m2, m3)
    known = (replies.agg(F.sum("known")).first()[0] or 0) + sum(y == -1 and x not in (START, NIL) and n > 0 for (x, y), n in heavy.items())
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField(key, kind), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def add(blocks_: pa.Table, replies_: pa.Table) -> pa.Table:
        _lean()
        row = blocks_.slice(0, 1).to_pylist()[0]
        keys = blocks_.column("keys").chunk(0)[0].values
        block, parts = Block(row, shards, apart, common), {}
        for reply in replies_.to_pylist():
            parts[reply["group"]] = reply["answer"]
        found = _scores(block, parts, total, known, m2)
        return pa.table([pa.array(row["rows"], pa.int64()), keys, *[pa.array(x) for x in found]], names=schema.names)

    sides = (
        table.select("block", "rows", "keys", "segments", "words", "tokens").groupBy("block"),
        replies.filter("block IS NOT NULL").select("block", "group", "answer").groupBy("block"),
    )
    parts = sides[0].cogroup(sides[1]).applyInArrow(add, schema)
    scores = settle(parts.groupBy("row").agg(
        F.first(key).alias(key), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), F.sum("base_score").alias("base_score"), F.sum("score").alias("score"),
    ).drop("row"))
    spark.sql(f"DROP TABLE {name}")
    return scores
