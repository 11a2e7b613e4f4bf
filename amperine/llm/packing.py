"""Best-fit packing of token pieces into sequences by bin completion.

Documents are tokenised once; only the lengths of their pieces travel. Pieces are dealt to
shards of about `shard_rows` rows, whose number grows with the input, and every shard is
packed by bin completion (see `completion`) from a best-fit incumbent. The search ends at the
lower bound or after a number of steps that grows with the gap to it, so a shard may keep a gap.

Defined results: a null or empty text is one piece holding the end token; a null key stays
null; repeated rows are packed as often as they occur; an empty table packs to no rows;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperine.llm.completion import bin_completion
from amperine.session import settle

CAPACITY = 4096
END_ID = 1
SHARD_ROWS = 16_384
# Words whose ids a Python worker remembers; about 200 bytes each.
CACHE_WORDS = 1_000_000

_SIGNS = ".,;:!?*#$%&|<>()[]{}"
_WORDS = re.compile(r"[^ \t-\r]+")
_tokenizers: dict[str, tuple] = {}


def _encoder(path: str):
    """Tokenizer, which ids end a word, and word cache of this worker; all outlive a task."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        ends = np.zeros(tokenizer.get_vocab_size(), bool)
        ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        _tokenizers[path] = (tokenizer, ends, {})
    return _tokenizers[path]


def word_ids(texts: list[str], path: str) -> list[bytes]:
    """Little-endian ids of every text.

    The tokenizer lower-cases, drops white space and splits letters from punctuation, so
    the ids of a text are those of its blank-separated words in turn and every distinct
    word is encoded once per worker. Texts with a character whose treatment depends on its
    neighbours across a blank are encoded whole.
    """
    tokenizer, ends, cache = _encoder(path)
    if len(cache) > CACHE_WORDS:
        cache.clear()
    out, split, whole = [b""] * len(texts), {}, []
    for i, text in enumerate(texts):
        if text.isascii() or not _CONTEXT.search(text):
            split[i] = _parts(text)
        else:
            whole.append(i)
    new = {w for words in split.values() for w in words if w not in cache}
    # a word of letters is one unit of the tokenizer, whose last id closes it
    letters = [w for w in new if w.isalpha()]
    joined = tokenizer.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids
    joined = np.asarray(joined, "<u4")
    closed = np.flatnonzero(ends[joined]) + 1
    others = list(new) if len(closed) != len(letters) else [w for w in new if not w.isalpha()]
    if len(closed) == len(letters):
        data, begin = joined.tobytes(), 0
        for word, end in zip(letters, (4 * closed).tolist()):
            cache[word] = data[begin:end]
            begin = end
    for word, got in zip(others, tokenizer.encode_batch_fast(others, add_special_tokens=False)):
        cache[word] = np.asarray(got.ids, "<u4").tobytes()
    for i, words in split.items():
        out[i] = b"".join(map(cache.__getitem__, words))
    got = tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)
    for i, encoding in zip(whole, got):
        out[i] = np.asarray(encoding.ids, "<u4").tobytes()
    return out


# Combining marks, other white space and letters that change case in more than one way.
_CONTEXT = re.compile("[İΣ̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯"
                      "\x1c-\x1f\x85\xa0  -     　]")


def _parts(text: str) -> list[str]:
    """Words in lower case, signs after a run of letters on their own."""
    parts = []
    for word in _WORDS.findall(text.lower()):
        if not word.isalpha():
            stem = word.rstrip(_SIGNS)
            if stem != word and stem.isalpha():
                parts.append(stem)
                word = word[len(stem):]
        parts.append(word)
    return parts


def token_pieces(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most `capacity` ids per document; only longer documents are cut.

    Columns: key, piece, start, length, ids_crc32, `ids` if asked for, and `_draw`, a number
    that differs from row to row and is meant to be written before it is used.
    """
    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, _draw long"
    schema += ", ids array<int>" if with_ids else ""
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                cols = defaultdict(list)
                for i, ids in enumerate(word_ids(texts, tokenizer)):
                    ids += end
                    for piece, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[begin : begin + 4 * capacity]
                        row += 1
                        for name, value in (
                            ("source", i), ("piece", piece), ("start", begin // 4),
                            ("length", len(own) // 4), ("crc", crc32(own)), ("row", row),
                        ):
                            cols[name].append(value)
                        if with_ids:
                            cols["ids"].append(np.frombuffer(own, "<u4").astype("i4"))
                arrays = [
                    part.column(0).take(pa.array(cols["source"], pa.int64())),
                    pa.array(cols["piece"], pa.int32()),
                    *(pa.array(cols[n], pa.int64()) for n in ("start", "length", "crc", "row")),
                ]
                if with_ids:
                    arrays.append(pa.array(cols["ids"], pa.list_(pa.int32())))
                names = [key, "piece", "start", "length", "ids_crc32", "_draw"]
                yield pa.RecordBatch.from_arrays(arrays, [*names, *["ids"] * with_ids])

    return docs.select(key, text).mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Adds sequence_id and offset to pieces; `pieces` must be a written table with `_draw`."""
    shards = max(1, math.ceil(pieces.count() / shard_rows))
    placed = [c for c in pieces.columns if c != "_draw"]
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes if n != "_draw")

    def place(group: pa.Table) -> pa.Table:
        shard = group.column("_shard")[0].as_py()
        bins, offsets = pack_lengths(group.column("length").to_numpy(), capacity)
        return group.select(placed).append_column(
            "sequence_id", pa.array(bins + (shard << 32))
        ).append_column("offset", pa.array(offsets))

    sharded = pieces.withColumn("_shard", F.pmod(F.xxhash64("_draw"), F.lit(shards)))
    return sharded.groupBy("_shard").applyInArrow(
        place, f"{schema}, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Tokenise, write the pieces once, pack."""
    return pack(settle(token_pieces(docs, tokenizer, **options)), options.get("capacity", CAPACITY))


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item; lengths lie between 1 and `capacity`."""
    counts = Counter(int(x) for x in lengths)
    rows = defaultdict(list)
    for i in np.argsort(-lengths, kind="stable")[::-1]:
        rows[int(lengths[i])].append(int(i))
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, content in enumerate(bin_completion(counts, capacity)):
        at = 0
        for size in content:
            row = rows[size].pop()
            bins[row], offsets[row] = number, at
            at += size
    return bins, offsets
