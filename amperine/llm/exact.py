"""Exact de-duplication by content-defined chunk recipes, in DataFrame functions only.

Every text is cut where its own content says so, so equal texts give equal chunks. A text's
recipe is the ordered list of its chunks' identifiers. Chunks are de-duplicated before they
are moved: each distinct chunk travels once per task that holds it, however many documents
repeat it, and shows whether an identifier stands for exactly one chunk text. Documents are
then compared by their recipes, about one hundredth of the text, and no text is moved again.

Defined results: a null text equals an empty one; of equal texts the row with the largest
key stays, a null key being smallest and one of several rows with that key staying; every
row gets a decision; an empty table gives no rows; other columns are carried in a struct
and cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine.llm.common import spread_lookup, stored
from amperine.session import settle

# A chunk ends after the first blank that follows one of these letters, 512 to 4096
# characters after its start; without such a place it has 4096 characters.
CHUNK = r"((?s).{511,4094}?[eEnNrR,]\s|(?s).{1,4096})"

#: Identifiers of a chunk, the cheap one first; the second is used if the first is ambiguous.
DIGESTS: tuple[Callable[[Column], Column], ...] = (
    lambda chunk: F.xxhash64(chunk),
    lambda chunk: F.sha2(chunk, 256),
)


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CHUNK), F.lit(1))


def ambiguous(docs: DataFrame, text: str, digest: Callable[[Column], Column]) -> int:
    """Identifiers that stand for more than one chunk text."""
    distinct = (
        docs.select(F.explode(chunks(F.col(text))).alias("chunk"))
        .groupBy(digest(F.col("chunk")).alias("digest"), "chunk")
        .agg(F.lit(1).alias("one"))
    )
    return distinct.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").count()


def recipes(docs: DataFrame, text: str, digests=DIGESTS, carry: list[str] = ()) -> DataFrame:
    """Written table of _row (differs from row to row), recipe, text_sha256 and `carry`."""
    for digest in digests:
        if not ambiguous(docs, text, digest):
            break
    else:
        raise ValueError("two chunks share every digest that was offered")
    value = F.coalesce(F.col(text), F.lit(""))
    return stored(docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.transform(chunks(F.col(text)), digest).alias("recipe"),
        F.sha2(value, 256).alias("text_sha256"),
        *carry,
    ))


def decide(listed: DataFrame, key: str) -> DataFrame:
    """keep_id, group_size and kept for every row of a table of recipes."""
    groups = settle(
        listed.groupBy("recipe")
        .agg(F.max(F.struct(F.col(key).alias("id"), "_row")).alias("keep"),
             F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )
    rows = spread_lookup(listed, groups, "recipe", "group_size")
    alone = F.col("group_size").isNull()
    return rows.withColumns({
        "keep_id": F.when(alone, F.col(key)).otherwise(F.col("keep.id")),
        "kept": alone | (F.col("keep._row") == F.col("_row")),
        "group_size": F.coalesce("group_size", F.lit(1).cast("long")),
    }).drop("keep")


def duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", digests=DIGESTS) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256."""
    rows = decide(recipes(docs, text, digests, [key]), key)
    return rows.select(key, "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their columns as they came.

    Only keys and digests of the rows that go are joined to the documents, so texts are not
    copied to a working table. Rows that repeat both key and text of a row that stays, if
    there are any, are put together afterwards.
    """
    listed = recipes(docs, text, carry=[F.col(key).alias("_key")])
    rows = decide(listed.select("_row", "recipe", "_key", "text_sha256"), "_key").filter(~F.col("kept"))
    twin = F.col("_key").eqNullSafe(F.col("keep_id"))
    gone = settle(rows.select("_key", "text_sha256", twin.alias("twin")).distinct())
    named = docs.select(
        F.struct("*").alias("_doc"), F.col(key).alias("_k"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_s")
    )
    same = F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_s") == F.col("text_sha256"))
    left = named.join(gone.filter("not twin"), same, "left_anti")
    twins = gone.filter("twin")
    if twins.isEmpty():
        return left.select("_doc.*")
    once = left.join(twins, same, "left_semi").groupBy("_k", "_s").agg(F.first("_doc").alias("_doc"))
    return left.join(twins, same, "left_anti").select("_doc").unionByName(once.select("_doc")).select("_doc.*")
