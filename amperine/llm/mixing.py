"""Mixing sources to target weights by systematic sampling.

Every source gets a share of the mix by weight, held to `most` times its own size; what is
over goes to the others. A document of a source is expected target / source size times in
the mix. These expectations are summed along the source in the order of document size, one
random offset per source is added, and a document is taken once for every whole number its
stretch of the sum crosses. In size order the taken words miss the target by about one
document at most.

The running sum is a rank times a constant, and the rank is put together from three small
steps (sizes of a source, buckets of a size, rows of a bucket), none of which needs a
source, or all documents of one size, in one task. Sources themselves are ranked in one
task, one row each.

Defined results: null is a source of its own, last in order; a null or empty text has size
0 and may be taken without adding words; repeated rows are separate documents; a source
without words has target 0; an empty table gives no rows; other columns are carried in a
struct and cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperine.llm.common import stored, word_count
from amperine.session import settle

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST = 2
SEED = "mix"
BUCKET_ROWS = 10_000


def _number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of the md5 of a text, as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def targets(
    sources: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE, most: float = MOST
) -> DataFrame:
    """Target of every source from a table of source and source_size, one row each.

    Sources are filled in the order in which they reach their limit. The level of the
    first one below its limit, given that all before are at theirs, is the level of all.
    """
    one = F.lit(0)
    position = F.row_number().over(Window.partitionBy(one).orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = sources.withColumn("_w", F.get(cycle, (position - 1) % len(weights))).withColumn(
        "_limit", most * F.col("source_size").cast("double")
    )
    order = Window.partitionBy(one).orderBy(
        F.col("_limit") / F.col("_w"), F.col("source").asc_nulls_last()
    )
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(one)
    mass = total_share * F.sum("source_size").over(everything)
    levels = weighed.withColumn(
        "_level",
        (mass - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))),
    ).withColumn("_below", F.col("_limit") > F.col("_level") * F.col("_w"))
    level = F.min(F.when(F.col("_below"), F.struct(F.col("_limit") / F.col("_w"), "_level"))).over(everything)
    return levels.withColumn("_common", level["_level"]).select(
        "source", "source_size",
        F.when(F.col("_common").isNull() | (F.col("_common") * F.col("_w") >= F.col("_limit")),
               F.col("_limit")).otherwise(F.col("_common") * F.col("_w")).alias("target"),
    )


def copies(sized: DataFrame, key: str, bucket_rows: int = BUCKET_ROWS, seed: str = SEED, **shares) -> DataFrame:
    """Adds source_size, target and copies to a written table with source and size.

    `key` orders documents of one size; `_row`, if the table has it, settles the rest.
    """
    buckets = max(1, math.ceil(sized.count() / bucket_rows))
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    rows = sized.withColumn("_bucket", _number(F.concat(F.lit(seed), name), 8) % buckets)
    place = ["source", "size", "_bucket"]
    counts = settle(rows.groupBy(*place).agg(F.count("*").alias("n")))
    by_size = settle(counts.groupBy("source", "size").agg(F.sum("n").alias("n")))
    by_source = by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))

    def so_far(partition: list[str], order: str) -> Column:
        running = Window.partitionBy(*partition).orderBy(order)
        return F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")

    def same(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
        """Join that takes null sources as equal and keeps one copy of the keys."""
        b = b.withColumnsRenamed({c: f"_{c}_2" for c in on})
        both = [F.col(c).eqNullSafe(F.col(f"_{c}_2")) for c in on]
        return a.join(b, both, how).drop(*[f"_{c}_2" for c in on])

    sizes = same(
        by_size.withColumn("_size_start", so_far(["source"], "size")).drop("n"),
        targets(by_source, **shares), ["source"],
    )
    starts = same(
        counts.withColumn("_bucket_start", so_far(["source", "size"], "_bucket")).drop("n"),
        sizes, ["source", "size"],
    )
    ties = [c for c in (key, "_row") if c in sized.columns]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*place).orderBy(*ties)))
    placed = same(ranked, starts, place)
    rank = F.col("_size_start") + F.col("_bucket_start") + F.col("_rank")
    offset = _number(F.concat(F.lit(seed), F.coalesce("source", F.lit(""))), 13) / F.lit(float(2**52))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    taken = F.floor(rank * each + offset) - F.floor((rank - 1) * each + offset)
    return placed.withColumn("copies", taken.cast("long")).drop(
        "_bucket", "_rank", "_size_start", "_bucket_start"
    )


def mix_plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, taken."""
    sized = settle(docs.select(key, F.col(source).alias("source"), word_count(F.col(text)).alias("size")))
    plan = copies(sized, key, **options)
    return plan.withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their columns as they came."""
    held = stored(docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"),
        F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.struct("*").alias("_doc"),
    ))
    plan = copies(held.select("_row", "_key", "source", "size"), "_key", **options)
    taken = plan.filter("copies > 0").select("_row", "copies")
    return held.join(taken, "_row").select(
        "_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    ).select("_doc.*")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::DOUBLE AS lim,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM weighed)::DOUBLE
             - coalesce(sum(lim) OVER earlier, 0))
            / ((SELECT sum(w) FROM weighed)::DOUBLE - coalesce(sum(w) OVER earlier, 0)::DOUBLE) AS level
  FROM weighed
  WINDOW earlier AS (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), common AS (
  SELECT arg_min(level, lim / w) AS common FROM levels WHERE lim > level * w
), target AS (
  SELECT source, source_size,
         CASE WHEN common IS NULL OR common * w >= lim THEN lim ELSE common * w END AS target
  FROM levels, common
), shared AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS part,
         ('0x' || md5('mix' || coalesce(s.source, ''))[1:13])::BIGINT / 4503599627370496.0::DOUBLE AS u,
         row_number() OVER (PARTITION BY s.source ORDER BY size,
           ('0x' || md5('mix' || coalesce(doc_id::VARCHAR, 'null'))[1:8])::BIGINT
             % (SELECT greatest(1, ceil(count(*) / 10000.0))::BIGINT FROM documents), doc_id) AS k
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       ((floor(k * part + u) - floor((k - 1) * part + u)) * size)::BIGINT AS taken
FROM shared
"""
