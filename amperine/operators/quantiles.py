"""Exact quantiles of large, skewed groups.

The built-in exact percentile keeps every distinct value of a group in one task. Here a
first pass brackets each quantile with a bounded sketch, and a second pass counts what
lies below the bracket and keeps only the values inside it. While a group still has more
than RANKED distinct values, they are split into POINTS buckets or more, counted per bucket, and the
buckets that hold none of the wanted ranks collapse to one entry each. What is ranked in one
task is therefore bounded, whatever the size of the group; all passes combine partially
before their shuffle, so one group may hold most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperine.session import level_join, lookup_join, settle

ACCURACY = 10_000
RANKED = 100_000  # entries of one group that are put in order in one task
POINTS = 256
_SLACK = 4  # bracket half-width in units of the sketch error


def _brackets(df: DataFrame, by: list[str], values: list[str], probs: list[float], accuracy: int):
    """Per group: for every value column its row count and (low, high) per quantile."""
    pad = _SLACK / accuracy
    points = [p for q in probs for p in (max(q - pad, 0.0), min(q + pad, 1.0))]
    aggs = []
    for i, name in enumerate(values):
        aggs.append(F.count(F.col(f"`{name}`")).alias(f"_n{i}"))
        aggs.append(F.percentile_approx(F.col(f"`{name}`"), points, accuracy).alias(f"_p{i}"))
    return df.groupBy(*by).agg(*aggs)


def _entry(i: int, name: str, kind: str) -> Column:
    """What a row adds for one value column, next to the column's count and bracket points."""
    return F.struct(
        F.lit(i).alias("column"), F.col(f"_n{i}").alias("n"), F.col(f"`{name}`").cast(kind).alias("value"),
        F.col(f"_p{i}").cast(f"array<{kind}>").alias("points"),
    )


def _bracketed(probs: list[float], accuracy: int) -> tuple[Column, Column]:
    """Value of an entry, and whether it is exact.

    Inside a bracket the value itself; outside, the upper end of the next lower bracket
    (null below all of them) marked as not exact, so that such rows collapse before the
    shuffle. In groups of up to ten times `accuracy` rows a bracket could be narrower than
    the distance of two ranks; they keep every value.
    """
    value, n, points = F.col("value"), F.col("n"), F.col("points")
    lows = [points[2 * j] for j in range(len(probs))]
    highs = [points[2 * j + 1] for j in range(len(probs))]
    exact = n <= 10 * accuracy
    for q, low, high in zip(probs, lows, highs):
        over = F.lit(True) if q <= 0.0 else value >= low
        under = F.lit(True) if q >= 1.0 else value <= high
        exact = exact | (over & under)
    below = [F.when(high < value, high) for high in highs]
    snapped = F.greatest(*below) if len(below) > 1 else below[0]
    return F.when(exact, value).otherwise(snapped), exact


def _wanted(probs: list[float], n: Column) -> list[tuple[Column, Column]]:
    """The two ranks, from 0, on either side of every quantile's position."""
    positions = [F.lit(float(q)) * (n - 1) for q in probs]
    return [(F.floor(p), F.ceil(p)) for p in positions]


def _running(group: list[str], *order: Column) -> Column:
    """Rows up to and with the current entry of a group."""
    window = Window.partitionBy(*group).orderBy(*order)
    return F.sum("rows").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _collapse(cells: DataFrame, group: list[str], probs: list[float]) -> DataFrame:
    """Fewer entries with the same values at the wanted ranks: at most about a quarter.

    A bucket holds the entries up to a point of the sketch, so its count is exact however
    good the sketch is. A bucket without a wanted rank becomes one entry at its upper end.
    """
    split = max(POINTS, 8 * len(probs))
    points = cells.groupBy(*group).agg(F.percentile_approx(
        F.when(F.col("exact"), F.col("value")), [i / split for i in range(1, split)], ACCURACY
    ).alias("points"))
    # 2 kB a row, so at most 4 MB are broadcast
    placed = lookup_join(cells, points, group, max_rows=2000).withColumn("bucket", F.coalesce(
        F.size(F.filter("points", lambda p: p < F.col("value"))), F.lit(0)
    )).drop("points")
    place = [*group, "bucket"]
    buckets = placed.groupBy(*place, "n").agg(F.sum("rows").alias("rows"), F.max("value").alias("top"))
    buckets = buckets.withColumn("through", _running(group, F.col("bucket").asc()))
    start = F.col("through") - F.col("rows")
    held = F.lit(False)
    for low, high in _wanted(probs, F.col("n")):
        for rank in (low, high):
            held = held | ((rank >= start) & (rank < F.col("through")))
    marked = settle(buckets.withColumn("held", held).drop("through"))
    full = marked.filter("held").select(*place)
    rest = marked.filter("not held").select(
        *group, "n", F.col("top").alias("value"), F.lit(False).alias("exact"), "rows"
    )
    kept = lookup_join(placed, full.withColumn("held", F.lit(True)), place).filter("held")
    return settle(kept.select(*rest.columns).unionByName(rest))


def exact_quantiles(
    df: DataFrame, by: list[str], values: list[str], probs: list[float],
    accuracy: int = ACCURACY, pick: str = "linear", ranked: int = RANKED,
) -> DataFrame:
    """Quantiles as columns `by`, feature, n, and quantiles (array in order of `probs`).

    `pick` is 'linear' (interpolate between the neighbours) or 'higher' (take the upper, in
    the type of the first value column).
    Nulls are ignored; a column without values in a group gives no row. `df` is read
    twice, so it should be a table or settled. If the sketch ever failed to bracket a
    rank the job stops instead of returning a wrong value.
    """
    columns = [f"`{v}`" for v in values]
    if not by:
        one = df.select(*columns, F.lit(1).alias("_all"))
        return exact_quantiles(one, ["_all"], values, probs, accuracy, pick, ranked).drop("_all")
    brackets = _brackets(df, by, values, probs, accuracy)
    rows = df.select(*by, *columns)
    if by == ["_all"]:
        keyed = rows.join(F.broadcast(brackets), by)  # one row
    elif by == ["aggregation_level"]:
        keyed = level_join(rows, brackets)
    else:
        keyed = lookup_join(rows, brackets, by)

    kind = dict(df.dtypes)[values[0]] if pick == "higher" else "double"
    # a row is taken apart first, so that one short expression serves all columns and is compiled
    entries = F.array(*[_entry(i, name, kind) for i, name in enumerate(values)])
    group = [*by, "column"]
    value, exact = _bracketed(probs, accuracy)
    cells = settle(
        keyed.select(*by, F.explode(entries).alias("_m"))
        .select(*by, "_m.*")
        .filter(F.col("value").isNotNull())
        .select(*group, "n", value.alias("value"), exact.alias("exact"))
        .groupBy(*group, "n", "value", "exact")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    least = 2 * max(POINTS, 8 * len(probs))  # fewer entries need not become fewer still
    while True:
        most = cells.groupBy(*group).agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
        if most <= max(ranked, least):
            break
        cells = _collapse(cells, group, probs)
    through = _running(group, F.col("value").asc_nulls_first(), F.col("exact").desc())
    in_order = cells.withColumn("through", through).withColumn("found", F.struct("value", "exact"))
    picks = []
    for j, ranks in enumerate(_wanted(probs, F.col("n"))):
        for end, rank in zip(("lo", "hi"), ranks):
            reached = F.when(F.col("through") > rank, F.col("through"))
            picks.append(F.min_by("found", reached).alias(f"{end}{j}"))
    picked = in_order.groupBy(*group, "n").agg(*picks)

    def quantile(j: int, prob: float) -> Column:
        lo, hi = F.col(f"lo{j}"), F.col(f"hi{j}")
        position = F.lit(float(prob)) * (F.col("n") - 1)
        between = lo["value"] + (hi["value"] - lo["value"]) * (position - F.floor(position))
        sure = F.coalesce(lo["exact"] & hi["exact"], F.lit(False))
        stop = F.raise_error(F.lit("a quantile was not bracketed")).cast(kind)
        return F.when(sure, between if pick == "linear" else hi["value"]).otherwise(stop)

    names = F.element_at(F.array(*[F.lit(v) for v in values]), F.col("column") + 1)
    quantiles = F.array(*[quantile(j, p) for j, p in enumerate(probs)])
    return picked.select(*by, names.alias("feature"), "n", quantiles.alias("quantiles"))
