from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from amperine.operators import quantiles
from amperine.operators.quantiles import exact_quantiles
from amperine.operators.series import previous_in_series
from amperine.session import lookup_join

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("accuracy", [20, 10_000])  # 20 forces brackets at these sizes
@pytest.mark.parametrize("shape", ["spread", "copies", "lumps"])
def test_equals_numpy(spark, accuracy, shape):
    rng = np.random.default_rng(3)
    groups = {"hot": 6000, "mid": 900, "tiny": 1, "pair": 2}
    rows, want = [], {}
    for name, n in groups.items():
        x = rng.normal(size=n)
        if shape == "copies":
            x[: n // 2] = 0.25
        if shape == "lumps":
            x = np.round(x)
        want[name] = np.quantile(x, PROBS)
        rows += [(name, float(v)) for v in x] + [(name, None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in exact_quantiles(df, ["g"], ["v"], PROBS, accuracy).collect()}
    for name, n in groups.items():
        assert got[name].n == n
        assert np.allclose(got[name].quantiles, want[name], atol=1e-12), name


@pytest.mark.parametrize("probs", [PROBS, [0.25, 0.75]])
def test_large_groups_are_narrowed_before_they_are_ranked(spark, probs, monkeypatch):
    rounds, collapse = [], quantiles._collapse

    def counted(cells, group, probs):
        out = collapse(cells, group, probs)
        sizes = [frame.groupBy(*group).count().agg(F.max("count")).first()[0] for frame in (cells, out)]
        rounds.append(sizes)
        return out

    monkeypatch.setattr(quantiles, "_collapse", counted)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=29_000), np.full(9_000, 0.125)])
    rng.shuffle(x)
    groups = ["hot" if i % 40 else None for i in range(len(x))]
    df = spark.createDataFrame(list(zip(groups, map(float, x))), "g string, v double").repartition(6)
    got = {r.g: r.quantiles for r in exact_quantiles(df, ["g"], ["v"], probs, ranked=1).collect()}
    for name in ("hot", None):
        own = np.array([v for g, v in zip(groups, x) if g == name])
        assert np.allclose(got[name], np.quantile(own, probs), atol=1e-12)
    assert rounds and all(2 * after < before for before, after in rounds)
    assert rounds[-1][1] <= 2 * quantiles.POINTS


def test_integers_beyond_doubles_keep_their_digits(spark):
    base = 2**60
    df = spark.range(3001).select((F.col("id") + base).alias("t"))
    got = exact_quantiles(df, [], ["t"], [0.5], accuracy=20, pick="higher", ranked=1).first().quantiles
    assert got == [base + 1500]


def test_several_columns_and_no_group(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("a"), (-F.col("id")).cast("double").alias("b"),
                                  F.lit(None).cast("double").alias("c"))
    got = {r.feature: r.quantiles for r in exact_quantiles(df, [], ["a", "b", "c"], [0.25, 0.5], accuracy=20).collect()}
    assert got == {"a": [250.0, 500.0], "b": [-750.0, -500.0]}


@pytest.mark.parametrize("n", [1, 2, 7, 8, 1000, 1001])
def test_upper_median_is_rank_n_half(spark, n):
    df = spark.range(n)
    got = exact_quantiles(df, [], ["id"], [0.5], accuracy=20, pick="higher").first().quantiles[0]
    assert got == n // 2


def test_lookup_join_is_the_same_salted(spark):
    df = spark.range(500).select((F.col("id") % 7 % 3).alias("k"), "id")
    table = spark.createDataFrame([(0, "x"), (1, "y")], "k bigint, v string")
    plain = sorted(map(tuple, lookup_join(df, table, ["k"]).collect()), key=str)
    salted = sorted(map(tuple, lookup_join(df, table, ["k"], max_rows=0).collect()), key=str)
    assert plain == salted and len(plain) == 500


def test_previous_row_crosses_days_and_gaps(spark):
    rows = [("a", f"2025-04-0{d} {h:02d}:00:00", 10 * d + h) for d, h in [(1, 3), (1, 9), (2, 1), (5, 0), (5, 1)]]
    rows += [("b", "2025-04-03 00:00:00", 1)]
    df = spark.createDataFrame(rows, "k string, t string, v int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = previous_in_series(df, ["k"], "t", {"p": F.col("v")}).orderBy("k", "t")
    assert [r.p for r in got.collect()] == [None, 13, 19, 21, 50, None]


def test_null_keys_have_a_previous_row_across_days(spark):
    rows = [(None, datetime(2025, 1, day, hour), float(10 * day + hour)) for day in (1, 2) for hour in (1, 2)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    got = previous_in_series(df, ["k"], "t", {"before": F.col("v")}).orderBy("t").collect()
    assert [r.before for r in got] == [None, 11.0, 12.0, 21.0]
