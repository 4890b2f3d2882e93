import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwatch.functions import vectors
from cellwatch.operators import population


@pytest.mark.parametrize("shape", ["continuous", "ties", "one_value"])
def test_exact_quantiles_with_brackets(spark, shape):
    rng = random.Random(3)
    draw = {"continuous": rng.random, "ties": lambda: float(rng.randrange(4)), "one_value": lambda: 2.5}[shape]
    rows = [("big", draw()) for _ in range(3000)] + [("small", draw()) for _ in range(5)] + [("small", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    points = (0.0, 0.25, 0.5, 0.99, 1.0)
    got = {r.g: r for r in population.exact_quantiles(df, ["g"], "x", points, accuracy=100).collect()}
    for g in ("big", "small"):
        values = [x for k, x in rows if k == g and x is not None]
        assert got[g].n == len(values)
        assert got[g].quantiles == pytest.approx(list(np.quantile(values, points)))


def test_bracket_keeps_little_of_the_group(spark):
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.rand(1).alias("x"))
    plan = population.exact_quantiles(df, ["g"], "x", (0.5,), accuracy=1000)
    assert plan.count() == 1


def test_z_scores_of_flat_and_noisy_groups(spark):
    rows = [("flat", 3.0 + 1e-15), ("flat", 3.0), ("live", 1.0), ("live", 3.0)]
    got = population.z_scores(spark.createDataFrame(rows, "g string, x double"), ["g"], ["x"]).collect()
    assert sorted((r.g, r.z_x) for r in got) == [("flat", 0.0), ("flat", 0.0), ("live", -1.0), ("live", 1.0)]


def test_vector_statistics(spark):
    rng = random.Random(5)
    data = [[float(rng.randrange(5)) for _ in range(n)] for n in (1, 2, 7, 12, 40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, v array<double>")
    df = df.withColumns({"s": F.array_sort("v"), "mu": vectors.mean(F.col("v"))})
    v = F.col("v")
    df = df.select("i", vectors.median(F.col("s")).alias("median"), vectors.entropy(v).alias("entropy"),
                   vectors.sorted_quantile(F.col("s"), 0.75).alias("q3"), vectors.waveform(v, F.col("mu")).alias("w"),
                   vectors.ranks(v, F.col("s")).alias("ranks"), vectors.argmax(v).alias("top"))
    for row in df.collect():
        x = np.array(data[row.i])
        _, counts = np.unique(x, return_counts=True)
        p = counts / counts.sum()
        assert row.entropy == pytest.approx(-(p * np.log2(p)).sum())
        assert 0 <= row.entropy <= math.log2(len(x)) + 1e-9
        assert row.median == np.median(x) and row.q3 == pytest.approx(np.quantile(x, 0.75))
        assert row.top == int(np.argmax(x)) + 1
        assert row.ranks == [int((x < y).sum()) + 1 for y in x]
        assert row.w.rms == pytest.approx(np.sqrt((x ** 2).mean()))
        assert row.w.stddev == pytest.approx(x.std())
        if x.std() > 0:
            z = (x - x.mean()) / x.std()
            assert row.w.skewness == pytest.approx((z ** 3).mean(), abs=1e-9)
            assert row.w.kurtosis == pytest.approx((z ** 4).mean())
        else:
            assert row.w.skewness is None and row.w.kurtosis is None


def test_empty_vectors_give_nulls(spark):
    df = spark.sql("SELECT array() AS v").select(F.col("v").cast("array<double>").alias("v"))
    row = df.select(vectors.mean(F.col("v")).alias("m"), vectors.median(F.col("v")).alias("d"),
                    vectors.entropy(F.col("v")).alias("e"), vectors.argmax(F.col("v")).alias("a"),
                    vectors.zero_or_nan_share(F.col("v")).alias("z")).first()
    assert list(row) == [None] * 5


def test_groups_join_alike_broadcast_and_salted(spark):
    rows = [(f"g{i % 3}" if i % 5 else None, float(i), [float(i)]) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, x double, v array<double>")
    stats = df.groupBy("g").agg(F.avg("x").alias("m"))
    for how in ("inner", "left"):
        one = population.join_groups(df, stats, ["g"], how)
        two = population.join_groups(df, stats, ["g"], how, most=0)
        assert "_salt" in two._jdf.queryExecution().toString() and "_salt" not in two.columns
        assert sorted(one.collect(), key=repr) == sorted(two.collect(), key=repr)
        assert one.count() == (240 if how == "inner" else 300)


def test_block_rows_are_not_dealt_by_group(spark):
    """With automatic broadcasts off, rows of a group of any size stay where they are."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"))
        plan = population.z_scores(df, ["g"], ["x"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_principal_axes_against_eigenvectors(spark):
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)), "b": rng.normal(size=(300, 4)) * [5, 2, 1, 0.5],
            "flat": np.zeros((3, 4))}
    data = {g: x - x.mean(0) for g, x in data.items()}
    rows = [(g, *map(float, r)) for g, x in data.items() for r in x]
    df = spark.createDataFrame(rows, "g string, p double, q double, r double, s double")
    for k in (1, 2, 3):
        for row in population.principal(df, ["g"], list("pqrs"), k).collect():
            x = data[row.g]
            axes = np.linalg.eigh(x.T @ x / len(x))[1][:, ::-1][:, :k]
            want = axes @ axes.T if row.g != "flat" else np.zeros((4, 4))
            assert np.allclose(np.array(row.projector).reshape(4, 4), want, atol=1e-6)
