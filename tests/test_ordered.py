"""The ordered operators against pandas, with slices and chunks far smaller than the keys."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellwatch.operators import ordered


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out, start = [], datetime(2024, 1, 1)
    for i in range(600):
        # one key holds most rows; many rows share a second
        key = "hot" if rng.random() < 0.7 else rng.choice(["a", "b"])
        out.append((key, start + timedelta(seconds=rng.randrange(0, 4000)), i,
                    rng.choice(["x", "y", None]) if rng.random() < 0.4 else "x", rng.randrange(0, 5)))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, sample_ts timestamp, frame_no long, kind string, v int")


@pytest.fixture(scope="module")
def local(rows):
    pdf = pd.DataFrame(rows, columns=["k", "sample_ts", "frame_no", "kind", "v"])
    return pdf.sort_values(["k", "sample_ts", "frame_no"]).reset_index(drop=True)


SLICES = ordered.time_slice


def collected(df, *cols):
    pdf = df.select("frame_no", *cols).toPandas().sort_values("frame_no").reset_index(drop=True)
    return pdf


def test_previous(df, local):
    got = collected(ordered.previous(df, ["k"], ["v", "kind"], SLICES(60)).selectExpr(
        "frame_no", "prev.v AS pv", "prev IS NULL AS first"), "pv", "first")
    local = local.assign(pv=local.groupby("k").v.shift(1), first=local.groupby("k").cumcount() == 0)
    want = local.sort_values("frame_no").reset_index(drop=True)
    assert got["first"].tolist() == want["first"].tolist()
    assert got.pv.fillna(-1).tolist() == want.pv.fillna(-1).tolist()


def test_running_total(df, local):
    got = collected(ordered.running_total(df, ["k"], F.col("v"), SLICES(60)), "total")
    want = local.assign(t=local.groupby("k").v.cumsum()).sort_values("frame_no")
    assert got.total.tolist() == want.t.tolist()


@pytest.mark.parametrize("number", [ordered.number_runs, ordered.number_long_runs])
def test_number_runs_counts_nulls_as_a_kind(df, local, number):
    got = collected(number(df, ["k"], "kind", SLICES(60)), "run")
    kind = local.kind.fillna("-")
    change = (kind != kind.groupby(local.k).shift(1)).astype(int)
    want = local.assign(r=change.groupby(local.k).cumsum()).sort_values("frame_no")
    assert got.run.tolist() == want.r.tolist()


@pytest.mark.parametrize("number", [ordered.number_runs, ordered.number_long_runs])
def test_number_runs_with_kept_slice_columns(df, local, number):
    tagged = df.withColumn("hour", F.hour("sample_ts")).withColumn("minute", F.minute("sample_ts"))
    got = collected(number(tagged, ["k"], "kind", ["hour", "minute"]), "run")
    kind = local.kind.fillna("-")
    change = (kind != kind.groupby(local.k).shift(1)).astype(int)
    want = local.assign(r=change.groupby(local.k).cumsum()).sort_values("frame_no")
    assert got.run.tolist() == want.r.tolist()


@pytest.mark.parametrize("chunk", [7, 50, 50_000])
def test_rolling(df, local, chunk):
    got = collected(ordered.rolling(df, ["k"], 7, {"s": F.sum("v"), "n": F.count("*")}, SLICES(60),
                                    chunk_rows=chunk), "s", "n")
    rolled = local.groupby("k").v.rolling(7, min_periods=1)
    want = local.assign(s=rolled.sum().values, n=rolled.count().values).sort_values("frame_no")
    assert got.s.tolist() == want.s.astype(int).tolist()
    assert got.n.tolist() == want.n.astype(int).tolist()


def test_condition_runs(df, local):
    got = ordered.condition_runs(df, ["k"], F.col("v") >= 2, SLICES(60),
                                 [F.count("*").alias("n"), F.min("frame_no").alias("lo")]).toPandas()
    hold = local.v >= 2
    island = (~hold).groupby(local.k).cumsum()
    want = local[hold].groupby([local.k[hold], island[hold]]).frame_no.agg(["count", "min"])
    assert sorted(zip(got.n, got.lo)) == sorted(zip(want["count"], want["min"]))


def test_condition_that_is_null_does_not_hold(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1), 1, None), ("a", datetime(2024, 1, 2), 2, 5)],
                               "k string, sample_ts timestamp, frame_no long, v int")
    runs = ordered.condition_runs(df, ["k"], F.col("v") > 1, SLICES(60), [F.count("*").alias("n")])
    assert [r.n for r in runs.collect()] == [1]
