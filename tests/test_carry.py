"""Bucketed carries of live forms: only touched buckets are rewritten, old versions go, repeats change nothing."""

import glob
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cellwatch.operators import features
from cellwatch.streaming import carry, live
from tests.test_rules import T0, frames

POOL = [f"B{i}" for i in range(6)]


def count_step(batch, state, keep):
    """Rows of a battery so far."""
    both = batch.groupBy("battery_id").agg(F.count("*").alias("n"))
    if state is not None:
        both = both.unionByName(state).groupBy("battery_id").agg(F.sum("n").alias("n"))
    return batch, both


def batch(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "battery_id string")


def test_only_touched_buckets_are_written(spark, tmp_path):
    out, path = str(tmp_path / "out"), str(tmp_path / "carry")
    write = carry.writer(lambda b: b, count_step, out, path)
    for n, ids in enumerate((POOL * 3, ["B1"], ["B1", "B2"], [], ["B5"])):
        write(batch(spark, ids), n)
        if n in (1, 4):
            write(batch(spark, ids), n)  # again
    got = {r.battery_id: r.n for r in carry.latest_state(spark, path, 4).collect()}
    assert got == {"B0": 3, "B1": 5, "B2": 4, "B3": 3, "B4": 3, "B5": 4}
    rows = {n: sum(spark.read.parquet(f).count() for f in glob.glob(f"{path}/_batch={n}/_bucket=*")) for n in range(5)}
    assert rows[3] == 0 and rows[4] == 1  # written rows follow the batch
    buckets = {n: len(glob.glob(f"{path}/_batch={n}/_bucket=*")) for n in range(5)}
    # what batch 1 and 2 replaced is gone
    assert buckets[0] == 6 - 2 and buckets[1] == 0
    assert not os.path.exists(f"{path}/manifest/0")


def test_a_lost_manifest_is_an_error(spark, tmp_path):
    write = carry.writer(lambda b: b, count_step, str(tmp_path / "out"), str(tmp_path / "carry"))
    with pytest.raises(Exception):
        write(batch(spark, ["B1"]), 3)


def charge_and_rest():
    """Two batteries at a station: charging, then parked, over and over, a frame a minute; some frames are not effective."""
    rng, rows = random.Random(4), []
    for battery in "AB":
        kind, left, no = "parking", 3, 0
        for i in range(120):
            if not left:
                kind = "parking" if kind == "charging" else "charging"
                left = rng.randint(1, 4) if kind == "charging" else rng.randint(3, 14)
            left -= 1
            base = 3600 + rng.randint(0, 9)
            rows.append({"battery_id": battery, "device_id": f"D{battery}", "device_type": "swap_station", "event_type": kind,
                         "sample_ts": T0 + timedelta(minutes=i), "frame_no": no,
                         "cell_v": [(base + rng.randint(0, 20)) / 1000 for _ in range(10)],
                         "iso_kohm": 5000.0 if rng.random() < 0.2 else 900.0})
            no += 1
    return rows


@pytest.mark.parametrize("cuts", [(40, 41)])
def test_live_rests_and_blocks_are_those_of_the_batch_job(spark, tmp_path, cuts):
    rows = charge_and_rest()
    df = frames(spark, rows)
    rests = live.rest_writer(str(tmp_path / "rests"), str(tmp_path / "c1"))
    blocks = live.block_writer(str(tmp_path / "blocks"), str(tmp_path / "c2"))
    edges = [0, *cuts, 120]
    for n, (a, b) in enumerate(zip(edges, edges[1:])):
        part = df.filter(F.col("frame_no").between(a, b - 1))
        rests(part, n)
        blocks(part, n)
        if n == 1:
            rests(part, n)
            blocks(part, n)
    ready = features.prepare(df)
    figures = ["sp_after_chg_volt_diff0", "sp_after_chg_volt_diff1", "spafchg_volt_drop_rate", "spafchg_outlier_rate"]
    want = features.rest_pairs(ready).filter("at1 is not null").select(
        "battery_id", "process_id", F.col("at0.sample_ts").alias("t0"), F.col("at1.sample_ts").alias("t1"), *figures).collect()
    got = spark.read.parquet(str(tmp_path / "rests")).select("battery_id", "process_id", "t0", "t1", *figures).collect()
    assert len(want) > 5 and sorted(map(tuple, got)) == sorted(map(tuple, want))
    counted = features.effective(ready).groupBy(*features.BLOCK_KEY).agg(F.count("*").alias("n_frames"), F.max("volt_diff_mv").alias("v"))
    live_ = live.merged_blocks(spark.read.parquet(str(tmp_path / "blocks"))).select(*features.BLOCK_KEY, "n_frames", F.col("max_volt_diff_mv").alias("v"))
    assert sorted(map(tuple, live_.collect()), key=repr) == sorted(map(tuple, counted.collect()), key=repr)
