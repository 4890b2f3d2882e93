"""The carry writers: batches in sequence equal one batch, and a repeated batch changes nothing."""

import random
from datetime import timedelta

from pyspark.sql import functions as F

from cellwatch.operators import signals
from cellwatch.operators.alarms import realtime
from cellwatch.params import Params
from cellwatch.streaming import live
from tests.test_rules import T0, flagged, frames


def telemetry():
    rng = random.Random(11)
    return [{"battery_id": rng.choice(["A", "A", "B"]), "iso_kohm": rng.choice([50.0, 60.0, 500.0, 0.0]),
             "sample_ts": T0 + timedelta(seconds=40 * i), "frame_no": i} for i in range(60)]


def batches(spark, rows):
    df = frames(spark, rows)
    return [df.filter(F.col("frame_no").between(lo, hi)) for lo, hi in ((0, 19), (20, 24), (25, 59))]


def test_hazard_over_batches(spark, tmp_path):
    p = Params(hazard_window=7, hazard_limit=3.0)
    write = live.hazard_writer(str(tmp_path / "out"), str(tmp_path / "carry"), p)
    rows = telemetry()
    for i, batch in enumerate(batches(spark, rows)):
        write(batch, i)
    write(batches(spark, rows)[2], 2)
    got = {r.frame_no: (r.factor, r.fired) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.frame_no: (r.factor, r.fired) for r in realtime.realtime_hazard(flagged(spark, rows), p).collect()}
    assert got == want and len(got) == 60


def test_insulation_runs_over_batches(spark, tmp_path):
    write = live.insulation_writer(str(tmp_path / "out"), str(tmp_path / "carry"))
    rows = telemetry()
    for i, batch in enumerate(batches(spark, rows)):
        write(batch, i)
        write(batch, i)
    runs = live.latest_runs(spark.read.parquet(str(tmp_path / "out"))).collect()
    got = sorted((r.battery_id, r.start_ts, r.end_ts, r.n_frames, r.min_iso) for r in runs)
    want = sorted((r.battery_id, r.start_ts, r.end_ts, r.n_frames, r.min_iso)
                  for r in signals.insulation_runs(frames(spark, rows)).collect())
    assert got == want


def test_alarm_batches_are_replaced_not_doubled(spark, tmp_path):
    from cellwatch.sources.sinks import alarm_batch_writer

    write = alarm_batch_writer(str(tmp_path / "alarms"))
    first, second, _ = batches(spark, telemetry())
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        write(batch.select("battery_id", "frame_no"), number)
    assert spark.read.parquet(str(tmp_path / "alarms")).count() == 25
