"""What daily runs, odd process ids, single bad readings and repeated runs must not break."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cellwatch.operators import features, normalize, quality, segment, signals
from cellwatch.operators.alarms import sampling, temperature
from cellwatch.sources import registry, sinks
from tests.test_blocks import minute
from tests.test_rules import T0, cells, frames


def test_numbers_go_on_over_two_runs(spark):
    kinds = ["charging"] * 30 + ["parking"] * 50 + ["driving"] * 20 + ["charging"] * 20
    rows = [minute(i * 30, event_type=k, frame_no=i) for i, k in enumerate(kinds)]
    whole = {r.frame_no: r.process_id for r in features.prepare(frames(spark, rows), collapse=False).collect()}
    assert sorted(set(whole.values())) == [1, 2, 3, 4]
    for cut in (30, 47, 80, 99):
        one = features.prepare(frames(spark, rows[:cut]), collapse=False)
        two = features.prepare(frames(spark, rows[cut:]), collapse=False, carry=segment.last_processes(one))
        got = {r.frame_no: r.process_id for r in one.union(two).collect()}
        assert got == whole, cut


def test_numbers_go_on_after_a_silent_run(spark):
    rows = [minute(i * 30, event_type="charging" if i < 2 else "parking", frame_no=i, battery_id="B") for i in range(4)]
    rows += [minute(i * 30, event_type="parking" if i < 7 else "driving", frame_no=10 + i, battery_id="A") for i in range(9)]
    rows += [minute(i * 30, event_type="charging", frame_no=i, battery_id="B") for i in (7, 8)]
    whole = {(r.battery_id, r.frame_no): r.process_id for r in features.prepare(frames(spark, rows), collapse=False).collect()}
    got, carry = {}, None
    for lo, hi in ((0, 120), (120, 210), (210, 300)):  # the second without B
        some = frames(spark, rows).filter(F.col("sample_ts").between(
            F.lit(T0 + timedelta(minutes=lo)), F.lit(T0 + timedelta(minutes=hi - 1))))
        ready = features.prepare(some, collapse=False, carry=carry)
        got |= {(r.battery_id, r.frame_no): r.process_id for r in ready.collect()}
        carry = segment.last_processes(ready, carry)
    assert got == whole and whole["B", 8] == 3


def test_processes_are_neighbours_by_time(spark):
    rows = [minute(i, event_type=k, process_id=p, device_type="swap_station", frame_no=i)
            for i, (k, p) in enumerate([("charging", "950"), ("charging", "950"), ("parking", "90x"), ("parking", "90x"),
                                        ("parking", "90x"), ("parking", "90x"), ("parking", "90x"), ("parking", "90x")])]
    df = normalize_ids(frames(spark, rows))
    ready = features.prepare(df, numbered=True, collapse=False)
    runs = {r.process_id: r.prev_event_type for r in segment.processes(ready).collect()}
    assert runs == {"950": None, "90x": "charging"}
    rest = features.rest_pairs(ready).first()
    assert rest.process_id == "90x" and rest.at1.sample_ts - rest.at0.sample_ts == timedelta(minutes=5)


def normalize_ids(df):
    return df.withColumn("process_id", F.col("process_id").cast("string"))


def test_blocks_add_up_to_the_process(spark):
    rows = [{**minute(0, current_a=50.0 if i % 2 else 150.0, frame_no=i), "sample_ts": T0 + timedelta(seconds=5 * i)}
            for i in range(101)]
    ready = features.prepare(frames(spark, rows), collapse=False)
    blocks = features.gap_features(ready).collect()
    assert len(blocks) == 2 and sum(b.discharge_cap for b in blocks) == 50 * 5 * 50 + 50 * 5 * 150


def test_one_bad_cell_reads_as_nothing(spark):
    bad = cells(3.6)
    bad[4] = float("nan")
    row = signals.frame_signals(quality.with_quality(normalize.frame_derived(frames(spark, [minute(0, cell_v=bad)])))).first()
    assert row.hi_mv < 4500 and row.volt_diff_mv < 300 and row.median_mv == row.median_mv
    assert not row.sig_cell_limit and not row.sig_spread and row.is_effective
    low = cells(3.6)
    low[4] = 0.0  # a zero is a reading: below every limit
    row = signals.frame_signals(quality.with_quality(normalize.frame_derived(frames(spark, [minute(0, cell_v=low)])))).first()
    assert row.lo_mv == 0 and row.sig_cell_limit
    gap = quality.pack_sum_gap(frames(spark, [minute(0, cell_v=bad, pack_voltage_v=36.0)])).first()
    assert gap.pack_gap_v is None


def test_equal_copies_count_once(spark):
    rows = [minute(0, frame_no=7), minute(0, frame_no=7), minute(0, frame_no=9)]
    got = quality.collapse_repeats(frames(spark, rows)).collect()
    assert [(r.frame_no, r.n_msgs) for r in got] == [(7, 3)]
    read = frames(spark, [minute(0, frame_no=7), minute(0, frame_no=9)])
    read = read.withColumn("frame_no", F.col("frame_no").alias("frame_no", metadata={"unique": True}))
    assert quality.has_unique_numbers(read) and quality.collapse_repeats(read).first().n_msgs == 2


def test_symmetry_is_of_a_day(spark):
    def jitter(i, on):
        v = cells(3.6)
        if on:
            v[2] += 0.05 * (-1) ** i
            v[3] -= 0.05 * (-1) ** i
        return v

    rows = [minute(i * 10, cell_v=jitter(i, i < 40), frame_no=i) for i in range(400)]
    ready = features.prepare(frames(spark, rows), collapse=False)
    days = {d.date_tag for d in sampling.symmetry(ready).filter("fired").collect()}
    assert len(days) == 1 and ready.select("date_tag").distinct().count() > 2


def test_daily_spread_weighs_frames(spark):
    blocks = spark.createDataFrame(
        [("B0", "D0", "vehicle", "2024-01-01", 10.0, 1), ("B0", "D0", "vehicle", "2024-01-01", 2.0, 9)],
        "battery_id string, device_id string, device_type string, date_tag string, avg_temp_diff double, effect_msg_count int")
    assert temperature.statistical(blocks).first().daily_temp_diff == pytest.approx(2.8)


def test_alarms_of_a_repeated_run_replace(spark, tmp_path):
    alarms = spark.sql("SELECT 'B0' AS battery_id, 'D0' AS device_id, 'E' AS event_id, "
                       "timestamp'2024-01-01 10:00:00' AS at, 'ap16' AS algorithm, true AS fired")
    for _ in range(2):
        sinks.write_alarms(alarms, f"{tmp_path}/alarms")
    sinks.write_alarms(alarms.withColumn("algorithm", F.lit("ap9")), f"{tmp_path}/alarms")
    assert spark.read.parquet(f"{tmp_path}/alarms").count() == 2


def test_registry_is_whole():
    types = registry.BUILT_IN
    assert len(types) == 25 and sum(len(t.keywords) for t in types) == 95
    assert sum(len(t.signals) for t in types) == 14 and sum(bool(t.signals) for t in types) == 9
    assert all(t.skill and t.design_doc for t in types) and [t.failure_type for t in types if t.model_path] == ["thermal_runaway"]


def test_rank_shift_follows_time_with_text_ids(spark):
    """Charges are neighbours by time: ids sort otherwise or are no numbers at all."""
    from cellwatch.operators.alarms import spread

    rows, at = [], 0
    for process, lowest in (("P-10", 0), ("P-9", 5), ("x", 5)):
        for _ in range(3):
            cells = [3.60 + 0.001 * i for i in range(10)]
            cells[0], cells[lowest] = cells[lowest], cells[0]
            rows.append({**minute(at, event_type="charging", process_id=process, frame_no=at), "cell_v": cells, "battery_type": "T0"})
            at += 1
    ready = features.prepare(normalize_ids(frames(spark, rows)), numbered=True, collapse=False)
    static = spark.createDataFrame([("T0", 70.0)], "battery_type string, battery_energy double")
    got = spread.rank_shift(ready, static).collect()
    pairs = {(r.prev_process_id, r.process_id): r.shift for r in got if r.position == 1}
    assert pairs == {("P-10", "P-9"): 5.0, ("P-9", "x"): 0.0}
