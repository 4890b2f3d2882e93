"""Limits below, at and above, on literal frames."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cellwatch.functions import tags
from cellwatch.operators import normalize, quality, signals
from cellwatch.operators.alarms import diagnosis, realtime, sampling, spread
from cellwatch.params import Params
from cellwatch.schemas import CANONICAL_FRAME_DDL

T0 = datetime(2024, 1, 1)


def frames(spark, rows):
    """Canonical frames from dicts; what is not given is a healthy reading."""
    base = dict(battery_id="B", device_id="D", device_name="N", device_type="vehicle", source="vehicle",
                event_type="driving", user_soc=50.0, current_a=10.0, pack_voltage_v=36.0,
                cell_v=[3.6] * 10, probe_temp_c=[25.0, 25.0], n_cells=10, n_probes=2, iso_kohm=2000.0)
    schema = spark.createDataFrame([], CANONICAL_FRAME_DDL).schema
    full = [{**{f.name: None for f in schema}, **base, "sample_ts": T0 + timedelta(seconds=5 * i),
             "frame_no": i, **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in full], schema)


def flagged(spark, rows):
    return signals.frame_signals(quality.with_quality(normalize.frame_derived(frames(spark, rows))))


def flags(df, name):
    return [r[0] for r in df.orderBy("frame_no").select(name).collect()]


def cells(*changed):
    return list(changed) + [3.6] * (10 - len(changed))


@pytest.mark.parametrize("name, rows, want", [
    ("sig_heat", [{"probe_temp_c": [54.9, 54.9]}, {"probe_temp_c": [55.0, 55.0]}, {"probe_temp_c": [55.1, 55.1]}],
     [False, False, True]),
    ("sig_heat", [{"probe_temp_c": [10.0, 39.9]}, {"probe_temp_c": [10.0, 40.0]}, {"probe_temp_c": [10.0, 40.1]}],
     [False, False, True]),
    ("sig_cell_limit", [{"cell_v": cells(1.301)}, {"cell_v": cells(1.300)}, {"cell_v": cells(1.299)}],
     [False, False, True]),
    ("sig_cell_limit", [{"cell_v": cells(4.499)}, {"cell_v": cells(4.5)}, {"cell_v": cells(4.501)}],
     [False, False, True]),
    ("sig_spread", [{"cell_v": cells(3.899)}, {"cell_v": cells(3.9)}, {"cell_v": cells(3.901)}],
     [False, False, True]),
    ("sig_insulation", [{"iso_kohm": 101.0}, {"iso_kohm": 100.0}, {"iso_kohm": 99.0}, {"iso_kohm": 0.0},
                        {"iso_kohm": None}], [False, False, True, False, False]),
    ("sig_cool_spread", [{"cell_v": cells(3.8)}, {"cell_v": cells(3.801)},
                         {"cell_v": cells(3.801), "probe_temp_c": [40.0, 40.0]}], [False, True, False]),
    ("sig_temp_spread", [{"probe_temp_c": [20.0, 35.0]}, {"probe_temp_c": [20.0, 35.1]},
                         {"probe_temp_c": [20.0, 35.1], "cell_v": cells(3.65)}], [False, True, False]),
    ("sig_missing", [{"cell_v": cells(*[0.0] * n)} for n in (2, 3, 4)] + [{"cell_v": cells(*[float("nan")] * 4)}],
     [False, False, True, True]),
])
def test_signal_limits_are_strict(spark, name, rows, want):
    assert flags(flagged(spark, rows), name) == want


def test_wide_spread_follows_the_temperature(spark):
    rows = [{"cell_v": cells(4.0)}, {"cell_v": cells(4.0), "probe_temp_c": [45.0, 45.0]},
            {"cell_v": cells(4.0), "probe_temp_c": [60.0, 60.0]}]
    assert flags(flagged(spark, rows), "spread_family") == ["voltage_spread", "thermal_runaway", None]


def test_initial_values_of_single_precision_sources(spark):
    f32 = 4.096000194549561
    df = quality.flag_init(frames(spark, [{"max_cell_v": f32}, {"max_cell_v": 4.095}, {"max_cell_v": 65535.0},
                                          {"max_cell_v": None}]))
    assert flags(df, "cell_init") == [True, False, True, False]


def test_repeats_equal_in_content_are_collapsed(spark):
    same = {"sample_ts": T0, "frame_no": 5}
    df = frames(spark, [same, same, same, {"frame_no": 9}])
    got = quality.collapse_repeats(df, unique_numbers=False).orderBy("sample_ts").collect()
    assert [(r.frame_no, r.n_msgs) for r in got] == [(5, 3), (9, 1)]


def test_thermal_runaway_conditions(spark):
    hot = [60.0, 60.0]
    rows = [{"probe_temp_c": hot}, {"probe_temp_c": hot, "cell_v": cells(4.6)},
            {"probe_temp_c": hot, "iso_kohm": 50.0}, {"cell_v": cells(*[0.0] * 4), "iso_kohm": 0.0},
            {"cell_v": cells(*[0.0] * 4)}, {"cell_v": cells(4.0)}]
    df = realtime.thermal_runaway(flagged(spark, rows), spread_alone=True)
    got = [tuple(r) for r in df.orderBy("frame_no").select("c1", "c2", "c3", "c5").collect()]
    assert got == [(False, False, False, False), (True, False, False, True), (False, True, False, False),
                   (False, False, False, True), (False, False, True, True), (False, False, False, True)]


def test_hazard_fires_above_ten(spark):
    rows = [{"iso_kohm": 50.0}] * 11 + [{}] * 100
    got = realtime.realtime_hazard(flagged(spark, rows)).orderBy("frame_no").collect()
    assert [r.fired for r in got[:12]] == [False] * 10 + [True] * 2
    assert got[99].factor == 11 and got[100].factor == 10 and not got[100].fired


def test_insulation_runs_skip_missing_readings(spark):
    rows = [{"iso_kohm": v} for v in (50.0, 0.0, 60.0, None, 70.0, 500.0, 50.0)]
    got = realtime.insulation_lv2(frames(spark, rows)).collect()
    assert [(r.n_frames, r.min_iso) for r in got] == [(3, 50.0)]
    assert realtime.insulation_lv3(frames(spark, rows), Params(iso_lv3_seconds=20)).count() == 1
    assert realtime.insulation_lv3(frames(spark, rows), Params(iso_lv3_seconds=21)).count() == 0


@pytest.mark.parametrize("volts, want", [(55.9, False), (56.0, False), (56.1, True), (15.9, True)])
def test_pack_gap(spark, volts, want):
    assert flags(sampling.pack_voltage(frames(spark, [{"pack_voltage_v": volts}])), "fired") == [want]


@pytest.mark.parametrize("n, want", [(59, False), (60, False), (61, True)])
def test_cold_frames(spark, n, want):
    df = quality.with_quality(normalize.frame_derived(frames(spark, [{"probe_temp_c": [-40.0, 20.0]}] * n)))
    df = df.withColumns({"n_msgs": F.lit(1), "date_tag": F.lit("2024-01-01")})
    assert [r.fired for r in sampling.cold_frames(df).collect()] == [want]


@pytest.mark.parametrize("cell_type, rule, spread_v, deviation_v, want", [
    ("LFP", spread.outlier_lfp, 0.026, 0.06, True), ("LFP", spread.outlier_lfp, 0.024, 0.06, False),
    ("NCM", spread.outlier_ncm, 0.017, 0.071, True), ("NCM", spread.outlier_ncm, 0.017, 0.069, False)])
def test_spread_outliers(spark, cell_type, rule, spread_v, deviation_v, want):
    blocks = spark.createDataFrame([(cell_type, spread_v, deviation_v)],
                                   "cell_type string, max_volt_diff double, max_volt_skewness double")
    assert [r.fired for r in rule(blocks).collect()] == [want]


def test_high_spread_needs_more_than_one_frame(spark):
    rows = [("B", n, "charging", "D", "2024-01-01", True, 101.0 if i < n else 100.0)
            for n in (0, 1, 2) for i in range(4)]
    df = spark.createDataFrame(rows, "battery_id string, process_id long, event_type string, device_id string, "
                                     "date_tag string, is_effective boolean, volt_diff_mv double")
    got = {r.process_id: r.fired for r in spread.high_spread(df).collect()}
    assert got == {0: False, 1: False, 2: True}


def test_tags(spark):
    at = [datetime(2024, 1, 1, 1, 59, 59), datetime(2024, 1, 1, 2), datetime(2024, 1, 1, 23, 59, 59)]
    rows = list(zip(at, [4.9, 5.0, 100.0], [-150.0, 0.0, 100.0]))
    df = spark.createDataFrame(rows, "t timestamp, soc double, amp double")
    got = df.orderBy("t").select(tags.hour_tag(F.col("t")), tags.soc_tag(F.col("soc")),
                                 tags.curr_tag(F.col("amp"))).collect()
    assert [tuple(r) for r in got] == [(0, 0, 0), (1, 1, 2), (11, 19, 4)]


def test_epochs_in_seconds_and_milliseconds(spark):
    df = spark.createDataFrame([(1704067200,), (1704067200000,)], "v long")
    assert {r[0] for r in df.select(tags.epoch_ts(F.col("v"))).collect()} == {datetime(2024, 1, 1)}


def test_codes_stay_within_their_layer():
    assert {r.code for r in diagnosis.VOLT_RULES} == {"P0201", "P0202", "P0203"}
    assert {r.code for r in diagnosis.TEMP_RULES} == {"P0302", "P0308"}
    assert {r.code for r in diagnosis.SAMPLING_RULES} == {"P0301", "P0303", "P0308"}
