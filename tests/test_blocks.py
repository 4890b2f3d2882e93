"""A hand-made block, invariants on random frames, plans and the daily table."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cellwatch.operators import features, quality, segment
from cellwatch.operators.segment import BLOCK_KEY, join_blocks
from cellwatch.plans import daily
from cellwatch.schemas import BLOCK_FEATURES_DDL
from cellwatch.sources import sinks
from tests.test_rules import T0, cells, frames


def minute(i, **given):
    return {"sample_ts": T0 + timedelta(seconds=60 * i), "frame_no": i, **given}


def test_hand_made_block(spark):
    rows = [minute(0, current_a=-10.0, cell_v=cells(3.61), user_soc=51.0, is_balancing=True),
            minute(1, current_a=-20.0, cell_v=cells(3.63), user_soc=52.0, is_balancing=True),
            minute(3, current_a=-30.0, cell_v=cells(3.62), user_soc=53.0, is_balancing=False),
            minute(4, current_a=-40.0, cell_v=cells(4.096), max_cell_v=4.096, user_soc=54.0)]
    rows = [{**r, "event_type": "charging"} for r in rows]
    ready = features.prepare(frames(spark, rows))
    block = features.block_features(ready).first()
    assert (block.block_msg_count, block.effect_msg_count, block.fault_msg_count) == (4, 3, 1)
    assert block.cell_volt_init_count == {4.096: 1, 5.094: 0, 65535.0: 0}
    assert (block.start_user_soc, block.end_user_soc) == (51.0, 53.0)
    assert block.max_volt_diff == pytest.approx(0.03) and block.max_volt_diff_time == T0 + timedelta(minutes=1)
    assert block.volt_diff_quartiles == pytest.approx({0.25: 0.015, 0.5: 0.02, 0.75: 0.025})
    assert (block.max_charge_current, block.min_charge_current, block.avg_discharge_current) == (30.0, 10.0, None)
    assert block.max_volt_diff_volt_entropy == pytest.approx(-(0.1 * -3.321928094887362 + 0.9 * -0.15200309344505))
    gaps = features.gap_features(ready).first()
    assert gaps.block_duration == 180
    # gaps 0, 60 and 120 s; a frame counts with its own current
    assert gaps.charge_cap == 20.0 * 60 + 30.0 * 120 and gaps.discharge_cap == 0.0
    assert gaps.charge_energy == pytest.approx(gaps.charge_cap * 36 / 3600)
    assert (gaps.balance_count, gaps.balance_duration) == (1, 60)


def test_flat_block_has_no_correlation(spark):
    ready = features.prepare(frames(spark, [minute(i) for i in range(3)]))
    block = features.block_features(ready).first()
    assert block.volt_diff_time_corr is None and block.max_volt_diff_volt_margin is None


def test_block_of_unsound_frames_is_kept(spark):
    ready = features.prepare(frames(spark, [minute(0, iso_kohm=5000.0)]))
    block = features.block_features(ready).first()
    assert (block.block_msg_count, block.effect_msg_count, block.start_time) == (1, 0, None)
    assert block.insu_resis_init_count == {5000.0: 1, 10000.0: 0, 60000.0: 0}


def test_blocks_with_unknown_tags_meet_their_parts(spark):
    ready = features.prepare(frames(spark, [minute(0, user_soc=None), minute(1, user_soc=None)]))
    joined = join_blocks(features.block_features(ready), features.gap_features(ready))
    assert joined.count() == 1 and joined.first().charge_cap == 0.0 and joined.first().soc_tag is None
    ranks = features.rank_features(ready).collect()
    assert len(ranks) == 1 and len(ranks[0].volt_rank_mean) == 10


def test_invariants_on_random_frames(spark):
    rng = random.Random(1)
    rows = [minute(i, cell_v=rng.sample([3.5 + j / 1000 for j in range(100)], 10), current_a=rng.uniform(-50, 50),
                   probe_temp_c=[float(rng.randrange(20, 30)) for _ in range(2)]) for i in range(200)]
    ready = features.prepare(frames(spark, rows))
    for b in features.block_features(ready).collect():
        assert b.min_volt_diff <= b.avg_volt_diff <= b.max_volt_diff + 1e-12
        assert b.effect_msg_count + b.fault_msg_count == b.block_msg_count
        assert 0 <= b.max_volt_diff_volt_entropy <= 3.3219281
    for r in features.rank_features(ready).collect():
        assert sum(r.volt_rank_mean) == pytest.approx(10 * 11 / 2)
    for g in features.gap_features(ready).collect():
        assert g.charge_cap >= 0 and g.discharge_cap >= 0


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode
                                                  .fromString("simple"))


def test_numbered_frames_need_one_exchange_of_aggregates_only(spark):
    df = frames(spark, [minute(i, process_id=1) for i in range(3)])
    ready = features.prepare(df, numbered=True, collapse=False)
    text = plan(features.block_features(ready).select(*BLOCK_KEY, "max_volt_diff"))
    head = text.split("AdaptiveSparkPlan")[-1]
    assert head.count("Exchange") == 1 and "Window" not in head and "partial_" in head


def odd_frames(spark):
    """Frames of two batteries with copies, unknown keys and readings, and events that change often."""
    rng = random.Random(3)
    rows = []
    for i in range(240):
        kind = rng.choice(["driving", "parking", "charging"])
        given = {"battery_id": rng.choice(["B", "C"]), "event_type": kind, "user_soc": rng.choice([None, 40.0, 41.0, 77.0]),
                 "current_a": rng.uniform(-50, 50), "is_balancing": rng.random() < 0.3, "device_type": "swap_station",
                 "cell_v": rng.choice([None, [], [3.5, None, 3.7], [3.5 + rng.randrange(9) / 100 for _ in range(10)]]),
                 "probe_temp_c": rng.choice([None, [float(rng.randrange(20, 30)) for _ in range(2)]]),
                 "n_cells": None, "n_probes": None, "iso_kohm": rng.choice([5000.0, 2000.0, 1900.0])}
        rows.append(minute(3 * i, **given))
        if i % 5 == 0:  # a copy, later in number
            rows.append({**rows[-1], "frame_no": 1000 + i, "event_type": "parking"})
    rows += [minute(900, battery_id=None, frame_no=2000 + i) for i in range(2)]
    rows += [{**minute(0, frame_no=n, event_type=e), "sample_ts": None} for n, e in ((3001, "driving"), (3002, "parking"))]
    rows += [minute(901, frame_no=None, event_type="parking"), minute(903, frame_no=None),
             minute(903, frame_no=4000, event_type="charging")]
    return frames(spark, rows)


def test_collapsed_and_numbered_in_one_join_as_in_two(spark):
    tagged = segment.with_tags(quality.with_quality(features.normalize.frame_derived(odd_frames(spark))))
    cols = ["battery_id", "sample_ts", "frame_no", "event_type", "n_msgs", "process_id"]
    carry = segment.last_processes(segment.number_processes(quality.collapse_repeats(segment.with_tags(
        frames(spark, [{"sample_ts": T0 - timedelta(hours=9), "event_type": "parking"}])), True)))
    for before in (None, carry):
        want = segment.number_processes(quality.collapse_repeats(tagged, True), carry=before).select(cols).collect()
        got = segment.collapse_and_number(tagged, carry=before).select(cols).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) > 240
    # wide frames meet repeats and numbers in a single join
    text = plan(features.prepare(odd_frames(spark), unique_numbers=True))
    assert len(re.findall("(SortMerge|BroadcastHash|ShuffledHash)Join", text)) == 1


def test_table_features_in_one_aggregate_are_those_of_the_parts(spark):
    ready = daily.prepare_day(odd_frames(spark), unique_numbers=True)
    want = features.block_features(ready)
    for part in (features.gap_features(ready), features.rank_features(ready), features.sn_histograms(ready),
                 features.rest_features(ready)):
        want = segment.join_blocks(want, part)
    got = features.table_features(ready)
    assert set(got.columns) == set(want.columns)

    def rows(df):
        maps = [f.name for f in df.schema if f.dataType.typeName() in ("map", "struct")]
        return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r])
                      for r in df.withColumns({m: F.to_json(m) for m in maps}).select(sorted(df.columns)).collect())

    assert rows(got) == rows(want)
    # ranks and histograms by hand
    effective = ready.filter("is_effective").collect()
    for r in got.filter("effect_msg_count > 0").collect():
        inside = [f for f in effective if all(f[k] == r[k] for k in BLOCK_KEY)]
        assert len(inside) == r.effect_msg_count
        vectors = [f.cell_mv for f in inside if f.cell_mv]
        numbers = [f.max_cell_sn for f in inside if f.max_cell_sn is not None]
        if vectors:
            for k in range(max(map(len, vectors))):
                ranks = [1 + sum(x is not None and x < v[k] or x is None for x in v) for v in vectors
                         if len(v) > k and v[k] is not None]
                assert r.volt_rank_mean[k] == (pytest.approx(sum(ranks) / len(ranks)) if ranks else None)
        if numbers:
            assert r.max_volt_sn_count == {n: numbers.count(n) for n in numbers}
    # no row is exploded, and no wide row of a block is joined with another
    text = plan(daily.block_table(ready, spark.createDataFrame([], "battery_type string, cell_type string, "
                                                               "battery_capacity double, battery_energy double"),
                                  datetime(2024, 1, 2), datetime(2024, 1, 2)))
    assert "Generate" not in text and len(re.findall("Join .*LeftOuter", text.split("Union")[0])) == 1


def test_daily_table_has_every_column_and_replaces_only_its_partitions(spark, tmp_path):
    static = spark.createDataFrame([("T0", "NCM", 200.0, 70.0)],
                                   "battery_type string, cell_type string, battery_capacity double, battery_energy double")
    rows = [minute(i, battery_type="T0", brand="b", event_type="charging" if i < 3 else "parking",
                   current_a=-5.0 if i < 3 else 0.0, device_type="swap_station") for i in range(12)]
    table = daily.block_table(daily.prepare_day(frames(spark, rows)), static, datetime(2024, 1, 2),
                              datetime(2024, 1, 2, 1))
    want = spark.createDataFrame([], BLOCK_FEATURES_DDL).schema
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in want]
    assert len(want) == 139
    rest = table.filter("sp_after_chg_volt_diff0 is not null").collect()
    assert [(r.event_type, r.cell_type, r.sp_after_chg_volt_diff1) for r in rest] == [("parking", "NCM", 0.0)]
    path = str(tmp_path / "blocks")
    sinks.write_blocks(table, path)
    other = table.withColumn("date", F.lit("2024-01-03"))
    sinks.write_blocks(other, path)
    sinks.write_blocks(other.limit(0).union(other), path)
    got = spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("d")).count().collect()
    assert {r["d"]: r["count"] for r in got} == {"2024-01-02": table.count(), "2024-01-03": table.count()}
