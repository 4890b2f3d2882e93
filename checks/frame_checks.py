"""Normalisation, quality and segmentation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from cellwatch.functions import tags
from cellwatch.operators import features, normalize, quality, segment

from . import raw
from .registry import check
from .telemetry import KEY, KEY_SQL, frames, messages, prepared, static_dim, table, with_ctes



def us():
    return F.unix_micros("sample_ts").alias("us")


def _at(vector: str, name: str):
    return [F.get(vector, 0).alias(f"{name}_1"), F.get(vector, 5).alias(f"{name}_6"),
            F.size(vector).alias(f"n_{name}")]


_CANONICAL = ["battery_id", "device_id", "device_name", "device_type", "source", "event_type",
              "user_soc", "real_soc", "soh", "real_energy", "current_a", "pack_voltage_v",
              "max_cell_v", "max_cell_sn", "min_cell_v", "min_cell_sn", "avg_cell_v", "max_temp_c",
              "max_temp_sn", "min_temp_c", "min_temp_sn", "iso_kohm", "iso_level", "is_balancing",
              "charge_state", "mileage", "speed", "bms_version", "device_version", "coolant_in_c",
              "coolant_out_c", "n_cells", "n_probes"]
_CANONICAL_ROUNDS = ["user_soc", "real_soc", "real_energy", "current_a", "pack_voltage_v",
                     "max_cell_v", "min_cell_v", "avg_cell_v", "cell_1", "cell_6", "probe_1",
                     "probe_6", "coolant_in_c", "coolant_out_c", "speed"]


def _canonical_view(df):
    return df.select(*_CANONICAL, us(), *_at("cell_v", "cell"), *_at("probe_temp_c", "probe"))


_COMMON_SQL = """
  'B' || b AS battery_id, 'D' || b AS device_id,
  CAST(k AS DOUBLE) AS user_soc, CAST(k - 1 AS DOUBLE) AS real_soc, 95.0::DOUBLE AS soh,
  k * 0.5::DOUBLE AS real_energy,
  list_max(mv) / 1000.0 AS max_cell_v, list_min(mv) / 1000.0 AS min_cell_v,
  CAST(list_position(mv, list_max(mv)) AS INT) AS max_cell_sn,
  CAST(list_position(mv, list_min(mv)) AS INT) AS min_cell_sn,
  list_max(temps) AS max_temp_c, list_min(temps) AS min_temp_c,
  CAST(list_position(temps, list_max(temps)) AS INT) AS max_temp_sn,
  CAST(list_position(temps, list_min(temps)) AS INT) AS min_temp_sn,
  iso_kohm, k % 3 AS iso_level, e % 7 < 2 AS is_balancing, 'd' || (e // 3000) AS device_version,
  CAST(20 + k % 5 AS DOUBLE) AS coolant_in_c, CAST(22 + k % 5 AS DOUBLE) AS coolant_out_c,
  12 AS n_cells, 6 AS n_probes, mv[1] / 1000.0 AS cell_1, mv[6] / 1000.0 AS cell_6, 12 AS n_cell,
  temps[1] AS probe_1, temps[6] AS probe_6, 6 AS n_probe"""

_VEHICLE_SQL = f"""SELECT {_COMMON_SQL}, 'N' || b AS device_name, 'vehicle' AS device_type,
  'vehicle' AS source, event_type,
  CAST(CASE WHEN event_type = 'charging' THEN -50 - k ELSE 20 + k END AS DOUBLE) AS current_a,
  list_sum(mv) / 1000.0 AS pack_voltage_v, list_sum(mv) / 12000.0 AS avg_cell_v,
  k % 4 AS charge_state,
  CAST(1000 + e AS INT) AS mileage, CAST(k AS DOUBLE) AS speed,
  CAST(NULL AS VARCHAR) AS bms_version, epoch_us(ts) AS us FROM b1 WHERE NOT station"""

_STATION_SQL = f"""SELECT {_COMMON_SQL}, 'D' || b AS device_name, 'swap_station' AS device_type,
  'station' AS source, event_type,
  CAST(CASE WHEN event_type = 'charging' THEN -50 - k ELSE 0 END AS DOUBLE) AS current_a,
  CAST(CASE WHEN e % 59 = 0 THEN 0 WHEN e % 37 = 0 THEN 420 ELSE 240 + k END AS DOUBLE)
    AS pack_voltage_v, floor(list_sum(mv) / 120) / 100 AS avg_cell_v,
  CASE WHEN event_type = 'charging' THEN 1 ELSE 0 END AS charge_state,
  CAST(NULL AS INT) AS mileage, CAST(NULL AS DOUBLE) AS speed, 'v' || (e // 5000) AS bms_version,
  epoch_us(ts) // 1000 * 1000 AS us FROM b1 WHERE station"""


@check("nrm_vehicle_frame", with_ctes(_VEHICLE_SQL), rounds=_CANONICAL_ROUNDS)
def _(spark, sf):
    return _canonical_view(normalize.vehicle_to_frame(raw.vehicle(spark, sf)))


@check("nrm_station_frame", with_ctes(_STATION_SQL), rounds=_CANONICAL_ROUNDS, digits=4)
def _(spark, sf):
    return _canonical_view(normalize.station_to_frame(raw.station(spark, sf)))


@check("nrm_union_sources", with_ctes("""
SELECT battery_id, source, device_type, event_type, count(*) AS n_frames, min(us) AS first_us,
       max(us) AS last_us, sum(iso_kohm) AS sum_iso
FROM (SELECT * REPLACE (CASE WHEN station THEN us // 1000 * 1000 ELSE us END AS us) FROM t)
GROUP BY ALL"""), rounds=["sum_iso"])
def _(spark, sf):
    both = normalize.frames(normalize.vehicle_to_frame(raw.vehicle(spark, sf)),
                            normalize.station_to_frame(raw.station(spark, sf)))
    return (both.groupBy("battery_id", "source", "device_type", "event_type")
            .agg(F.count("*").alias("n_frames"), F.unix_micros(F.min("sample_ts")).alias("first_us"),
                 F.unix_micros(F.max("sample_ts")).alias("last_us"),
                 F.sum("iso_kohm").alias("sum_iso")))


@check("nrm_pack_assembly", with_ctes("""
SELECT battery_id, epoch_us(ts) AS us, len(c) AS n_cells, c[1] AS cell_1, c[6] AS cell_6,
       c[12] AS cell_12, len(c) = 12 AS is_complete
FROM (SELECT 'B' || b AS battery_id, ts,
             CASE WHEN e % 19 = 0 THEN mv[1:8] ELSE mv END AS c FROM b1)"""))
def _(spark, sf):
    # Each pack arrives as three lists of four cells, last first; some lose the last list,
    # and some lists are sent twice.
    parts = (frames(spark, sf).selectExpr(
        "battery_id", "sample_ts", "1 AS pack_sn", "frame_no",
        "transform(cell_v, x -> rint(x * 1e6) / 1e3) AS mv",
        "explode(if(frame_no % 7 = 0, array(2, 1, 0, 0), array(2, 1, 0))) AS part")
        .filter("not (frame_no % 19 = 0 and part = 2)")
        .selectExpr("battery_id", "sample_ts", "pack_sn", "part * 4 + 1 AS start_sn",
                    "slice(mv, part * 4 + 1, 4) AS cells", "12 AS declared"))
    packs = normalize.assemble_pack(parts, ("battery_id", "sample_ts", "pack_sn"), "start_sn",
                                    "cells", "declared")
    return packs.select("battery_id", us(), F.size("cells").alias("n_cells"),
                        F.get("cells", 0).alias("cell_1"), F.get("cells", 5).alias("cell_6"),
                        F.get("cells", 11).alias("cell_12"), "is_complete")


@check("nrm_enum_decode", with_ctes("""
SELECT e, ['NOT_PRESSED', 'PRESSED', 'RESERVERD', 'ERROR'][k % 4 + 1] AS brake,
  ['BRK_PED_VALID', 'BRK_PED_INVALID'][k % 2 + 1] AS brake_valid,
  ['automatic mode', 'economy mode', 'comfort mode', 'sport mode', 'invalid'][k % 5 + 1] AS drive,
  ['no charging', 'charge processing', 'charge complete', 'charge fault'][k % 4 + 1] AS charge,
  ['parking charging', 'driving charging', 'not charging', 'charge complete', 'abnormal', 'invalid']
    [k % 6 + 1] AS vehicle_charge,
  ['working', 'disconnected', 'abnormal', 'invalid'][k % 4 + 1] AS dcdc,
  ['pure electric', 'hydride', 'fuel', 'abnormal', 'invalid'][k % 5 + 1] AS operation,
  ['driving', 'parked vehicle', 'driver present', 'sw update', 'abnormal', 'invalid'][k % 6 + 1]
    AS vehicle_state,
  ['NO_REQUEST', 'NORMAL', 'AC', 'DC', 'POWER_EXPRESS', 'INVALID'][k % 6 + 1] AS charger,
  ['nt1', 'nt2'][b % 2 + 1] AS platform FROM b1 WHERE NOT station"""))
def _(spark, sf):
    names = {"drivingBrkPedalState": "brake", "drivingBrkPedalValid": "brake_valid",
             "drivingVehDrvgMod": "drive", "socChrgState": "charge",
             "vehicleChrgState": "vehicle_charge", "vehicleDcDcSts": "dcdc",
             "vehicleOprtnMode": "operation", "vehicleVehlState": "vehicle_state",
             "chargingChargerType": "charger", "platformType": "platform"}
    df = normalize.decode_enums(raw.vehicle(spark, sf, "e"))
    return df.select("e", *[F.col(f"{c}_label").alias(n) for c, n in names.items()])


@check("nrm_invalid_null", with_ctes("""
SELECT e, CASE WHEN k % 4 < 2 THEN k % 4 END AS brake, CASE WHEN k % 5 < 4 THEN k % 5 END AS drive,
  CASE WHEN k % 6 < 4 THEN k % 6 + 1 END AS vehicle_charge, CASE WHEN k % 4 < 2 THEN k % 4 + 1 END AS dcdc,
  CASE WHEN k % 5 < 3 THEN k % 5 + 1 END AS operation, CASE WHEN k % 6 < 4 THEN k % 6 + 1 END AS vehicle_state,
  CASE WHEN k % 6 < 5 THEN k % 6 END AS charger FROM b1 WHERE NOT station"""))
def _(spark, sf):
    names = {"drivingBrkPedalState": "brake", "drivingVehDrvgMod": "drive",
             "vehicleChrgState": "vehicle_charge", "vehicleDcDcSts": "dcdc",
             "vehicleOprtnMode": "operation", "vehicleVehlState": "vehicle_state",
             "chargingChargerType": "charger"}
    df = normalize.null_invalid(raw.vehicle(spark, sf, "e"))
    return df.select("e", *[F.col(c).cast("int").alias(n) for c, n in names.items()])


@check("nrm_units", with_ctes("""
SELECT frame_no, max_cell_v * 1000 AS max_cell_mv, lo_mv AS min_cell_mv, mean_mv AS avg_cell_mv
FROM d WHERE frame_no < 1000000000000"""), rounds=["max_cell_mv", "min_cell_mv", "avg_cell_mv"], digits=2)
def _(spark, sf):
    df = normalize.frame_derived(frames(spark, sf))
    return normalize.to_mv(df, ["max_cell_v", "min_cell_v", "avg_cell_v"]).select(
        "frame_no", "max_cell_mv", "min_cell_mv", "avg_cell_mv")


@check("nrm_alarm_explode", with_ctes("""
SELECT 'B' || b AS battery_id, k % 8 AS alarm_id, count(*) AS n_alarms, max(k % 4) AS max_level
FROM b1 WHERE NOT station GROUP BY ALL"""))
def _(spark, sf):
    counts = normalize.alarm_counts(raw.vehicle(spark, sf), ["batteryId"])
    return counts.select(F.col("batteryId").alias("battery_id"), F.col("alarm_id").cast("int"),
                         "n_alarms", F.col("max_level").cast("int"))


@check("nrm_sensor_zip", with_ctes("""
SELECT e, 'C' || unnest(range(1, 13)) AS sensor, unnest(mv) / 1000.0 AS reading
FROM b1 WHERE station"""), rounds=["reading"], digits=4)
def _(spark, sf):
    rows = normalize.sensor_rows(raw.station(spark, sf, "e"), "cell_voltage_sensor_data_index",
                                 "cell_voltage_sensor_data")
    return rows.select("e", "sensor", F.col("reading").cast("double").alias("reading"))


@check("nrm_dual_pack", with_ctes("""
SELECT e, CASE WHEN e % 3 = 2 THEN hi + 1 ELSE hi END / 1000.0 AS hi_v,
       CASE WHEN e % 3 = 2 THEN k % 12 + 1 ELSE list_position(mv, hi) END AS hi_v_sn,
       CASE WHEN e % 3 = 2 THEN 'B' ELSE 'A' END AS hi_v_pack,
       CASE WHEN e % 3 = 0 THEN lo - 1 ELSE lo END / 1000.0 AS lo_v,
       CASE WHEN e % 3 = 0 THEN k % 11 + 1 ELSE list_position(mv, lo) END AS lo_v_sn,
       CASE WHEN e % 3 = 0 THEN 'B' ELSE 'A' END AS lo_v_pack
FROM (SELECT *, list_max(mv) AS hi, list_min(mv) AS lo FROM b1 WHERE NOT station)"""),
       rounds=["hi_v", "lo_v"])
def _(spark, sf):
    df = normalize.merge_dual_pack(raw.vehicle(spark, sf, "e"), [
        ("max", "hi_v", "extremumSinBtryHistVolt", "extremumHistVoltSinglBtrySn",
         "bmsCellVoltgMaxB", "bmsMaximumCellVoltageNumberB"),
        ("min", "lo_v", "extremumSinBtryLwstVolt", "extremumLwstVoltSinglBtrySn",
         "bmsCellVoltgMinB", "bmsMinimumCellVoltageNumberB")])
    return df.select("e", "hi_v", "hi_v_sn", "hi_v_pack", "lo_v", "lo_v_sn", "lo_v_pack")


@check("nrm_epoch", with_ctes("""
SELECT e, epoch_us(ts) // 1000 * 1000 AS sample_us,
  (epoch_us(ts) // 1000 - 1000 * k) * 1000 AS start_us,
  (epoch_us(ts) // 1000000 + k) * 1000000 AS end_us,
  epoch_us(ts) // 1000000 * 1000000 AS discharge_us,
  (epoch_us(ts) // 1000 + 60000) * 1000 AS ready_us FROM b1 WHERE station"""))
def _(spark, sf):
    cols = {"time_stamp": "sample_us", "charging_start_time": "start_us",
            "charging_end_time": "end_us", "discharging_start_timestamp": "discharge_us",
            "expected_charging_ready_time": "ready_us"}
    df = normalize.epoch_to_ts(raw.station(spark, sf, "e"), list(cols))
    return df.select("e", *[F.unix_micros(f"{c}_ts").alias(n) for c, n in cols.items()])


@check("nrm_static_join", with_ctes("""
SELECT frame_no, kind AS battery_type,
  CASE kind WHEN 'T0' THEN 'NCM' WHEN 'T1' THEN 'LFP' END AS cell_type,
  CAST(CASE kind WHEN 'T0' THEN 200 WHEN 'T1' THEN 210 END AS DOUBLE) AS battery_capacity,
  CAST(CASE kind WHEN 'T0' THEN 70 WHEN 'T1' THEN 75 END AS DOUBLE) AS battery_energy
FROM (SELECT *, CASE WHEN e % 10 = 0 THEN 'T9' ELSE battery_type END AS kind FROM t)"""))
def _(spark, sf):
    df = frames(spark, sf).withColumn(
        "battery_type", F.when(F.col("frame_no") % 10 == 0, "T9").otherwise(F.col("battery_type")))
    return normalize.enrich_static(df, static_dim(spark)).select(
        "frame_no", "battery_type", "cell_type", "battery_capacity", "battery_energy")


_DERIVED = ["hi_mv", "lo_mv", "mean_mv", "median_mv", "volt_diff_mv", "deviation_mv", "hot_c",
            "cold_c", "mean_c", "temp_diff_c"]


@check("nrm_frame_derived", with_ctes(f"""
SELECT frame_no, {", ".join(_DERIVED)}, hi_sn, lo_sn, hot_sn, cold_sn FROM d
WHERE frame_no < 1000000000000"""), rounds=_DERIVED)
def _(spark, sf):
    return normalize.frame_derived(frames(spark, sf)).select(
        "frame_no", *_DERIVED, "hi_sn", "lo_sn", "hot_sn", "cold_sn")


@check("nrm_current_class", with_ctes("""
SELECT battery_id, CASE WHEN current_a < 0 THEN 'charge' WHEN current_a > 0 THEN 'discharge'
  ELSE 'rest' END AS current_class, count(*) AS n_frames FROM t GROUP BY ALL"""))
def _(spark, sf):
    return (normalize.current_class(frames(spark, sf)).groupBy("battery_id", "current_class")
            .agg(F.count("*").alias("n_frames")))


# --- quality -----------------------------------------------------------------------------


def _flagged(spark, sf):
    return quality.with_quality(normalize.frame_derived(frames(spark, sf)))


@check("qlt_init_flags", with_ctes("""
SELECT frame_no, cell_init, probe_init, cold_init, iso_init FROM d WHERE frame_no < 1000000000000"""))
def _(spark, sf):
    return _flagged(spark, sf).select("frame_no", "cell_init", "probe_init", "cold_init", "iso_init")


@check("qlt_valid_frames", with_ctes("""
SELECT frame_no, battery_id FROM d WHERE frame_no < 1000000000000 AND is_sound"""))
def _(spark, sf):
    return quality.valid_frames(normalize.frame_derived(frames(spark, sf))).select(
        "frame_no", "battery_id")


@check("qlt_dedup", with_ctes("SELECT frame_no, battery_id, us, pack_voltage_v FROM u"),
       rounds=["pack_voltage_v"])
def _(spark, sf):
    return quality.dedup_frames(messages(spark, sf), unique_numbers=True).select(
        "frame_no", "battery_id", us(), "pack_voltage_v")


@check("qlt_aligned", with_ctes("SELECT frame_no, battery_id, n_cells FROM t WHERE n_cells = 12"))
def _(spark, sf):
    return quality.aligned_frames(frames(spark, sf)).select("frame_no", "battery_id", "n_cells")


@check("qlt_msg_counts", with_ctes(f"""
SELECT {KEY_SQL}, CAST(sum(n_msgs) AS INT) AS block_msg_count,
  CAST(count_if(is_effective) AS INT) AS effect_msg_count,
  CAST(sum(n_msgs) - count_if(is_effective) AS INT) AS fault_msg_count FROM f GROUP BY ALL"""))
def _(spark, sf):
    return quality.msg_counts(prepared(spark, sf), KEY)


@check("qlt_station_flags", with_ctes("""
SELECT e, CAST(list_max(temps) > 50 AS INT) AS hot, CAST(list_min(temps) < -30 AS INT) AS cold,
  CAST(v = 0 AS INT) AS zero, CAST(v > 410 AS INT) AS high, CAST(v < 250 AS INT) AS low
FROM (SELECT *, CASE WHEN e % 59 = 0 THEN 0 WHEN e % 37 = 0 THEN 420 ELSE 240 + k END AS v
      FROM b1 WHERE station)"""))
def _(spark, sf):
    return quality.station_flags(raw.station(spark, sf, "e")).select(
        "e", F.col("is_temp_gt_50").alias("hot"), F.col("is_temp_lt_minus_30").alias("cold"),
        F.col("is_voltage_eq_0").alias("zero"), F.col("is_voltage_gt_410").alias("high"),
        F.col("is_voltage_lt_250").alias("low"))


@check("qlt_jump", with_ctes("""
SELECT frame_no, CAST(coalesce(abs(user_soc - lag(user_soc) OVER w) > 5, false) AS INT) AS is_soc_jumping,
  CAST(coalesce(abs(pack_voltage_v - lag(pack_voltage_v) OVER w) > 20, false) AS INT)
    AS is_voltage_jumping,
  CAST(coalesce(abs(user_soc - lag(user_soc) OVER s) > 5, false) AS INT) AS is_soc_jumping_slot,
  CAST(coalesce(abs(pack_voltage_v - lag(pack_voltage_v) OVER s) > 20, false) AS INT)
    AS is_voltage_jumping_slot
FROM t WINDOW w AS (PARTITION BY battery_id ORDER BY ts, frame_no),
              s AS (PARTITION BY device_id, k % 3 ORDER BY ts, frame_no)"""))
def _(spark, sf):
    df = frames(spark, sf).select("frame_no", "sample_ts", "battery_id", "device_id", "user_soc",
                                  "pack_voltage_v")
    events = table(spark, sf, "events").selectExpr(
        "event_id AS frame_no", "cast(get_json_object(props, '$.k') AS int) % 3 AS slot_id")
    df = quality.jump_flags(df.join(events, "frame_no"))
    df = quality.jump_flags(df, keys=("device_id", "slot_id"), out="_slot")
    return df.select("frame_no", "is_soc_jumping", "is_voltage_jumping", "is_soc_jumping_slot",
                     "is_voltage_jumping_slot")


@check("qlt_missing_ratio", with_ctes("""
SELECT frame_no, cell_missing_share, probe_missing_share, is_missing FROM d
WHERE frame_no < 1000000000000"""), rounds=["cell_missing_share", "probe_missing_share"])
def _(spark, sf):
    return _flagged(spark, sf).select("frame_no", "cell_missing_share", "probe_missing_share",
                                      "is_missing")


@check("qlt_pack_gap", with_ctes("""
SELECT frame_no, abs(pack_voltage_v - list_sum(mv) / 1000.0) AS pack_gap_v FROM t"""),
       rounds=["pack_gap_v"])
def _(spark, sf):
    return quality.pack_sum_gap(frames(spark, sf)).select("frame_no", "pack_gap_v")


# --- segmentation ------------------------------------------------------------------------


@check("blk_hour_tag", with_ctes("SELECT frame_no, slot AS hour_tag FROM t"))
def _(spark, sf):
    return frames(spark, sf).select("frame_no", tags.hour_tag(F.col("sample_ts")).alias("hour_tag"))


@check("blk_soc_tag", with_ctes("""
SELECT frame_no, CAST(least(floor(user_soc / 5), 19) AS INT) AS soc_tag,
       CAST(least(floor((frame_no % 101) / 5), 19) AS INT) AS full_range_tag FROM t"""))
def _(spark, sf):
    return frames(spark, sf).select(
        "frame_no", tags.soc_tag(F.col("user_soc")).alias("soc_tag"),
        tags.soc_tag((F.col("frame_no") % 101).cast("double")).alias("full_range_tag"))


@check("blk_curr_tag", with_ctes("""
SELECT frame_no, CASE WHEN current_a < -100 THEN 0 WHEN current_a < 0 THEN 1 WHEN current_a = 0
  THEN 2 WHEN current_a < 100 THEN 3 ELSE 4 END AS curr_tag FROM t"""))
def _(spark, sf):
    return frames(spark, sf).select("frame_no", tags.curr_tag(F.col("current_a")).alias("curr_tag"))


@check("blk_date_tag", with_ctes("SELECT frame_no, strftime(ts, '%Y-%m-%d') AS date_tag FROM t"))
def _(spark, sf):
    return frames(spark, sf).select("frame_no", tags.date_tag(F.col("sample_ts")).alias("date_tag"))


@check("blk_process_id", with_ctes("SELECT frame_no, battery_id, event_type, process_id FROM f"))
def _(spark, sf):
    return prepared(spark, sf).select("frame_no", "battery_id", "event_type", "process_id")


@check("blk_event_id", with_ctes("""
SELECT DISTINCT battery_id, process_id, sha256(concat_ws('#', CAST(process_id AS VARCHAR), device_name,
  battery_id, event_type)) AS event_id FROM f"""))
def _(spark, sf):
    return segment.with_event_id(prepared(spark, sf)).select(
        "battery_id", "process_id", "event_id").distinct()


@check("blk_event_id_two_days", with_ctes("""
SELECT DISTINCT battery_id, process_id, sha256(concat_ws('#', CAST(process_id AS VARCHAR), device_name,
  battery_id, event_type)) AS event_id FROM f"""))
def _(spark, sf):
    """Two runs, cut in the middle of a slot: the second goes on from the first one's carry."""
    cut = F.lit("2024-01-15 13:00:00").cast("timestamp")
    both = messages(spark, sf)
    one = features.prepare(both.filter(F.col("sample_ts") < cut), unique_numbers=True)
    two = features.prepare(both.filter(F.col("sample_ts") >= cut), unique_numbers=True,
                           carry=segment.last_processes(one))
    return segment.with_event_id(one.unionByName(two)).select("battery_id", "process_id", "event_id").distinct()


@check("blk_features_core", with_ctes(f"""
SELECT {KEY_SQL}, any_value(event_type) AS event_type, any_value(device_id) AS device_id,
  CAST(sum(n_msgs) AS INT) AS block_msg_count, CAST(count_if(is_effective) AS INT) AS effect_msg_count,
  max(volt_diff_mv) FILTER (is_effective) / 1000 AS max_volt_diff,
  min(volt_diff_mv) FILTER (is_effective) / 1000 AS min_volt_diff,
  avg(volt_diff_mv) FILTER (is_effective) / 1000 AS avg_volt_diff,
  arg_max(us, (volt_diff_mv, -us, -frame_no)) FILTER (is_effective) AS max_volt_diff_us
FROM f GROUP BY {KEY_SQL}"""), rounds=["max_volt_diff", "min_volt_diff", "avg_volt_diff"])
def core(spark, sf):
    return features.block_features(prepared(spark, sf)).select(
        *KEY, "event_type", "device_id", "block_msg_count", "effect_msg_count", "max_volt_diff",
        "min_volt_diff", "avg_volt_diff", F.unix_micros("max_volt_diff_time").alias("max_volt_diff_us"))


@check("blk_bookkeeping", with_ctes(f"""
SELECT {KEY_SQL}, 1706659200000000 AS exp_us, 1706670000000000 AS etl_us, '2024-01-31' AS exp_date,
  '2024-01-31' AS "date", arg_max(source, (us, frame_no)) FILTER (is_effective) AS source,
  arg_max(brand, (us, frame_no)) FILTER (is_effective) AS brand FROM f GROUP BY {KEY_SQL}"""))
def _(spark, sf):
    blocks = features.block_features(prepared(spark, sf)).select(*KEY, "source", "brand")
    df = segment.with_bookkeeping(blocks, datetime(2024, 1, 31), datetime(2024, 1, 31, 3))
    return df.select(*KEY, F.unix_micros("exp_time").alias("exp_us"),
                     F.unix_micros("dw_etl_time").alias("etl_us"), "exp_date", "date", "source", "brand")
