"""Sources, sinks and the daily plan, over tables written from the given data."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from cellwatch.operators import features, segment
from cellwatch.operators.alarms import as_alarms, realtime, sampling, spread
from cellwatch.plans import daily
from cellwatch.sources import frames as readers
from cellwatch.sources import sinks
from cellwatch.sources.scratch import scratch_path

from . import raw
from .registry import check
from .telemetry import KEY, KEY_SQL, frames, messages, prepared, static_dim, with_ctes

AS_OF, ETL_AT = datetime(2024, 1, 31), datetime(2024, 1, 31, 3)


def _written(spark, df, name):
    path = scratch_path(spark, name)
    df.hint("rebalance", "date", "hour").sortWithinPartitions("date", "hour").write.partitionBy("date", "hour").parquet(path)
    return path


_SPAN = (datetime(2024, 1, 5, 6), datetime(2024, 1, 9, 17))
_SCAN_SQL = """
SELECT 'B' || b AS battery_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
  count(*) AS n_frames, sum(iso_kohm) AS sum_iso FROM b1
WHERE {side} AND strftime(ts, '%Y-%m-%d %H') BETWEEN '2024-01-05 06' AND '2024-01-09 17' GROUP BY ALL"""


def _scan_view(df, battery, iso):
    return (df.groupBy(F.col(battery).alias("battery_id"), "date", "hour")
            .agg(F.count("*").alias("n_frames"), F.sum(F.col(iso).cast("double")).alias("sum_iso")))


@check("src_frames_scan", with_ctes(_SCAN_SQL.format(side="NOT station")))
def _(spark, sf):
    path = _written(spark, raw.vehicle(spark, sf), "vehicle")
    return _scan_view(readers.read_vehicle(spark, path, *_SPAN), "batteryId", "vehicleInsulatnResis")


@check("src_station_scan", with_ctes(_SCAN_SQL.format(side="station")))
def _(spark, sf):
    path = _written(spark, raw.station(spark, sf), "station")
    return _scan_view(readers.read_station(spark, path, *_SPAN), "battery_id",
                      "bms_insulation_resistance_value")


@check("src_case_bad_rows", with_ctes("""
SELECT battery_id, e % 31 = 0 OR e % 37 = 0 AS is_malformed, count(*) AS n_rows,
  sum(CASE WHEN e % 31 <> 0 AND e % 37 <> 0 THEN iso_kohm END) AS sum_iso
FROM (SELECT * REPLACE (CASE WHEN e % 31 = 0 OR e % 37 = 0 THEN NULL ELSE battery_id END AS battery_id) FROM t)
GROUP BY ALL"""))
def _(spark, sf):
    # Frames as JSON lines; some lines are cut short, some have text for a number.
    path = scratch_path(spark, "cases")
    line = F.to_json(F.struct("battery_id", F.col("frame_no").alias("case_id"), "iso_kohm"))
    broken = (F.when(F.col("frame_no") % 31 == 0, F.substr(line, F.lit(1), F.lit(20)))
              .when(F.col("frame_no") % 37 == 0, F.regexp_replace(line, "B[0-9]+\"", "B\", \"iso_kohm\": \"x\""))
              .otherwise(line))
    frames(spark, sf).select(broken.alias("value")).write.text(path)
    rows = readers.read_cases(spark, path, "json", "battery_id string, case_id bigint, iso_kohm double")
    ok = F.when(~F.col("is_malformed"), F.col("battery_id"))
    return (rows.groupBy(ok.alias("battery_id"), "is_malformed")
            .agg(F.count("*").alias("n_rows"),
                 F.sum(F.when(~F.col("is_malformed"), F.col("iso_kohm"))).alias("sum_iso")))


@check("src_retention", with_ctes("""
SELECT DISTINCT date_tag AS date, datediff('day', CAST(date_tag AS DATE), DATE '2024-02-10') AS age_days,
  datediff('day', CAST(date_tag AS DATE), DATE '2024-02-10') > 30 AS expired FROM f"""))
def _(spark, sf):
    df = frames(spark, sf).select(F.date_format("sample_ts", "yyyy-MM-dd").alias("date"))
    return readers.expired_partitions(df, date(2024, 2, 10)).withColumn(
        "age_days", F.col("age_days").cast("long"))


def _block_table(spark, sf):
    ready = daily.prepare_day(messages(spark, sf), unique_numbers=True)
    return daily.block_table(ready, static_dim(spark), AS_OF, ETL_AT)


@check("src_blocks_scan", with_ctes(f"""
, x AS (SELECT {KEY_SQL}, arg_max(source, (us, frame_no)) AS source, arg_max(brand, (us, frame_no)) AS brand,
          count(*) AS effect_msg_count FROM g GROUP BY {KEY_SQL})
SELECT battery_id, source, brand, count(*) AS n_blocks, CAST(sum(effect_msg_count) AS BIGINT) AS n_frames
FROM x WHERE source = 'vehicle' AND brand IN ('brand0', 'brand1') GROUP BY ALL"""))
def _(spark, sf):
    path = scratch_path(spark, "blocks")
    blocks = features.block_features(prepared(spark, sf)).filter("effect_msg_count > 0").select(
        *KEY, "source", "brand", "effect_msg_count", F.lit("2024-01-31").alias("date"))
    sinks.write_blocks(blocks, path)
    got = readers.read_blocks(spark, path, dates=["2024-01-31"], sources=["vehicle"],
                              brands=["brand0", "brand1"])
    return got.groupBy("battery_id", "source", "brand").agg(
        F.count("*").alias("n_blocks"), F.sum("effect_msg_count").alias("n_frames"))


@check("plan_daily_blocks")
def _(spark, sf):
    """The whole block table of 139 columns; its parts have oracles of their own."""
    df = _block_table(spark, sf)
    maps = [f.name for f in df.schema if f.dataType.typeName() in ("map", "array")]
    return df.withColumns({m: F.to_json(m) for m in maps})


@check("snk_blocks", with_ctes(f"""
SELECT date_tag, count(*) AS n_blocks, CAST(sum(n) AS BIGINT) AS n_msgs, max(run) AS run FROM (
  SELECT {KEY_SQL}, sum(n_msgs) AS n, CASE WHEN date_tag >= '2024-01-20' THEN 2 ELSE 1 END AS run
  FROM f GROUP BY {KEY_SQL}) GROUP BY date_tag"""))
def _(spark, sf):
    # Written twice; the second run replaces the later days only.
    path = scratch_path(spark, "daily")
    counts = features.block_features(prepared(spark, sf)).select(*KEY, "source", "brand", "block_msg_count")
    first = counts.select(*KEY, "block_msg_count", F.lit(1).alias("run"), F.col("date_tag").alias("date"),
                          F.lit("all").alias("source"), F.lit("all").alias("brand"))
    sinks.write_blocks(first, path)
    sinks.write_blocks(first.filter("date >= '2024-01-20'").withColumn("run", F.lit(2)), path)
    got = spark.read.parquet(path)
    return got.groupBy("date_tag").agg(F.count("*").alias("n_blocks"),
                                       F.sum("block_msg_count").alias("n_msgs"), F.max("run").alias("run"))


_EVENT = "sha256(concat_ws('#', process_id, device_name, battery_id, event_type))"


@check("snk_alarms", with_ctes(f"""
, al AS (SELECT date_tag AS date, 'ap13' AS algorithm, {_EVENT} AS event_id, device_id FROM f
  WHERE abs(pack_voltage_v - list_sum(mv) / 1000) > 20
UNION ALL SELECT date_tag, 'ap16', {_EVENT}, device_id FROM f WHERE
  (hot_c > 55 OR temp_diff_c > 30) AND (lo_mv < 1300 OR hi_mv > 4500 OR volt_diff_mv > 300)
  OR (hot_c > 55 OR temp_diff_c > 30 OR lo_mv < 1300 OR hi_mv > 4500 OR volt_diff_mv > 300)
     AND ((iso_kohm > 0 AND iso_kohm < 100) OR (is_missing AND iso_kohm <> 0))
UNION ALL SELECT min(date_tag), 'ap8', any_value({_EVENT}), any_value(device_id) FROM g WHERE event_type = 'charging'
  GROUP BY battery_id, process_id HAVING count_if(volt_diff_mv > 100) > 1)
SELECT date, algorithm, count(*) AS n_alarms, count(DISTINCT event_id) AS n_events, min(event_id) AS first_event,
  count(DISTINCT device_id) AS n_devices FROM al GROUP BY ALL"""))
def _(spark, sf):
    """Alarms of frames and of processes, each with the event and the device it belongs to."""
    path = scratch_path(spark, "alarms")
    ready = segment.with_event_id(prepared(spark, sf))
    events = segment.events(ready)
    charges = spread.high_spread(ready).drop("device_id")
    for name, rows, at, seen in (
            ("ap16", realtime.thermal_runaway(ready), F.col("sample_ts"), ["hot_c", "volt_diff_mv"]),
            ("ap13", sampling.pack_voltage(ready), F.col("sample_ts"), ["pack_gap_v"]),
            ("ap8", charges, F.to_timestamp("date_tag"), ["n_high"])):
        sinks.write_alarms(as_alarms(rows.filter("fired"), name, at, seen, events=events), path)
    return (spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date"), "algorithm")
            .agg(F.count("*").alias("n_alarms"), F.count_distinct("event_id").alias("n_events"),
                 F.min("event_id").alias("first_event"), F.count_distinct("device_id").alias("n_devices")))


