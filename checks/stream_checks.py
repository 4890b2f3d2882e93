"""Streaming forms, each run over the events as a stream and compared with its batch twin."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellwatch.operators.segment import BLOCK_KEY
from cellwatch.params import DEFAULTS
from cellwatch.sources import sinks
from cellwatch.sources.frames import stream_frames
from cellwatch.sources.scratch import materialize, scratch_path
from cellwatch.streaming import live

from .alarm_checks import _COND
from .feature_checks import REST_CTES
from .registry import check
from .telemetry import frames_of, spread, table, with_copies, with_ctes

PARTS = 3


def us():
    return F.unix_micros("sample_ts").alias("us")


class Arrivals(NamedTuple):
    """Events as a stream, and what writes a part of them to where the stream looks."""

    stream: DataFrame
    arrive: Callable[[int], None]


def _arrivals(spark: SparkSession, sf_dir: str, late_every: int | None = None) -> Arrivals:
    """Events in ``PARTS`` parts by time, each dealt to as many files as the session deals rows to.

    With ``late_every``, every so many-th event of the first part arrives with the last one.
    """
    path = scratch_path(spark, "arrivals")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    first, last = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    days = (last - first).days + 1
    part = F.floor(F.date_diff("ts", F.lit(first)) * PARTS / days).cast("int")
    if late_every:
        part = F.when((part == 0) & (F.col("event_id") % late_every == 0), PARTS - 1).otherwise(part)
    held = materialize(spread(events.withColumn("part", part), "event_id"), "events", ("part",))
    held.limit(0).drop("part").write.parquet(path)

    def arrive(i: int) -> None:
        held.filter(F.col("part") == i).drop("part").write.mode("append").parquet(path)

    return Arrivals(stream_frames(spark, path, events.schema), arrive)


def _each_part(arrivals: Arrivals, start: Callable[[], StreamingQuery]) -> None:
    """Lets a part arrive and runs the query over it, one part after the other."""
    for i in range(PARTS):
        arrivals.arrive(i)
        start().awaitTermination()


def _to_table(arrivals: Arrivals, df: DataFrame, name: str) -> DataFrame:
    """Runs an append-mode stream to its end into a table of the shared folder."""
    spark = df.sparkSession
    path, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    _each_part(arrivals, lambda: df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
               .option("checkpointLocation", state).start(path))
    return spark.read.schema(df.schema).parquet(path)


def _by_batch(arrivals: Arrivals, writer, name: str, p=DEFAULTS) -> DataFrame:
    """Runs a ``foreachBatch`` stream over the frames of all events to its end; the rows of all batches."""
    df = frames_of(arrivals.stream)
    spark = df.sparkSession
    out, carry, state = (scratch_path(spark, f"{name}-{k}") for k in ("rows", "carry", "state"))
    _each_part(arrivals, lambda: df.writeStream.foreachBatch(writer(out, carry, p=p)).trigger(availableNow=True)
               .option("checkpointLocation", state).start())
    return spark.read.parquet(out)


@check("str_ap16", with_ctes(f"""
, c AS (SELECT frame_no, battery_id, iso_kohm, is_missing, {_COND} FROM d WHERE frame_no < 1000000000000),
r AS (SELECT frame_no, battery_id, (hot OR temp_wide) AND (cell_limit OR wide) AS c1,
  (hot OR temp_wide OR cell_limit OR wide) AND low_iso AS c2,
  (hot OR temp_wide OR cell_limit OR wide) AND is_missing AND iso_kohm <> 0 AS c3 FROM c)
SELECT * FROM r WHERE c1 OR c2 OR c3"""))
def _(spark, sf):
    came = _arrivals(spark, sf)
    return _to_table(came, live.thermal_runaway(frames_of(came.stream)).filter("fired").select(
        "frame_no", "battery_id", "c1", "c2", "c3"), "ap16")


_SLOTS = """SELECT battery_id, event_type, us // 7200000000 * 7200000000 AS slot_us, count(*) AS n_frames,
  max(volt_diff_mv) AS max_volt_diff_mv, max(temp_diff_c) AS max_temp_diff_c, avg(current_a) AS avg_current_a
FROM d WHERE frame_no < 1000000000000 GROUP BY ALL"""


def _slot_view(df):
    return df.select("battery_id", "event_type", F.unix_micros("slot_start").alias("slot_us"), "n_frames",
                     "max_volt_diff_mv", "max_temp_diff_c", "avg_current_a")


@check("str_blocks", with_ctes("""
SELECT battery_id, device_id, process_id, event_type, date_tag, hour_tag, soc_tag, curr_tag, count(*) AS n_frames,
  min(us) AS start_us, max(us) AS end_us, max(volt_diff_mv) AS max_volt_diff_mv, max(temp_diff_c) AS max_temp_diff_c,
  avg(current_a) AS avg_current_a FROM g GROUP BY ALL"""), rounds=["avg_current_a"])
def _(spark, sf):
    """The live blocks of all batches are those of the batch job, on the whole block key."""
    rows = _by_batch(_arrivals(spark, sf), partial(live.block_writer, collapse=False), "blocks")
    return live.merged_blocks(rows).select(
        *BLOCK_KEY, "n_frames", F.unix_micros("start_time").alias("start_us"), F.unix_micros("end_time").alias("end_us"),
        "max_volt_diff_mv", "max_temp_diff_c", "avg_current_a")


@check("str_ap21", with_ctes(f"""
, c AS (SELECT battery_id, us, frame_no, is_missing, {_COND} FROM d WHERE frame_no < 1000000000000),
r AS (SELECT frame_no, battery_id, sum(hot::INT + temp_wide::INT + cell_limit::INT + wide::INT + low_iso::INT
    + is_missing::INT) OVER (PARTITION BY battery_id ORDER BY us, frame_no
    ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)::DOUBLE AS factor FROM c)
SELECT *, factor > 10 AS fired FROM r"""))
def _(spark, sf):
    rows = _by_batch(_arrivals(spark, sf), live.hazard_writer, "ap21")
    return rows.select("frame_no", "battery_id", "factor", "fired")


@check("str_insulation", with_ctes("""
, i AS (SELECT *, sum(CASE WHEN iso_kohm < 100 THEN 0 ELSE 1 END)
          OVER (PARTITION BY battery_id ORDER BY us, frame_no) AS island FROM t WHERE iso_kohm > 0)
SELECT battery_id, count(*) AS n_frames, min(us) AS start_us, max(us) AS end_us, min(iso_kohm) AS min_iso
FROM i WHERE iso_kohm < 100 GROUP BY battery_id, island HAVING count(*) >= 3"""))
def _(spark, sf):
    rows = _by_batch(_arrivals(spark, sf), live.insulation_writer, "iso")
    return live.latest_runs(rows).filter("n_frames >= 3").select(
        "battery_id", "n_frames", F.unix_micros("start_ts").alias("start_us"),
        F.unix_micros("end_ts").alias("end_us"), "min_iso")


@check("str_rest_pair", with_ctes(REST_CTES + """
SELECT battery_id, process_id, at0.us AS t0_us, at1.us AS t1_us, diff0 AS sp_after_chg_volt_diff0,
  diff1 AS sp_after_chg_volt_diff1, drop_rate AS spafchg_volt_drop_rate, outlier AS spafchg_outlier_rate
FROM pairs WHERE device_type = 'swap_station' AND prev_event_type = 'charging' AND at1 IS NOT NULL"""),
       rounds=["sp_after_chg_volt_diff0", "sp_after_chg_volt_diff1", "spafchg_volt_drop_rate", "spafchg_outlier_rate"])
def _(spark, sf):
    """Every rest after a charge, found live from all frames."""
    rows = _by_batch(_arrivals(spark, sf), live.rest_writer, "rests")
    return rows.select("battery_id", "process_id", F.unix_micros("t0").alias("t0_us"), F.unix_micros("t1").alias("t1_us"),
                       "sp_after_chg_volt_diff0", "sp_after_chg_volt_diff1", "spafchg_volt_drop_rate", "spafchg_outlier_rate")


@check("str_dedup", with_ctes("SELECT battery_id, us, frame_no % 1000000000000 AS event FROM u"))
def _(spark, sf):
    came = _arrivals(spark, sf)
    copies = with_copies(frames_of(came.stream).select("battery_id", "sample_ts", "frame_no"))
    return _to_table(came, live.dedup(copies), "once").select(
        "battery_id", us(), (F.col("frame_no") % 10**12).alias("event"))


@check("str_late", with_ctes(_SLOTS), rounds=["avg_current_a"])
def _(spark, sf):
    """Late frames are dropped by the stream; the daily recomputation replaces the slots' days."""
    path = scratch_path(spark, "slots")

    def dated(df):
        return df.withColumns({"date": F.date_format("slot_start", "yyyy-MM-dd"), "source": F.lit("all"),
                               "brand": F.lit("all")})

    came = _arrivals(spark, sf, late_every=7)
    sinks.write_blocks(dated(_to_table(came, live.block_windows(frames_of(came.stream)), "late")), path)
    everything = frames_of(table(spark, sf, "events"))
    # the days the late events belong to, and the last day, whose slots are still open
    recomputed = dated(live.block_windows(everything)).filter("date <= '2024-01-10' or date >= '2024-01-30'")
    sinks.write_blocks(recomputed, path)
    return _slot_view(spark.read.parquet(path))
