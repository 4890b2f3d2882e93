"""Cutting frames into processes, events and analysis blocks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tags
from ..params import DEFAULTS, Params
from . import ordered

# One output row of the feature table per distinct value of these.
BLOCK_KEY = ("battery_id", "device_id", "process_id", "event_type",
             "date_tag", "hour_tag", "soc_tag", "curr_tag")
SLOT = ("date_tag", "hour_tag")


def join_blocks(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join of two tables keyed by block; blocks with an unknown tag match too."""
    other = right.select(*[F.col(k).alias(f"_{k}") for k in BLOCK_KEY],
                         *[c for c in right.columns if c not in BLOCK_KEY])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in BLOCK_KEY]
    return left.join(other, same, "left").drop(*[f"_{k}" for k in BLOCK_KEY])


def with_tags(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    return df.withColumns({
        "date_tag": tags.date_tag(F.col("sample_ts")),
        "hour_tag": tags.hour_tag(F.col("sample_ts"), p),
        "soc_tag": tags.soc_tag(F.col("user_soc"), p),
        "curr_tag": tags.curr_tag(F.col("current_a"), p.curr_edges),
    })


def number_processes(df: DataFrame, out: str = "process_id", carry: DataFrame | None = None) -> DataFrame:
    """Numbers the runs of equal event type of each battery in time order.

    Needs the tags: runs are numbered per (battery, date, slot), and the block key contains
    that, so where the frames are shuffled for it the blocks need no further exchange.

    ``carry`` (``last_processes`` of what was numbered before): numbers go on from there, so
    a process that lasts over the border keeps its number and no number is given twice.
    """
    df = df.drop(out) if out in df.columns else df
    return ordered.number_long_runs(df, ["battery_id"], "event_type", SLOT, out=out,
                                    carry=None if carry is None else carry.withColumnRenamed("process_id", "run"))


def collapse_and_number(df: DataFrame, out: str = "process_id", carry: DataFrame | None = None) -> DataFrame:
    """``quality.collapse_repeats`` and ``number_processes`` of tagged frames with unique numbers, in one.

    Either would shuffle the wide frames. Here thin rows, one per sample however many copies it has,
    give the run starts and the repeated samples of each (battery, date, slot), and the wide
    frames meet both in a single join. The list of a slot never exceeds its samples. Frames without a
    number are no copies of each other.
    """
    df = df.drop(out) if out in df.columns else df
    # a frame without a time is no copy of another
    apart = F.when(F.col("sample_ts").isNull(), F.col("frame_no")).alias("_apart")
    first = F.min(F.struct(F.col("frame_no").isNull().alias("unknown"), "frame_no", "event_type"))
    samples = (df.groupBy("battery_id", *SLOT, "sample_ts", apart)
               .agg(F.count("*").alias("_copies"), first.alias("_first"))
               .select("battery_id", *SLOT, "sample_ts", "_copies", "_first.frame_no", "_first.event_type")
               .filter("_copies = 1 or frame_no is not null or sample_ts is null"))
    repeated = F.when((F.col("_copies") > 1) & F.col("sample_ts").isNotNull(), F.struct("sample_ts", "frame_no", "_copies"))
    starts = ordered.run_starts(
        samples, ["battery_id"], "event_type", SLOT, more=[F.collect_list(repeated).alias("_r")],
        carry=None if carry is None else carry.withColumnRenamed("process_id", "run"))
    starts = starts.select("*", F.col("_r.sample_ts").alias("_times"), F.col("_r.frame_no").alias("_kept"),
                           F.col("_r._copies").alias("_counts")).drop("_r")
    at = F.nullif(F.array_position("_times", F.col("sample_ts")).cast("int"), F.lit(0))
    met = df.join(starts, ["battery_id", *SLOT], "left").withColumn("_at", at)
    met = met.filter(F.col("_at").isNull() | (F.col("frame_no") == F.get("_kept", F.col("_at") - 1)))
    met = met.withColumn("n_msgs", F.coalesce(F.get("_counts", F.col("_at") - 1), F.lit(1)))
    return ordered.place_in_runs(met, out=out).drop("_at", "_times", "_kept", "_counts")


def with_event_id(df: DataFrame) -> DataFrame:
    return df.withColumn("event_id", tags.event_id(
        F.col("process_id"), F.col("device_name"), F.col("battery_id"), F.col("event_type")))


def events(df: DataFrame) -> DataFrame:
    """One row per process of tagged frames: battery_id, process_id, event_id, device_id and when it began."""
    first = F.min_by(F.struct("device_name", "device_id", "event_type"), F.struct("sample_ts", "frame_no"))
    rows = df.groupBy("battery_id", "process_id").agg(first.alias("_f"), F.min("sample_ts").alias("start_ts"))
    return with_event_id(rows.select("battery_id", "process_id", "_f.*", "start_ts")).drop("device_name", "event_type")


def with_bookkeeping(df: DataFrame, as_of: datetime, etl_at: datetime) -> DataFrame:
    """Run parameters as columns: calculation cutoff, extraction time, cutoff and partition date."""
    day = as_of.strftime("%Y-%m-%d")
    return df.withColumns({"exp_time": F.lit(as_of), "dw_etl_time": F.lit(etl_at),
                           "exp_date": F.lit(day), "date": F.lit(day)})


def processes(frames: DataFrame) -> DataFrame:
    """One row per process, with the type of the process that started before it."""
    runs = frames.groupBy("battery_id", "process_id").agg(
        F.min("event_type").alias("event_type"), F.min("device_id").alias("device_id"),
        F.min("device_type").alias("device_type"),
        F.min("sample_ts").alias("start_ts"), F.max("sample_ts").alias("end_ts"))
    return in_order(runs, ["event_type"]).withColumn("prev_event_type", F.col("before.event_type")).drop("before")


def in_order(runs: DataFrame, cols: list[str]) -> DataFrame:
    """Adds ``before``: ``cols`` of the battery's process that started last before this one.

    By time and not by number: sources give their processes ids of any form.
    """
    return ordered.previous(runs, ["battery_id"], cols, ordered.time_slice(86_400, "start_ts"),
                            order=("start_ts", "process_id"), out="before")


def last_processes(prepared: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """The carry of numbered frames: of each battery its last frame's place, type and process.

    ``carry``, the one these frames were numbered with, keeps its row of a battery without frames.
    """
    at = F.struct("sample_ts", "frame_no")
    rows = prepared.select("battery_id", *SLOT, "sample_ts", "frame_no", "event_type",
                           F.col("process_id").cast("long").alias("process_id"))
    rows = rows if carry is None else rows.unionByName(carry)
    last = rows.groupBy("battery_id").agg(F.max_by(F.struct(
        *SLOT, "sample_ts", "frame_no", "event_type", "process_id"), at).alias("x"))
    return last.select("battery_id", "x.*")
