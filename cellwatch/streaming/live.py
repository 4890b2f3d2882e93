"""Streaming forms.

Stateless rules run on the stream as they are. Windows and copies use watermarks and Spark's own
state. What looks back over rows (the 100-frame score, the insulation run, process numbers and
with them blocks, rests after a charge) keeps a small state per battery in buckets, see
``carry``: a batch rewrites the buckets of its own batteries only, a batch that is run again gives
the same result, and the batch operators do the work, hot batteries included. These forms
expect batches in the order of time; frames that come later are corrected by the daily job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features, normalize, ordered, quality, segment, signals
from ..operators.alarms import realtime
from ..operators.segment import BLOCK_KEY, SLOT
from ..params import DEFAULTS, Params
from . import carry as state


def thermal_runaway(frames: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap16`` on a stream of canonical frames; append mode, no state."""
    return realtime.thermal_runaway(quality.with_quality(normalize.frame_derived(frames), p), p)


def block_windows(frames: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Counts and spreads per battery, event type and 2-hour slot; emitted when a slot closes."""
    df = normalize.frame_derived(frames).withWatermark("sample_ts", p.watermark)
    slot = F.window("sample_ts", f"{p.slot_seconds} seconds")
    return (df.groupBy(slot.alias("slot"), "battery_id", "event_type")
            .agg(F.count("*").alias("n_frames"), F.max("volt_diff_mv").alias("max_volt_diff_mv"),
                 F.max("temp_diff_c").alias("max_temp_diff_c"), F.avg("current_a").alias("avg_current_a"))
            .select("battery_id", "event_type", F.col("slot.start").alias("slot_start"), "n_frames",
                    "max_volt_diff_mv", "max_temp_diff_c", "avg_current_a"))


def dedup(frames: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Drops repeated samples; state is kept no longer than the watermark."""
    return frames.withWatermark("sample_ts", p.watermark).dropDuplicatesWithinWatermark(
        ["battery_id", "sample_ts"])


UNNUMBERED = ("battery_id", *SLOT, "sample_ts", "frame_no", "event_type")
NUMBERING = (*UNNUMBERED, "process_id")


def _flagged(batch: DataFrame, p: Params, collapse: bool) -> DataFrame:
    """Frames with signals, flags and tags; their processes are numbered on from the carry."""
    return features.prepare(batch, p, numbered=True, collapse=collapse)


def block_writer(out_path: str, carry_path: str, p: Params = DEFAULTS, collapse: bool = True):
    """Analysis blocks live: partial aggregates of a batch's effective frames on the full block key.

    The carry holds a battery's last frame and process number, so numbers, and with them blocks, are
    those of the batch job. ``merged_blocks`` adds up the parts of blocks that several batches saw.
    """

    def thin(batch):
        return _flagged(batch, p, collapse).select(
            *UNNUMBERED, "device_id", "soc_tag", "curr_tag", "is_effective", "volt_diff_mv", "temp_diff_c", "current_a")

    def step(frames, carry, keep):
        df = keep(segment.number_processes(frames, carry=carry))
        ok = features.effective(df)
        rows = ok.groupBy(*BLOCK_KEY).agg(
            F.count("*").alias("n_frames"), F.min("sample_ts").alias("start_time"), F.max("sample_ts").alias("end_time"),
            F.max("volt_diff_mv").alias("max_volt_diff_mv"), F.max("temp_diff_c").alias("max_temp_diff_c"),
            F.sum("current_a").alias("sum_current_a"), F.count("current_a").alias("n_current"))
        return rows, segment.last_processes(df, carry)

    return state.writer(thin, step, out_path, carry_path)


def merged_blocks(rows: DataFrame) -> DataFrame:
    """The rows of ``block_writer``, one per block, as far as it is known."""
    return rows.groupBy(*BLOCK_KEY).agg(
        F.sum("n_frames").alias("n_frames"), F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
        F.max("max_volt_diff_mv").alias("max_volt_diff_mv"), F.max("max_temp_diff_c").alias("max_temp_diff_c"),
        (F.sum("sum_current_a") / F.nullif(F.sum("n_current").cast("double"), F.lit(0.0))).alias("avg_current_a"))


def rest_writer(out_path: str, carry_path: str, p: Params = DEFAULTS, device_type: str | None = "swap_station",
                collapse: bool = True):
    """Rests after a charge live: one row per rest, when its first frame ``rest_seconds`` or more after its
    start arrives.

    A rest is a parking process whose effective frames follow those of a charging one; t0 is its first
    effective frame, t1 the first at or after the deadline t0 + ``rest_seconds``. The carry
    holds of each battery the last frame's process number, the last process with effective frames, and
    the rest that waits for its deadline with the figures of its t0. A rest that ends before gives no row.
    """

    def thin(batch):
        some = batch if device_type is None else batch.filter(F.col("device_type") == device_type)
        return _flagged(some, p, collapse).select(*UNNUMBERED, "device_id", "is_effective", "volt_diff_mv", "mean_mv",
                                                  features.low_outlier(F.col("cell_mv")).alias("outlier"))

    def step(batch, carry, keep):
        df = keep(segment.number_processes(batch, carry=None if carry is None else carry.select(*NUMBERING)))
        frames = features.effective(df)
        order, shot = F.struct("sample_ts", "frame_no"), F.struct("sample_ts", "device_id", "volt_diff_mv", "mean_mv", "outlier")
        begun = frames.groupBy("battery_id", "process_id").agg(
            F.min("event_type").alias("event_type"), F.min("sample_ts").alias("start_ts"),
            F.min_by(shot, order).alias("at0"), F.lit(False).alias("known"))
        if carry is not None:
            seen = carry.filter("seen is not null").select("battery_id", "seen.*", F.lit(None).cast(
                begun.schema["at0"].dataType).alias("at0"), F.lit(True).alias("known"))
            # a process that goes on is not begun anew
            begun = begun.unionByName(seen).groupBy("battery_id", "process_id").agg(
                F.min("event_type").alias("event_type"), F.min("start_ts").alias("start_ts"),
                F.min("at0").alias("at0"), F.max("known").alias("known"))
        begun = keep(begun)
        rests = segment.in_order(begun, ["event_type"]).filter(
            "event_type = 'parking' and before.event_type = 'charging' and not known").select("battery_id", "process_id", "at0")
        if carry is not None:
            rests = rests.unionByName(carry.filter("waits is not null").select("battery_id", "waits.*"))
        parked = frames.filter("event_type = 'parking'").select("battery_id", "process_id", "sample_ts", "frame_no", shot.alias("shot"))
        due = F.unix_micros("sample_ts") >= F.unix_micros("at0.sample_ts") + p.rest_seconds * 1_000_000
        rests = keep(rests.join(parked, ["battery_id", "process_id"], "left").groupBy("battery_id", "process_id").agg(
            F.min("at0").alias("at0"), F.min_by("shot", F.when(due, order)).alias("at1")))
        rows = rests.filter("at1 is not null").select(
            "battery_id", "process_id", F.col("at1.device_id").alias("device_id"), F.col("at0.sample_ts").alias("t0"),
            F.col("at1.sample_ts").alias("t1"), *features.rest_figures())
        left = segment.last_processes(df, None if carry is None else carry.select(*NUMBERING))
        last = begun.groupBy("battery_id").agg(F.max_by(F.struct("process_id", "event_type", "start_ts"), "process_id").alias("seen"))
        waiting = rests.filter("at1 is null").select("battery_id", F.struct("process_id", "at0").alias("waits")).join(
            left.select("battery_id", F.col("process_id").alias("now")), "battery_id").filter("waits.process_id = now").drop("now")
        return rows, left.join(last, "battery_id", "left").join(waiting, "battery_id", "left")

    return state.writer(thin, step, out_path, carry_path)


def hazard_writer(out_path: str, carry_path: str, p: Params = DEFAULTS):
    """``ap21`` live: rows of a batch with the factor over the last 100 frames.

    The carry holds the newest 99 frames of each battery.
    """
    before = p.hazard_window - 1
    slices = ordered.time_slice(p.slot_seconds)

    def thin(batch):
        return quality.with_quality(normalize.frame_derived(batch), p).select(
            "battery_id", "device_id", "sample_ts", "frame_no", realtime.hazard_points(p).alias("points"),
            F.lit(True).alias("_new"))

    def step(frames, carry, keep):
        both = frames if carry is None else frames.unionByName(carry.withColumn("_new", F.lit(False)))
        scored = keep(ordered.rolling(both, ["battery_id"], p.hazard_window, {"factor": F.sum("points")}, slices, number="_no"))
        rows = scored.filter("_new").drop("_new", "_no").withColumn("fired", F.col("factor") > p.hazard_limit)
        newest = both.groupBy("battery_id").agg(F.count("*").alias("_n"))
        left = (scored.join(newest, "battery_id").filter(F.col("_no") > F.col("_n") - before)
                .drop("_no", "_n", "_new", "factor"))
        return rows, left

    return state.writer(thin, step, out_path, carry_path)


def insulation_writer(out_path: str, carry_path: str, p: Params = DEFAULTS):
    """Sustained low insulation live: every run as far as it is known, per batch.

    The open run of a battery travels as one row that stands for all its frames. A run is
    known by (battery_id, start_ts); a later batch's row for it supersedes an earlier one.
    """
    slices = ordered.time_slice(p.slot_seconds)

    def thin(batch):
        return (batch.select("battery_id", "device_id", "sample_ts", "frame_no",
                             signals.iso_reading().alias("iso"), F.col("sample_ts").alias("start_ts"),
                             F.lit(1).cast("long").alias("n_frames"))
                .filter("iso is not null"))

    def step(frames, carry, keep):
        both = frames if carry is None else frames.unionByName(carry)
        at = F.struct("sample_ts", "frame_no")
        runs = ordered.condition_runs(
            both, ["battery_id"], F.col("iso") < p.iso_kohm, slices,
            [F.sum("n_frames").alias("n_frames"), F.min("start_ts").alias("start_ts"),
             F.max(at).alias("_end"), F.min("iso").alias("iso"), F.min("device_id").alias("device_id")])
        newest = both.groupBy("battery_id").agg(F.max(at).alias("_last"))
        runs = keep(runs.join(newest, "battery_id").withColumn("is_open", F.col("_end") == F.col("_last")))
        rows = runs.select("battery_id", "device_id", "start_ts", F.col("_end.sample_ts").alias("end_ts"),
                           "n_frames", F.col("iso").alias("min_iso"), "is_open")
        left = runs.filter("is_open").select(
            "battery_id", "device_id", F.col("_end.sample_ts").alias("sample_ts"),
            F.col("_end.frame_no").alias("frame_no"), "iso", "start_ts", "n_frames")
        return rows, left

    return state.writer(thin, step, out_path, carry_path)


def latest_runs(rows: DataFrame) -> DataFrame:
    """The rows of ``insulation_writer`` with only the newest state of each run."""
    newest = F.max_by(F.struct("device_id", "end_ts", "n_frames", "min_iso", "is_open"),
                      F.struct("n_frames", "batch"))
    return rows.groupBy("battery_id", "start_ts").agg(newest.alias("_r")).select(
        "battery_id", "start_ts", "_r.*")
