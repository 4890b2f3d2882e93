"""Sampling-fault algorithms of the warning layer; all over every message, sound or not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...params import DEFAULTS, Params
from .. import ordered, quality, segment


def initial_values(prepared: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap12``: share of messages with an initial value, per battery and day and quantity."""
    shares = {f"{n}_share": F.sum(F.when(F.col(f), F.col("n_msgs")).otherwise(0)) / F.sum("n_msgs")
              for n, f in (("cell", "cell_init"), ("probe", "probe_init"), ("iso", "iso_init"))}
    out = prepared.groupBy("battery_id", "date_tag").agg(
        F.min("device_id").alias("device_id"), F.sum("n_msgs").alias("n_msgs"),
        *[c.alias(n) for n, c in shares.items()])
    return out.withColumn("fired", F.greatest(*shares) > p.init_share)


def pack_voltage(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap13`` per frame: pack voltage away from the sum of its cells.

    Known to fire falsely where frames are incomplete; keep ``is_aligned`` at hand.
    """
    return quality.pack_sum_gap(df).withColumn(
        "fired", F.coalesce(F.col("pack_gap_v") > p.pack_gap_v, F.lit(False)))


def cold_frames(prepared: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """More frames at the -40 initial value than allowed, per battery and day."""
    return (prepared.filter("cold_init").groupBy("battery_id", "date_tag")
            .agg(F.sum("n_msgs").alias("n_cold"), F.min("device_id").alias("device_id"))
            .withColumn("fired", F.col("n_cold") > p.cold_init_frames))


def symmetry(prepared: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Neighbouring cells that jitter in mirror image.

    Between two frames a pair scores the smaller of its two steps when they go opposite
    ways. Scores add up per battery, day and pair; a pair above its battery-day's fence fires. A
    step over midnight counts on the day it ends. A pack has at most a few hundred pairs, so the fence's group is bounded by the pack.
    """
    day = ["battery_id", "date_tag"]
    # uV fit an int, half of what travels; the slices are those frames are numbered by, so a plan that
    # numbers them does not shuffle them again
    uv = F.transform("cell_mv", lambda x: F.when(~F.isnan(x), F.rint(x * 1e3)).cast("int"))
    thin = prepared.select("battery_id", *segment.SLOT, "sample_ts", "frame_no", uv.alias("_uv"))
    df = ordered.previous(thin, ["battery_id"], ["_uv"], segment.SLOT)
    steps = F.zip_with("_uv", "prev._uv", lambda a, b: (a - b) / 1e3)
    df = df.filter(F.col("prev").isNotNull()).select(*day, steps.alias("_d"))
    left = F.slice("_d", 1, F.greatest(F.size("_d") - 1, F.lit(0)))
    right = F.slice("_d", 2, F.greatest(F.size("_d") - 1, F.lit(0)))
    score = F.zip_with(left, right, lambda a, b: F.when(
        a * b < 0, F.least(F.abs(a), F.abs(b))).otherwise(0.0))
    pairs = (df.select(*day, F.posexplode(score).alias("_at", "_s"))
             .groupBy(*day, (F.col("_at") + 1).alias("position"))
             .agg(F.sum("_s").alias("score")))
    q = F.percentile("score", F.array(F.lit(0.25), F.lit(0.75)))
    fences = pairs.groupBy(*day).agg(q.alias("_q")).select(
        *day, (F.get("_q", 1) + p.iqr_factor * (F.get("_q", 1) - F.get("_q", 0))).alias("fence"))
    return (pairs.join(fences, day)
            .withColumn("fired", F.col("score") > F.col("fence")))
