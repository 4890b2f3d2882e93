"""Temperature-spread algorithms of the warning layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...params import DEFAULTS, Params
from .. import features, population, segment


def expert(prepared: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap9`` per process of any type: wide spread, very wide spread, wide in a charge and
    again in the rest right after it.

    The process after a charge is the one that starts next, whatever its number.
    """
    runs = segment.in_order(features.effective(prepared).groupBy("battery_id", "process_id").agg(
        F.min("event_type").alias("event_type"), F.min("device_id").alias("device_id"),
        F.min("date_tag").alias("date_tag"), F.max("temp_diff_c").alias("max_temp_diff"),
        F.min("sample_ts").alias("start_ts")), ["process_id"])
    after = runs.select("battery_id", F.col("before.process_id").alias("process_id"),
                        F.col("event_type").alias("_next_type"), F.col("max_temp_diff").alias("_next_diff"))
    wide = F.col("max_temp_diff") > p.tdiff_c
    pair = ((F.col("event_type") == "charging") & (F.col("_next_type") == "parking") & wide
            & (F.col("_next_diff") > p.tdiff_c))
    return (runs.join(after, ["battery_id", "process_id"], "left")
            .withColumns({"wide": F.coalesce(wide, F.lit(False)),
                          "very_wide": F.coalesce(F.col("max_temp_diff") > p.temp_spread_c, F.lit(False)),
                          "charge_and_rest": F.coalesce(pair, F.lit(False))})
            .withColumn("fired", F.col("wide") | F.col("very_wide") | F.col("charge_and_rest"))
            .drop("_next_type", "_next_diff", "before", "start_ts"))


def statistical(blocks: DataFrame, p: Params = DEFAULTS,
                group: Sequence[str] = ("device_type", "date_tag")) -> DataFrame:
    """``ap10``: a battery's mean temperature spread of the day above the fence of its group's
    battery-days. A block counts with its effective frames, so the mean is that of the frames."""
    known = F.when(F.col("avg_temp_diff").isNotNull(), F.col("effect_msg_count"))
    daily = blocks.groupBy(*dict.fromkeys([*group, "battery_id", "date_tag"])).agg(
        (F.sum(F.col("avg_temp_diff") * known) / F.nullif(F.sum(known), F.lit(0))).alias("daily_temp_diff"),
        F.min("device_id").alias("device_id"))
    fence = population.upper_fences(daily, group, {"daily_temp_diff": "fence"}, p.iqr_factor)
    return population.join_groups(daily, fence, group, "left").withColumn(
        "fired", F.coalesce(F.round("daily_temp_diff", 9) > F.round("fence", 9), F.lit(False)))
