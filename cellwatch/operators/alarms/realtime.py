"""Real-time algorithms: thermal runaway, insulation, hazard score, low charge, self-discharge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...params import DEFAULTS, Params
from .. import features, ordered, signals


def thermal_runaway(df: DataFrame, p: Params = DEFAULTS, spread_alone: bool = False,
                    c4: Column | None = None) -> DataFrame:
    """Per-frame rule ``ap16``; stateless, so the same plan serves a stream.

    c1: temperature and voltage; c2: either one and low insulation; c3: either one and a
    sampling anomaly while insulation reads other than 0. c4 (the caller's condition) and c5
    (a wide spread alone) are proposed extensions and off unless asked for.
    """
    k = signals.conditions(p)
    heat, volts = k["hot"] | k["temp_wide"], k["cell_limit"] | k["spread"]
    either = heat | volts
    iso_alive = F.coalesce(F.col("iso_kohm") != 0, F.lit(False))
    out = {"c1": heat & volts, "c2": either & k["insulation"], "c3": either & k["missing"] & iso_alive}
    if c4 is not None:
        out["c4"] = F.coalesce(c4, F.lit(False))
    if spread_alone:
        out["c5"] = k["spread"]
    fired = F.lit(False)
    for name in out:
        fired = fired | F.col(name)
    return df.withColumns(out).withColumn("fired", fired)


def insulation_lv2(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap19``: insulation below the limit over enough frames; one row per run."""
    return signals.insulation_runs(df, min_frames=p.iso_lv2_frames, p=p)


def insulation_lv3(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap20``: insulation not recovered for long enough; one row per run."""
    return signals.insulation_runs(df, min_seconds=p.iso_lv3_seconds, p=p)


def hazard_points(p: Params = DEFAULTS) -> Column:
    """Weighted indicators of one frame."""
    k = signals.conditions(p)
    points = F.lit(0.0)
    for name, weight in zip(signals.HAZARD, p.hazard_weights):
        points = points + F.when(k[name], float(weight)).otherwise(0.0)
    return points


def realtime_hazard(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap21``: indicators summed over the last 100 frames of a battery, fired above the limit."""
    thin = df.select("battery_id", "device_id", "sample_ts", "frame_no",
                     hazard_points(p).alias("points"))
    return (ordered.rolling(thin, ["battery_id"], p.hazard_window, {"factor": F.sum("points")},
                            ordered.time_slice(p.slot_seconds))
            .withColumn("fired", F.col("factor") > p.hazard_limit))


def low_soc(df: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """Low-charge levels per battery and day: how many of the caller's falling cuts are crossed."""
    level = F.lit(0)
    for cut in cuts:
        level = level + (F.col("user_soc") < float(cut)).cast("int")
    return (df.withColumn("_level", level).filter("_level > 0")
            .groupBy("battery_id", "date_tag")
            .agg(F.max("_level").alias("level"), F.count("*").alias("n_frames"),
                 F.min("user_soc").alias("min_soc"), F.min("sample_ts").alias("first_ts"),
                 F.min("device_id").alias("device_id")))


def station_self_discharge(prepared: DataFrame, static: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Voltage drop and low outlier five minutes after a charge at a station, one chemistry only.

    ``static`` maps battery type to cell type. Only that chemistry's frames are looked at.
    """
    kinds = static.filter(F.col("cell_type") == p.selfdch_cell_type).select("battery_type")
    pairs = features.rest_pairs(prepared.join(kinds, "battery_type", "left_semi"), p)
    return pairs.filter("at1 is not null").select(
        "battery_id", "process_id", F.col("at0.device_id").alias("device_id"),
        F.col("at1.sample_ts").alias("at"), "spafchg_volt_drop_rate", "spafchg_outlier_rate",
        F.coalesce((F.col("spafchg_volt_drop_rate") < p.drop_rate_lt)
                   & (F.col("spafchg_outlier_rate") > p.outlier_gt), F.lit(False)).alias("fired"))
