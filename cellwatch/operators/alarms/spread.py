"""Voltage-spread algorithms of the warning layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...params import DEFAULTS, Params
from .. import features, population, segment

# Block columns the population models look at.
FACTORS = ("max_volt_diff", "max_volt_diff_volt_entropy", "max_volt_diff_volt_rms", "max_volt_skewness")


def _outlier(blocks: DataFrame, cell_type: str, spread_mv: float, deviation_v: float) -> DataFrame:
    return blocks.filter(F.col("cell_type") == cell_type).withColumn("fired", F.coalesce(
        (F.col("max_volt_diff") * 1e3 > spread_mv) & (F.col("max_volt_skewness") > deviation_v),
        F.lit(False)))


def outlier_lfp(blocks: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap2``: LFP blocks with a wide spread and a cell far from the median."""
    return _outlier(blocks, "LFP", p.lfp_spread_mv, p.lfp_deviation_v)


def outlier_ncm(blocks: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap3``: the same for NCM with its own limits."""
    return _outlier(blocks, "NCM", p.ncm_spread_mv, p.ncm_deviation_v)


def high_spread(prepared: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``ap8``: charge events with more than one frame of high spread."""
    return (features.effective(prepared).filter("event_type = 'charging'")
            .groupBy("battery_id", "process_id")
            .agg(F.min("device_id").alias("device_id"), F.min("date_tag").alias("date_tag"),
                 F.count_if(F.col("volt_diff_mv") > p.high_spread_mv).alias("n_high"))
            .withColumn("fired", F.col("n_high") > p.high_spread_frames))


def parking_growth(prepared: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Spread growth from the first parked frame to the first after depolarisation."""
    pairs = features.rest_pairs(prepared, p, after_charge=False, device_type=None)
    growth = F.col("at1.volt_diff_mv") - F.col("at0.volt_diff_mv")
    return pairs.filter("at1 is not null").select(
        "battery_id", "process_id", F.col("at0.device_id").alias("device_id"),
        F.col("at0.date_tag").alias("date_tag"), growth.alias("growth_mv"),
        F.coalesce(growth > p.parking_growth_mv, F.lit(False)).alias("fired"))


def statistical(blocks: DataFrame, p: Params = DEFAULTS,
                group: Sequence[str] = ("cell_type", "date_tag")) -> DataFrame:
    """Blocks whose spread and whose entropy both lie above their group's fence."""
    fences = population.upper_fences(blocks, group, {
        "max_volt_diff": "volt_fence", "max_volt_diff_volt_entropy": "entropy_fence"}, p.iqr_factor)
    return (population.join_groups(blocks, fences, group, "left")
            .withColumns({
                "volt_outlier": F.coalesce(F.col("max_volt_diff") > F.col("volt_fence"), F.lit(False)),
                "entropy_outlier": F.coalesce(
                    F.col("max_volt_diff_volt_entropy") > F.col("entropy_fence"), F.lit(False))})
            .withColumn("fired", F.col("volt_outlier") & F.col("entropy_outlier")))


def rank_shift(prepared: DataFrame, static: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Cells whose mean rank moves between two successive charges; packs of one energy only."""
    packs = static.filter(F.col("battery_energy") == p.alphaq_energy_kwh).select("battery_type")
    charges = (features.effective(prepared).filter("event_type = 'charging'")
               .join(packs, "battery_type", "left_semi"))
    ranks = features.rank_rows(charges, ["battery_id", "process_id"], "cell_mv").drop("rank_stddev")
    runs = charges.groupBy("battery_id", "process_id").agg(
        F.min("date_tag").alias("date_tag"), F.min("sample_ts").alias("start_ts"))
    # by time: ids may have any form
    pairs = segment.in_order(runs, ["process_id"]).select(
        "battery_id", "process_id", "date_tag", F.col("before.process_id").alias("prev_process_id"))
    before = ranks.select("battery_id", F.col("process_id").alias("prev_process_id"), "position",
                          F.col("rank_mean").alias("prev_rank_mean"))
    return (ranks.join(pairs, ["battery_id", "process_id"])
            .join(before, ["battery_id", "prev_process_id", "position"])
            .withColumn("shift", F.abs(F.col("rank_mean") - F.col("prev_rank_mean")))
            .withColumn("fired", F.col("shift") >= p.rank_shift))


def factor_score(blocks: DataFrame, p: Params = DEFAULTS, group: Sequence[str] = ("cell_type",),
                 loads: Sequence[float] = (0.5, 0.5, 0.5, 0.5)) -> DataFrame:
    """Several factors, normalised per group, projected on one direction, cut at a quantile."""
    complete = blocks.dropna(subset=[*FACTORS, *group])
    scored = population.z_scores(complete, group, FACTORS)
    score = F.lit(0.0)
    for factor, load in zip(FACTORS, loads):
        score = score + F.col(f"z_{factor}") * float(load)
    return _cut(scored.withColumn("score", score), group, p)


def factor_score_pca(blocks: DataFrame, p: Params = DEFAULTS, group: Sequence[str] = ("cell_type",),
                     k: int = 2) -> DataFrame:
    """The same with the projection learnt per group: distance in the first ``k`` principal components of
    the normalised factors. A direction's sign does not matter to it."""
    complete = blocks.dropna(subset=[*FACTORS, *group])
    scored = population.z_scores(complete, group, FACTORS)
    names = [f"z_{c}" for c in FACTORS]
    axes = population.principal(scored, group, names, k)
    z = F.array(*names)
    # squared length of the projection: z' P z, P being the sum of the axes' projectors
    length = F.lit(0.0)
    for i in range(len(names)):
        for j in range(len(names)):
            length = length + F.get(z, i) * F.get(z, j) * F.get("projector", i * len(names) + j)
    joined = population.join_groups(scored, axes, group)
    return _cut(joined.withColumn("score", F.sqrt(F.greatest(length, F.lit(0.0)))).drop("projector"), group, p)


def _cut(scored: DataFrame, group: Sequence[str], p: Params) -> DataFrame:
    cut = population.exact_quantiles(scored, group, "score", (p.math_quantile,)).select(
        *group, F.get("quantiles", 0).alias("score_cut"))
    return (population.join_groups(scored, cut, group)
            .withColumn("fired", F.col("score") > F.col("score_cut")))
