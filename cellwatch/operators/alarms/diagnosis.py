"""Diagnosis layer: alarms of the warning layer fused to fault codes.

Which alarms mean which code is a table of ``CodeRule``; the defaults are assumed and each
layer emits only codes of its own list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...params import DEFAULTS, Params
from ...sources.scratch import materialize
from .. import population, signals


@dataclass(frozen=True)
class CodeRule:
    """``code`` holds when every ``all_of`` and one ``any_of`` fired and ``condition`` is true."""

    code: str
    all_of: tuple[str, ...] = ()
    any_of: tuple[str, ...] = ()
    condition: str | None = None


LFP, NCM = ("ap2",), ("ap3",)
COMMON = ("ap8", "ap_alphaq", "ap_vdiff_stat", "ap_vdiff_math", "ap_vdiff_parking")

# Assumed meaning of the codes.
VOLT_RULES = (
    CodeRule("P0201", any_of=("ap2", "ap3"), all_of=("ap_vdiff_parking",)),
    CodeRule("P0202", any_of=("ap8", "ap_vdiff_stat", "ap_vdiff_math")),
    CodeRule("P0203", all_of=("ap_alphaq",)),
)
TEMP_RULES = (
    CodeRule("P0302", any_of=("ap9", "ap10"), condition="longest_s >= suspect_s and not recovered"),
    CodeRule("P0308", any_of=("ap9", "ap10"), condition="recovered"),
)
SAMPLING_RULES = (
    CodeRule("P0301", any_of=("ap12", "ap_sampling_symmetry"), condition="sigma_outlier"),
    CodeRule("P0303", all_of=("ap_sampling_temp",)),
    CodeRule("P0308", all_of=("ap13",)),
)


def merge(fired: Sequence[DataFrame]) -> DataFrame:
    """Alarm frames of several algorithms, each (battery_id, date_tag, algorithm), as one."""
    return reduce(DataFrame.unionByName, fired)


def fired_days(df: DataFrame, algorithm: str) -> DataFrame:
    """Battery-days on which an algorithm fired, with how often: input of ``merge``."""
    return (df.filter("fired").groupBy("battery_id", "date_tag")
            .agg(F.count("*").alias("n_fired")).withColumn("algorithm", F.lit(algorithm)))


def by_battery_day(alarms: DataFrame) -> DataFrame:
    """Algorithms that fired per battery and day; the set is bounded by their number."""
    return alarms.groupBy("battery_id", "date_tag").agg(
        F.sort_array(F.collect_set("algorithm")).alias("algorithms"), F.sum("n_fired").alias("n_fired"))


def codes(days: DataFrame, rules: Sequence[CodeRule]) -> DataFrame:
    """One row per battery-day and code whose rule holds."""

    def holds(rule: CodeRule) -> Column:
        ok = F.lit(True)
        for name in rule.all_of:
            ok = ok & F.array_contains("algorithms", name)
        if rule.any_of:
            ok = ok & F.arrays_overlap("algorithms", F.array(*[F.lit(n) for n in rule.any_of]))
        if rule.condition:
            ok = ok & F.coalesce(F.expr(rule.condition), F.lit(False))
        return F.when(ok, F.lit(rule.code))

    return days.select("*", F.explode(F.array_compact(F.array(*[holds(r) for r in rules]))).alias("code"))


def voltage(alarms: DataFrame, rules: Sequence[CodeRule] = VOLT_RULES) -> DataFrame:
    """``ap28``: the chemistry groups and the common group side by side, then the codes."""
    days = by_battery_day(alarms)

    def group(names):
        return F.arrays_overlap("algorithms", F.array(*[F.lit(n) for n in names]))

    return codes(days.withColumns({"lfp_group": group(LFP), "ncm_group": group(NCM),
                                   "common_group": group(COMMON)}), rules)


def temperature(alarms: DataFrame, prepared: DataFrame, p: Params = DEFAULTS,
                rules: Sequence[CodeRule] = TEMP_RULES) -> DataFrame:
    """``ap27``: alarms with how long the spread lasted and whether it came back to normal.

    A suspect run is one of effective frames with a wide temperature spread, counted with its
    whole length on every day it touches; it has recovered when a later effective frame of the battery is normal,
    that is, when the run does not reach the battery's last frame.
    """
    thin = prepared.filter("is_effective and temp_diff_c is not null").select(
        "battery_id", "sample_ts", "frame_no", "temp_diff_c")
    suspect = signals.runs(thin, F.col("temp_diff_c") > p.tdiff_c, p=p)
    last = thin.groupBy("battery_id").agg(F.max("sample_ts").alias("_last"))
    spans = (suspect.join(last, "battery_id")
             .withColumn("_day", F.explode(F.sequence(F.to_date("start_ts"), F.to_date("end_ts"))))
             .withColumn("date_tag", F.date_format("_day", "yyyy-MM-dd"))
             .groupBy("battery_id", "date_tag")
             .agg(F.max("duration_s").alias("longest_s"),
                  F.bool_and(F.col("end_ts") < F.col("_last")).alias("recovered")))
    days = by_battery_day(alarms).join(spans, ["battery_id", "date_tag"], "left")
    return codes(days.withColumn("suspect_s", F.lit(float(p.suspect_seconds))), rules).drop("suspect_s")


def sampling(alarms: DataFrame, p: Params = DEFAULTS,
             rules: Sequence[CodeRule] = SAMPLING_RULES) -> DataFrame:
    """``ap29``: alarms with a sigma test of their number against the other batteries that day."""
    # one row per battery-day; read twice, so written once
    days = materialize(by_battery_day(alarms), "battery-days")
    stats = days.groupBy("date_tag").agg(F.avg("n_fired").alias("_mean"),
                                         F.stddev_pop("n_fired").alias("_sd"))
    days = (population.join_groups(days, stats, ["date_tag"])
            .withColumn("sigma_outlier", F.col("n_fired") > F.col("_mean") + p.sigma * F.col("_sd"))
            .drop("_mean", "_sd"))
    return codes(days, rules)
