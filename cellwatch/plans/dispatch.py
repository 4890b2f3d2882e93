"""Case to failure type to route: the whole chain as one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import classify, signals
from ..params import DEFAULTS, Params
from ..sources.registry import BUILT_IN, FailureType, registry_df

_DAY = ["battery_id", "date_tag"]


def day_signals(signalled: DataFrame, registry: Sequence[FailureType] = BUILT_IN, p: Params = DEFAULTS) -> DataFrame:
    """Signals of every battery-day, from frames of ``signals.frame_signals`` with ``date_tag``: those of
    the rules, and whether several metrics lie beyond limits of the registry."""
    metrics = signals.case_metrics(signalled, _DAY)
    held = signals.insulation_runs(signalled, min_frames=p.iso_lv2_frames, keys=_DAY, p=p)
    limits = registry_df(signalled.sparkSession, tuple(registry))
    hits = signals.eval_registry(signals.metrics_long(metrics, _DAY), limits, _DAY, p)
    return signals.case_signals(metrics, _DAY, held).unionByName(signals.several_signals(hits, _DAY))


def infer_types(cases: DataFrame, signalled: DataFrame, registry: Sequence[FailureType] = BUILT_IN,
                p: Params = DEFAULTS) -> DataFrame:
    """Verdict of each case over the days it spans.

    Frames are reduced to battery-days before they meet the cases, so cases sharing a
    battery-day never multiply its frames; a case is opened to its days, and the join is on
    (battery, day).
    """
    days = cases.select("case_id", "battery_id", F.explode(
        F.sequence("from_date", "to_date")).alias("_day"))
    days = days.select("case_id", "battery_id", F.date_format("_day", "yyyy-MM-dd").alias("date_tag"))
    found = days.join(day_signals(signalled, registry, p), _DAY).select("case_id", "signal", "family")
    return signals.arbitrate(cases, found, ["case_id"])


def resolve_cases(cases: DataFrame, signalled: DataFrame,
                  registry: Sequence[FailureType] = BUILT_IN, p: Params = DEFAULTS,
                  corrections: DataFrame | None = None, as_of=None) -> DataFrame:
    """Adds the declared and inferred types and settles on one, with its origin.

    ``corrections`` is the log of ``classify.latest_corrections``, looked up at ``as_of``.

    Keywords are found where the texts lie; the texts then stay behind, so that the joins
    move identifiers only.
    """
    verdicts = infer_types(cases, signalled, registry, p).select(
        "case_id", "verdict", "signals",
        classify.family_type(F.col("inferred_family")).alias("inferred_type"))
    declared = classify.declare_type(cases, registry).drop("text")
    settled = declared.join(verdicts, "case_id", "left")
    if corrections is not None:
        settled = settled.join(classify.latest_corrections(corrections, as_of), "case_id", "left")
    return classify.resolve_type(settled)


def dispatch(cases: DataFrame, signalled: DataFrame, registry: DataFrame,
             types: Sequence[FailureType] = BUILT_IN, p: Params = DEFAULTS,
             corrections: DataFrame | None = None, as_of=None) -> DataFrame:
    """Resolved cases with their registry fields, path, task and what is still missing."""
    resolved = resolve_cases(classify.task_type(cases), signalled, types, p, corrections, as_of)
    return classify.split_route(classify.route(resolved, registry))
