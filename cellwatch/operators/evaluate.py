"""How good alarms are: confusion counts, why cases were missed or fired, threshold sweeps."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(predictions: DataFrame, truth: DataFrame, keys: Sequence[str] = ("case_id",),
              by: Sequence[str] = ("algorithm",)) -> DataFrame:
    """TP, FP, FN, TN, precision and recall per algorithm.

    ``predictions``: keys, ``by`` and ``fired``; ``truth``: keys and ``is_fault``. A labelled
    case an algorithm says nothing about counts as not fired, which a join alone would lose
    for algorithms silent on it: the counts of each algorithm are completed from the label
    totals, so no case-by-algorithm product is built. Predictions without a label are left out.
    """
    totals = truth.agg(F.count_if("is_fault").alias("_pos"), F.count_if(~F.col("is_fault")).alias("_neg"))
    fired = (predictions.groupBy(*by, *keys).agg(F.bool_or("fired").alias("fired"))
             .join(truth, list(keys)).groupBy(*by)
             .agg(F.count_if(F.col("fired") & F.col("is_fault")).alias("tp"),
                  F.count_if(F.col("fired") & ~F.col("is_fault")).alias("fp")))
    named = predictions.select(*by).distinct().join(fired, list(by), "left").fillna(0, ["tp", "fp"])
    one = F.lit(1)
    return (named.withColumn("_one", one).join(totals.withColumn("_one", one), "_one")
            .withColumns({"fn": F.col("_pos") - F.col("tp"), "tn": F.col("_neg") - F.col("fp")})
            .withColumns(_rates()).drop("_one", "_pos", "_neg"))


def _rates() -> dict[str, Column]:
    zero = F.lit(0)
    return {"precision": F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), zero),
            "recall": F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), zero)}


@dataclass(frozen=True)
class Step:
    """One condition of a rule: ``metric`` above (gt) or below (lt) ``limit``."""

    name: str
    metric: str
    op: str
    limit: float


def _steps(steps: Sequence[Step]) -> Column:
    """Every step of a case as structs, in rule order, with a margin that is negative on failure."""
    def one(i, s):
        value = F.col(s.metric).cast("double")
        margin = value - s.limit if s.op == "gt" else s.limit - value
        return F.struct(F.lit(i + 1).alias("step"), F.lit(s.name).alias("condition"),
                        value.alias("value"), F.lit(float(s.limit)).alias("limit_value"),
                        margin.alias("margin"), F.coalesce(margin > 0, F.lit(False)).alias("holds"))
    return F.array(*[one(i, s) for i, s in enumerate(steps)])


def why_missed(cases: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """For each missed case (``is_fault`` and not ``fired``): every step, and the first that failed."""
    missed = cases.filter("is_fault and not fired").withColumn("_s", _steps(steps))
    first = F.get(F.filter("_s", lambda s: ~s["holds"]), 0)["step"]
    return missed.select("case_id", first.alias("first_failed"), F.inline("_s"))


def why_fired(cases: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """For each false alarm (``fired`` and not a fault): the conditions that held, with margins."""
    false = cases.filter("fired and not is_fault")
    return false.select("case_id", F.inline(_steps(steps))).filter("holds").drop("holds")


def sweep(cases: DataFrame, value: str, limits: Sequence[float], above: bool = True) -> DataFrame:
    """Confusion counts at every limit of a grid, ranked by F1, then by the lower limit.

    Each case is binned once by how many limits it passes, the bins are counted map-side,
    and a running sum over the bins (as many rows as limits) gives all limits together:
    the work does not grow with the grid and no case is paired with a limit.
    """
    limits = sorted(float(v) for v in limits)
    grid = F.array(*[F.lit(v) for v in limits])
    x = F.col(value).cast("double")
    # number of limits at which the case fires; firing limits are the lowest (above) or highest ones
    passed = F.coalesce(F.size(F.filter(grid, lambda t: (x > t) if above else (x < t))), F.lit(0))
    bins = (cases.groupBy(passed.alias("_passed"))
            .agg(F.count_if("is_fault").alias("_pos"), F.count_if(~F.col("is_fault")).alias("_neg")))
    # fires at the i-th limit (from 1) <=> passed >= i (above) or passed >= n + 1 - i
    n = len(limits)
    spread = bins.select("_pos", "_neg", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_i"),
                         F.col("_passed"))
    hit = F.col("_passed") >= (F.col("_i") if above else F.lit(n + 1) - F.col("_i"))
    counted = spread.groupBy("_i").agg(
        F.sum(F.when(hit, F.col("_pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("_neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit, F.col("_pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(~hit, F.col("_neg")).otherwise(0)).alias("tn"))
    f1 = 2.0 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0))
    scored = counted.withColumns({"limit_value": F.get(grid, F.col("_i") - 1), **_rates(), "f1": f1})
    # as many rows as the grid has limits
    order = Window.orderBy(F.desc_nulls_last("f1"), F.asc("limit_value"))
    return scored.withColumn("place", F.row_number().over(order)).drop("_i")


@dataclass(frozen=True)
class UserRule:
    """A rule given by the user: named conditions over mapped fields and parameters.

    ``fields`` maps names used in the conditions to columns, ``parameters`` maps names to
    (default, unit). A case fires when all conditions hold (``mode="all"``) or any does.
    """

    name: str
    conditions: dict[str, str]
    fields: dict[str, str]
    parameters: dict[str, tuple[float, str]] = field(default_factory=dict)
    mode: str = "all"


def apply_rule(df: DataFrame, rule: UserRule, keep: Sequence[str],
               overrides: dict[str, float] | None = None) -> DataFrame:
    """Evaluates a user rule; only mapped fields and parameters are visible to it.

    Spark resolves the expressions against exactly those columns, so a name that is not
    declared fails when the plan is analysed, before any data is read.
    """
    unknown = set(overrides or {}) - set(rule.parameters)
    if unknown:
        raise ValueError(f"not parameters of rule {rule.name}: {sorted(unknown)}")
    clash = set(rule.fields) & set(rule.parameters)
    if clash:
        raise ValueError(f"both field and parameter: {sorted(clash)}")
    for name in (*rule.fields, *rule.parameters, *rule.conditions):
        if not re.fullmatch(r"[A-Za-z_]\w*", name):
            raise ValueError(f"not a plain name: {name!r}")
    values = {n: (overrides or {}).get(n, default) for n, (default, _) in rule.parameters.items()}
    kept = F.struct(*keep).alias("_kept")
    visible = df.select(kept, *[F.col(c).alias(n) for n, c in rule.fields.items()],
                        *[F.lit(float(v)).alias(n) for n, v in values.items()])
    out = visible.select("_kept", *[F.coalesce(F.expr(e), F.lit(False)).alias(n)
                                    for n, e in rule.conditions.items()])
    fired = F.lit(rule.mode == "all")
    for n in rule.conditions:
        fired = (fired & F.col(n)) if rule.mode == "all" else (fired | F.col(n))
    return out.select("_kept.*", *rule.conditions, fired.alias("fired"))
