"""Case text to failure type, and failure type to route.

The registry is a few dozen rows of configuration, so keywords enter the plan as a literal
array: matching is a narrow projection over whole texts, with no join and no pairs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.registry import BUILT_IN, FailureType

# Assumed wording of the four task kinds, first match wins.
TASK_WORDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("missed_alarm", ("漏报", "missed alarm")),
    ("false_alarm", ("误报", "false alarm")),
    ("batch", ("批量", "batch")),
    ("optimise", ("优化", "调优", "optimi")),
)

# Assumed: the registry entry that stands for an inferred family.
FAMILY_TYPES = {"thermal_runaway": "thermal_runaway", "insulation": "insulation_lv2",
                "voltage_spread": "vdiff_outlier_lfp", "temperature_spread": "tempdiff_expert",
                "sampling": "sampling_comprehensive"}


_IDEOGRAPH = "[\u4e00-\u9fff]"


def _hits(text: str, registry: Sequence[FailureType]) -> Column:
    """Keywords found in the folded text.

    The text goes in as a lambda variable, so that it is folded once and not once per
    keyword. Keywords with ideographs, the most, are tried only where the text has any.
    """
    words = [(t.failure_type, k, i) for i, t in enumerate(registry) for k in t.keywords]

    def array(chosen):
        return F.array(*[F.struct(F.lit(kind).alias("failure_type"), F.lit(k).alias("keyword"),
                                  F.lit(k.lower()).alias("folded"), F.lit(i).alias("position"))
                         for kind, k, i in chosen])

    def found(t, chosen):
        return F.filter(array(chosen), lambda w: F.contains(t, w["folded"]))

    ideographic = [w for w in words if re.search(_IDEOGRAPH, w[1])]
    plain = [w for w in words if not re.search(_IDEOGRAPH, w[1])]
    if not ideographic or not plain:
        return F.get(F.transform(F.array(F.lower(text)), lambda t: found(t, words)), 0)
    return F.get(F.transform(F.array(F.lower(text)), lambda t: F.concat(
        found(t, plain), F.when(t.rlike(_IDEOGRAPH), found(t, ideographic))
        .otherwise(F.slice(array(plain), 1, 0)))), 0)


def match_keywords(cases: DataFrame, registry: Sequence[FailureType] = BUILT_IN,
                   text: str = "text") -> DataFrame:
    """One row per case and keyword found in its text, case folded."""
    return cases.select("case_id", F.inline(_hits(text, registry))).drop("folded")


def declare_type(cases: DataFrame, registry: Sequence[FailureType] = BUILT_IN,
                 text: str = "text") -> DataFrame:
    """Adds ``declared_type`` and ``declared_keyword``: the longest keyword in the text wins,
    then registry order. Narrow: the hits of one text are compared inside its row.
    """
    ordered = F.array_sort(
        _hits(text, registry),
        lambda a, b: F.coalesce(
            F.nullif(F.length(b["folded"]) - F.length(a["folded"]), F.lit(0)),
            F.nullif(a["position"] - b["position"], F.lit(0)),
            F.when(a["folded"] < b["folded"], -1).when(a["folded"] > b["folded"], 1).otherwise(0)))
    return (cases.withColumn("_best", F.get(ordered, 0))
            .withColumns({"declared_type": F.col("_best.failure_type"),
                          "declared_keyword": F.col("_best.keyword")})
            .drop("_best"))


def best_match(hits: DataFrame) -> DataFrame:
    """The same choice over rows of ``match_keywords``, several texts of one case together."""
    rank = F.struct(-F.length("keyword"), F.col("position"), F.lower("keyword"))
    return (hits.groupBy("case_id")
            .agg(F.min_by(F.struct("failure_type", "keyword"), rank).alias("_b"))
            .select("case_id", "_b.failure_type", "_b.keyword"))


def latest_corrections(log: DataFrame, as_of=None) -> DataFrame:
    """(case_id, corrected_type) in force at ``as_of``, or now, from a log that is only appended to.

    The log has case_id, corrected_type and corrected_at; of a case the latest entry holds, of entries of one
    moment the one of the greatest type. An entry without a type takes the correction back.
    """
    log = log if as_of is None else log.filter(F.col("corrected_at") <= F.lit(as_of))
    kind = F.col("corrected_type")
    latest = F.max_by(F.struct("corrected_type"), F.struct("corrected_at", F.coalesce(kind, F.lit(""))))
    return log.groupBy("case_id").agg(latest.alias("_c")).select("case_id", "_c.corrected_type").filter(
        "corrected_type is not null")


def resolve_type(cases: DataFrame, declared: str = "declared_type",
                 confirmed: str = "confirmed_type", inferred: str = "inferred_type",
                 corrected: str = "corrected_type") -> DataFrame:
    """Precedence corrected, declared, confirmed, inferred; ``origin`` tells which one applied.

    A type once settled is not inferred again unless the reporter corrects it; cases without a column of
    corrections have none.
    """
    cases = cases if corrected in cases.columns else cases.withColumn(corrected, F.lit(None).cast("string"))
    return cases.withColumns({
        "failure_type": F.coalesce(corrected, declared, confirmed, inferred),
        "origin": F.when(F.col(corrected).isNotNull(), "corrected").when(F.col(declared).isNotNull(), "declared")
        .when(F.col(confirmed).isNotNull(), "confirmed")
        .when(F.col(inferred).isNotNull(), "inferred").otherwise("unknown")})


def family_type(family: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, kind in FAMILY_TYPES.items():
        out = F.when(family == name, kind).otherwise(out)
    return out


def route(cases: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry fields of each case's failure type; unknown types keep their row."""
    fields = registry.select("failure_type", "name", "family", "algorithm", "version", "skill",
                             "status", "model_path", "design_doc")
    return cases.join(fields, "failure_type", "left")


def split_route(routed: DataFrame) -> DataFrame:
    """``path``: own rules (ready), generic framework (placeholder), or unresolved.

    ``needs`` lists what the generic framework has to be given for the case.
    """
    wanted = ("rule", "parameters", "fields")
    have = [F.col(c) if c in routed.columns else F.lit(None) for c in wanted]
    missing = F.array_compact(F.array(*[F.when(h.isNull(), F.lit(c)) for c, h in zip(wanted, have)]))
    generic = F.col("status") == "placeholder"
    return routed.withColumns({
        "path": F.when(F.col("status") == "ready", "own").when(generic, "generic")
        .otherwise("unresolved"),
        "needs": F.when(generic, missing).otherwise(F.array().cast("array<string>"))})


def task_type(cases: DataFrame, words: Sequence[tuple[str, Sequence[str]]] = TASK_WORDS,
              text: str = "text") -> DataFrame:
    low = F.col("_text")
    task = F.lit(None).cast("string")
    for name, terms in reversed(words):
        hit = F.lit(False)
        for term in terms:
            hit = hit | F.contains(low, F.lit(term.lower()))
        task = F.when(hit, name).otherwise(task)
    return cases.withColumn("_text", F.lower(text)).withColumn("task", task).drop("_text")


def coverage(resolved: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry types no case has, and cases no type was found for: (side, item)."""
    bare = registry.join(resolved.select("failure_type").distinct(), "failure_type", "left_anti")
    lost = resolved.join(registry, "failure_type", "left_anti")
    return (bare.select(F.lit("type_without_case").alias("side"), F.col("failure_type").alias("item"))
            .unionByName(lost.select(F.lit("case_without_type").alias("side"),
                                     F.col("case_id").cast("string").alias("item"))))


def registry_summary(registry: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """Types, signals and keywords per family and status, and the cases that fell to them."""
    df = registry
    if resolved is not None:
        counts = resolved.groupBy("failure_type").agg(F.count("*").alias("_cases"))
        df = df.join(counts, "failure_type", "left")
    return df.groupBy("family", "status").agg(
        F.count("*").alias("n_types"), F.sum(F.size("keywords")).alias("n_keywords"),
        F.count_if(F.size("signals") > 0).alias("n_with_signals"),
        F.array_join(F.sort_array(F.collect_set("algorithm")), ",").alias("algorithms"),
        *([F.sum(F.coalesce("_cases", F.lit(0))).alias("n_cases")] if resolved is not None else []))
