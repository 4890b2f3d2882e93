"""Signal rules: what a frame, and a case of many frames, points at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULTS, Params
from ..sources.registry import signal_rows
from . import ordered

# Signal columns of ``frame_signals``, with the failure family each infers. The family of
# ``sig_spread`` depends on the temperature and is in the column ``spread_family``.
FAMILIES = {
    "sig_heat": "thermal_runaway", "sig_cell_limit": "thermal_runaway", "sig_spread": None,
    "sig_insulation": "insulation", "sig_cool_spread": "voltage_spread",
    "sig_temp_spread": "temperature_spread", "sig_missing": "sampling",
}

# The six indicators of the hazard score, in the order of ``Params.hazard_weights``.
HAZARD = ("hot", "temp_wide", "cell_limit", "spread", "insulation", "missing")

# Frame columns behind the metric names the registry limits use.
METRICS = {"max_temp": ("hot_c", "max"), "temp_diff": ("temp_diff_c", "max"),
           "min_volt": ("lo_mv", "min"), "max_volt": ("hi_mv", "max"),
           "volt_diff": ("volt_diff_mv", "max"), "iso_resistance": ("iso_reading", "min")}

# The same for limits on rests after a charge, over rows of ``features.rest_pairs``.
REST_METRICS = {"volt_drop_rate": ("spafchg_volt_drop_rate", "min"), "outlier_rate": ("spafchg_outlier_rate", "max")}

# The metric of the registry's flag: how many others lie beyond a limit. It stands for no family.
SEVERAL = "multi_signal"


def _yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def iso_reading() -> Column:
    """Insulation with 0, which means no reading, taken out."""
    return F.when(F.col("iso_kohm") > 0, F.col("iso_kohm"))


def conditions(p: Params = DEFAULTS) -> dict[str, Column]:
    """The elementary conditions every rule is put together from; all comparisons strict.

    Needs the columns of ``normalize.frame_derived`` and ``quality.with_quality``.
    """
    c = F.col
    return {
        "hot": _yes(c("hot_c") > p.hot_c),
        "temp_wide": _yes(c("temp_diff_c") > p.temp_spread_c),
        "cell_limit": _yes((c("lo_mv") < p.cell_low_mv) | (c("hi_mv") > p.cell_high_mv)),
        "spread": _yes(c("volt_diff_mv") > p.spread_mv),
        "insulation": _yes(iso_reading() < p.iso_kohm),
        "missing": _yes(c("is_missing")),
    }


def frame_signals(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Adds one boolean per inference rule and the family a wide spread stands for."""
    c, k = F.col, conditions(p)
    heat = k["hot"] | k["temp_wide"]
    return df.withColumns({
        "sig_heat": heat,
        "sig_cell_limit": k["cell_limit"],
        "sig_spread": k["spread"] & ~heat,
        "sig_insulation": k["insulation"],
        "sig_cool_spread": _yes((c("volt_diff_mv") > p.cool_spread_mv) & (c("hot_c") < p.cool_c)),
        "sig_temp_spread": _yes((c("temp_diff_c") > p.tdiff_c)
                                & (c("volt_diff_mv") < p.tdiff_flat_mv)),
        "sig_missing": k["missing"],
        "spread_family": F.when(k["spread"] & ~heat, F.when(
            c("hot_c") < p.cool_c, "voltage_spread").otherwise("thermal_runaway")),
    })


def runs(df: DataFrame, condition: Column, min_frames: int = 1, min_seconds: float = 0,
         keys: Sequence[str] = ("battery_id",), p: Params = DEFAULTS,
         extra: Sequence[Column] = ()) -> DataFrame:
    """Runs of frames over which ``condition`` holds, long enough in frames and time."""
    aggs = [F.count("*").alias("n_frames"), F.min("sample_ts").alias("start_ts"),
            F.max("sample_ts").alias("end_ts"), *extra]
    out = ordered.condition_runs(df, keys, condition, ordered.time_slice(p.slot_seconds), aggs)
    seconds = (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / 1e6
    return (out.withColumn("duration_s", seconds)
            .filter((F.col("n_frames") >= min_frames) & (F.col("duration_s") >= min_seconds)))


def insulation_runs(df: DataFrame, min_frames: int = 1, min_seconds: float = 0,
                    keys: Sequence[str] = ("battery_id",), p: Params = DEFAULTS) -> DataFrame:
    """Sustained low insulation; a missing reading neither breaks nor extends a run."""
    thin = (df.select(*{*keys, "battery_id", "device_id"}, "sample_ts", "frame_no",
                      iso_reading().alias("iso")).filter("iso is not null"))
    return runs(thin, F.col("iso") < p.iso_kohm, min_frames, min_seconds, keys, p,
                [F.min("iso").alias("min_iso"), F.min("device_id").alias("device_id")])


def case_metrics(signalled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Extremes and frame counts of each signal per case; one map-side combined aggregate."""
    df = signalled.withColumn("iso_reading", iso_reading())
    extremes = [getattr(F, how)(col).alias(name) for name, (col, how) in METRICS.items()]
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_frames"), *extremes,
        F.max(F.greatest("cell_missing_share", "probe_missing_share")).alias("missing_share"),
        *[F.count_if(s).alias(f"n_{s}") for s in FAMILIES],
        F.count_if(F.col("spread_family") == "voltage_spread").alias("n_spread_cool"))


def metrics_long(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    return metrics.select(*keys, *[F.col(m).cast("double").alias(m) for m in METRICS]).unpivot(
        list(keys), list(METRICS), "metric", "value")


def rest_metrics_long(rests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rest metrics of cases as rows (case, metric, value); a case takes its worst rest. ``rests`` are
    rows of ``features.rest_pairs`` with the case's keys."""
    worst = rests.groupBy(*keys).agg(*[getattr(F, how)(col).alias(m) for m, (col, how) in REST_METRICS.items()])
    return worst.unpivot(list(keys), list(REST_METRICS), "metric", "value")


def eval_registry(long: DataFrame, registry: DataFrame, keys: Sequence[str], p: Params = DEFAULTS) -> DataFrame:
    """One row per case, failure type and registry limit that the case crosses.

    ``long`` holds a case's metrics of any grain, (case, metric, value). A flag holds where so many different
    metrics lie beyond a limit as ``p.multi_signal`` says; its value is their number. The
    registry side is a handful of local rows, so Spark plans a broadcast equi-join on the metric name.
    """
    limits = signal_rows(registry)
    hit = F.when(F.col("op") == "gt", F.col("value") > F.col("limit_value")).otherwise(
        F.col("value") < F.col("limit_value"))
    hits = long.join(limits.filter("op <> 'flag'"), "metric").filter(hit)
    several = hits.groupBy(*keys).agg(F.count_distinct("metric").cast("double").alias("value")).filter(
        F.col("value") >= p.multi_signal).withColumn("metric", F.lit(SEVERAL))
    flags = limits.filter("op = 'flag'").withColumn("limit_value", F.lit(float(p.multi_signal)))
    return hits.select(*keys, "metric", "value", "failure_type", "algorithm", "signal", "op", "limit_value").unionByName(
        several.join(flags, "metric"))


def several_signals(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The flags among registry hits as rows of ``case_signals``: they stand for no family."""
    return hits.filter(F.col("metric") == SEVERAL).select(
        *keys, F.col("signal"), F.lit(None).cast("string").alias("family"), F.col("value").cast("long").alias("n_hits")).distinct()


def case_signals(metrics: DataFrame, keys: Sequence[str],
                 sustained: DataFrame | None = None) -> DataFrame:
    """Signals of a case as rows: (case, signal, family, n_frames).

    ``sustained``: the cases with an insulation run long enough (rows of ``insulation_runs``
    by case); without it a single low reading counts.
    """
    hits = [F.struct(F.lit(s).alias("signal"), F.lit(f).alias("family"), F.col(f"n_{s}").alias("n_hits"))
            for s, f in FAMILIES.items() if f is not None]
    cool = F.col("n_spread_cool")
    hits += [F.struct(F.lit("sig_spread").alias("signal"), F.lit(f).alias("family"), n.alias("n_hits"))
             for f, n in (("voltage_spread", cool), ("thermal_runaway", F.col("n_sig_spread") - cool))]
    rows = metrics.select(*keys, F.inline(F.array(*hits))).filter("n_hits > 0")
    if sustained is None:
        return rows
    long_enough = sustained.select(*keys).distinct().withColumn("_held", F.lit(True))
    return (rows.join(long_enough, list(keys), "left")
            .filter("signal <> 'sig_insulation' or _held").drop("_held"))


def arbitrate(cases: DataFrame, signals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One verdict per case: ``inferred`` for one family, ``ambiguous`` for several, ``weak`` where the only
    signals are of no family (several metrics beyond a registry limit, none of the rules), ``none`` without
    any signal. All but the first leave the type to the reporter, who is shown the signals.
    """
    found = signals.groupBy(*keys).agg(
        F.sort_array(F.collect_set("family")).alias("families"),
        F.sort_array(F.collect_set("signal")).alias("signals"))
    n = F.coalesce(F.size("families"), F.lit(0))
    return (cases.select(*keys).distinct().join(found, list(keys), "left")
            .withColumn("families", F.when(n > 0, F.col("families")))
            .withColumns({"verdict": F.when(n == 1, "inferred").when(n > 1, "ambiguous")
                          .when(F.size("signals") > 0, "weak").otherwise("none"),
                          "inferred_family": F.when(n == 1, F.get("families", 0))}))
