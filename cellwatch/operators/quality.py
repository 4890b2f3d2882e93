"""Which messages count: initial values, missing readings, misalignment, repeats, jumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from ..params import DEFAULTS, Params
from . import ordered


def _is_any(value: Column, values: Sequence[float]) -> Column:
    """Equality on the 3rd decimal, so that single-precision sources match too."""
    return F.coalesce((F.rint(value * 1e3) / 1e3).isin(*values), F.lit(False))


def flag_init(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Flags readings that still hold a bus initial value."""
    c = F.col
    return df.withColumns({
        "cell_init": _is_any(c("max_cell_v"), p.init_cell_v),
        "probe_init": _is_any(c("min_temp_c"), p.init_probe_c),
        "cold_init": (_is_any(c("max_temp_c"), (p.cold_init_c,))
                      | _is_any(c("min_temp_c"), (p.cold_init_c,))),
        "iso_init": _is_any(c("iso_kohm"), p.init_iso_kohm),
    })


def missing_ratio(df: DataFrame) -> DataFrame:
    """Shares of zero or NaN readings in the cell and probe vectors."""
    return df.withColumns({
        "cell_missing_share": vectors.zero_or_nan_share(F.col("cell_v")),
        "probe_missing_share": vectors.zero_or_nan_share(F.col("probe_temp_c")),
    })


def is_missing(p: Params = DEFAULTS) -> Column:
    return F.coalesce(F.col("cell_missing_share") > p.missing_share, F.lit(False)) | F.coalesce(
        F.col("probe_missing_share") > p.missing_share, F.lit(False))


def is_aligned() -> Column:
    """Vector lengths equal the declared counts; an undeclared count cannot disagree."""
    return (F.coalesce(F.size("cell_v") == F.col("n_cells"), F.lit(True))
            & F.coalesce(F.size("probe_temp_c") == F.col("n_probes"), F.lit(True)))


def with_quality(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """All flags plus ``is_effective``: no initial value, not missing, aligned.

    Needs the completed extremes of ``frame_derived``. Repeats are another matter: they are
    rows, not readings, and ``collapse_repeats`` takes care of them.
    """
    df = missing_ratio(flag_init(df, p))
    df = df.withColumns({"is_missing": is_missing(p), "is_aligned": is_aligned()})
    sound = ~(F.col("cell_init") | F.col("probe_init") | F.col("cold_init") | F.col("iso_init")
              | F.col("is_missing"))
    return df.withColumns({"is_sound": sound, "is_effective": sound & F.col("is_aligned")})


def valid_frames(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    return with_quality(df, p).filter("is_sound")


def aligned_frames(df: DataFrame) -> DataFrame:
    return df.filter(is_aligned())


def has_unique_numbers(df: DataFrame) -> bool:
    """Whether the frame numbers tell equal copies apart, as those of frames read from files do."""
    return bool(df.schema["frame_no"].metadata.get("unique"))


def collapse_repeats(df: DataFrame, unique_numbers: bool | None = None) -> DataFrame:
    """Keeps the first frame per (battery, sample time) and adds ``n_msgs``, its copies.

    ``unique_numbers`` is taken from the frames themselves unless the caller knows better.
    With frame numbers unique within a battery (what the readers of ``sources.frames`` give)
    the wide frames are not shuffled: a thin aggregate, combined map-side so that a group of
    any size becomes one row, lists the repeated samples only, and the frames are filtered
    against it. The list is short in healthy data; Spark broadcasts it while it measures
    small and splits skewed keys when it does not.

    Without unique numbers, equal copies cannot be told apart, so whole frames are
    aggregated, again map-side first.
    """
    key = ["battery_id", "sample_ts"]
    if not (has_unique_numbers(df) if unique_numbers is None else unique_numbers):
        rest = [c for c in df.columns if c not in key]
        return (df.groupBy(*key)
                .agg(F.min_by(F.struct(*rest), "frame_no").alias("_f"),
                     F.count("*").alias("n_msgs"))
                .select(*key, "_f.*", "n_msgs"))
    repeated = (df.groupBy(*key)
                .agg(F.count("*").alias("_copies"), F.min("frame_no").alias("_first"))
                .filter("_copies > 1"))
    return (df.join(repeated, key, "left")
            .filter("_copies is null or frame_no = _first")
            .withColumn("n_msgs", F.coalesce("_copies", F.lit(1)))
            .drop("_copies", "_first"))


def dedup_frames(df: DataFrame, unique_numbers: bool | None = None) -> DataFrame:
    return collapse_repeats(df, unique_numbers).drop("n_msgs")


def msg_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total, effective and invalid messages of collapsed, flagged and tagged frames."""
    return df.groupBy(*keys).agg(*count_columns())


def count_columns() -> list[Column]:
    effective = F.count_if("is_effective")
    return [F.sum("n_msgs").cast("int").alias("block_msg_count"),
            effective.cast("int").alias("effect_msg_count"),
            (F.sum("n_msgs") - effective).cast("int").alias("fault_msg_count")]


def station_flags(df: DataFrame, p: Params = DEFAULTS,
                  current_error: Column | None = None) -> DataFrame:
    """Point flags of station messages as 0 / 1; what a current error is the caller knows."""
    c = F.col
    error = F.lit(None).cast("int") if current_error is None else current_error.cast("int")
    return df.withColumns({
        "is_current_error": error,
        "is_temp_gt_50": (c("max_battery_pack_temperature") > p.station_hot_c).cast("int"),
        "is_temp_lt_minus_30": (c("min_battery_pack_temperature") < p.station_cold_c).cast("int"),
        "is_voltage_eq_0": (c("voltage") == 0).cast("int"),
        "is_voltage_gt_410": (c("voltage") > p.station_high_v).cast("int"),
        "is_voltage_lt_250": (c("voltage") < p.station_low_v).cast("int"),
    })


def jump_flags(df: DataFrame, p: Params = DEFAULTS, keys: Sequence[str] = ("battery_id",),
               out: str = "") -> DataFrame:
    """SOC and pack-voltage jumps against the previous frame of ``keys``.

    The slot form is the same with ``keys=("device_id", "slot_id")`` and ``out="_slot"``.
    """
    slices = ordered.time_slice(p.slot_seconds)
    df = ordered.previous(df, keys, ["user_soc", "pack_voltage_v"], slices, out="_prev")

    def jump(name, limit):
        step = F.abs(F.col(name) - F.col(f"_prev.{name}"))
        return F.coalesce(step > limit, F.lit(False)).cast("int")

    return df.withColumns({
        f"is_soc_jumping{out}": jump("user_soc", p.jump_soc),
        f"is_voltage_jumping{out}": jump("pack_voltage_v", p.jump_volt)}).drop("_prev")


def pack_sum_gap(df: DataFrame) -> DataFrame:
    """Adds ``pack_gap_v``: distance of the pack voltage from the sum of its cells; null where a
    cell has no reading."""
    gap = F.abs(F.col("pack_voltage_v") - vectors.total(vectors.vector_mv(F.col("cell_v"))) / 1e3)
    return df.withColumn("pack_gap_v", F.when(~F.isnan(gap), gap))
