"""The per-block feature table.

``prepare`` turns canonical frames into tagged, flagged frames. Wide frames are shuffled
there only to number processes, and not at all where the source numbers them.

``block_features`` is one grouped aggregate without any window: partial aggregates are
built where the frames lie, so cell vectors travel only as the few a block keeps.
``gap_features`` needs the neighbouring frame, and orders five thin columns for it. A block
lies inside one (battery, 2-hour slot); after ``collapse_repeats`` the clock bounds a slot's
frames (1,440 at 5 s), whatever share of the data its battery has.

Features use effective frames only, messages are counted over all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors
from ..params import DEFAULTS, Params
from . import normalize, ordered, quality, segment
from .segment import BLOCK_KEY


def _order() -> Column:
    return F.struct("sample_ts", "frame_no")


def prepare(frames: DataFrame, p: Params = DEFAULTS, numbered: bool = False,
            collapse: bool = True, unique_numbers: bool | None = None,
            carry: DataFrame | None = None, whole: bool = False) -> DataFrame:
    """Canonical frames to frames ready for blocks: derived signals, flags, process, tags.

    ``numbered``: the frames already carry process numbers. ``collapse``: repeats are still
    in; leave it off when the input holds one row per (battery, sample time). ``carry``: see
    ``segment.number_processes``. ``whole``: all signals are wanted, so frames that are shuffled
    travel without them; few signals are smaller than the vectors they come from.
    """
    def signals(df):
        return quality.with_quality(normalize.frame_derived(df), p)

    unique = quality.has_unique_numbers(frames) if unique_numbers is None else unique_numbers
    if collapse and unique and not numbered:
        df = segment.with_tags(frames if whole else signals(frames), p)
        df = segment.collapse_and_number(df, carry=carry)
        return signals(df) if whole else df
    df = signals(frames)
    df = (quality.collapse_repeats(df, unique_numbers) if collapse
          else df.withColumn("n_msgs", F.lit(1)))
    df = segment.with_tags(df, p)
    return df if numbered else segment.number_processes(df, carry=carry)


def effective(df: DataFrame) -> DataFrame:
    return df.filter("is_effective")


def with_gaps(df: DataFrame) -> DataFrame:
    """Adds ``gap_s`` and ``was_balancing`` from the previous frame of the process.

    The frame before may lie in another block; its step counts where it ends. So the blocks of a
    process add up to the process, however often its current moves between bins. The first
    frame of a process has gap 0.
    """
    df = ordered.previous(df, ["battery_id", "process_id"], ["sample_ts", "is_balancing"], segment.SLOT, out="_before")
    gap = (F.unix_micros("sample_ts") - F.unix_micros("_before.sample_ts")) / 1e6
    return df.withColumns({
        "gap_s": F.coalesce(gap, F.lit(0.0)),
        "was_balancing": F.coalesce("_before.is_balancing", F.lit(False))}).drop("_before")


def _if(condition: Column, value) -> Column:
    return F.when(condition, value if isinstance(value, Column) else F.col(value))


def _spread(value: Column, name: str) -> list[Column]:
    return [F.max(value).alias(f"max_{name}"), F.min(value).alias(f"min_{name}"),
            F.avg(value).alias(f"avg_{name}")]


def _counts_by_value(flag_of: Column, values: Sequence[float]) -> Column:
    keys = F.array(*[F.lit(float(v)) for v in values])
    hits = [F.sum(F.when(F.rint(flag_of * 1e3) / 1e3 == v, F.col("n_msgs")).otherwise(0)).cast("int")
            for v in values]
    return F.map_from_arrays(keys, F.array(*hits))


def pearson(x: Column, y: Column) -> Column:
    """Correlation that is null, not an error, when one side is flat."""
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def _quantile_map(value: Column, points: Sequence[float]) -> Column:
    """Exact: Spark's ``percentile`` keeps value counts, and a block has few distinct values."""
    keys = F.array(*[F.lit(float(q)) for q in points])
    return F.map_from_arrays(keys, F.percentile(value, keys))


def aggregates(p: Params = DEFAULTS, packed: bool = False) -> list[Column]:
    """Every grouped feature that needs no neighbouring frame, over frames of ``prepare``.

    ``packed``: what is taken of the first frame comes as one struct, and so of the last; ``unpack`` opens them.
    """
    c, ok = F.col, F.col("is_effective")

    def e(name):
        return _if(ok, name)

    vd, td = e(c("volt_diff_mv") / 1e3), e("temp_diff_c")
    dev = e(c("deviation_mv") / 1e3)
    amp = e("current_a")
    discharge, charge = _if(amp > 0, amp), _if(amp < 0, -amp)
    order = F.when(ok, _order())

    def taken(pick, out, cols):
        if packed:
            return [pick(F.struct(*[c(v).alias(n) for n, v in cols.items()]), order).alias(out)]
        return [pick(c(v), order).alias(n) for n, v in cols.items()]

    values = {"user_soc": "user_soc", "real_soc": "real_soc", "soh": "soh", "current": "current_a"}
    vectors_ = {"pack_cell_voltage": "cell_v", "pack_probe_temp": "probe_temp_c"}
    ends = [*taken(F.min_by, "_first", {f"start_{n}": v for n, v in values.items()}
                   | {f"first_{n}": v for n, v in vectors_.items()}),
            *taken(F.max_by, "_last", {n: n for n in ("device_name", "device_type", "source", "brand", "battery_type",
                                                      "real_energy", "is_test", "bms_version", "device_version")}
                   | {f"end_{n}": v for n, v in values.items()} | {f"last_{n}": v for n, v in vectors_.items()})]
    earliest = (-F.unix_micros("sample_ts"), -c("frame_no"))
    at_vd = F.max_by(
        F.struct(c("sample_ts").alias("time"), c("user_soc").alias("soc"),
                 c("current_a").alias("current"), (c("hi_mv") / 1e3).alias("max_cell_voltage"),
                 c("hi_sn").alias("max_cell_voltage_sn"),
                 (c("lo_mv") / 1e3).alias("min_cell_voltage"),
                 c("lo_sn").alias("min_cell_voltage_sn"), (c("mean_mv") / 1e3).alias("volt_mean"),
                 c("cell_v").alias("cell_voltage"), c("median_mv").alias("median_mv")),
        F.when(ok & vd.isNotNull(), F.struct(c("volt_diff_mv"), *earliest)))
    at_td = F.max_by(
        F.struct(c("sample_ts").alias("time"), c("user_soc").alias("soc"),
                 c("current_a").alias("current"), c("hot_c").alias("max_probe_temp"),
                 c("hot_sn").alias("max_probe_temp_sn"), c("cold_c").alias("min_probe_temp"),
                 c("cold_sn").alias("min_probe_temp_sn"), c("probe_temp_c").alias("probe_temp")),
        F.when(ok & td.isNotNull(), F.struct(c("temp_diff_c"), *earliest)))
    at_hi = F.max_by(c("cell_v"), F.when(ok & c("hi_mv").isNotNull(), F.struct(c("hi_mv"), *earliest)))
    cold = F.sum(F.when(c("cold_init"), c("n_msgs")).otherwise(0)).cast("int")
    # Insulation 0 means "no reading" and is left to the rules; here it is a value.
    iso = e("iso_kohm")
    return [
        *quality.count_columns(),
        _counts_by_value(c("max_cell_v"), p.init_cell_v).alias("cell_volt_init_count"),
        _counts_by_value(c("min_temp_c"), p.init_probe_c).alias("probe_temp_init_count"),
        F.map_from_arrays(F.array(F.lit(p.cold_init_c)), F.array(cold)).alias("bms_temp_init_count"),
        _counts_by_value(c("iso_kohm"), p.init_iso_kohm).alias("insu_resis_init_count"),
        F.min(e("sample_ts")).alias("start_time"), F.max(e("sample_ts")).alias("end_time"),
        *ends,
        *_spread(discharge, "discharge_current"), *_spread(charge, "charge_current"),
        *_spread(e("pack_voltage_v"), "pack_voltage"),
        *_spread(e("max_cell_v"), "high_cell_volt"), *_spread(e("min_cell_v"), "low_cell_volt"),
        *_spread(e("avg_cell_v"), "avg_cell_volt"),
        at_hi.alias("_at_hi"),
        *_spread(e("max_temp_c"), "high_probe_temp"), *_spread(e("min_temp_c"), "low_probe_temp"),
        *_spread(dev, "volt_skewness"),
        _quantile_map(dev, p.quantiles).alias("volt_skewness_quartiles"),
        *_spread(vd, "volt_diff"),
        F.count_if(e(c("volt_diff_mv") > p.high_spread_mv)).cast("int").alias("high_volt_diff_count"),
        _quantile_map(vd, p.quantiles).alias("volt_diff_quartiles"),
        *_spread(td, "temp_diff"),
        *_spread(iso, "insu_resis"),
        _quantile_map(iso, p.quantiles).alias("insu_resis_quartiles"),
        pearson(vd, e(F.unix_micros("sample_ts") / 1e6)).alias("volt_diff_time_corr"),
        pearson(vd, e("user_soc")).alias("volt_diff_soc_corr"),
        pearson(vd, amp).alias("volt_diff_current_corr"),
        pearson(td, amp).alias("temp_diff_current_corr"),
        at_vd.alias("_at_vd"), at_td.alias("_at_td"),
        F.max(e("mileage")).alias("max_mileage"), F.min(e("mileage")).alias("min_mileage"),
        *_spread(e("speed"), "speed"),
    ]


def unpack(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Opens the frames picked by the aggregate into their feature columns."""
    c = F.col
    bins = F.transform(vectors.vector_mv(c("_at_vd.cell_voltage")), lambda x: F.rint(x))
    for packed in ("_first", "_last"):
        if packed in df.columns:
            df = df.select("*", f"{packed}.*").drop(packed)
    df = df.withColumns({
        "_dev": vectors.deviations(c("_at_vd.cell_voltage"), c("_at_vd.median_mv") / 1e3),
        "_mu": c("_at_vd.volt_mean") - c("_at_vd.median_mv") / 1e3})
    df = df.withColumn("_wave", vectors.waveform(c("_dev"), c("_mu")))
    ordered_hi = F.sort_array("_at_hi")
    points = F.array(*[F.lit(float(q)) for q in p.quantiles])
    out = {
        "max_cell_volt_quartiles": F.when(c("_at_hi").isNotNull(), F.map_from_arrays(
            points, F.array(*[vectors.sorted_quantile(ordered_hi, q) for q in p.quantiles]))),
        **{f"max_volt_diff_{n}": c(f"_at_vd.{n}") for n in (
            "time", "soc", "current", "max_cell_voltage", "max_cell_voltage_sn",
            "min_cell_voltage", "min_cell_voltage_sn", "volt_mean", "cell_voltage")},
        "max_volt_diff_volt_entropy": vectors.entropy(bins),
        **{f"max_volt_diff_volt_{n}": c(f"_wave.{n}")
           for n in ("rms", "arv", "stddev", "margin", "skewness", "kurtosis")},
        **{f"max_temp_diff_{n}": c(f"_at_td.{n}") for n in (
            "time", "soc", "current", "max_probe_temp", "max_probe_temp_sn",
            "min_probe_temp", "min_probe_temp_sn", "probe_temp")},
        "max_temp_diff_temp_entropy": vectors.entropy(
            F.transform(c("_at_td.probe_temp"), lambda x: F.rint(x))),
    }
    return df.withColumns(out).drop("_at_hi", "_at_vd", "_at_td", "_dev", "_mu", "_wave")


def block_features(prepared: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Scalar, map and vector features of every block; one row per ``BLOCK_KEY``.

    Select what is needed: Catalyst drops the aggregates nobody asks for.
    """
    grouped = prepared.groupBy(*BLOCK_KEY).agg(*aggregates(p))
    return segment.with_event_id(unpack(grouped, p))


def gap_features(prepared: DataFrame) -> DataFrame:
    """Duration, capacities, energies and balancing of every block that has effective frames."""
    thin = effective(prepared).select(*BLOCK_KEY, "sample_ts", "frame_no", "current_a", "pack_voltage_v",
                                      F.coalesce("is_balancing", F.lit(False)).alias("is_balancing"))
    amp, balancing = F.col("current_a"), F.col("is_balancing")
    amp_s = amp * F.col("gap_s")
    watt_h = amp_s * F.col("pack_voltage_v") / 3600

    def total(condition, value):
        return F.coalesce(F.sum(_if(condition, value)), F.lit(0.0))

    return with_gaps(thin).groupBy(*BLOCK_KEY).agg(
        # gaps are whole microseconds; half of one keeps their sum from falling below a second
        (F.sum("gap_s") + 5e-7).cast("long").alias("block_duration"),
        total(amp < 0, -amp_s).alias("charge_cap"), total(amp < 0, -watt_h).alias("charge_energy"),
        total(amp > 0, amp_s).alias("discharge_cap"), total(amp > 0, watt_h).alias("discharge_energy"),
        F.count_if(balancing & ~F.col("was_balancing")).cast("int").alias("balance_count"),
        total(balancing, "gap_s").cast("long").alias("balance_duration"))


def _ranked(prepared: DataFrame, keys: Sequence[str], vectors_: dict[str, str]) -> DataFrame:
    """Rank statistics per position of each vector (name -> column), in one pass."""
    frames = effective(prepared).select(
        *keys, *[F.col(v).alias(f"_v_{n}") for n, v in vectors_.items()],
        *[F.sort_array(v).alias(f"_s_{n}") for n, v in vectors_.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("_of"),
                               vectors.ranks(F.col(f"_v_{n}"), F.col(f"_s_{n}")).alias("_ranks"))
                      for n in vectors_])
    rows = (frames.select(*keys, F.inline(pairs))
            .select(*keys, "_of", F.posexplode("_ranks").alias("_at", "_rank")))
    return (rows.groupBy(*keys, "_of", (F.col("_at") + 1).alias("position"))
            .agg(F.avg("_rank").alias("rank_mean"), F.stddev_pop("_rank").alias("rank_stddev")))


def rank_rows(prepared: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """Mean and spread of the rank each position of ``vector`` has within its frame."""
    return _ranked(prepared, keys, {"v": vector}).drop("_of")


def _with_places(frames: DataFrame) -> DataFrame:
    """Adds what ranks and number histograms need of an effective frame: small integers in ``_places``."""
    ranks = [vectors.ranks(F.col(v), F.sort_array(v)).cast("array<smallint>").alias(n)
             for n, v in (("volt", "cell_mv"), ("temp", "probe_temp_c"))]
    numbers = [F.col(c).alias(h) for h, c in _EXTREMES.items()]
    return frames.withColumn("_places", _if(F.col("is_effective"), F.struct(*ranks, *numbers)))


def _with_ranks(blocks: DataFrame) -> DataFrame:
    """The rank features from ``_places``, the list of a block's frames; null where no frame has a rank."""
    def moments(of):
        lists = F.filter(F.col(f"_places.{of}"), lambda v: v.isNotNull())
        zero = F.struct(*[F.lit(0.0).alias(n) for n in ("n", "sum", "mean", "m2")])

        def add(acc, x):
            n, step = acc["n"] + 1, x - acc["mean"]
            return F.struct(n.alias("n"), (acc["sum"] + x).alias("sum"), (acc["mean"] + step / n).alias("mean"),
                            (acc["m2"] + step * (step - step / n)).alias("m2"))

        def at(k):
            return F.aggregate(F.filter(F.transform(lists, lambda v: F.get(v, k).cast("double")), lambda x: x.isNotNull()),
                               zero, add)

        longest = F.coalesce(F.array_max(F.transform(lists, F.size)), F.lit(0))
        return F.when(longest > 0, F.transform(F.sequence(F.lit(0), longest - 1), at)).otherwise(
            F.array().cast("array<struct<n:double,sum:double,mean:double,m2:double>>"))

    def mean(s):
        return s["sum"] / F.nullif(s["n"], F.lit(0.0))

    def deviation(s):
        return F.sqrt(s["m2"] / F.nullif(s["n"], F.lit(0.0)))

    some = (F.size("_volt") > 0) | (F.size("_temp") > 0)
    return blocks.withColumns({"_volt": moments("volt"), "_temp": moments("temp")}).withColumns({
        "volt_rank_mean": _if(some, F.transform("_volt", mean)), "volt_rank_stddev": _if(some, F.transform("_volt", deviation)),
        "temp_rank_mean": _if(some, F.transform("_temp", mean))}).drop("_volt", "_temp")


def rank_features(prepared: DataFrame) -> DataFrame:
    """``volt_rank_mean``, ``volt_rank_stddev``, ``temp_rank_mean`` per block that has a rank.

    A block gathers the ranks of its frames, two bytes a cell and probe; the clock bounds the frames.
    """
    rows = _with_places(prepared).groupBy(*BLOCK_KEY).agg(F.collect_list("_places").alias("_places"))
    return _with_ranks(rows).drop("_places").filter("volt_rank_mean is not null")


_EXTREMES = {"max_volt_sn_count": "max_cell_sn", "min_volt_sn_count": "min_cell_sn",
             "max_temp_sn_count": "max_temp_sn", "min_temp_sn_count": "min_temp_sn"}


def sn_histogram_rows(prepared: DataFrame, keys: Sequence[str] = BLOCK_KEY) -> DataFrame:
    """How often each cell or probe number was the extreme: (histogram, sn, frames)."""
    pairs = F.array(*[F.struct(F.lit(h).alias("histogram"), F.col(c).alias("sn"))
                      for h, c in _EXTREMES.items()])
    return (effective(prepared).select(*keys, F.inline(pairs))
            .filter("sn is not null").groupBy(*keys, "histogram", "sn")
            .agg(F.count("*").cast("int").alias("frames")))


def _with_histograms(blocks: DataFrame) -> DataFrame:
    """The number histograms from ``_places``, the list of a block's frames; null where no frame has a number."""
    held = {f"_{h}": F.sort_array(F.filter(F.col(f"_places.{h}"), lambda n: n.isNotNull())) for h in _EXTREMES}
    some = F.greatest(*[F.size(h) for h in held]) > 0

    def counted(numbers):
        keys = F.array_distinct(numbers)
        counts = F.transform(keys, lambda k: F.size(F.filter(numbers, lambda n: n == k)))
        return F.map_from_arrays(keys, counts)

    return blocks.withColumns(held).withColumns({h: _if(some, counted(F.col(f"_{h}"))) for h in _EXTREMES}).drop(*held)


def sn_histograms(prepared: DataFrame) -> DataFrame:
    """The four number histograms as map columns, one row per block that has a number."""
    rows = _with_places(prepared).groupBy(*BLOCK_KEY).agg(F.collect_list("_places").alias("_places"))
    return _with_histograms(rows).drop("_places").filter(F.col(next(iter(_EXTREMES))).isNotNull())


def low_outlier(mv: Column) -> Column:
    """How far the lowest cell lies below the fourth lowest, as a share of the frame's spread."""
    low = F.sort_array(mv)
    v1, v4, top = F.get(low, 0), F.get(low, 3), F.array_max(mv)
    return (v4 - v1) / F.nullif(top - v1, F.lit(0.0))


def rest_figures() -> list[Column]:
    """The rest features from the figures ``at0`` and ``at1`` of its two frames."""
    minutes = (F.unix_micros("at1.sample_ts") - F.unix_micros("at0.sample_ts")) / 60e6
    return [(F.col("at0.volt_diff_mv") / 1e3).alias("sp_after_chg_volt_diff0"),
            (F.col("at1.volt_diff_mv") / 1e3).alias("sp_after_chg_volt_diff1"),
            ((F.col("at0.mean_mv") - F.col("at1.mean_mv")) / F.nullif(minutes, F.lit(0.0))).alias("spafchg_volt_drop_rate"),
            F.col("at1.outlier").alias("spafchg_outlier_rate")]


def rest_pairs(prepared: DataFrame, p: Params = DEFAULTS, after_charge: bool = True,
               device_type: str | None = "swap_station") -> DataFrame:
    """First frame t0 of a rest and the first at or after t0 + ``rest_seconds``, t1.

    ``after_charge``: only rests that follow a charge. Both frames come from one
    aggregate per rest over an equi-join on (battery, process), so a long rest is
    combined map-side and no range join is planned.
    """
    frames = effective(prepared)
    if device_type is not None:
        frames = frames.filter(F.col("device_type") == device_type)
    rests = segment.processes(frames).filter("event_type = 'parking'")
    if after_charge:
        rests = rests.filter("prev_event_type = 'charging'")
    frames = frames.filter("event_type = 'parking'")
    rests = rests.select("battery_id", "process_id", F.col("start_ts").alias("t0"))
    # the cells of a frame are reduced to one figure where the frame lies; vectors do not travel
    thin = frames.select(*BLOCK_KEY, "sample_ts", "frame_no", "volt_diff_mv", "mean_mv",
                         low_outlier(F.col("cell_mv")).alias("outlier"))
    shot = F.struct("sample_ts", "volt_diff_mv", "mean_mv", "outlier",
                    *[k for k in BLOCK_KEY if k not in ("battery_id", "process_id")])
    late = F.unix_micros("sample_ts") >= F.unix_micros("t0") + p.rest_seconds * 1_000_000
    pairs = (thin.join(rests, ["battery_id", "process_id"])
             .groupBy("battery_id", "process_id")
             .agg(F.min_by(shot, _order()).alias("at0"),
                  F.min_by(shot, F.when(late, _order())).alias("at1")))
    return pairs.select("battery_id", "process_id", "at0", "at1", *rest_figures())


def rest_features(prepared: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The station rest features on the block that holds t0."""
    pairs = rest_pairs(prepared, p)
    key = [F.col(k) if k in ("battery_id", "process_id") else F.col(f"at0.{k}").alias(k)
           for k in BLOCK_KEY]
    return pairs.select(*key, "sp_after_chg_volt_diff0", "sp_after_chg_volt_diff1",
                        "spafchg_volt_drop_rate", "spafchg_outlier_rate")


def table_features(prepared: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Every feature of every block, those of the functions above, in one aggregate.

    Gaps and rests, which look at other frames, join it as thin rows of their block, so wide rows of
    blocks are never joined and only partial aggregates are shuffled.
    """
    rows, added = _with_places(prepared), []
    for part in (gap_features(prepared), rest_features(prepared, p)):
        added += [n for n in part.columns if n not in BLOCK_KEY]
        rows = rows.unionByName(part, allowMissingColumns=True)
    grouped = rows.groupBy(*BLOCK_KEY).agg(*aggregates(p, packed=True), F.collect_list("_places").alias("_places"),
                                           *[F.max(n).alias(n) for n in added])
    blocks = _with_histograms(_with_ranks(unpack(grouped, p))).drop("_places")
    return segment.with_event_id(blocks)
