"""Per-block features. Maps and vectors are opened to rows, so that order does not matter."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwatch.functions import vectors
from cellwatch.operators import features, segment

from .registry import check
from .telemetry import KEY, KEY_SQL, prepared, table, with_ctes

STAT = ("max", "min", "avg")


def blocks(spark, sf, *cols):
    return features.block_features(prepared(spark, sf)).select(*KEY, *cols)


def _us(name):
    return F.unix_micros(name).alias(name)


def _stats_sql(value: str, name: str) -> str:
    return ", ".join(f"{s}({value}) AS {s}_{name}" for s in STAT)


def _stats(*names):
    return [f"{s}_{n}" for n in names for s in STAT]


def _on_effective(select: str) -> str:
    """A select over effective frames per block; blocks without any still get their row."""
    return with_ctes(f"""
SELECT * FROM (SELECT DISTINCT {KEY_SQL} FROM f)
LEFT JOIN (SELECT {KEY_SQL}, {select} FROM g GROUP BY {KEY_SQL}) USING ({KEY_SQL})""")


_ATTRS = ["device_name", "device_type", "battery_type", "is_test", "bms_version", "device_version",
          "real_energy"]


@check("fea_attrs", _on_effective(", ".join(
    f"arg_max({c}, (us, frame_no)) AS {c}" for c in _ATTRS if c != "real_energy")
    + ", arg_max(user_soc, (us, frame_no)) * 0.7 AS real_energy"), rounds=["real_energy"])
def _(spark, sf):
    return blocks(spark, sf, *_ATTRS)


def _init_sql(column, name, values):
    return " UNION ALL ".join(
        f"SELECT {KEY_SQL}, '{name}' AS feature, CAST({v} AS DOUBLE) AS init_value, "
        f"CAST(coalesce(sum(n_msgs) FILTER ({column} = {v}), 0) AS INT) AS msgs FROM f GROUP BY {KEY_SQL}"
        for v in values)


@check("fea_init_counts", with_ctes(" UNION ALL ".join([
    _init_sql("max_cell_v", "cell_volt_init_count", (4.096, 5.094, 65535.0)),
    _init_sql("cold_c", "probe_temp_init_count", (-40.0, -50.0, 255.0)),
    _init_sql("iso_kohm", "insu_resis_init_count", (5000.0, 10000.0, 60000.0)),
    f"SELECT {KEY_SQL}, 'bms_temp_init_count', -40.0::DOUBLE, "
    f"CAST(coalesce(sum(n_msgs) FILTER (cold_init), 0) AS INT) FROM f GROUP BY {KEY_SQL}"])))
def _(spark, sf):
    names = ["cell_volt_init_count", "probe_temp_init_count", "bms_temp_init_count",
             "insu_resis_init_count"]
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("counts")) for n in names])
    return (blocks(spark, sf, *names).select(*KEY, F.inline(pairs))
            .select(*KEY, "feature", F.explode("counts").alias("init_value", "msgs")))


@check("fea_first_last_vec", with_ctes(f"""
, v AS (SELECT {KEY_SQL}, arg_min(mv, (us, frame_no)) AS a, arg_max(mv, (us, frame_no)) AS z,
               arg_min(temps, (us, frame_no)) AS ta, arg_max(temps, (us, frame_no)) AS tz
        FROM g GROUP BY {KEY_SQL})
SELECT {KEY_SQL}, unnest(range(1, 13)) AS position, unnest(a) / 1000 AS first_v, unnest(z) / 1000 AS last_v,
       unnest(ta) AS first_c, unnest(tz) AS last_c FROM v"""), rounds=["first_v", "last_v"])
def _(spark, sf):
    names = ["first_pack_cell_voltage", "last_pack_cell_voltage", "first_pack_probe_temp",
             "last_pack_probe_temp"]
    zipped = F.arrays_zip(F.sequence(F.lit(1), F.size(names[0])).alias("position"),
                          *[F.col(n).alias(a) for n, a in
                            zip(names, ("first_v", "last_v", "first_c", "last_c"))])
    return (blocks(spark, sf, *names).filter("first_pack_cell_voltage is not null")
            .select(*KEY, F.inline(zipped)).withColumn("position", F.col("position").cast("long")))


@check("fea_time_span", with_ctes(f"""
SELECT {KEY_SQL}, min(us) AS start_time, max(us) AS end_time,
       CAST(floor(coalesce(sum(gap_s), 0) + 0.0000005) AS BIGINT) AS block_duration
FROM (SELECT * FROM g UNION ALL SELECT *, CAST(NULL AS DOUBLE) AS gap_s, NULL AS was_balancing
      FROM f WHERE NOT is_effective)
WHERE is_effective GROUP BY {KEY_SQL}"""))
def _(spark, sf):
    ready = prepared(spark, sf)
    both = segment.join_blocks(features.block_features(ready), features.gap_features(ready))
    return both.select(*KEY, _us("start_time"), _us("end_time"), "block_duration").filter("start_time is not null")


_ENDS = {"user_soc": "user_soc", "real_soc": "user_soc - 1", "soh": "95.0::DOUBLE",
         "current": "current_a"}


@check("fea_start_end", _on_effective(", ".join(
    f"arg_min({v}, (us, frame_no)) AS start_{n}, arg_max({v}, (us, frame_no)) AS end_{n}"
    for n, v in _ENDS.items())))
def _(spark, sf):
    return blocks(spark, sf, *[f"{e}_{n}" for n in _ENDS for e in ("start", "end")])


@check("fea_current_stats", _on_effective(
    _stats_sql("CASE WHEN current_a > 0 THEN current_a END", "discharge_current") + ", "
    + _stats_sql("CASE WHEN current_a < 0 THEN -current_a END", "charge_current")),
       rounds=["avg_discharge_current", "avg_charge_current"])
def _(spark, sf):
    return blocks(spark, sf, *_stats("discharge_current", "charge_current"))


_VOLTS = {"pack_voltage": "pack_voltage_v", "high_cell_volt": "max_cell_v",
          "low_cell_volt": "lo_mv / 1000", "avg_cell_volt": "mean_mv / 1000"}


@check("fea_volt_stats", _on_effective(", ".join(_stats_sql(v, n) for n, v in _VOLTS.items())),
       rounds=_stats(*_VOLTS))
def _(spark, sf):
    return blocks(spark, sf, *_stats(*_VOLTS))


_TEMPS = {"high_probe_temp": "hot_c", "low_probe_temp": "cold_c", "temp_diff": "temp_diff_c"}


@check("fea_temp_stats", _on_effective(", ".join(_stats_sql(v, n) for n, v in _TEMPS.items())),
       rounds=_stats(*_TEMPS))
def _(spark, sf):
    return blocks(spark, sf, *_stats(*_TEMPS))


@check("fea_deviation", _on_effective(_stats_sql("deviation_mv / 1000", "volt_skewness")),
       rounds=_stats("volt_skewness"))
def _(spark, sf):
    return blocks(spark, sf, *_stats("volt_skewness"))


def _points_sql(values):
    return "unnest([0.25::DOUBLE, 0.5, 0.75]) AS point, " + ", ".join(
        f"unnest(quantile_cont({v}, [0.25, 0.5, 0.75])) AS {n}" for n, v in values.items())


_BLOCK_Q = {"volt_skewness": "deviation_mv / 1000", "volt_diff": "volt_diff_mv / 1000",
            "insu_resis": "iso_kohm"}


@check("fea_block_quartiles", with_ctes(
    f"SELECT {KEY_SQL}, {_points_sql(_BLOCK_Q)} FROM g GROUP BY {KEY_SQL}"), rounds=list(_BLOCK_Q))
def _(spark, sf):
    names = [f"{n}_quartiles" for n in _BLOCK_Q]
    rows = (blocks(spark, sf, "effect_msg_count", *names).filter("effect_msg_count > 0")
            .withColumn("point", F.explode(F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)]))))
    return rows.select(*KEY, "point", *[F.col(f"{n}_quartiles")[F.col("point")].alias(n)
                                        for n in _BLOCK_Q])


@check("fea_max_cell_quartiles", with_ctes(f"""
, v AS (SELECT {KEY_SQL}, arg_max(mv, (hi_mv, -us, -frame_no)) AS mv FROM g GROUP BY {KEY_SQL})
SELECT {KEY_SQL}, unnest([0.25::DOUBLE, 0.5, 0.75]) AS point,
       unnest([list_aggregate(mv, 'quantile_cont', 0.25), list_aggregate(mv, 'quantile_cont', 0.5),
               list_aggregate(mv, 'quantile_cont', 0.75)]) / 1000 AS volts FROM v"""), rounds=["volts"])
def _(spark, sf):
    return (blocks(spark, sf, "max_cell_volt_quartiles")
            .select(*KEY, F.explode("max_cell_volt_quartiles").alias("point", "volts")))


@check("fea_high_vdiff_count", with_ctes(f"""
SELECT {KEY_SQL}, CAST(count_if(is_effective AND volt_diff_mv > 100) AS INT) AS high_volt_diff_count
FROM f GROUP BY {KEY_SQL}"""))
def _(spark, sf):
    return blocks(spark, sf, "high_volt_diff_count")


# Rest after charge at a station: t0 and the first frame at least 300 s later.
REST_CTES = """
, runs AS (SELECT battery_id, process_id, min(event_type) AS event_type, min(device_type) AS device_type,
             min(us) AS t0, max(us) AS t_end FROM g GROUP BY battery_id, process_id),
edge AS (SELECT *, lag(event_type) OVER (PARTITION BY battery_id ORDER BY t0) AS prev_event_type FROM runs),
shots AS (SELECT g.battery_id, g.process_id, e.device_type, e.prev_event_type, g.cell_type,
            arg_min({'us': us, 'vd': volt_diff_mv, 'mean': mean_mv, 'mv': mv, 'date_tag': date_tag,
                     'hour_tag': hour_tag, 'soc_tag': soc_tag, 'curr_tag': curr_tag},
                    (us, frame_no)) AS at0,
            arg_min({'us': us, 'vd': volt_diff_mv, 'mean': mean_mv, 'mv': list_sort(mv)},
                    (us, frame_no)) FILTER (us >= t0 + 300000000) AS at1
          FROM g JOIN edge e USING (battery_id, process_id) WHERE e.event_type = 'parking'
          GROUP BY ALL),
pairs AS (SELECT *, at0.vd / 1000 AS diff0, at1.vd / 1000 AS diff1,
            (at0.mean - at1.mean) / nullif((at1.us - at0.us) / 60000000.0, 0) AS drop_rate,
            (at1.mv[4] - at1.mv[1]) / nullif(at1.mv[12] - at1.mv[1], 0) AS outlier FROM shots)
"""


@check("fea_station_rest", with_ctes(REST_CTES + """
SELECT battery_id, process_id, at0.date_tag AS date_tag, at0.hour_tag AS hour_tag,
  at0.soc_tag AS soc_tag, at0.curr_tag AS curr_tag, diff0 AS sp_after_chg_volt_diff0,
  diff1 AS sp_after_chg_volt_diff1, drop_rate AS spafchg_volt_drop_rate, outlier AS spafchg_outlier_rate
FROM pairs WHERE device_type = 'swap_station' AND prev_event_type = 'charging'"""),
       rounds=["sp_after_chg_volt_diff0", "sp_after_chg_volt_diff1", "spafchg_volt_drop_rate",
               "spafchg_outlier_rate"])
def _(spark, sf):
    return features.rest_features(prepared(spark, sf)).drop("device_id", "event_type")


@check("fea_sn_hist", with_ctes(" UNION ALL ".join(
    (f"SELECT {KEY_SQL}, '{h}' AS histogram, {c} AS sn, CAST(count(*) AS INT) AS frames "
     f"FROM g GROUP BY ALL") for i, (h, c) in enumerate((
         ("max_volt_sn_count", "hi_sn"), ("min_volt_sn_count", "lo_sn"),
         ("max_temp_sn_count", "hot_sn"), ("min_temp_sn_count", "cold_sn"))))))
def _(spark, sf):
    names = ["max_volt_sn_count", "min_volt_sn_count", "max_temp_sn_count", "min_temp_sn_count"]
    pairs = F.array(*[F.struct(F.lit(n).alias("histogram"), F.col(n).alias("counts")) for n in names])
    return (features.sn_histograms(prepared(spark, sf)).select(*KEY, F.inline(pairs))
            .select(*KEY, "histogram", F.explode("counts").alias("sn", "frames")))


@check("fea_rank", with_ctes(f"""
, r AS (SELECT {KEY_SQL}, 'volt' AS kind, unnest(range(1, 13)) AS position,
          unnest(list_transform(mv, lambda x: list_position(list_sort(mv), x))) AS rank FROM g
        UNION ALL
        SELECT {KEY_SQL}, 'temp', unnest(range(1, 7)),
          unnest(list_transform(temps, lambda x: list_position(list_sort(temps), x))) FROM g)
SELECT {KEY_SQL}, kind, position, avg(rank) AS rank_mean,
  CASE WHEN kind = 'volt' THEN stddev_pop(rank) END AS rank_stddev FROM r GROUP BY {KEY_SQL}, kind, position"""),
       rounds=["rank_mean", "rank_stddev"])
def _(spark, sf):
    ranks = features.rank_features(prepared(spark, sf))
    nothing = F.array_repeat(F.lit(None).cast("double"), F.size("temp_rank_mean"))
    pairs = F.array(
        F.struct(F.lit("volt").alias("kind"),
                 F.arrays_zip(F.sequence(F.lit(1), F.size("volt_rank_mean")).alias("position"),
                              F.col("volt_rank_mean").alias("rank_mean"),
                              F.col("volt_rank_stddev").alias("rank_stddev")).alias("rows")),
        F.struct(F.lit("temp").alias("kind"),
                 F.arrays_zip(F.sequence(F.lit(1), F.size("temp_rank_mean")).alias("position"),
                              F.col("temp_rank_mean").alias("rank_mean"),
                              nothing.alias("rank_stddev")).alias("rows")))
    return (ranks.select(*KEY, F.inline(pairs)).select(*KEY, "kind", F.inline("rows"))
            .withColumn("position", F.col("position").cast("long")))


@check("fea_rank_vectors", """
SELECT label, position, avg(rank) AS rank_mean, stddev_pop(rank) AS rank_stddev
FROM (SELECT label, unnest(range(1, 65)) AS position,
        unnest(list_transform(embedding, lambda x: list_position(list_sort(embedding), x))) AS rank
      FROM embeddings) GROUP BY ALL""", rounds=["rank_mean", "rank_stddev"])
def _(spark, sf):
    """The rank feature on long real-valued vectors."""
    df = (table(spark, sf, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
          .withColumn("is_effective", F.lit(True)))
    return features.rank_rows(df, ["label"], "v").select(
        "label", F.col("position").cast("long").alias("position"), "rank_mean", "rank_stddev")


_ENERGY = {"charge_cap": "coalesce(sum(-current_a * gap_s) FILTER (current_a < 0), 0)",
           "charge_energy":
               "coalesce(sum(-current_a * gap_s * pack_voltage_v / 3600) FILTER (current_a < 0), 0)",
           "discharge_cap": "coalesce(sum(current_a * gap_s) FILTER (current_a > 0), 0)",
           "discharge_energy":
               "coalesce(sum(current_a * gap_s * pack_voltage_v / 3600) FILTER (current_a > 0), 0)"}


@check("fea_energy", with_ctes(f"SELECT {KEY_SQL}, " + ", ".join(
    f"{v} AS {n}" for n, v in _ENERGY.items()) + f" FROM g GROUP BY {KEY_SQL}"), rounds=list(_ENERGY),
       digits=3)
def _(spark, sf):
    return features.gap_features(prepared(spark, sf)).select(*KEY, *_ENERGY)


@check("fea_insulation", _on_effective(_stats_sql("iso_kohm", "insu_resis")), rounds=["avg_insu_resis"])
def _(spark, sf):
    return blocks(spark, sf, *_stats("insu_resis"))


@check("fea_balance", with_ctes(f"""
SELECT {KEY_SQL}, CAST(count_if(is_balancing AND NOT was_balancing) AS INT) AS balance_count,
  CAST(floor(coalesce(sum(gap_s) FILTER (is_balancing), 0) + 0.0000005) AS BIGINT) AS balance_duration
FROM g GROUP BY {KEY_SQL}"""))
def _(spark, sf):
    return features.gap_features(prepared(spark, sf)).select(*KEY, "balance_count", "balance_duration")


def _corr_sql(x, y):
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


_CORRS = {"volt_diff_time_corr": ("volt_diff_mv", "us / 1000000"),
          "volt_diff_soc_corr": ("volt_diff_mv", "user_soc"),
          "volt_diff_current_corr": ("volt_diff_mv", "current_a"),
          "temp_diff_current_corr": ("temp_diff_c", "current_a")}


@check("fea_corr", _on_effective(", ".join(f"{_corr_sql(*xy)} AS {n}" for n, xy in _CORRS.items())),
       rounds=list(_CORRS), digits=4)
def _(spark, sf):
    return blocks(spark, sf, *_CORRS)


_AT_VD = {"time": "us", "soc": "user_soc", "current": "current_a", "max_cell_voltage": "hi_mv / 1000",
          "max_cell_voltage_sn": "hi_sn", "min_cell_voltage": "lo_mv / 1000",
          "min_cell_voltage_sn": "lo_sn", "volt_mean": "mean_mv / 1000"}


@check("fea_at_max_vdiff", _on_effective(", ".join(
    f"arg_max({v}, (volt_diff_mv, -us, -frame_no)) AS max_volt_diff_{n}" for n, v in _AT_VD.items())
    + ", arg_max(list_sum(mv) / 1000, (volt_diff_mv, -us, -frame_no)) AS max_volt_diff_cell_sum"),
       rounds=["max_volt_diff_max_cell_voltage", "max_volt_diff_min_cell_voltage",
               "max_volt_diff_volt_mean", "max_volt_diff_cell_sum"])
def _(spark, sf):
    df = blocks(spark, sf, *[f"max_volt_diff_{n}" for n in (*_AT_VD, "cell_voltage")])
    return df.withColumns({
        "max_volt_diff_time": F.unix_micros("max_volt_diff_time"),
        "max_volt_diff_cell_sum": vectors.total(F.col("max_volt_diff_cell_voltage"))}).drop(
            "max_volt_diff_cell_voltage")


_AT_TD = {"time": "us", "soc": "user_soc", "current": "current_a", "max_probe_temp": "hot_c",
          "max_probe_temp_sn": "hot_sn", "min_probe_temp": "cold_c", "min_probe_temp_sn": "cold_sn"}


@check("fea_at_max_tdiff", _on_effective(", ".join(
    f"arg_max({v}, (temp_diff_c, -us, -frame_no)) AS max_temp_diff_{n}" for n, v in _AT_TD.items())
    + ", arg_max(list_sum(temps), (temp_diff_c, -us, -frame_no)) AS max_temp_diff_probe_sum"))
def _(spark, sf):
    df = blocks(spark, sf, *[f"max_temp_diff_{n}" for n in (*_AT_TD, "probe_temp")])
    return df.withColumns({
        "max_temp_diff_time": F.unix_micros("max_temp_diff_time"),
        "max_temp_diff_probe_sum": vectors.total(F.col("max_temp_diff_probe_temp"))}).drop(
            "max_temp_diff_probe_temp")


# Cell and probe vectors at the frames of largest spread, opened to one row per position.
AT_CTES = f"""
, at_vd AS (SELECT {KEY_SQL}, arg_max(mv, (volt_diff_mv, -us, -frame_no)) AS v,
                   arg_max(temps, (temp_diff_c, -us, -frame_no)) AS c FROM g GROUP BY {KEY_SQL}),
cells AS (SELECT {KEY_SQL}, list_aggregate(v, 'quantile_cont', 0.5) AS mid, unnest(v) AS x FROM at_vd),
probes AS (SELECT {KEY_SQL}, unnest(c) AS x FROM at_vd),
dev AS (SELECT *, (x - mid) / 1000 AS y FROM cells),
mom AS (SELECT {KEY_SQL}, avg(y) AS mu FROM dev GROUP BY {KEY_SQL}),
wave AS (SELECT {KEY_SQL}, sqrt(avg(y * y)) AS rms, avg(abs(y)) AS arv,
           avg((y - mu) * (y - mu)) AS m2, avg((y - mu) ** 3) AS m3, avg((y - mu) ** 4) AS m4
         FROM dev JOIN mom USING ({KEY_SQL}) GROUP BY {KEY_SQL})
"""


@check("fea_entropy", with_ctes(AT_CTES + f"""
SELECT {KEY_SQL}, volt_entropy AS max_volt_diff_volt_entropy, temp_entropy AS max_temp_diff_temp_entropy
FROM (SELECT {KEY_SQL}, entropy(x) AS volt_entropy FROM cells GROUP BY {KEY_SQL})
JOIN (SELECT {KEY_SQL}, entropy(x) AS temp_entropy FROM probes GROUP BY {KEY_SQL}) USING ({KEY_SQL})"""),
       rounds=["max_volt_diff_volt_entropy", "max_temp_diff_temp_entropy"])
def _(spark, sf):
    return blocks(spark, sf, "max_volt_diff_volt_entropy", "max_temp_diff_temp_entropy").filter(
        "max_volt_diff_volt_entropy is not null")


_WAVES = ["rms", "arv", "stddev", "margin", "skewness", "kurtosis"]


@check("fea_waveform", with_ctes(AT_CTES + f"""
SELECT {KEY_SQL}, rms AS max_volt_diff_volt_rms, arv AS max_volt_diff_volt_arv,
  sqrt(m2) AS max_volt_diff_volt_stddev, rms / nullif(arv, 0) AS max_volt_diff_volt_margin,
  m3 / nullif(m2 ** 1.5, 0) AS max_volt_diff_volt_skewness,
  m4 / nullif(m2 * m2, 0) AS max_volt_diff_volt_kurtosis FROM wave"""),
       rounds=[f"max_volt_diff_volt_{w}" for w in _WAVES], digits=5)
def _(spark, sf):
    return blocks(spark, sf, *[f"max_volt_diff_volt_{w}" for w in _WAVES]).filter(
        "max_volt_diff_volt_rms is not null")


@check("fea_motion", _on_effective("max(mileage) AS max_mileage, min(mileage) AS min_mileage, "
                                   + _stats_sql("speed", "speed")), rounds=["avg_speed"])
def _(spark, sf):
    return blocks(spark, sf, "max_mileage", "min_mileage", *_stats("speed"))
