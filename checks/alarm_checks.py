"""The failure-type algorithms and the diagnosis layer."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cellwatch.operators import features, normalize, ordered
from cellwatch.operators.alarms import diagnosis, realtime, sampling, spread, temperature
from cellwatch.params import DEFAULTS
from cellwatch.plans import daily
from cellwatch.sources.scratch import materialize

from .case_checks import signalled
from .feature_checks import AT_CTES, REST_CTES
from .registry import check
from .telemetry import KEY, KEY_SQL, frames, messages, prepared, static_dim, with_ctes

# Frames come about every quarter of an hour here, so limits counted in frames are smaller.
SPARSE = replace(DEFAULTS, cold_init_frames=1, init_share=0.02, sigma=1.0, rank_shift=3.0,
                 parking_growth_mv=5.0, suspect_seconds=1)
_COND = """hot_c > 55 AS hot, temp_diff_c > 30 AS temp_wide, lo_mv < 1300 OR hi_mv > 4500 AS cell_limit,
  volt_diff_mv > 300 AS wide, iso_kohm > 0 AND iso_kohm < 100 AS low_iso"""
_RUNS = """
, i AS (SELECT *, sum(CASE WHEN iso_kohm < 100 THEN 0 ELSE 1 END)
          OVER (PARTITION BY battery_id ORDER BY us, frame_no) AS island FROM t WHERE iso_kohm > 0),
ir AS (SELECT battery_id, min(device_id) AS device_id, count(*) AS n_frames, min(us) AS start_us, max(us) AS end_us,
         min(iso_kohm) AS min_iso FROM i WHERE iso_kohm < 100 GROUP BY battery_id, island)
"""


@check("alg_ap16", with_ctes(f"""
, c AS (SELECT frame_no, iso_kohm, is_missing, {_COND} FROM d WHERE frame_no < 1000000000000),
r AS (SELECT frame_no, (hot OR temp_wide) AND (cell_limit OR wide) AS c1,
  (hot OR temp_wide OR cell_limit OR wide) AND low_iso AS c2,
  (hot OR temp_wide OR cell_limit OR wide) AND is_missing AND iso_kohm <> 0 AS c3, wide AS c5 FROM c)
SELECT *, c1 OR c2 OR c3 OR c5 AS fired FROM r"""))
def _(spark, sf):
    return realtime.thermal_runaway(signalled(spark, sf), spread_alone=True).select(
        "frame_no", "c1", "c2", "c3", "c5", "fired")


def _run_view(df):
    return df.select("battery_id", "device_id", "n_frames", F.unix_micros("start_ts").alias("start_us"),
                     F.unix_micros("end_ts").alias("end_us"), "min_iso")


@check("alg_ap19", with_ctes(_RUNS + "SELECT * FROM ir WHERE n_frames >= 3"))
def _(spark, sf):
    return _run_view(realtime.insulation_lv2(frames(spark, sf)))


@check("alg_ap20", with_ctes(_RUNS + "SELECT * FROM ir WHERE end_us - start_us >= 600000000"))
def _(spark, sf):
    return _run_view(realtime.insulation_lv3(frames(spark, sf)))


@check("alg_ap21", with_ctes(f"""
, c AS (SELECT battery_id, us, frame_no, is_missing, {_COND} FROM d WHERE frame_no < 1000000000000),
r AS (SELECT frame_no, battery_id, sum(hot::INT + temp_wide::INT + cell_limit::INT + wide::INT + low_iso::INT
    + is_missing::INT) OVER (PARTITION BY battery_id ORDER BY us, frame_no
    ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)::DOUBLE AS factor FROM c)
SELECT *, factor > 10 AS fired FROM r"""))
def _(spark, sf):
    return realtime.realtime_hazard(signalled(spark, sf)).select("frame_no", "battery_id", "factor", "fired")


@check("alg_low_soc", with_ctes("""
SELECT battery_id, date_tag, CAST(max(level) AS INT) AS level, count(*) AS n_frames, min(user_soc) AS min_soc, min(us) AS first_us
FROM (SELECT *, (user_soc < 50)::INT + (user_soc < 40)::INT + (user_soc < 32)::INT AS level FROM f)
WHERE level > 0 GROUP BY battery_id, date_tag"""))
def _(spark, sf):
    return realtime.low_soc(prepared(spark, sf), (50, 40, 32)).select(
        "battery_id", "date_tag", "level", "n_frames", "min_soc", F.unix_micros("first_ts").alias("first_us"))


@check("alg_station_selfdch", with_ctes(REST_CTES + """
SELECT battery_id, process_id, at1.us AS at_us, drop_rate AS spafchg_volt_drop_rate,
  outlier AS spafchg_outlier_rate, coalesce(drop_rate < 1.5 AND outlier > 0.66, false) AS fired
FROM pairs WHERE device_type = 'swap_station' AND prev_event_type = 'charging' AND cell_type = 'NCM'
  AND at1 IS NOT NULL"""), rounds=["spafchg_volt_drop_rate", "spafchg_outlier_rate"])
def _(spark, sf):
    return realtime.station_self_discharge(prepared(spark, sf), static_dim(spark)).select(
        "battery_id", "process_id", F.unix_micros("at").alias("at_us"), "spafchg_volt_drop_rate",
        "spafchg_outlier_rate", "fired")


def prepared_table(spark, sf):
    """Prepared frames written once, for queries that run several algorithms over them."""
    return daily.prepare_day(messages(spark, sf), unique_numbers=True)


def typed_blocks(spark, sf, *cols, ready=None):
    """Blocks with at least one effective frame, with the facts of their battery type.

    Written once and read back, as the warning layer reads the daily block table.
    """
    ready = prepared(spark, sf) if ready is None else ready
    blocks = features.block_features(ready).filter("effect_msg_count > 0").select(
        *KEY, "device_type", "device_id", "battery_type", *cols)
    return materialize(normalize.enrich_static(blocks, static_dim(spark)), "blocks")


# One row per block with what the warning layer looks at.
BLK_CTES = AT_CTES + f"""
, ent AS (SELECT {KEY_SQL}, round(entropy(x), 12) AS bits FROM cells GROUP BY {KEY_SQL}),
blk AS (SELECT {KEY_SQL}, any_value(device_type) AS device_type, any_value(cell_type) AS cell_type,
          max(volt_diff_mv) AS vd_mv, max(deviation_mv) AS dev_mv, avg(temp_diff_c) AS avg_td
        FROM g GROUP BY {KEY_SQL})
"""
_FENCE = "quantile_cont({v}, 0.75) + 1.5 * (quantile_cont({v}, 0.75) - quantile_cont({v}, 0.25))"
ALARM_CTES = BLK_CTES + REST_CTES + f"""
, a2 AS (SELECT *, vd_mv > 25 AND dev_mv > 50 AS fired FROM blk WHERE cell_type = 'LFP'),
a3 AS (SELECT *, vd_mv > 16 AND dev_mv > 70 AS fired FROM blk WHERE cell_type = 'NCM'),
a8 AS (SELECT battery_id, process_id, min(date_tag) AS date_tag, count_if(volt_diff_mv > 100) AS n_high,
         count_if(volt_diff_mv > 100) > 1 AS fired
       FROM g WHERE event_type = 'charging' GROUP BY battery_id, process_id),
apk AS (SELECT battery_id, process_id, at0.date_tag AS date_tag, at1.vd - at0.vd AS growth_mv,
          at1.vd - at0.vd > 5 AS fired FROM pairs WHERE at1 IS NOT NULL),
sf0 AS (SELECT cell_type, date_tag, {_FENCE.format(v='vd_mv')} AS volt_fence, {_FENCE.format(v='bits')} AS entropy_fence
        FROM blk JOIN ent USING ({KEY_SQL}) GROUP BY cell_type, date_tag),
ast AS (SELECT {KEY_SQL}, vd_mv > volt_fence AS volt_outlier, bits > entropy_fence AS entropy_outlier,
          vd_mv > volt_fence AND bits > entropy_fence AS fired
        FROM blk JOIN ent USING ({KEY_SQL}) JOIN sf0 USING (cell_type, date_tag)),
rk AS (SELECT battery_id, process_id, position, avg(r) AS rank_mean FROM (
         SELECT battery_id, process_id, unnest(range(1, 13)) AS position,
           unnest(list_transform(mv, lambda x: list_position(list_sort(mv), x))) AS r
         FROM g WHERE event_type = 'charging' AND cell_type = 'NCM') GROUP BY ALL),
rp AS (SELECT battery_id, process_id, min(date_tag) AS date_tag,
         lag(process_id) OVER (PARTITION BY battery_id ORDER BY process_id) AS prev_process_id
       FROM g WHERE event_type = 'charging' AND cell_type = 'NCM' GROUP BY battery_id, process_id),
aq AS (SELECT rk.battery_id, rk.process_id, rp.date_tag, rk.position,
         abs(rk.rank_mean - q.rank_mean) AS shift, abs(rk.rank_mean - q.rank_mean) >= 3 AS fired
       FROM rk JOIN rp USING (battery_id, process_id)
       JOIN rk q ON q.battery_id = rk.battery_id AND q.process_id = rp.prev_process_id AND q.position = rk.position),
fac AS (SELECT {KEY_SQL}, cell_type, vd_mv / 1000 AS f1, bits AS f2, rms AS f3, dev_mv / 1000 AS f4
        FROM blk JOIN ent USING ({KEY_SQL}) JOIN wave USING ({KEY_SQL})),
fst AS (SELECT cell_type, avg(f1) AS m1, stddev_pop(f1) AS s1, avg(f2) AS m2, stddev_pop(f2) AS s2,
          avg(f3) AS m3, stddev_pop(f3) AS s3, avg(f4) AS m4, stddev_pop(f4) AS s4 FROM fac GROUP BY cell_type),
sc AS (SELECT {KEY_SQL}, cell_type, ((f1 - m1) / s1 + (f2 - m2) / s2 + (f3 - m3) / s3 + (f4 - m4) / s4) * 0.5 AS score
       FROM fac JOIN fst USING (cell_type)),
am AS (SELECT {KEY_SQL}, score, score > cut AS fired FROM sc JOIN
         (SELECT cell_type, quantile_cont(score, 0.99) AS cut FROM sc GROUP BY cell_type) USING (cell_type)),
a9 AS (SELECT r.battery_id, r.process_id, r.event_type, r.date_tag, r.td, r.td > 15 AS wide, r.td > 30 AS very_wide,
         coalesce(r.event_type = 'charging' AND n.event_type = 'parking' AND r.td > 15 AND n.td > 15, false)
           AS charge_and_rest, r.td > 15 AS fired
       FROM (SELECT battery_id, process_id, min(event_type) AS event_type, min(date_tag) AS date_tag,
               max(temp_diff_c) AS td FROM g GROUP BY 1, 2) r
       LEFT JOIN (SELECT battery_id, min(event_type) AS event_type, max(temp_diff_c) AS td,
                    lag(process_id) OVER (PARTITION BY battery_id ORDER BY min(us)) AS before
                  FROM g GROUP BY battery_id, process_id) n
         ON n.battery_id = r.battery_id AND n.before = r.process_id),
bd AS (SELECT battery_id, device_type, date_tag, avg(temp_diff_c) AS daily FROM g
       GROUP BY battery_id, device_type, date_tag),
a10 AS (SELECT battery_id, device_type, date_tag, daily, fence, round(daily, 9) > round(fence, 9) AS fired
        FROM bd JOIN (SELECT device_type, date_tag, {_FENCE.format(v='daily')} AS fence FROM bd
                      GROUP BY device_type, date_tag) USING (device_type, date_tag)),
a12 AS (SELECT *, greatest(cell_share, probe_share, iso_share) > 0.02 AS fired FROM (
          SELECT battery_id, date_tag, CAST(sum(n_msgs) AS BIGINT) AS n_msgs,
            coalesce(sum(n_msgs) FILTER (cell_init), 0) / sum(n_msgs) AS cell_share,
            coalesce(sum(n_msgs) FILTER (probe_init), 0) / sum(n_msgs) AS probe_share,
            coalesce(sum(n_msgs) FILTER (iso_init), 0) / sum(n_msgs) AS iso_share
          FROM f GROUP BY battery_id, date_tag)),
a13 AS (SELECT battery_id, date_tag, frame_no, abs(pack_voltage_v - list_sum(mv) / 1000) AS pack_gap_v,
          abs(pack_voltage_v - list_sum(mv) / 1000) > 20 AS fired FROM f),
acf AS (SELECT battery_id, date_tag, CAST(sum(n_msgs) AS BIGINT) AS n_cold, sum(n_msgs) > 1 AS fired
        FROM f WHERE cold_init GROUP BY battery_id, date_tag)
"""


def _alarm_sql(select):
    return with_ctes(ALARM_CTES + select)


@check("alg_ap2", _alarm_sql(f"SELECT {KEY_SQL}, vd_mv / 1000 AS max_volt_diff, "
                             "dev_mv / 1000 AS max_volt_skewness, fired FROM a2"),
       rounds=["max_volt_diff", "max_volt_skewness"])
def _(spark, sf):
    blocks = typed_blocks(spark, sf, "max_volt_diff", "max_volt_skewness")
    return spread.outlier_lfp(blocks).select(*KEY, "max_volt_diff", "max_volt_skewness", "fired")


@check("alg_ap3", _alarm_sql(f"SELECT {KEY_SQL}, vd_mv / 1000 AS max_volt_diff, "
                             "dev_mv / 1000 AS max_volt_skewness, fired FROM a3"),
       rounds=["max_volt_diff", "max_volt_skewness"])
def _(spark, sf):
    blocks = typed_blocks(spark, sf, "max_volt_diff", "max_volt_skewness")
    return spread.outlier_ncm(blocks).select(*KEY, "max_volt_diff", "max_volt_skewness", "fired")


@check("alg_ap8", _alarm_sql("SELECT battery_id, process_id, n_high, fired FROM a8"))
def _(spark, sf):
    return spread.high_spread(prepared(spark, sf)).select("battery_id", "process_id", "n_high", "fired")


@check("alg_parking", _alarm_sql("SELECT battery_id, process_id, growth_mv, fired FROM apk"),
       rounds=["growth_mv"])
def _(spark, sf):
    return spread.parking_growth(prepared(spark, sf), SPARSE).select(
        "battery_id", "process_id", "growth_mv", "fired")


_FACTORS = spread.FACTORS


@check("alg_vdiff_stat", _alarm_sql(f"SELECT {KEY_SQL}, volt_outlier, entropy_outlier, fired FROM ast"))
def _(spark, sf):
    return spread.statistical(typed_blocks(spark, sf, *_FACTORS[:2])).select(
        *KEY, "volt_outlier", "entropy_outlier", "fired")


@check("alg_alphaq", _alarm_sql("SELECT battery_id, process_id, position, shift, fired FROM aq"),
       rounds=["shift"])
def _(spark, sf):
    return spread.rank_shift(prepared(spark, sf), static_dim(spark), SPARSE).select(
        "battery_id", "process_id", F.col("position").cast("long").alias("position"), "shift", "fired")


@check("alg_vdiff_math", _alarm_sql(f"SELECT {KEY_SQL}, score, fired FROM am"), rounds=["score"], digits=5)
def _(spark, sf):
    return spread.factor_score(typed_blocks(spark, sf, *_FACTORS)).select(*KEY, "score", "fired")


# The first two principal axes of the normalised factors, per group: a covariance matrix, as a list row by row,
# squared 40 times with its trace kept at 1, is the projector on its first axis.
_TRACE = "({m}[1] + {m}[6] + {m}[11] + {m}[16])"
_AXIS = f"""list_reduce(list_transform(range(0, 41), lambda i: list_transform({{m}}, lambda v: v / {_TRACE.format(m='{m}')})),
  lambda a, b: list_transform(range(0, 16), lambda k: list_sum(list_transform(range(0, 4),
    lambda x: a[k // 4 * 4 + x + 1] * a[x * 4 + k % 4 + 1])) / list_sum(list_transform(a, lambda v: v * v))))"""
_ALONG = "list_sum(list_transform(range(1, 17), lambda i: {m}[i] * {p}[i]))"
_COV = ", ".join(f"avg(z{i} * z{j})" for i in range(1, 5) for j in range(1, 5))
_LENGTH = " + ".join(f"z{i} * z{j} * p[{4 * (i - 1) + j}]" for i in range(1, 5) for j in range(1, 5))
PCA_CTES = f"""
, zs AS (SELECT {KEY_SQL}, cell_type, {", ".join(f"(f{i} - m{i}) / s{i} AS z{i}" for i in range(1, 5))}
         FROM fac JOIN fst USING (cell_type)),
cov AS (SELECT cell_type, [{_COV}] AS c FROM zs GROUP BY cell_type),
ax1 AS (SELECT cell_type, c, {_AXIS.format(m='c')} AS p1 FROM cov),
cov2 AS (SELECT cell_type, p1, list_transform(range(1, 17), lambda i: c[i] - along * p1[i]) AS d
         FROM (SELECT *, {_ALONG.format(m='c', p='p1')} AS along FROM ax1)),
ax2 AS (SELECT cell_type, p1, {_AXIS.format(m='d')} AS p2 FROM cov2),
proj AS (SELECT cell_type, list_transform(range(1, 17), lambda i: p1[i] + p2[i]) AS p FROM ax2),
pc AS (SELECT {KEY_SQL}, cell_type, sqrt(greatest({_LENGTH}, 0)) AS score FROM zs JOIN proj USING (cell_type))
"""


@check("alg_vdiff_math_pca", _alarm_sql(PCA_CTES + f"""
SELECT {KEY_SQL}, score, score > cut AS fired FROM pc JOIN
  (SELECT cell_type, quantile_cont(score, 0.99) AS cut FROM pc GROUP BY cell_type) USING (cell_type)"""),
       rounds=["score"], digits=4)
def _(spark, sf):
    return spread.factor_score_pca(typed_blocks(spark, sf, *_FACTORS)).select(
        *KEY, "score", "fired")


@check("alg_ap9", _alarm_sql("SELECT battery_id, process_id, event_type, td AS max_temp_diff, wide, very_wide, "
                             "charge_and_rest, fired FROM a9"))
def _(spark, sf):
    return temperature.expert(prepared(spark, sf)).select(
        "battery_id", "process_id", "event_type", "max_temp_diff", "wide", "very_wide", "charge_and_rest",
        "fired")


@check("alg_ap10", _alarm_sql("SELECT battery_id, device_type, date_tag, daily AS daily_temp_diff, fence, fired "
                              "FROM a10"), rounds=["daily_temp_diff", "fence"])
def _(spark, sf):
    return temperature.statistical(typed_blocks(spark, sf, "avg_temp_diff", "effect_msg_count")).select(
        "battery_id", "device_type", "date_tag", "daily_temp_diff", "fence", "fired")


@check("alg_ap12", _alarm_sql("SELECT battery_id, date_tag, n_msgs, cell_share, probe_share, iso_share, fired "
                              "FROM a12"), rounds=["cell_share", "probe_share", "iso_share"])
def _(spark, sf):
    return sampling.initial_values(prepared(spark, sf), SPARSE).drop("device_id")


@check("alg_ap13", with_ctes("""
SELECT frame_no, abs(pack_voltage_v - list_sum(mv) / 1000) AS pack_gap_v,
  abs(pack_voltage_v - list_sum(mv) / 1000) > 20 AS fired FROM t"""), rounds=["pack_gap_v"])
def _(spark, sf):
    return sampling.pack_voltage(frames(spark, sf)).select("frame_no", "pack_gap_v", "fired")


@check("alg_sampling_temp", _alarm_sql("SELECT battery_id, date_tag, n_cold, fired FROM acf"))
def _(spark, sf):
    return sampling.cold_frames(prepared(spark, sf), SPARSE).drop("device_id")


SYM_CTES = """
, pv AS (SELECT battery_id, strftime(ts, '%Y-%m-%d') AS date_tag, mv, lag(mv) OVER (PARTITION BY battery_id ORDER BY us, frame_no) AS pmv FROM u),
st AS (SELECT battery_id, date_tag, list_transform(range(1, 13), lambda i: mv[i] - pmv[i]) AS dv FROM pv WHERE pmv IS NOT NULL),
sp AS (SELECT battery_id, date_tag, unnest(range(1, 12)) AS position,
         unnest(list_transform(range(1, 12), lambda i: CASE WHEN dv[i] * dv[i + 1] < 0
           THEN least(abs(dv[i]), abs(dv[i + 1])) ELSE 0 END)) AS x FROM st),
ss AS (SELECT battery_id, date_tag, position, sum(x) AS score FROM sp GROUP BY ALL),
sy AS (SELECT battery_id, date_tag, position, score, fence, score > fence AS fired FROM ss JOIN (
         SELECT battery_id, date_tag, quantile_cont(score, 0.75) + 1.5 * (quantile_cont(score, 0.75) - quantile_cont(score, 0.25))
           AS fence FROM ss GROUP BY ALL) USING (battery_id, date_tag))
"""


@check("alg_symmetry", with_ctes(SYM_CTES + "SELECT * FROM sy"), rounds=["score", "fence"])
def _(spark, sf):
    return sampling.symmetry(prepared(spark, sf)).withColumn("position", F.col("position").cast("long"))


@check("win_hot_battery", with_ctes("""
, c AS (SELECT us, frame_no, CASE WHEN e % 3 = 0 THEN 'HOT' ELSE battery_id END AS bid,
          (iso_kohm > 0 AND iso_kohm < 100)::INT AS p FROM t)
SELECT frame_no, bid AS battery_id, sum(p) OVER (PARTITION BY bid ORDER BY us, frame_no
  ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)::DOUBLE AS factor FROM c"""))
def _(spark, sf):
    """The row window with a third of all frames on one battery, in chunks far below its length."""
    df = frames(spark, sf).select(
        F.when(F.col("frame_no") % 3 == 0, "HOT").otherwise(F.col("battery_id")).alias("battery_id"),
        "sample_ts", "frame_no",
        F.when((F.col("iso_kohm") > 0) & (F.col("iso_kohm") < 100), 1.0).otherwise(0.0).alias("points"))
    return ordered.rolling(df, ["battery_id"], 100, {"factor": F.sum("points")}, ordered.time_slice(7200),
                           chunk_rows=500).select("frame_no", "battery_id", "factor")


# --- diagnosis ---------------------------------------------------------------------------


def _days_sql(rows):
    return " UNION ALL ".join(
        f"SELECT battery_id, date_tag, '{name}' AS algorithm, count(*) AS n FROM {table} WHERE fired "
        "GROUP BY battery_id, date_tag" for name, table in rows)


def _fused(rows):
    return f"""
, al AS ({_days_sql(rows)}),
dy AS (SELECT battery_id, date_tag, list_sort(list(DISTINCT algorithm)) AS algorithms,
         CAST(sum(n) AS BIGINT) AS n_fired FROM al GROUP BY battery_id, date_tag)
"""


_VOLT = (("ap2", "a2"), ("ap3", "a3"), ("ap8", "a8"), ("ap_alphaq", "aq"), ("ap_vdiff_stat", "ast"),
         ("ap_vdiff_math", "am"), ("ap_vdiff_parking", "apk"))


@check("alg_ap28", _alarm_sql(_fused(_VOLT) + """
, r AS (SELECT *, list_has_any(algorithms, ['ap2']) AS lfp_group, list_has_any(algorithms, ['ap3']) AS ncm_group,
    list_has_any(algorithms, ['ap8', 'ap_alphaq', 'ap_vdiff_stat', 'ap_vdiff_math', 'ap_vdiff_parking'])
      AS common_group FROM dy)
SELECT battery_id, date_tag, code, n_fired, lfp_group, ncm_group, common_group FROM (
  SELECT *, 'P0201' AS code FROM r WHERE list_has_any(algorithms, ['ap2', 'ap3'])
    AND list_contains(algorithms, 'ap_vdiff_parking')
  UNION ALL SELECT *, 'P0202' FROM r WHERE list_has_any(algorithms, ['ap8', 'ap_vdiff_stat', 'ap_vdiff_math'])
  UNION ALL SELECT *, 'P0203' FROM r WHERE list_contains(algorithms, 'ap_alphaq'))"""))
def _(spark, sf):
    ready, static = prepared_table(spark, sf), static_dim(spark)
    blocks = typed_blocks(spark, sf, *_FACTORS, ready=ready)
    alarms = diagnosis.merge([
        diagnosis.fired_days(df, name) for name, df in (
            ("ap2", spread.outlier_lfp(blocks)), ("ap3", spread.outlier_ncm(blocks)),
            ("ap8", spread.high_spread(ready)), ("ap_alphaq", spread.rank_shift(ready, static, SPARSE)),
            ("ap_vdiff_stat", spread.statistical(blocks)), ("ap_vdiff_math", spread.factor_score(blocks)),
            ("ap_vdiff_parking", spread.parking_growth(ready, SPARSE)))])
    return diagnosis.voltage(alarms).drop("algorithms")


@check("alg_ap27", _alarm_sql(_fused((("ap9", "a9"), ("ap10", "a10"))) + """
, n0 AS (SELECT battery_id, us, frame_no, temp_diff_c, sum(CASE WHEN temp_diff_c > 15 THEN 0 ELSE 1 END)
           OVER (PARTITION BY battery_id ORDER BY us, frame_no) AS island,
           max(us) OVER (PARTITION BY battery_id) AS last_us FROM g),
sr AS (SELECT battery_id, min(us) AS s, max(us) AS z, any_value(last_us) AS last_us FROM n0
       WHERE temp_diff_c > 15 GROUP BY battery_id, island),
sd AS (SELECT battery_id, strftime(day, '%Y-%m-%d') AS date_tag, max((z - s) / 1000000.0) AS longest_s,
         bool_and(z < last_us) AS recovered FROM (SELECT *, unnest(generate_series(
           date_trunc('day', make_timestamp(s)), date_trunc('day', make_timestamp(z)), INTERVAL 1 DAY)) AS day FROM sr)
       GROUP BY ALL),
r AS (SELECT * FROM dy LEFT JOIN sd USING (battery_id, date_tag))
SELECT battery_id, date_tag, code, n_fired, longest_s, recovered FROM (
  SELECT *, 'P0302' AS code FROM r WHERE longest_s >= 1 AND NOT recovered
  UNION ALL SELECT *, 'P0308' FROM r WHERE recovered)"""), rounds=["longest_s"])
def _(spark, sf):
    ready = prepared_table(spark, sf)
    blocks = typed_blocks(spark, sf, "avg_temp_diff", "effect_msg_count", ready=ready)
    alarms = diagnosis.merge([diagnosis.fired_days(temperature.expert(ready), "ap9"),
                              diagnosis.fired_days(temperature.statistical(blocks), "ap10")])
    return diagnosis.temperature(alarms, ready, SPARSE).drop("algorithms")


@check("alg_ap29", _alarm_sql(SYM_CTES + """
, syd AS (SELECT battery_id, date_tag, bool_or(fired) AS fired FROM sy GROUP BY ALL)
""" + _fused((("ap12", "a12"), ("ap13", "a13"), ("ap_sampling_temp", "acf"), ("ap_sampling_symmetry", "syd"))) + """
, r AS (SELECT *, n_fired > avg(n_fired) OVER w + 1.0 * stddev_pop(n_fired) OVER w AS sigma_outlier FROM dy
        WINDOW w AS (PARTITION BY date_tag))
SELECT battery_id, date_tag, code, n_fired, sigma_outlier FROM (
  SELECT *, 'P0301' AS code FROM r WHERE list_has_any(algorithms, ['ap12', 'ap_sampling_symmetry']) AND sigma_outlier
  UNION ALL SELECT *, 'P0303' FROM r WHERE list_contains(algorithms, 'ap_sampling_temp')
  UNION ALL SELECT *, 'P0308' FROM r WHERE list_contains(algorithms, 'ap13'))"""))
def _(spark, sf):
    ready = prepared_table(spark, sf)
    mirrored = sampling.symmetry(ready).groupBy("battery_id", "date_tag").agg(F.bool_or("fired").alias("fired"))
    alarms = diagnosis.merge([diagnosis.fired_days(df, name) for name, df in (
        ("ap12", sampling.initial_values(ready, SPARSE)), ("ap13", sampling.pack_voltage(ready)),
        ("ap_sampling_temp", sampling.cold_frames(ready, SPARSE)),
        ("ap_sampling_symmetry", mirrored))])
    return diagnosis.sampling(alarms, SPARSE).drop("algorithms")
