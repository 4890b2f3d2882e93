"""Battery telemetry derived from the ``events`` table, in Spark and in SQL.

Integer arithmetic on event id, user and the ``k`` property, so both engines see the same
values. Four batteries per 200 users: their number grows with the table while the time
between two frames of a battery stays about a quarter of an hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.operators import features
from cellwatch.params import DEFAULTS, Params

STATIC_ROWS = [("T0", "NCM", 200.0, 70.0), ("T1", "LFP", 210.0, 75.0)]
STATIC_DDL = "battery_type string, cell_type string, battery_capacity double, battery_energy double"


def static_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIC_ROWS, STATIC_DDL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The vectors are written out per position, with the injected faults as columns of their
# own: short compiled code, where one long expression per position would not be compiled.
_FAULTS = {
    "flat": "e % 97 = 0", "width": "9 + e % 7", "x2": "if(e % 211 = 0, -2400, 0)",
    "x3": "if(e % 29 = 0, 20, 0)", "x5": "if(e % 53 = 0, 250, 0)",
    "x7": "if(e % 199 = 0 OR e % 173 = 0, 1000, 0)", "y2": "if(e % 61 = 0, 20, 0)",
    "y1": "if(e % 113 = 0 OR e % 173 = 0, 40, 0)", "y4": "if(e % 127 = 0, -65 - (e + 4) % 4, 0)",
}
_FLAT = ", ".join(f"{3600 + i if i >= 4 else 0}.0D" for i in range(12))
_CELLS = ", ".join(f"cast(3600 + (e * 7 + {i * 13}) % width{f' + x{i}' if i in (2, 3, 5, 7) else ''} AS double)"
                   for i in range(12))
_PROBES = ", ".join(f"cast(25 + (e + {i}) % 4{f' + y{i}' if i in (1, 2, 4) else ''} AS double)"
                    for i in range(6))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deals rows by their id: the test tables are single files that scans cannot split."""
    return df.repartition(F.col(key))


def base(events: DataFrame) -> DataFrame:
    """One row per event with the integers everything else is computed from."""
    return (events.selectExpr(
        "event_id AS e", "cast(ts AS timestamp) AS sample_ts",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        "cast((user_id div 200) * 4 + user_id % 4 AS int) AS b")
        .selectExpr("*", "cast(hour(sample_ts) div 2 AS int) AS slot",
                    "(hour(sample_ts) % 2) * 60 + minute(sample_ts) AS m2", "b % 4 >= 2 AS station")
        .selectExpr("*", """CASE WHEN station THEN if((slot + b) % 3 = 0, 'charging', 'parking')
            ELSE element_at(array('driving', 'parking', 'charging'), (slot + b) % 3 + 1) END
            AS event_type""")
        .selectExpr("*", *[f"{v} AS {n}" for n, v in _FAULTS.items()])
        .selectExpr("e", "sample_ts", "k", "b", "slot", "m2", "station", "event_type",
                    f"if(flat, array({_FLAT}), array({_CELLS})) AS mv", f"array({_PROBES}) AS temps",
                    """CASE WHEN (e div 40) % 23 = 0 THEN 60 + k % 30 WHEN e % 131 = 0 THEN 5000
            ELSE 2000 + 10 * k END AS iso"""))


def frames_of(events: DataFrame) -> DataFrame:
    """Canonical frames of an events frame, batch or stream."""
    return base(events).selectExpr(
        "concat('B', b) AS battery_id", "concat('D', b) AS device_id",
        "concat('N', b) AS device_name", "if(station, 'swap_station', 'vehicle') AS device_type",
        "if(station, 'station', 'vehicle') AS source", "event_type",
        "cast(null AS bigint) AS process_id", "sample_ts", "e AS frame_no",
        """cast(CASE event_type WHEN 'charging' THEN 30 + m2 * 0.5D
            WHEN 'driving' THEN 90 - m2 * 0.5D ELSE 60 END AS double) AS user_soc""",
        """cast(CASE event_type WHEN 'charging' THEN -50 - k WHEN 'driving' THEN 20 + k
            ELSE 0 END AS double) AS current_a""",
        """aggregate(mv, 0.0D, (a, x) -> a + x) / 1000.0D + if(e % 89 = 0, 25, 0)
            AS pack_voltage_v""",
        "transform(mv, x -> x / 1000.0D) AS cell_v", "temps AS probe_temp_c",
        "if(e % 103 = 0, 13, 12) AS n_cells", "6 AS n_probes",
        "if(e % 151 = 0, 4.096D, null) AS max_cell_v", "cast(null AS int) AS max_cell_sn",
        "cast(null AS double) AS min_cell_v", "cast(null AS int) AS min_cell_sn",
        "cast(null AS double) AS avg_cell_v",
        "cast(null AS double) AS max_temp_c", "cast(null AS int) AS max_temp_sn",
        "cast(null AS double) AS min_temp_c", "cast(null AS int) AS min_temp_sn",
        "cast(null AS double) AS avg_temp_c",
        "cast(iso AS double) AS iso_kohm", "e % 7 < 2 AS is_balancing",
        "cast(if(event_type = 'charging', 1, 0) AS int) AS charge_state",
        "cast(if(station, null, 1000 + e) AS int) AS mileage",
        "cast(if(station, null, if(event_type = 'driving', k, 0)) AS double) AS speed",
        "concat('v', e div 5000) AS bms_version", "concat('d', e div 3000) AS device_version",
        "if(b % 2 = 0, 'T0', 'T1') AS battery_type",
        "if(station, null, cast(b % 2 AS string)) AS is_test",
        "concat('brand', b % 3) AS brand",
    ).selectExpr("*", "user_soc - 1 AS real_soc", "95.0D AS soh", "user_soc * 0.7D AS real_energy")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props"), "event_id")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames_of(events(spark, sf_dir))


def with_copies(df: DataFrame) -> DataFrame:
    """Every 83rd frame is sent a second time, later in number."""
    copies = F.when(F.col("frame_no") % 83 == 0, F.array(F.lit(0), F.lit(10**12)))
    return (df.withColumn("_c", F.explode(F.coalesce(copies, F.array(F.lit(0).cast("long")))))
            .withColumn("frame_no", F.col("frame_no") + F.col("_c")).drop("_c"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(frames(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str, p: Params = DEFAULTS) -> DataFrame:
    return features.prepare(messages(spark, sf_dir), p, unique_numbers=True)


# The same in SQL, as a chain of common table expressions:
#   t frames, m frames with copies, d derived signals and quality flags,
#   u one frame per sample, f with process and tags, g with gaps inside the process.
CTES = """
WITH b0 AS (
  SELECT event_id AS e, ts, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CAST((user_id // 200) * 4 + user_id % 4 AS INT) AS b,
         CAST(hour(ts) // 2 AS INT) AS slot,
         CAST((hour(ts) % 2) * 60 + minute(ts) AS INT) AS m2
  FROM events),
b1 AS (
  SELECT *, b % 4 >= 2 AS station,
         CASE WHEN b % 4 >= 2 THEN CASE WHEN (slot + b) % 3 = 0 THEN 'charging' ELSE 'parking' END
              ELSE CASE (slot + b) % 3 WHEN 0 THEN 'driving' WHEN 1 THEN 'parking'
                   ELSE 'charging' END END AS event_type,
         list_transform(range(0, 12), lambda i: CAST(CASE
           WHEN e % 97 = 0 THEN CASE WHEN i >= 4 THEN 3600 + i ELSE 0 END
           ELSE 3600 + (e * 7 + i * 13) % (9 + e % 7) + CASE WHEN e % 29 = 0 AND i = 3 THEN 20 ELSE 0 END
             + CASE WHEN e % 53 = 0 AND i = 5 THEN 250 ELSE 0 END
             + CASE WHEN (e % 199 = 0 OR e % 173 = 0) AND i = 7 THEN 1000 ELSE 0 END
             - CASE WHEN e % 211 = 0 AND i = 2 THEN 2400 ELSE 0 END END AS DOUBLE)) AS mv,
         list_transform(range(0, 6), lambda i: CAST(25 + (e + i) % 4
           + CASE WHEN e % 61 = 0 AND i = 2 THEN 20 ELSE 0 END
           + CASE WHEN (e % 113 = 0 OR e % 173 = 0) AND i = 1 THEN 40 ELSE 0 END
           - CASE WHEN e % 127 = 0 AND i = 4 THEN 65 + (e + i) % 4 ELSE 0 END AS DOUBLE)) AS temps,
         CAST(CASE WHEN (e // 40) % 23 = 0 THEN 60 + k % 30 WHEN e % 131 = 0 THEN 5000
              ELSE 2000 + 10 * k END AS DOUBLE) AS iso_kohm
  FROM b0),
t AS (
  SELECT e, b, k, slot, station, event_type, mv, temps, iso_kohm, ts,
         'B' || b AS battery_id, 'D' || b AS device_id, 'N' || b AS device_name,
         CASE WHEN station THEN 'swap_station' ELSE 'vehicle' END AS device_type,
         CASE WHEN station THEN 'station' ELSE 'vehicle' END AS source,
         e AS frame_no, epoch_us(ts) AS us,
         CAST(CASE event_type WHEN 'charging' THEN 30 + m2 * 0.5 WHEN 'driving' THEN 90 - m2 * 0.5
              ELSE 60 END AS DOUBLE) AS user_soc,
         CAST(CASE event_type WHEN 'charging' THEN -50 - k WHEN 'driving' THEN 20 + k
              ELSE 0 END AS DOUBLE) AS current_a,
         list_sum(mv) / 1000.0 + CASE WHEN e % 89 = 0 THEN 25 ELSE 0 END AS pack_voltage_v,
         CASE WHEN e % 103 = 0 THEN 13 ELSE 12 END AS n_cells, 6 AS n_probes,
         e % 7 < 2 AS is_balancing,
         CASE WHEN station THEN NULL ELSE CAST(1000 + e AS INT) END AS mileage,
         CAST(CASE WHEN station THEN NULL WHEN event_type = 'driving' THEN k ELSE 0 END AS DOUBLE)
           AS speed,
         'v' || (e // 5000) AS bms_version, 'd' || (e // 3000) AS device_version,
         CASE WHEN b % 2 = 0 THEN 'T0' ELSE 'T1' END AS battery_type,
         CASE WHEN b % 2 = 0 THEN 'NCM' ELSE 'LFP' END AS cell_type,
         CASE WHEN station THEN NULL ELSE CAST(b % 2 AS VARCHAR) END AS is_test,
         'brand' || (b % 3) AS brand
  FROM b1),
m AS (
  SELECT * FROM t
  UNION ALL SELECT * REPLACE (frame_no + 1000000000000 AS frame_no) FROM t WHERE e % 83 = 0),
d0 AS (
  SELECT *, list_max(mv) AS hi_mv, list_min(mv) AS lo_mv, list_sum(mv) / 12 AS mean_mv,
         list_aggregate(mv, 'quantile_cont', 0.5) AS median_mv,
         CAST(list_position(mv, list_max(mv)) AS INT) AS hi_sn,
         CAST(list_position(mv, list_min(mv)) AS INT) AS lo_sn,
         list_max(temps) AS hot_c, list_min(temps) AS cold_c, list_sum(temps) / 6 AS mean_c,
         CAST(list_position(temps, list_max(temps)) AS INT) AS hot_sn,
         CAST(list_position(temps, list_min(temps)) AS INT) AS cold_sn
  FROM m),
d1 AS (
  SELECT *, hi_mv - lo_mv AS volt_diff_mv, hot_c - cold_c AS temp_diff_c,
         greatest(hi_mv - median_mv, median_mv - lo_mv) AS deviation_mv,
         CASE WHEN e % 151 = 0 THEN CAST(4.096 AS DOUBLE) ELSE hi_mv / 1000.0 END AS max_cell_v,
         len(list_filter(mv, lambda x: x = 0)) / 12.0 AS cell_missing_share,
         len(list_filter(temps, lambda x: x = 0)) / 6.0 AS probe_missing_share
  FROM d0),
d AS (
  SELECT *, max_cell_v IN (4.096, 5.094, 65535) AS cell_init, cold_c IN (-40, -50, 255) AS probe_init,
         hot_c = -40 OR cold_c = -40 AS cold_init, iso_kohm IN (5000, 10000, 60000) AS iso_init,
         cell_missing_share > 0.3 OR probe_missing_share > 0.3 AS is_missing,
         n_cells = 12 AS is_aligned,
         NOT (max_cell_v IN (4.096, 5.094, 65535) OR cold_c IN (-40, -50, 255) OR hot_c = -40
              OR cold_c = -40 OR iso_kohm IN (5000, 10000, 60000) OR cell_missing_share > 0.3
              OR probe_missing_share > 0.3) AS is_sound
  FROM d1),
u AS (
  SELECT *, is_sound AND is_aligned AS is_effective,
         count(*) OVER (PARTITION BY battery_id, ts) AS n_msgs
  FROM d QUALIFY row_number() OVER (PARTITION BY battery_id, ts ORDER BY frame_no) = 1),
u1 AS (
  SELECT *, CASE WHEN lag(event_type) OVER w IS NULL OR lag(event_type) OVER w = event_type
            THEN 0 ELSE 1 END AS chg
  FROM u WINDOW w AS (PARTITION BY battery_id ORDER BY ts, frame_no)),
f AS (
  SELECT *, CAST(1 + sum(chg) OVER (PARTITION BY battery_id ORDER BY ts, frame_no) AS BIGINT)
           AS process_id,
         strftime(ts, '%Y-%m-%d') AS date_tag, slot AS hour_tag,
         CAST(least(floor(user_soc / 5), 19) AS INT) AS soc_tag,
         CASE WHEN current_a < -100 THEN 0 WHEN current_a < 0 THEN 1 WHEN current_a = 0 THEN 2
              WHEN current_a < 100 THEN 3 ELSE 4 END AS curr_tag
  FROM u1),
g AS (
  SELECT *, coalesce((us - lag(us) OVER w) / 1000000.0, 0) AS gap_s,
         coalesce(lag(is_balancing) OVER w, false) AS was_balancing
  FROM f WHERE is_effective
  WINDOW w AS (PARTITION BY battery_id, process_id ORDER BY ts, frame_no))
"""

# The block key as the checks show it.
KEY_SQL = "battery_id, process_id, date_tag, hour_tag, soc_tag, curr_tag"
KEY = [c.strip() for c in KEY_SQL.split(",")]


def with_ctes(body: str) -> str:
    """The chain plus ``body``; a body that starts with a comma adds tables of its own."""
    return CTES + body
