"""Signals, classification, routing and evaluation of cases."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from cellwatch.operators import classify, features, normalize, quality, signals
from cellwatch.params import DEFAULTS
from cellwatch.plans import dispatch
from cellwatch.sources.registry import BUILT_IN, registry_df, signal_rows

from .feature_checks import REST_CTES
from .registry import check
from .registry_values import KEYWORDS, LIMITS, TYPES
from .telemetry import base, frames, prepared, spread, static_dim, table, with_ctes

DAY = ["battery_id", "date_tag"]


def station_rests(spark, sf):
    """Rests after a charge at stations, of batteries of the one chemistry, with the day they are known."""
    ready, p = prepared(spark, sf), DEFAULTS
    kinds = static_dim(spark).filter(F.col("cell_type") == p.selfdch_cell_type).select("battery_type")
    rests = features.rest_pairs(ready.join(kinds, "battery_type", "left_semi"), p).filter("at1 is not null")
    return rests.withColumn("date_tag", F.date_format("at1.sample_ts", "yyyy-MM-dd"))


def signalled(spark, sf):
    df = quality.with_quality(normalize.frame_derived(frames(spark, sf)))
    return signals.frame_signals(df).withColumn("date_tag", F.date_format("sample_ts", "yyyy-MM-dd"))


def _quote(value):
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


REG_CTES = f"""
, types(position, failure_type, family, name, algorithm, version, skill, status, model_path, design_doc) AS (
  VALUES {TYPES}),
words(position, keyword) AS (VALUES {KEYWORDS}),
lim(failure_type, algorithm, signal, metric, op, limit_value) AS (VALUES {LIMITS}),
kw AS (SELECT position, failure_type, keyword FROM words JOIN types USING (position)),
reg AS (SELECT *, (SELECT count(*) FROM words w WHERE w.position = t.position) AS n_keywords,
          (SELECT count(*) FROM lim l WHERE l.failure_type = t.failure_type) AS n_signals FROM types t)
"""
# Registry hits of battery-days, from their metrics as rows (battery_id, date_tag, metric, value).
HIT_CTES = """
, hits1 AS (SELECT battery_id, date_tag, metric, failure_type, signal, value, limit_value FROM {long} JOIN lim USING (metric)
  WHERE CASE op WHEN 'gt' THEN value > limit_value WHEN 'lt' THEN value < limit_value END),
reg_hits AS (SELECT battery_id, date_tag, failure_type, signal, value, limit_value FROM hits1
  UNION ALL SELECT battery_id, date_tag, failure_type, signal, n, limit_value FROM (
    SELECT battery_id, date_tag, count(DISTINCT metric)::DOUBLE AS n FROM hits1 GROUP BY ALL), lim
  WHERE op = 'flag' AND n >= limit_value)
"""
DAY_LONG = """
, day_long AS (UNPIVOT (SELECT battery_id, date_tag, max_temp, temp_diff, min_volt, max_volt, volt_diff,
    iso_resistance FROM cm)
  ON max_temp, temp_diff, min_volt, max_volt, volt_diff, iso_resistance INTO NAME metric VALUE value)
"""
# Rests at stations of the one chemistry, by the day they are known.
NCM_CTES = REST_CTES + """
, ncm AS (SELECT *, strftime(make_timestamp(at1.us), '%Y-%m-%d') AS date_tag FROM pairs
  WHERE device_type = 'swap_station' AND prev_event_type = 'charging' AND cell_type = 'NCM' AND at1 IS NOT NULL)
"""
# Metrics of frames and rests of battery-days as rows.
ALL_LONG = DAY_LONG + NCM_CTES + """
, rest_days AS (SELECT battery_id, date_tag, min(drop_rate) AS volt_drop_rate, max(outlier) AS outlier_rate FROM ncm
  GROUP BY ALL),
rest_long AS (UNPIVOT rest_days ON volt_drop_rate, outlier_rate INTO NAME metric VALUE value),
all_long AS (SELECT * FROM day_long UNION ALL SELECT battery_id, date_tag, metric, value FROM rest_long)
"""

# Frame signals and their day-level roll-up.
SIG_CTES = """
, s0 AS (SELECT *, hot_c > 55 OR temp_diff_c > 30 AS sig_heat, lo_mv < 1300 OR hi_mv > 4500 AS sig_cell_limit,
           volt_diff_mv > 300 AND NOT (hot_c > 55 OR temp_diff_c > 30) AS sig_spread,
           iso_kohm > 0 AND iso_kohm < 100 AS sig_insulation,
           volt_diff_mv > 200 AND hot_c < 40 AS sig_cool_spread,
           temp_diff_c > 15 AND volt_diff_mv < 50 AS sig_temp_spread, is_missing AS sig_missing,
           strftime(ts, '%Y-%m-%d') AS date_tag
         FROM d WHERE frame_no < 1000000000000),
s AS (SELECT *, CASE WHEN sig_spread THEN CASE WHEN hot_c < 40 THEN 'voltage_spread'
           ELSE 'thermal_runaway' END END AS spread_family FROM s0),
cm AS (SELECT battery_id, date_tag, count(*) AS n_frames, max(hot_c) AS max_temp,
         max(temp_diff_c) AS temp_diff, min(lo_mv) AS min_volt, max(hi_mv) AS max_volt,
         max(volt_diff_mv) AS volt_diff, min(CASE WHEN iso_kohm > 0 THEN iso_kohm END) AS iso_resistance,
         max(greatest(cell_missing_share, probe_missing_share)) AS missing_share,
         count_if(sig_heat) AS n_sig_heat, count_if(sig_cell_limit) AS n_sig_cell_limit,
         count_if(sig_spread) AS n_sig_spread, count_if(sig_insulation) AS n_sig_insulation,
         count_if(sig_cool_spread) AS n_sig_cool_spread, count_if(sig_temp_spread) AS n_sig_temp_spread,
         count_if(sig_missing) AS n_sig_missing,
         count_if(coalesce(spread_family = 'voltage_spread', false)) AS n_spread_cool
       FROM s GROUP BY battery_id, date_tag),
ir0 AS (SELECT battery_id, date_tag, us, frame_no, iso_kohm < 100 AS low,
          sum(CASE WHEN iso_kohm < 100 THEN 0 ELSE 1 END)
            OVER (PARTITION BY battery_id, date_tag ORDER BY us, frame_no) AS island
        FROM s WHERE iso_kohm > 0),
held AS (SELECT DISTINCT battery_id, date_tag FROM (
           SELECT battery_id, date_tag, island FROM ir0 WHERE low
           GROUP BY battery_id, date_tag, island HAVING count(*) >= 3)),
cs AS (SELECT battery_id, date_tag, signal, family FROM (
         SELECT battery_id, date_tag, unnest([
           {'signal': 'sig_heat', 'family': 'thermal_runaway', 'n': n_sig_heat},
           {'signal': 'sig_cell_limit', 'family': 'thermal_runaway', 'n': n_sig_cell_limit},
           {'signal': 'sig_insulation', 'family': 'insulation', 'n': n_sig_insulation},
           {'signal': 'sig_cool_spread', 'family': 'voltage_spread', 'n': n_sig_cool_spread},
           {'signal': 'sig_temp_spread', 'family': 'temperature_spread', 'n': n_sig_temp_spread},
           {'signal': 'sig_missing', 'family': 'sampling', 'n': n_sig_missing},
           {'signal': 'sig_spread', 'family': 'voltage_spread', 'n': n_spread_cool},
           {'signal': 'sig_spread', 'family': 'thermal_runaway', 'n': n_sig_spread - n_spread_cool}],
           recursive := true) FROM cm)
       WHERE n > 0 AND (signal <> 'sig_insulation' OR
         (battery_id, date_tag) IN (SELECT (battery_id, date_tag) FROM held)))
"""
# With what several registry limits add to the rules' signals.
VERDICT_CTES = REG_CTES + SIG_CTES + DAY_LONG + HIT_CTES.format(long="day_long") + """
, all_cs AS (SELECT battery_id, date_tag, signal, family FROM cs
  UNION ALL SELECT DISTINCT battery_id, date_tag, signal, NULL FROM reg_hits WHERE signal = 'multi_signal'),
verdicts AS (
  SELECT battery_id, date_tag, CASE WHEN n = 1 THEN 'inferred' WHEN n > 1 THEN 'ambiguous'
           WHEN signals IS NOT NULL THEN 'weak' ELSE 'none' END
           AS verdict, families, signals, CASE WHEN n = 1 THEN families END AS inferred_family
  FROM (SELECT cm.battery_id, cm.date_tag, count(DISTINCT family) AS n,
          string_agg(DISTINCT family, ',' ORDER BY family) AS families,
          string_agg(DISTINCT signal, ',' ORDER BY signal) AS signals
        FROM cm LEFT JOIN all_cs USING (battery_id, date_tag) GROUP BY cm.battery_id, cm.date_tag))
"""


@check("sig_rules", with_ctes(SIG_CTES + """
SELECT frame_no, sig_heat, sig_cell_limit, sig_spread, sig_insulation, sig_cool_spread, sig_temp_spread,
  sig_missing, spread_family FROM s"""))
def _(spark, sf):
    return signalled(spark, sf).select("frame_no", *signals.FAMILIES, "spread_family")


@check("sig_insulation_run", with_ctes("""
, i AS (SELECT *, sum(CASE WHEN iso_kohm < 100 THEN 0 ELSE 1 END)
          OVER (PARTITION BY battery_id ORDER BY us, frame_no) AS island FROM t WHERE iso_kohm > 0)
SELECT battery_id, count(*) AS n_frames, min(us) AS start_us, max(us) AS end_us,
  (max(us) - min(us)) / 1000000.0 AS duration_s, min(iso_kohm) AS min_iso
FROM i WHERE iso_kohm < 100 GROUP BY battery_id, island"""), rounds=["duration_s"], digits=6)
def _(spark, sf):
    return signals.insulation_runs(frames(spark, sf)).select(
        "battery_id", "n_frames", F.unix_micros("start_ts").alias("start_us"),
        F.unix_micros("end_ts").alias("end_us"), "duration_s", "min_iso")


@check("sig_case_rollup", with_ctes(SIG_CTES + "SELECT * FROM cm"), rounds=["missing_share"])
def _(spark, sf):
    return signals.case_metrics(signalled(spark, sf), DAY)


@check("reg_signals_long", with_ctes(REG_CTES + SIG_CTES + NCM_CTES + """
, long AS (UNPIVOT (SELECT frame_no, hot_c AS max_temp, temp_diff_c AS temp_diff, lo_mv AS min_volt,
    hi_mv AS max_volt, volt_diff_mv AS volt_diff,
    CASE WHEN iso_kohm > 0 THEN iso_kohm END AS iso_resistance FROM s)
  ON max_temp, temp_diff, min_volt, max_volt, volt_diff, iso_resistance INTO NAME metric VALUE value),
rests AS (UNPIVOT (SELECT drop_rate AS volt_drop_rate, outlier AS outlier_rate FROM ncm)
  ON volt_drop_rate, outlier_rate INTO NAME metric VALUE value),
beyond AS (SELECT frame_no, metric, failure_type, signal FROM lim JOIN long USING (metric)
  WHERE CASE op WHEN 'gt' THEN value > limit_value WHEN 'lt' THEN value < limit_value END
  UNION ALL SELECT NULL, metric, failure_type, signal FROM lim JOIN rests USING (metric)
  WHERE CASE op WHEN 'gt' THEN value > limit_value WHEN 'lt' THEN value < limit_value END),
several AS (SELECT frame_no, count(DISTINCT metric) AS n FROM beyond WHERE frame_no IS NOT NULL GROUP BY frame_no),
found AS (SELECT failure_type, signal FROM beyond
  UNION ALL SELECT failure_type, signal FROM several JOIN lim ON op = 'flag' AND n >= limit_value)
SELECT lim.failure_type, lim.signal, CASE WHEN op <> 'flag' THEN limit_value END AS limit_value,
  count(found.signal) AS n_beyond
FROM lim LEFT JOIN found USING (failure_type, signal) GROUP BY ALL"""))
def _(spark, sf):
    """Every limit of the registry with the number of frames, or of rests, beyond it."""
    df = signalled(spark, sf).withColumn("iso_reading", signals.iso_reading())
    registry, metrics = registry_df(spark), {**signals.METRICS, **signals.REST_METRICS}

    def hits(rows, keys, names):
        long = rows.select(*keys, *[F.col(metrics[m][0]).cast("double").alias(m) for m in names]).unpivot(
            keys, list(names), "metric", "value")
        return signals.eval_registry(long, registry, keys).select("failure_type", "signal")

    # the flag counts frames
    rests = hits(station_rests(spark, sf), ["battery_id", "process_id"], signals.REST_METRICS)
    found = hits(df, ["frame_no"], signals.METRICS).unionByName(rests.filter(F.col("signal") != signals.SEVERAL))
    counts = found.groupBy("failure_type", "signal").agg(F.count("*").alias("n"))
    return (signal_rows(registry).join(counts, ["failure_type", "signal"], "left")
            .select("failure_type", "signal", "limit_value", F.coalesce("n", F.lit(0)).alias("n_beyond")))


@check("sig_registry_eval", with_ctes(REG_CTES + SIG_CTES + ALL_LONG + HIT_CTES.format(long="all_long") + """
SELECT * FROM reg_hits"""), rounds=["value"])
def _(spark, sf):
    """Limits on frames and on rests, and the flag that counts both, for every battery-day."""
    metrics = signals.case_metrics(signalled(spark, sf), DAY)
    long = signals.metrics_long(metrics, DAY).unionByName(
        signals.rest_metrics_long(station_rests(spark, sf), DAY))
    return signals.eval_registry(long, registry_df(spark), DAY).select(
        *DAY, "failure_type", "signal", "value", "limit_value")


def verdicts(spark, sf):
    df = signalled(spark, sf)
    return signals.arbitrate(df, dispatch.day_signals(df), DAY)


@check("sig_arbitrate", with_ctes(VERDICT_CTES + "SELECT * FROM verdicts"))
def _(spark, sf):
    return verdicts(spark, sf).withColumns({
        "families": F.array_join("families", ","), "signals": F.array_join("signals", ",")})


# --- case text -----------------------------------------------------------------------------
# Cases are documents with registry keywords worked into two of seven texts.

_TYPES = [t.failure_type for t in BUILT_IN]
_WORDS = [k for t in BUILT_IN for k in t.keywords]


def cases(spark, sf):
    words = F.array(*[F.lit(w) for w in _WORDS])
    types = F.array(*[F.lit(t) for t in _TYPES])
    tasks = F.array(*[F.lit(w) for w in ("漏报", "误报", "批量", "优化", "")])
    c = F.col("doc_id")
    # cases name the batteries there are
    batteries = base(table(spark, sf, "events")).agg(F.max("b") + 1).first()[0]

    def word(step):
        return F.get(words, (c * step % len(_WORDS)).cast("int"))

    return spread(table(spark, sf, "documents"), "doc_id").select(
        c.alias("case_id"),
        F.concat("text", F.when(c % 7 == 0, F.concat(F.lit(" "), F.upper(word(1)))).otherwise(""),
                 F.when(c % 7 == 1, F.concat(F.lit(" "), word(3), F.lit(" "), word(11))).otherwise(""),
                 F.when(c % 3 == 0, F.concat(F.lit(" "), F.get(tasks, (c % 5).cast("int")))).otherwise(""))
        .alias("text"),
        F.when(c % 5 == 0, F.get(types, (c % 25).cast("int"))).alias("confirmed_type"),
        F.concat(F.lit("B"), c % batteries).alias("battery_id"),
        F.expr("date_add(date'2024-01-01', cast(doc_id % 30 AS int))").alias("from_date"),
        F.expr("date_add(date'2024-01-01', cast(doc_id % 30 + doc_id % 3 AS int))").alias("to_date"))


CASE_CTES = f"""
, word(i, w) AS (VALUES {", ".join(f"({i}, {_quote(w)})" for i, w in enumerate(_WORDS))}),
cases AS (
  SELECT doc_id AS case_id,
    text || CASE WHEN doc_id % 7 = 0 THEN ' ' || upper((SELECT w FROM word WHERE i = doc_id % {len(_WORDS)})) ELSE '' END
      || CASE WHEN doc_id % 7 = 1 THEN ' ' || (SELECT w FROM word WHERE i = doc_id * 3 % {len(_WORDS)})
           || ' ' || (SELECT w FROM word WHERE i = doc_id * 11 % {len(_WORDS)}) ELSE '' END
      || CASE WHEN doc_id % 3 = 0 THEN ' ' || ['漏报', '误报', '批量', '优化', ''][doc_id % 5 + 1] ELSE '' END AS text,
    CASE WHEN doc_id % 5 = 0 THEN (SELECT failure_type FROM reg WHERE position = doc_id % 25) END AS confirmed_type,
    'B' || (doc_id % (SELECT max(b) + 1 FROM b0)) AS battery_id, DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS from_date,
    DATE '2024-01-01' + CAST(doc_id % 30 + doc_id % 3 AS INT) AS to_date
  FROM documents),
hits AS (SELECT case_id, failure_type, keyword, position FROM cases JOIN kw ON contains(lower(text), lower(keyword))),
best AS (SELECT case_id, failure_type AS declared_type, keyword AS declared_keyword FROM hits
         QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY length(keyword) DESC, position, lower(keyword)) = 1)
"""


@check("key_match", with_ctes(REG_CTES + CASE_CTES + "SELECT * FROM hits"))
def _(spark, sf):
    return classify.match_keywords(cases(spark, sf))


@check("key_best", with_ctes(REG_CTES + CASE_CTES + """
SELECT case_id, declared_type, declared_keyword FROM cases LEFT JOIN best USING (case_id)"""))
def _(spark, sf):
    return classify.declare_type(cases(spark, sf)).select(
        "case_id", "declared_type", "declared_keyword")


@check("key_best_turns", """
SELECT conv_id AS case_id, failure_type, keyword FROM (
  SELECT conv_id, failure_type, keyword, position FROM conversations JOIN (VALUES
    ('th_type', 'th', 0), ('thble_type', 'thble', 1), ('the_type', 'the', 2), ('ing_type', 'ing', 3))
    k(failure_type, keyword, position) ON contains(lower(text), keyword))
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY length(keyword) DESC, position) = 1""")
def _(spark, sf):
    """One case over several texts, with a stand-in dictionary that occurs in them and nests."""
    from cellwatch.sources.registry import FailureType

    words = ("th", "thble", "the", "ing")
    stand_in = tuple(FailureType(f"{w}_type", None, w, w, keywords=(w,)) for w in words)
    turns = table(spark, sf, "conversations").withColumnRenamed("conv_id", "case_id")
    return classify.best_match(classify.match_keywords(turns, stand_in))


# Corrections of the reporters, appended to a log; the last of a case before this day holds.
AS_OF = datetime(2024, 1, 18)


def corrections(spark, sf):
    types = F.array(*[F.lit(t) for t in _TYPES])
    c = F.col("doc_id")

    def entry(when, step, days):
        kind = F.get(types, (c * step % len(_TYPES)).cast("int")) if step else F.lit(None).cast("string")
        at = F.timestamp_seconds(F.lit(1704067200) + (c % 20 + days) * 86_400)
        return F.when(when, F.struct(kind.alias("corrected_type"), at.alias("corrected_at")))

    return table(spark, sf, "documents").select(c.alias("case_id"), F.inline(F.array_compact(F.array(
        entry(c % 11 == 0, 3, 0), entry(c % 22 == 0, 7, 5), entry(c % 33 == 0, 0, 7)))))


RESOLVED_CTES = VERDICT_CTES + CASE_CTES + """
, clog AS (SELECT doc_id AS case_id, (SELECT failure_type FROM types WHERE position = doc_id * 3 % 25) AS kind, doc_id % 20 AS day
           FROM documents WHERE doc_id % 11 = 0
  UNION ALL SELECT doc_id, (SELECT failure_type FROM types WHERE position = doc_id * 7 % 25), doc_id % 20 + 5
           FROM documents WHERE doc_id % 22 = 0
  UNION ALL SELECT doc_id, NULL, doc_id % 20 + 7 FROM documents WHERE doc_id % 33 = 0),
corr AS (SELECT case_id, kind AS corrected_type FROM (SELECT * FROM clog WHERE day <= 17
           QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY day DESC) = 1) WHERE kind IS NOT NULL)
, days AS (SELECT case_id, battery_id, unnest(generate_series(from_date, to_date, INTERVAL 1 DAY)) AS day FROM cases),
spans AS (SELECT case_id, string_agg(DISTINCT family, ',') AS family, count(DISTINCT family) AS n
          FROM days JOIN cs ON cs.battery_id = days.battery_id AND cs.date_tag = strftime(day, '%Y-%m-%d')
          GROUP BY case_id),
res0 AS (SELECT case_id, text, declared_type, confirmed_type,
           CASE WHEN n = 1 THEN CASE family WHEN 'thermal_runaway' THEN 'thermal_runaway'
             WHEN 'insulation' THEN 'insulation_lv2' WHEN 'voltage_spread' THEN 'vdiff_outlier_lfp'
             WHEN 'temperature_spread' THEN 'tempdiff_expert' WHEN 'sampling' THEN 'sampling_comprehensive'
             END END AS inferred_type
         , corrected_type
         FROM cases LEFT JOIN best USING (case_id) LEFT JOIN spans USING (case_id) LEFT JOIN corr USING (case_id)),
res AS (SELECT *, coalesce(corrected_type, declared_type, confirmed_type, inferred_type) AS failure_type,
          CASE WHEN corrected_type IS NOT NULL THEN 'corrected' WHEN declared_type IS NOT NULL THEN 'declared' WHEN confirmed_type IS NOT NULL THEN 'confirmed'
               WHEN inferred_type IS NOT NULL THEN 'inferred' ELSE 'unknown' END AS origin FROM res0)
"""


def resolved(spark, sf):
    return dispatch.resolve_cases(cases(spark, sf), signalled(spark, sf), corrections=corrections(spark, sf), as_of=AS_OF)


@check("key_resolve", with_ctes(RESOLVED_CTES + """
SELECT case_id, corrected_type, declared_type, confirmed_type, inferred_type, failure_type, origin FROM res"""))
def _(spark, sf):
    return resolved(spark, sf).select("case_id", "corrected_type", "declared_type", "confirmed_type", "inferred_type",
                                      "failure_type", "origin")


@check("key_route", with_ctes(RESOLVED_CTES + """
SELECT case_id, failure_type, name, family, algorithm, version, skill, status, model_path, design_doc
FROM res LEFT JOIN reg USING (failure_type)"""))
def _(spark, sf):
    return classify.route(resolved(spark, sf), registry_df(spark)).select(
        "case_id", "failure_type", "name", "family", "algorithm", "version", "skill", "status", "model_path", "design_doc")


@check("key_route_split", with_ctes(RESOLVED_CTES + """
SELECT case_id, algorithm, CASE status WHEN 'ready' THEN 'own' WHEN 'placeholder' THEN 'generic'
    ELSE 'unresolved' END AS path,
  CASE WHEN status = 'placeholder' THEN
    CASE WHEN case_id % 2 = 0 THEN 'parameters,fields' ELSE 'rule,parameters,fields' END ELSE '' END AS needs
FROM res LEFT JOIN reg USING (failure_type)"""))
def _(spark, sf):
    routed = classify.route(resolved(spark, sf), registry_df(spark)).withColumn(
        "rule", F.when(F.col("case_id") % 2 == 0, "volt_diff > limit"))
    return classify.split_route(routed).select("case_id", "algorithm", "path",
                                               F.array_join("needs", ",").alias("needs"))


_TASK_SQL = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(lower(text), {_quote(w.lower())})" for w in words) + f" THEN '{name}'"
    for name, words in classify.TASK_WORDS) + " END"


@check("key_task", with_ctes(REG_CTES + CASE_CTES + f"SELECT case_id, {_TASK_SQL} AS task FROM cases"))
def _(spark, sf):
    return classify.task_type(cases(spark, sf)).select("case_id", "task")


@check("key_coverage", with_ctes(REG_CTES + CASE_CTES + """
, r AS (SELECT case_id, coalesce(declared_type, confirmed_type) AS failure_type
        FROM cases LEFT JOIN best USING (case_id))
SELECT 'type_without_case' AS side, failure_type AS item FROM reg
WHERE failure_type NOT IN (SELECT failure_type FROM r WHERE failure_type IS NOT NULL)
UNION ALL SELECT 'case_without_type', CAST(case_id AS VARCHAR) FROM r WHERE failure_type IS NULL"""))
def _(spark, sf):
    typed = classify.declare_type(cases(spark, sf)).withColumn(
        "failure_type", F.coalesce("declared_type", "confirmed_type"))
    return classify.coverage(typed, registry_df(spark))


@check("key_registry_summary", with_ctes(REG_CTES + CASE_CTES + """
, n AS (SELECT declared_type AS failure_type, count(*) AS cases FROM best GROUP BY 1)
SELECT family, status, count(*) AS n_types, CAST(sum(n_keywords) AS BIGINT) AS n_keywords,
  count_if(n_signals > 0) AS n_with_signals, string_agg(DISTINCT algorithm, ',' ORDER BY algorithm) AS algorithms,
  CAST(coalesce(sum(cases), 0) AS BIGINT) AS n_cases
FROM reg LEFT JOIN n USING (failure_type) GROUP BY family, status"""))
def _(spark, sf):
    typed = classify.declare_type(cases(spark, sf)).withColumnRenamed("declared_type", "failure_type")
    return classify.registry_summary(registry_df(spark), typed.filter("failure_type is not null"))


@check("plan_dispatch", with_ctes(RESOLVED_CTES + f"""
SELECT case_id, failure_type, origin, algorithm, CASE status WHEN 'ready' THEN 'own'
    WHEN 'placeholder' THEN 'generic' ELSE 'unresolved' END AS path, {_TASK_SQL} AS task
FROM res LEFT JOIN reg USING (failure_type)"""))
def _(spark, sf):
    return dispatch.dispatch(cases(spark, sf), signalled(spark, sf), registry_df(spark),
                             corrections=corrections(spark, sf), as_of=AS_OF).select(
        "case_id", "failure_type", "origin", "algorithm", "path", "task")
