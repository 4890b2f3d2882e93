"""Evaluation of alarms against labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwatch.operators import evaluate, signals

from .case_checks import DAY, SIG_CTES, signalled
from .registry import check
from .telemetry import spread, table, with_ctes

STEPS = (evaluate.Step("hot", "max_temp", "gt", 55), evaluate.Step("wide", "volt_diff", "gt", 300),
         evaluate.Step("low_iso", "iso_resistance", "lt", 100))
_RATES = ["precision", "recall"]


def _labelled(spark, sf):
    docs = spread(table(spark, sf, "documents"), "doc_id").select(F.col("doc_id").alias("case_id"), "n_chars", "lang")
    truth = table(spark, sf, "labels").select(F.col("doc_id").alias("case_id"),
                                              (F.col("quality") == 1).alias("is_fault"))
    return docs, truth


@check("evl_confusion", """
WITH p AS (SELECT doc_id, unnest([{'algorithm': 'long', 'fired': n_chars > 500},
    {'algorithm': 'very_long', 'fired': n_chars > 2000}, {'algorithm': 'english', 'fired': lang = 'en'},
    {'algorithm': 'never', 'fired': false}], recursive := true) FROM documents),
c AS (SELECT algorithm, count_if(fired AND quality = 1) AS tp, count_if(fired AND quality = 0) AS fp,
        count_if(NOT fired AND quality = 1) AS fn, count_if(NOT fired AND quality = 0) AS tn
      FROM p JOIN labels USING (doc_id) GROUP BY algorithm)
SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall FROM c""", rounds=_RATES)
def _(spark, sf):
    docs, truth = _labelled(spark, sf)
    rules = {"long": F.col("n_chars") > 500, "very_long": F.col("n_chars") > 2000,
             "english": F.col("lang") == "en", "never": F.lit(False)}
    predictions = docs.select("case_id", F.inline(F.array(*[
        F.struct(F.lit(n).alias("algorithm"), c.alias("fired")) for n, c in rules.items()])))
    return evaluate.confusion(predictions, truth)


def _judged(spark, sf):
    """Battery-days judged by a three-step rule; a fault is a hot or a widely spread pack."""
    metrics = signals.case_metrics(signalled(spark, sf), DAY)
    fired = (F.col("max_temp") > 55) & (F.col("volt_diff") > 300) & (F.col("iso_resistance") < 100)
    return metrics.select(
        F.concat_ws("/", *DAY).alias("case_id"), "max_temp", "volt_diff", "temp_diff", "iso_resistance",
        F.coalesce(fired, F.lit(False)).alias("fired"),
        ((F.col("max_temp") > 60) | (F.col("volt_diff") > 2000)).alias("is_fault"))


_JUDGED = SIG_CTES + """
, ca AS (SELECT battery_id || '/' || date_tag AS case_id, max_temp, volt_diff, temp_diff, iso_resistance,
    coalesce(max_temp > 55 AND volt_diff > 300 AND iso_resistance < 100, false) AS fired,
    max_temp > 60 OR volt_diff > 2000 AS is_fault FROM cm),
stp AS (SELECT *, unnest([
    {'step': 1, 'condition': 'hot', 'value': max_temp, 'limit_value': 55.0::DOUBLE, 'margin': max_temp - 55},
    {'step': 2, 'condition': 'wide', 'value': volt_diff, 'limit_value': 300.0::DOUBLE, 'margin': volt_diff - 300},
    {'step': 3, 'condition': 'low_iso', 'value': iso_resistance, 'limit_value': 100.0::DOUBLE,
     'margin': 100 - iso_resistance}], recursive := true) FROM ca)
"""


@check("evl_missed", with_ctes(_JUDGED + """
SELECT case_id, step, condition, value, limit_value, margin, coalesce(margin > 0, false) AS holds,
  min(CASE WHEN coalesce(margin > 0, false) THEN NULL ELSE step END) OVER (PARTITION BY case_id) AS first_failed
FROM stp WHERE is_fault AND NOT fired"""))
def _(spark, sf):
    return evaluate.why_missed(_judged(spark, sf), STEPS)


@check("evl_false", with_ctes(_JUDGED + """
SELECT case_id, step, condition, value, limit_value, margin FROM stp
WHERE (max_temp > 50 OR volt_diff > 200) AND NOT is_fault AND margin > 0"""))
def _(spark, sf):
    loose = _judged(spark, sf).withColumn("fired", (F.col("max_temp") > 50) | (F.col("volt_diff") > 200))
    return evaluate.why_fired(loose, STEPS)


@check("evl_sweep", """
WITH g AS (SELECT unnest([100.0::DOUBLE, 300, 500, 1000, 2000, 5000, 20000]) AS limit_value),
c AS (SELECT limit_value, count_if(n_chars > limit_value AND quality = 1) AS tp,
        count_if(n_chars > limit_value AND quality = 0) AS fp,
        count_if(n_chars <= limit_value AND quality = 1) AS fn,
        count_if(n_chars <= limit_value AND quality = 0) AS tn
      FROM g, documents JOIN labels USING (doc_id) GROUP BY limit_value),
s AS (SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall,
        2.0 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM c)
SELECT *, CAST(row_number() OVER (ORDER BY f1 DESC NULLS LAST, limit_value) AS INT) AS place FROM s""",
       rounds=[*_RATES, "f1"])
def _(spark, sf):
    docs, truth = _labelled(spark, sf)
    return evaluate.sweep(docs.join(truth, "case_id"), "n_chars",
                          (100, 300, 500, 1000, 2000, 5000, 20000))


@check("evl_user_rule", with_ctes(SIG_CTES + """
SELECT battery_id, date_tag, max_temp - min_volt / 1000 > 45 AS hot, volt_diff > 250 AS wide,
  max_temp - min_volt / 1000 > 45 AND volt_diff > 250 AS fired FROM cm"""))
def _(spark, sf):
    rule = evaluate.UserRule(
        "hot_and_wide", {"hot": "temp - low / 1000 > temp_limit", "wide": "spread > spread_limit"},
        {"temp": "max_temp", "low": "min_volt", "spread": "volt_diff"},
        {"temp_limit": (45.0, "degC"), "spread_limit": (300.0, "mV")})
    metrics = signals.case_metrics(signalled(spark, sf), DAY)
    return evaluate.apply_rule(metrics, rule, DAY, {"spread_limit": 250.0})
