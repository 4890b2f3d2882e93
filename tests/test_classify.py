import json

import pytest
from pyspark.sql import functions as F

from cellwatch.operators import classify, evaluate, signals
from cellwatch.sources.frames import read_cases
from cellwatch.sources.registry import BUILT_IN, load_registry, registry_df, signal_rows


def test_registry_counts(spark):
    words = [k for t in BUILT_IN for k in t.keywords]
    assert (len(BUILT_IN), len(words), len(set(words))) == (25, 95, 94)
    assert [t.failure_type for t in BUILT_IN if t.status == "ready"] == ["thermal_runaway"]
    limits = signal_rows(registry_df(spark)).collect()
    assert sum(r.op == "flag" for r in limits) == 1 and len(limits) == 14


def test_every_keyword_finds_its_type_and_nested_ones_take_the_longest(spark):
    rows, want = [], {}
    for i, (t, k) in enumerate((t, k) for t in BUILT_IN for k in t.keywords):
        longest = max(((o, w) for o in BUILT_IN for w in o.keywords if w.lower() in k.lower()),
                      key=lambda ow: (len(ow[1]), -BUILT_IN.index(ow[0])))
        rows.append((i, f"case {k.upper()} reported"))
        want[i] = longest[0].failure_type
    got = classify.declare_type(spark.createDataFrame(rows, "case_id int, text string")).collect()
    assert {r.case_id: r.declared_type for r in got} == want


def test_text_without_keyword_stays_undeclared(spark):
    got = classify.declare_type(spark.createDataFrame([(1, "nothing here"), (2, None)], "case_id int, text string"))
    assert [r.declared_type for r in got.collect()] == [None, None]


def test_precedence(spark):
    df = spark.createDataFrame([("a", "b", "c"), (None, "b", "c"), (None, None, "c"), (None, None, None)],
                               "declared_type string, confirmed_type string, inferred_type string")
    got = classify.resolve_type(df).collect()
    assert [(r.failure_type, r.origin) for r in got] == [
        ("a", "declared"), ("b", "confirmed"), ("c", "inferred"), (None, "unknown")]


def test_two_families_are_ambiguous(spark):
    cases = spark.createDataFrame([(1,), (2,), (3,)], "case_id int")
    hits = spark.createDataFrame([(1, "sig_heat", "thermal_runaway"), (1, "sig_cell_limit", "thermal_runaway"),
                                  (2, "sig_heat", "thermal_runaway"), (2, "sig_missing", "sampling")],
                                 "case_id int, signal string, family string")
    got = {r.case_id: (r.verdict, r.inferred_family) for r in signals.arbitrate(cases, hits, ["case_id"]).collect()}
    assert got == {1: ("inferred", "thermal_runaway"), 2: ("ambiguous", None), 3: ("none", None)}


def test_registry_file(spark, tmp_path):
    tree = {"failure_types": {"x": {"name": "X", "algorithm": "a1", "status": "ready", "skill": "s",
                                    "keywords": ["k1", 70], "auto_detect_signals": {"max_temp_gt": 5}}}}
    path = tmp_path / "registry.json"
    path.write_text(json.dumps(tree))
    (only,) = load_registry(spark, str(path))
    assert only.skill == "s" and only.keywords == ("k1", "70")
    row = registry_df(spark, (only,)).first()
    assert row.signals == {"max_temp_gt": "5"} and row.position == 0


def test_case_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("case_id,v\n1,2.5\n2,oops\n")
    got = read_cases(spark, str(tmp_path / "a.csv"), "csv", "case_id int, v double").collect()
    assert {r.case_id: r.is_malformed for r in got} == {1: False, 2: True}
    assert read_cases(spark, [(1, 2.0)], "rows", "case_id int, v double").first().is_malformed is False
    with pytest.raises(ValueError):
        read_cases(spark, "x", "xlsx", "case_id int")


def test_confusion_counts_silent_cases(spark):
    truth = spark.createDataFrame([(i, i < 3) for i in range(10)], "case_id int, is_fault boolean")
    said = spark.createDataFrame([(0, "a", True), (1, "a", False), (5, "a", True), (0, "b", False), (99, "a", True)],
                                 "case_id int, algorithm string, fired boolean")
    got = {r.algorithm: (r.tp, r.fp, r.fn, r.tn) for r in evaluate.confusion(said, truth).collect()}
    assert got == {"a": (1, 1, 2, 6), "b": (0, 0, 3, 7)}


@pytest.mark.parametrize("above", [True, False])
def test_sweep_equals_counting_each_limit(spark, above):
    data = [(float(i % 7), i % 3 == 0) for i in range(50)] + [(None, True)]
    limits = (0.0, 2.0, 3.5, 6.0)
    got = evaluate.sweep(spark.createDataFrame(data, "v double, is_fault boolean"), "v", limits, above).collect()
    for r in got:
        hit = [v is not None and ((v > r.limit_value) if above else (v < r.limit_value)) for v, _ in data]
        pairs = list(zip(hit, (f for _, f in data)))
        assert (r.tp, r.fp, r.fn, r.tn) == (pairs.count((True, True)), pairs.count((True, False)),
                                            pairs.count((False, True)), pairs.count((False, False)))
    ranked = sorted(got, key=lambda r: r.place)
    assert [r.f1 for r in ranked] == sorted((r.f1 for r in got), reverse=True)


def test_user_rule_sees_only_what_it_declares(spark):
    df = spark.createDataFrame([(1, 10.0, 3.0), (2, 60.0, None)], "case_id int, t double, hidden double")
    rule = evaluate.UserRule("r", {"hot": "temp > cut"}, {"temp": "t"}, {"cut": (50.0, "degC")})
    assert [r.fired for r in evaluate.apply_rule(df, rule, ["case_id"]).orderBy("case_id").collect()] == [False, True]
    assert evaluate.apply_rule(df, rule, ["case_id"], {"cut": 5.0}).filter("fired").count() == 2
    with pytest.raises(ValueError):
        evaluate.apply_rule(df, rule, ["case_id"], {"other": 1.0})
    sneaky = evaluate.UserRule("r", {"hot": "hidden > 1"}, {"temp": "t"})
    with pytest.raises(Exception, match="hidden"):
        evaluate.apply_rule(df, sneaky, ["case_id"])


def test_missed_and_false_attribution(spark):
    steps = (evaluate.Step("hot", "t", "gt", 50), evaluate.Step("low", "v", "lt", 5))
    df = spark.createDataFrame([(1, 60.0, 9.0, False, True), (2, 60.0, 9.0, True, False), (3, None, 1.0, False, True)],
                               "case_id int, t double, v double, fired boolean, is_fault boolean")
    missed = {(r.case_id, r.step): (r.holds, r.first_failed) for r in evaluate.why_missed(df, steps).collect()}
    assert missed == {(1, 1): (True, 2), (1, 2): (False, 2), (3, 1): (False, 1), (3, 2): (True, 1)}
    assert [(r.case_id, r.condition, r.margin) for r in evaluate.why_fired(df, steps).collect()] == [(2, "hot", 10.0)]


def test_task_words(spark):
    df = spark.createDataFrame([(1, "漏报 case"), (2, "A False Alarm"), (3, "批量"), (4, "x")], "case_id int, text string")
    assert [r.task for r in classify.task_type(df).orderBy("case_id").collect()] == [
        "missed_alarm", "false_alarm", "batch", None]


def test_keywords_are_matched_in_the_whole_text(spark):
    df = spark.createDataFrame([(1, "x" * 300_000 + "热失控")], "case_id int, text string")
    assert classify.match_keywords(df).select(F.first("failure_type")).first()[0] == "thermal_runaway"


def test_registry_flags_and_weak_verdicts(spark):
    """A flag counts different metrics; signals of no family make a case weak, not inferred."""
    from cellwatch.operators import signals
    from cellwatch.sources.registry import registry_df

    long = spark.createDataFrame([
        ("one", "volt_diff", 120.0), ("two", "volt_diff", 120.0), ("two", "temp_diff", 16.0),
        ("none", "volt_diff", 1.0), ("rest", "volt_drop_rate", 1.0), ("rest", "outlier_rate", 0.7), ("rest", "volt_diff", 1.0)],
        "case_id string, metric string, value double")
    hits = signals.eval_registry(long, registry_df(spark), ["case_id"])
    got = {(r.case_id, r.failure_type, r.signal): r.value for r in hits.collect()}
    assert got[("two", "realtime_hazard", "multi_signal")] == 2.0 and ("one", "realtime_hazard", "multi_signal") not in got
    assert got[("rest", "station_self_discharge", "outlier_rate_gt")] == 0.7
    assert got[("rest", "realtime_hazard", "multi_signal")] == 2.0
    cases = long.select("case_id").distinct()
    rows = signals.several_signals(hits, ["case_id"])
    verdicts = {r.case_id: (r.verdict, r.signals, r.families) for r in signals.arbitrate(cases, rows, ["case_id"]).collect()}
    assert verdicts == {"one": ("none", None, None), "none": ("none", None, None),
                        "two": ("weak", ["multi_signal"], None), "rest": ("weak", ["multi_signal"], None)}
    strong = rows.unionByName(spark.createDataFrame([("two", "sig_heat", "thermal_runaway", 1)], rows.schema))
    assert {r.case_id: r.verdict for r in signals.arbitrate(cases, strong, ["case_id"]).collect()}["two"] == "inferred"


def test_corrections_as_of(spark):
    from datetime import datetime

    log = spark.createDataFrame([
        (1, "vdiff_stat", datetime(2024, 1, 1)), (1, "vdiff_math", datetime(2024, 1, 5)),
        (2, "vdiff_stat", datetime(2024, 1, 1)), (2, None, datetime(2024, 1, 2)),
        (3, "tempdiff_stat", datetime(2024, 1, 3)), (3, "tempdiff_expert", datetime(2024, 1, 3))],
        "case_id long, corrected_type string, corrected_at timestamp")

    def held(as_of):
        return {r.case_id: r.corrected_type for r in classify.latest_corrections(log, as_of).collect()}

    assert held(None) == {1: "vdiff_math", 3: "tempdiff_stat"}
    assert held(datetime(2024, 1, 1)) == {1: "vdiff_stat", 2: "vdiff_stat"}
    cases = spark.createDataFrame([(1, "a", "b", "c"), (2, None, "b", "c"), (4, None, None, None)],
                                  "case_id long, declared_type string, confirmed_type string, inferred_type string")
    settled = classify.resolve_type(cases.join(classify.latest_corrections(log), "case_id", "left"))
    assert {r.case_id: (r.failure_type, r.origin) for r in settled.collect()} == {
        1: ("vdiff_math", "corrected"), 2: ("b", "confirmed"), 4: (None, "unknown")}
