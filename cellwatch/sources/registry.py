"""The failure-type registry: configuration of a few dozen rows, read on the driver.

``BUILT_IN`` carries what classification and routing need; ``load_registry`` reads a
deployment's own file. Notes are free text for readers and only come from such a file.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_DDL = """
failure_type string, family string, name string, algorithm string, version string,
skill string, status string, model_path string, design_doc string,
keywords array<string>, signals map<string,string>, notes string, position int
"""


@dataclass(frozen=True)
class FailureType:
    failure_type: str
    family: str | None
    name: str
    algorithm: str
    version: str | None = None
    status: str = "placeholder"
    keywords: tuple[str, ...] = ()
    signals: dict[str, object] = field(default_factory=dict)
    skill: str | None = None
    model_path: str | None = None
    design_doc: str | None = None
    notes: str | None = None


# Types, algorithm ids, versions, keywords and limits, in registry order.
_TYPES: tuple[FailureType, ...] = (
    FailureType("thermal_runaway", "realtime", "热失控", "ap16", "V1.0", "ready",
                ("热失控", "过温", "温升异常", "起火", "冒烟", "高温", "温度突变", "thermal runaway"),
                {"max_temp_gt": 55, "temp_diff_gt": 30, "min_volt_lt": 1300, "max_volt_gt": 4500,
                 "volt_diff_gt": 300}),
    FailureType("insulation_lv2", "realtime", "绝缘异常_lv2", "ap19", None, "placeholder",
                ("绝缘异常", "绝缘电阻", "绝缘故障", "漏电", "iso异常", "绝缘下降", "lv2", "二级"),
                {"iso_resistance_lt": 100}),
    FailureType("insulation_lv3", "realtime", "绝缘异常_lv3", "ap20", None, "placeholder",
                ("绝缘异常_lv3", "三级绝缘", "绝缘持续异常", "lv3"), {"iso_resistance_lt": 100}),
    FailureType("realtime_hazard", "realtime", "实时隐患告警", "ap21", "V1.0", "placeholder",
                ("实时隐患", "隐患告警", "综合告警", "多指标异常"), {"multi_signal": True}),
    FailureType("low_soc_lv1", "realtime", "低电量异常_lv1", "otr_low_soc", "V1.0", "placeholder",
                ("低电量", "低电", "过放", "深放", "lv1")),
    FailureType("low_soc_lv2", "realtime", "低电量异常_lv2", "otr_low_soc", "V1.0", "placeholder",
                ("低电量_lv2", "中等严重低电")),
    FailureType("low_soc_lv3", "realtime", "低电量异常_lv3", "otr_low_soc", "V1.0", "placeholder",
                ("低电量_lv3", "严重低电", "三级低电")),
    FailureType("station_self_discharge", "realtime", "换电站实时自放电", "otr_selfdch_station", "V1.0",
                "placeholder", ("换电站自放电", "站端自放电", "端云结合", "自放电实时"),
                {"volt_drop_rate_lt": 1.5, "outlier_rate_gt": 0.66}),
    FailureType("vdiff_outlier_lfp", "voltage spread", "压差离群_LFP", "ap2", "V1.0", "placeholder",
                ("压差离群", "压差异常", "lfp压差", "铁锂压差"), {"volt_diff_gt": 25}),
    FailureType("vdiff_outlier_ncm", "voltage spread", "压差离群_NCM", "ap3", "V1.0", "placeholder",
                ("压差离群_ncm", "三元压差", "ncm压差"), {"volt_diff_gt": 16}),
    FailureType("vdiff_high", "voltage spread", "压差偏高", "ap8", "V1.0", "placeholder",
                ("压差偏高", "大压差", "高压差"), {"volt_diff_gt": 100}),
    FailureType("vdiff_parking_selfdch", "voltage spread", "压差离群_parking自放电", "ap_vdiff_parking",
                "V2.0", "placeholder", ("parking自放电", "静置自放电", "去极化")),
    FailureType("vdiff_stat", "voltage spread", "压差离群_统计模型", "ap_vdiff_stat", "V1.0",
                "placeholder", ("压差统计", "压差分位数", "压差香农熵")),
    FailureType("vdiff_alphaq", "voltage spread", "压差离群_AlphaQ", "ap_alphaq", "V1.0", "placeholder",
                ("AlphaQ", "排名变化", "70kWh")),
    FailureType("vdiff_math", "voltage spread", "压差离群_数理模型", "ap_vdiff_math", "V2.0",
                "placeholder", ("压差数理", "空间投影", "压差归一化")),
    FailureType("tempdiff_expert", "temperature spread", "温差离群_专家模型", "ap9", "V2.0",
                "placeholder", ("温差离群", "温差异常", "单体温度分散", "局部过热"), {"temp_diff_gt": 15}),
    FailureType("tempdiff_stat", "temperature spread", "温差离群_统计模型", "ap10", "V1.0",
                "placeholder", ("温差统计", "温差香农熵")),
    FailureType("tempdiff_math", "temperature spread", "温差离群_数理模型（已停用）", "ap11", "V1.0",
                "placeholder", ("温差数理",)),
    FailureType("sampling_comprehensive", "sampling", "采样异常_综合", "ap12", "V1.0", "placeholder",
                ("采样异常", "初始化异常", "采样综合", "数据质量")),
    FailureType("sampling_pack_volt", "sampling", "采样异常_总压采样异常", "ap13", "V1.2",
                "placeholder", ("总压异常", "总压采样", "单体总压不匹配")),
    FailureType("sampling_temp", "sampling", "采样异常_温度", "ap_sampling_temp", "V1.0",
                "placeholder", ("温度采样异常", "-40度温度采样")),
    FailureType("sampling_volt_symmetry", "sampling", "采样异常_电压对称性抖动", "ap_sampling_symmetry",
                "V1.0", "placeholder", ("电压对称性", "采样抖动", "相邻电芯抖动")),
    FailureType("diagnosis_volt", "diagnosis", "诊断层_电压类", "ap28", None, "placeholder",
                ("电压诊断", "自放电诊断", "内阻诊断", "busbar诊断", "P0201", "P0202", "P0203")),
    FailureType("diagnosis_temp", "diagnosis", "诊断层_温度类", "ap27", None, "placeholder",
                ("温度诊断", "CSC温度采样", "P0302", "P0308")),
    FailureType("diagnosis_sampling", "diagnosis", "诊断层_采样类", "ap29", None, "placeholder",
                ("采样诊断", "CSC电压采样", "P0301", "P0303", "P0308")),
)

# Where a type's case is routed. Types without a model of their own share a skill.
SHARED_SKILL = "alarm-miss-analysis"
OWN_SKILLS = {"thermal_runaway": "ap16_热失控实时"}
MODEL_PATHS = {"thermal_runaway": "ap16_热失控实时/thermal_runaway_realtime.py"}
DESIGN_DOCS = {
    "thermal_runaway": "ap16_热失控实时/热失控实时算法设计文档.md",
    "insulation_lv2": "ap19_绝缘异常_lv2/README.md",
    "insulation_lv3": "ap20_绝缘异常_lv3/README.md",
    "realtime_hazard": "ap21_实时隐患告警/README.md",
    "low_soc_lv1": "otr_低电量_lv1/README.md",
    "low_soc_lv2": "otr_低电量_lv2/README.md",
    "low_soc_lv3": "otr_低电量_lv3/README.md",
    "station_self_discharge": "otr_换电站实时自放电/README.md",
    "vdiff_outlier_lfp": "ap2_压差离群_lfp/README.md",
    "vdiff_outlier_ncm": "ap3_压差离群_ncm/README.md",
    "vdiff_high": "ap8_压差偏高/README.md",
    "vdiff_parking_selfdch": "vdiff_parking自放电/README.md",
    "vdiff_stat": "vdiff_统计模型/README.md",
    "vdiff_alphaq": "vdiff_AlphaQ/README.md",
    "vdiff_math": "vdiff_数学模型/README.md",
    "tempdiff_expert": "ap9_温差离群_专家/README.md",
    "tempdiff_stat": "ap10_温差离群_统计/README.md",
    "tempdiff_math": "ap11_温差离群_数理/README.md",
    "sampling_comprehensive": "ap12_采样异常_综合/README.md",
    "sampling_pack_volt": "ap13_采样异常_总压/README.md",
    "sampling_temp": "sampling_采样异常_温度/README.md",
    "sampling_volt_symmetry": "sampling_采样异常_电压对称性/README.md",
    "diagnosis_volt": "ap28_诊断_电压类/README.md",
    "diagnosis_temp": "ap27_诊断_温度类/README.md",
    "diagnosis_sampling": "ap29_诊断_采样类/README.md",
}

BUILT_IN: tuple[FailureType, ...] = tuple(
    replace(t, skill=OWN_SKILLS.get(t.failure_type, SHARED_SKILL), model_path=MODEL_PATHS.get(t.failure_type),
            design_doc=DESIGN_DOCS[t.failure_type]) for t in _TYPES)


def load_registry(spark: SparkSession, path: str) -> tuple[FailureType, ...]:
    """Reads a registry file (YAML where the yaml module is there, or JSON).

    The file maps ``failure_types`` to entries with name, algorithm, version, skill, status,
    model_path, design_doc, keywords, auto_detect_signals and notes. Families are known for
    the built-in types only.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    if path.endswith(".json"):
        tree = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading a YAML registry needs the yaml module; "
                               "convert it to JSON") from missing
        tree = yaml.safe_load(text)
    families = {t.failure_type: t.family for t in BUILT_IN}
    out = []
    for key, entry in tree["failure_types"].items():
        out.append(FailureType(
            key, entry.get("family") or families.get(key), entry["name"], entry["algorithm"],
            entry.get("version"), entry.get("status", "placeholder"),
            tuple(str(k) for k in entry.get("keywords") or ()),
            dict(entry.get("auto_detect_signals") or {}), entry.get("skill"),
            entry.get("model_path"), entry.get("design_doc"), entry.get("notes")))
    return tuple(out)


def registry_df(spark: SparkSession, registry: tuple[FailureType, ...] = BUILT_IN) -> DataFrame:
    """The registry as rows, in registry order (``position``)."""
    rows = [(t.failure_type, t.family, t.name, t.algorithm, t.version, t.skill, t.status,
             t.model_path, t.design_doc, list(t.keywords),
             {k: str(v).lower() for k, v in t.signals.items()}, t.notes, i)
            for i, t in enumerate(registry)]
    return spark.createDataFrame(rows, REGISTRY_DDL)


def keyword_rows(registry: DataFrame) -> DataFrame:
    return registry.select("failure_type", "position", F.explode("keywords").alias("keyword"))


def signal_rows(registry: DataFrame) -> DataFrame:
    """One row per registry limit: metric, op (``gt``, ``lt`` or ``flag``) and limit."""
    op = F.regexp_extract("signal", "_(gt|lt)$", 1)
    return (registry.select("failure_type", "algorithm", F.explode("signals").alias("signal", "_v"))
            .select("failure_type", "algorithm", "signal",
                    F.regexp_replace("signal", "_(gt|lt)$", "").alias("metric"),
                    F.when(op == "", "flag").otherwise(op).alias("op"),
                    F.expr("try_cast(_v AS double)").alias("limit_value")))
