"""The failure-type registry as the SQL twins see it: typed here, not taken from the library, so that a
value the library loses or changes shows. Fixed values, in registry order."""

# position, failure_type, family, name, algorithm, version, skill, status, model_path, design_doc
TYPES = """
(0, 'thermal_runaway', 'realtime', '热失控', 'ap16', 'V1.0', 'ap16_热失控实时', 'ready',
  'ap16_热失控实时/thermal_runaway_realtime.py', 'ap16_热失控实时/热失控实时算法设计文档.md'),
(1, 'insulation_lv2', 'realtime', '绝缘异常_lv2', 'ap19', NULL, 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap19_绝缘异常_lv2/README.md'),
(2, 'insulation_lv3', 'realtime', '绝缘异常_lv3', 'ap20', NULL, 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap20_绝缘异常_lv3/README.md'),
(3, 'realtime_hazard', 'realtime', '实时隐患告警', 'ap21', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap21_实时隐患告警/README.md'),
(4, 'low_soc_lv1', 'realtime', '低电量异常_lv1', 'otr_low_soc', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'otr_低电量_lv1/README.md'),
(5, 'low_soc_lv2', 'realtime', '低电量异常_lv2', 'otr_low_soc', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'otr_低电量_lv2/README.md'),
(6, 'low_soc_lv3', 'realtime', '低电量异常_lv3', 'otr_low_soc', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'otr_低电量_lv3/README.md'),
(7, 'station_self_discharge', 'realtime', '换电站实时自放电', 'otr_selfdch_station', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'otr_换电站实时自放电/README.md'),
(8, 'vdiff_outlier_lfp', 'voltage spread', '压差离群_LFP', 'ap2', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap2_压差离群_lfp/README.md'),
(9, 'vdiff_outlier_ncm', 'voltage spread', '压差离群_NCM', 'ap3', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap3_压差离群_ncm/README.md'),
(10, 'vdiff_high', 'voltage spread', '压差偏高', 'ap8', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap8_压差偏高/README.md'),
(11, 'vdiff_parking_selfdch', 'voltage spread', '压差离群_parking自放电', 'ap_vdiff_parking', 'V2.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'vdiff_parking自放电/README.md'),
(12, 'vdiff_stat', 'voltage spread', '压差离群_统计模型', 'ap_vdiff_stat', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'vdiff_统计模型/README.md'),
(13, 'vdiff_alphaq', 'voltage spread', '压差离群_AlphaQ', 'ap_alphaq', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'vdiff_AlphaQ/README.md'),
(14, 'vdiff_math', 'voltage spread', '压差离群_数理模型', 'ap_vdiff_math', 'V2.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'vdiff_数学模型/README.md'),
(15, 'tempdiff_expert', 'temperature spread', '温差离群_专家模型', 'ap9', 'V2.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap9_温差离群_专家/README.md'),
(16, 'tempdiff_stat', 'temperature spread', '温差离群_统计模型', 'ap10', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap10_温差离群_统计/README.md'),
(17, 'tempdiff_math', 'temperature spread', '温差离群_数理模型（已停用）', 'ap11', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap11_温差离群_数理/README.md'),
(18, 'sampling_comprehensive', 'sampling', '采样异常_综合', 'ap12', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap12_采样异常_综合/README.md'),
(19, 'sampling_pack_volt', 'sampling', '采样异常_总压采样异常', 'ap13', 'V1.2', 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap13_采样异常_总压/README.md'),
(20, 'sampling_temp', 'sampling', '采样异常_温度', 'ap_sampling_temp', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'sampling_采样异常_温度/README.md'),
(21, 'sampling_volt_symmetry', 'sampling', '采样异常_电压对称性抖动', 'ap_sampling_symmetry', 'V1.0', 'alarm-miss-analysis', 'placeholder',
  NULL, 'sampling_采样异常_电压对称性/README.md'),
(22, 'diagnosis_volt', 'diagnosis', '诊断层_电压类', 'ap28', NULL, 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap28_诊断_电压类/README.md'),
(23, 'diagnosis_temp', 'diagnosis', '诊断层_温度类', 'ap27', NULL, 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap27_诊断_温度类/README.md'),
(24, 'diagnosis_sampling', 'diagnosis', '诊断层_采样类', 'ap29', NULL, 'alarm-miss-analysis', 'placeholder',
  NULL, 'ap29_诊断_采样类/README.md')
"""

# position of the type, keyword
KEYWORDS = """
(0, '热失控'), (0, '过温'), (0, '温升异常'), (0, '起火'), (0, '冒烟'), (0, '高温'), (0, '温度突变'), (0, 'thermal runaway'),
(1, '绝缘异常'), (1, '绝缘电阻'), (1, '绝缘故障'), (1, '漏电'), (1, 'iso异常'), (1, '绝缘下降'), (1, 'lv2'), (1, '二级'),
(2, '绝缘异常_lv3'), (2, '三级绝缘'), (2, '绝缘持续异常'), (2, 'lv3'),
(3, '实时隐患'), (3, '隐患告警'), (3, '综合告警'), (3, '多指标异常'),
(4, '低电量'), (4, '低电'), (4, '过放'), (4, '深放'), (4, 'lv1'),
(5, '低电量_lv2'), (5, '中等严重低电'),
(6, '低电量_lv3'), (6, '严重低电'), (6, '三级低电'),
(7, '换电站自放电'), (7, '站端自放电'), (7, '端云结合'), (7, '自放电实时'),
(8, '压差离群'), (8, '压差异常'), (8, 'lfp压差'), (8, '铁锂压差'),
(9, '压差离群_ncm'), (9, '三元压差'), (9, 'ncm压差'),
(10, '压差偏高'), (10, '大压差'), (10, '高压差'),
(11, 'parking自放电'), (11, '静置自放电'), (11, '去极化'),
(12, '压差统计'), (12, '压差分位数'), (12, '压差香农熵'),
(13, 'AlphaQ'), (13, '排名变化'), (13, '70kWh'),
(14, '压差数理'), (14, '空间投影'), (14, '压差归一化'),
(15, '温差离群'), (15, '温差异常'), (15, '单体温度分散'), (15, '局部过热'),
(16, '温差统计'), (16, '温差香农熵'),
(17, '温差数理'),
(18, '采样异常'), (18, '初始化异常'), (18, '采样综合'), (18, '数据质量'),
(19, '总压异常'), (19, '总压采样'), (19, '单体总压不匹配'),
(20, '温度采样异常'), (20, '-40度温度采样'),
(21, '电压对称性'), (21, '采样抖动'), (21, '相邻电芯抖动'),
(22, '电压诊断'), (22, '自放电诊断'), (22, '内阻诊断'), (22, 'busbar诊断'), (22, 'P0201'), (22, 'P0202'), (22, 'P0203'),
(23, '温度诊断'), (23, 'CSC温度采样'), (23, 'P0302'), (23, 'P0308'),
(24, '采样诊断'), (24, 'CSC电压采样'), (24, 'P0301'), (24, 'P0303'), (24, 'P0308')
"""

# failure_type, algorithm, signal, metric, op, limit; a flag has the least number of metrics as its limit
LIMITS = """
('thermal_runaway', 'ap16', 'max_temp_gt', 'max_temp', 'gt', 55.0::DOUBLE),
('thermal_runaway', 'ap16', 'temp_diff_gt', 'temp_diff', 'gt', 30.0::DOUBLE),
('thermal_runaway', 'ap16', 'min_volt_lt', 'min_volt', 'lt', 1300.0::DOUBLE),
('thermal_runaway', 'ap16', 'max_volt_gt', 'max_volt', 'gt', 4500.0::DOUBLE),
('thermal_runaway', 'ap16', 'volt_diff_gt', 'volt_diff', 'gt', 300.0::DOUBLE),
('insulation_lv2', 'ap19', 'iso_resistance_lt', 'iso_resistance', 'lt', 100.0::DOUBLE),
('insulation_lv3', 'ap20', 'iso_resistance_lt', 'iso_resistance', 'lt', 100.0::DOUBLE),
('realtime_hazard', 'ap21', 'multi_signal', 'multi_signal', 'flag', 2.0::DOUBLE),
('station_self_discharge', 'otr_selfdch_station', 'volt_drop_rate_lt', 'volt_drop_rate', 'lt', 1.5::DOUBLE),
('station_self_discharge', 'otr_selfdch_station', 'outlier_rate_gt', 'outlier_rate', 'gt', 0.66::DOUBLE),
('vdiff_outlier_lfp', 'ap2', 'volt_diff_gt', 'volt_diff', 'gt', 25.0::DOUBLE),
('vdiff_outlier_ncm', 'ap3', 'volt_diff_gt', 'volt_diff', 'gt', 16.0::DOUBLE),
('vdiff_high', 'ap8', 'volt_diff_gt', 'volt_diff', 'gt', 100.0::DOUBLE),
('tempdiff_expert', 'ap9', 'temp_diff_gt', 'temp_diff', 'gt', 15.0::DOUBLE)
"""
