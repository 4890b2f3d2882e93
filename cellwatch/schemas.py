"""Column contracts of the three tables and of the canonical frame, as DDL text.

The raw and block column names and types are fixed values: data written elsewhere is
read with them, so they stay in the order the tables declare.
"""

from __future__ import annotations

# 115 columns.
VEHICLE_FRAME_DDL = """
alarmCommon map<tinyint,tinyint>, batteryId string, bmsAvgCellVolt decimal(38,18), bmsAvgTemp
decimal(38,18), bmsChrgPwrLmt decimal(38,18), bmsDischrgPwrLmt decimal(38,18), bmsHealthStatus
decimal(38,18), bmsInCoolantTemp decimal(38,18), bmsIsolationLevel smallint, bmsOutCoolantTemp
decimal(38,18), btryPakSn smallint, btryReEncoding string, city string, drivingAclrtnPedalPosn
decimal(38,18), drivingAverageSpeed decimal(38,18), drivingBrkPedalState smallint,
drivingBrkPedalValid smallint, drivingMaxSpeed decimal(38,18), drivingMinSpeed decimal(38,18),
drivingSteerWhlRotnAg decimal(38,18), drivingSteerWhlRotnSpd smallint, drivingVehDrvgMod
smallint, extremumHighestTemp decimal(38,18), extremumHistTempBtrySbsysSn smallint,
extremumHistTempPrbSn smallint, extremumHistVoltBtrySbsysSn smallint,
extremumHistVoltSinglBtrySn smallint, extremumLowestTemp decimal(38,18),
extremumLwstTempBtrySbsysSn smallint, extremumLwstTempPrbSn smallint,
extremumLwstVoltBtrySbsysSn smallint, extremumLwstVoltSinglBtrySn smallint,
extremumSinBtryHistVolt decimal(38,18), extremumSinBtryLwstVolt decimal(38,18), hvacAirConOn
boolean, hvacAmbTempC float, hvacOutsideTempC float, hvacPm2p5Cabin smallint,
hvacPm2p5FilterActive boolean, iccId string, local_info string, msgType string, processId
string, province string, sampleTs timestamp, socBtryCap decimal(38,18), socBtryPakCurnt
decimal(38,18), socBtryPakHistTemp decimal(38,18), socBtryPakLwstTemp decimal(38,18),
socBtryPakSn smallint, socBtryPakSum smallint, socBtryPakVoltage decimal(38,18),
socBtryQualActvtn boolean, socChrgFinalSoc smallint, socChrgState tinyint, socDumpEnrgy
decimal(38,18), socFrmStartBtrySn int, socHivoltBtryCurnt decimal(38,18), socPrbTempLst
array<smallint>, socRealtimePowerConsumption int, socRemainingRange decimal(38,18),
socSinBtryHistTemp smallint, socSinBtryLwstTemp smallint, socSinBtryQuntyOfFrm smallint,
socSinBtryQuntyOfPak int, socSinBtryVoltLst array<decimal(38,18)>, socSoc decimal(38,18),
socTempPrbQunty int, vehicleAclrtnPedalPosn decimal(38,18), vehicleBrkPedalState smallint,
vehicleBrkPedalValid smallint, vehicleChrgState smallint, vehicleDcDcSts smallint, vehicleGear
tinyint, vehicleId string, vehicleInsulatnResis int, vehicleMileage int, vehicleOprtnMode
smallint, vehicleSoc decimal(38,18), vehicleSpeed decimal(38,18), vehicleUrgtPrwShtdwn boolean,
vehicleVehlState smallint, vehicleVehlTotlCurnt decimal(38,18), vehicleVehlTotlVolt
decimal(38,18), vin string, chargingEstimateChrgTime int, chargingChargerType tinyint,
chargingInVoltAc decimal(38,18), chargingInVoltDc decimal(38,18), bmsBatteryPackCap double,
vcuActvDchaCmdPeuf double, vcuActvDchaCmdPeur double, bmsSoc double, obcmChgStatus double,
ptcTotActPwr double, comprActPwr double, lvBattU double, lvBattSoc double, bmsCellVoltgMaxB
double, bmsCellVoltgMinB double, bmsMaximumCellVoltageNumberB double,
bmsMinimumCellVoltageNumberB double, bmsMinimumTempNumberB double, bmsTempMaxB double,
bmsTempMinB double, bmsMaximumTempNumberB double, bmsEssInletTemp double, bmsEssOutletTemp
double, platformType int, bmsCntctrSts double, regionCode string, vehicleVersion string,
vehicleVersionLarge string, date string, hour string
"""

# 116 columns.
STATION_FRAME_DDL = """
avg_battery_pack_temperature float, avg_cell_voltage float, battery_id string, battery_status
tinyint, bms_battery_rated_capacity float, bms_charge_power_limit_dynamic float,
bms_discharge_power_limit_dynamic float, bms_insulation_resistance_value int,
bms_normal_capacity float, bms_pack_energy_available float, bms_request_charge_current float,
bms_version string, charging_end_time bigint, charging_start_time bigint, current float,
customer_usage_soc float, cycle_ix bigint, device_id string, device_type string,
expected_charging_ready_time bigint, fault_level tinyint, hardware_version string,
inlet_water_temperature float, is_current_error_eq_0 tinyint, is_soc_jumping tinyint,
is_soc_jumping_slot tinyint, is_temp_gt_50 tinyint, is_temp_lt_minus_30 tinyint, is_voltage_eq_0
tinyint, is_voltage_gt_410 tinyint, is_voltage_jumping tinyint, is_voltage_jumping_slot tinyint,
is_voltage_lt_250 tinyint, isolation_level tinyint, max_battery_pack_temperature float,
max_battery_pack_temperature_number smallint, max_cell_voltage float, max_cell_voltage_number
smallint, min_battery_pack_temperature float, min_battery_pack_temperature_number smallint,
min_cell_voltage float, min_cell_voltage_number smallint, outlet_water_temperature float, power
float, slot_id string, soc float, soh float, status int, target_soc float, time string,
time_stamp bigint, vehicle_plate_number string, voltage float, is_chargeable boolean,
is_high_voltage_locked boolean, is_balanced boolean, battery_bms_state int, battery_charge_state
smallint, battery_charge_mode smallint, is_disconnect_high_voltage_relay_requested boolean,
is_battery_charge_ready boolean, is_battery_charge_permit boolean, is_battery_reach_target_soc
boolean, is_battery_reach_target_voltage boolean, is_battery_beach_target_cell_voltage boolean,
bms_battery_rated_voltage float, bms_battery_nominal_energy float,
bms_battery_max_permitted_voltage float, bms_battery_max_permitted_current float,
bms_battery_max_permitted_cell_voltage float, bms_battery_max_permitted_temperature float,
bms_battery_min_permitted_voltage float, bms_request_charge_voltage float,
bms_charge_current_limit float, chargeable_energy float, charged_energy float, discharged_energy
float, bms_cell_temperature_standard_deviation int, discharging_start_timestamp bigint,
battery_captured_fault int, battery_abort_controls_reason int,
bms_battery_dynamic_discharging_power_limit float, bms_battery_long_time_discharging_power_limit
float, bms_battery_short_time_discharging_power_limit float,
bms_battery_dynamic_charging_power_limit float, bms_battery_long_time_charging_power_limit
float, bms_battery_short_time_charging_power_limit float, bms_battery_pack_capacity int,
bms_battery_dc_charging_voltagemax float, bms_battery_dc_total_voltagemax float,
bms_battery_inner_high_voltage_connector_status int, bms_battery_stop_charging_soc float,
bms_connection_state smallint, temperature_sensor_data_index array<string>,
temperature_sensor_data array<float>, cell_voltage_sensor_data_index array<string>,
cell_voltage_sensor_data array<float>, bmscgw274 array<int>, software_version string,
battery_type string, max_cell_voltage_b float, min_cell_voltage_b float,
max_cell_voltage_number_b smallint, min_cell_voltage_number_b smallint,
max_battery_pack_temperature_b float, min_battery_pack_temperature_b float,
max_battery_pack_temperature_number_b smallint, min_battery_pack_temperature_number_b smallint,
bms_pack_capacity_type int, bms_battery_capacity_type int, bms_battery_usable_capacity_type int,
bms_pack_capacity_type_description string, bms_cgw string, source string, date string, hour
string
"""

# 139 columns.
BLOCK_FEATURES_DDL = """
battery_id string, cell_type string, battery_type string, battery_capacity double,
battery_energy double, real_energy double, device_name string, device_id string, device_type
string, is_test string, process_id string, bms_version string, device_version string, event_type
string, event_id string, hour_tag int, soc_tag int, date_tag string, curr_tag int,
block_msg_count int, effect_msg_count int, fault_msg_count int, cell_volt_init_count
map<double,int>, probe_temp_init_count map<double,int>, bms_temp_init_count map<double,int>,
insu_resis_init_count map<double,int>, first_pack_cell_voltage array<double>,
first_pack_probe_temp array<double>, last_pack_cell_voltage array<double>, last_pack_probe_temp
array<double>, start_time timestamp, end_time timestamp, block_duration bigint, start_user_soc
double, end_user_soc double, start_real_soc double, end_real_soc double, start_soh double,
end_soh double, start_current double, end_current double, max_discharge_current double,
min_discharge_current double, avg_discharge_current double, max_charge_current double,
min_charge_current double, avg_charge_current double, max_pack_voltage double, min_pack_voltage
double, avg_pack_voltage double, max_high_cell_volt double, min_high_cell_volt double,
avg_high_cell_volt double, max_low_cell_volt double, min_low_cell_volt double, avg_low_cell_volt
double, max_avg_cell_volt double, min_avg_cell_volt double, avg_avg_cell_volt double,
max_cell_volt_quartiles map<double,double>, max_high_probe_temp double, min_high_probe_temp
double, avg_high_probe_temp double, max_low_probe_temp double, min_low_probe_temp double,
avg_low_probe_temp double, max_volt_skewness double, min_volt_skewness double, avg_volt_skewness
double, volt_skewness_quartiles map<double,double>, max_volt_diff double, min_volt_diff double,
avg_volt_diff double, high_volt_diff_count int, volt_diff_quartiles map<double,double>,
sp_after_chg_volt_diff0 double, sp_after_chg_volt_diff1 double, spafchg_volt_drop_rate double,
spafchg_outlier_rate double, max_temp_diff double, min_temp_diff double, avg_temp_diff double,
max_volt_sn_count map<int,int>, min_volt_sn_count map<int,int>, max_temp_sn_count map<int,int>,
min_temp_sn_count map<int,int>, volt_rank_mean array<double>, volt_rank_stddev array<double>,
temp_rank_mean array<double>, charge_cap double, charge_energy double, discharge_cap double,
discharge_energy double, max_insu_resis double, min_insu_resis double, avg_insu_resis double,
insu_resis_quartiles map<double,double>, balance_count int, balance_duration bigint,
volt_diff_time_corr double, volt_diff_soc_corr double, volt_diff_current_corr double,
temp_diff_current_corr double, max_volt_diff_time timestamp, max_volt_diff_soc double,
max_volt_diff_current double, max_volt_diff_max_cell_voltage double,
max_volt_diff_max_cell_voltage_sn int, max_volt_diff_min_cell_voltage double,
max_volt_diff_min_cell_voltage_sn int, max_volt_diff_volt_mean double,
max_volt_diff_cell_voltage array<double>, max_volt_diff_volt_entropy double,
max_volt_diff_volt_rms double, max_volt_diff_volt_arv double, max_volt_diff_volt_stddev double,
max_volt_diff_volt_margin double, max_volt_diff_volt_skewness double,
max_volt_diff_volt_kurtosis double, max_temp_diff_time timestamp, max_temp_diff_soc double,
max_temp_diff_current double, max_temp_diff_max_probe_temp double,
max_temp_diff_max_probe_temp_sn int, max_temp_diff_min_probe_temp double,
max_temp_diff_min_probe_temp_sn int, max_temp_diff_probe_temp array<double>,
max_temp_diff_temp_entropy double, max_mileage int, min_mileage int, max_speed double, min_speed
double, avg_speed double, exp_time timestamp, dw_etl_time timestamp, exp_date string, date
string, source string, brand string
"""
# The canonical frame: one row per message, both raw tables map into it.
# Voltages in V, temperatures in degC, insulation in kOhm, current in A (charge < 0).
CANONICAL_FRAME_DDL = """
battery_id string, device_id string, device_name string, device_type string, source string,
event_type string, process_id string, sample_ts timestamp, frame_no bigint,
user_soc double, real_soc double, soh double, real_energy double,
current_a double, pack_voltage_v double, cell_v array<double>, probe_temp_c array<double>,
n_cells int, n_probes int,
max_cell_v double, max_cell_sn int, min_cell_v double, min_cell_sn int, avg_cell_v double,
max_temp_c double, max_temp_sn int, min_temp_c double, min_temp_sn int, avg_temp_c double,
iso_kohm double, iso_level int, is_balancing boolean, charge_state int,
mileage int, speed double, bms_version string, device_version string,
coolant_in_c double, coolant_out_c double, battery_type string, is_test string, brand string
"""

# One row per alarm of any algorithm.
ALARM_DDL = """
battery_id string, device_id string, event_id string, at timestamp,
algorithm string, fired boolean, evidence map<string,double>
"""

PARTITIONS = {
    "vehicle": ["date", "hour"],
    "station": ["date", "hour"],
    "blocks": ["date", "source", "brand"],
}

