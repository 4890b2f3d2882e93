"""Raw vehicle and station messages, in the full column lists, derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.schemas import STATION_FRAME_DDL, VEHICLE_FRAME_DDL

from .telemetry import base, events

VEHICLE = {
    "alarmCommon": "map(k % 8, k % 4)", "batteryId": "concat('B', b)",
    "bmsAvgCellVolt": "aggregate(mv, 0.0D, (a, x) -> a + x) / 12000.0D",
    "bmsHealthStatus": "95", "bmsIsolationLevel": "k % 3", "btryPakSn": "1",
    "bmsInCoolantTemp": "20 + k % 5", "bmsOutCoolantTemp": "22 + k % 5",
    "drivingBrkPedalState": "k % 4", "drivingBrkPedalValid": "k % 2",
    "drivingVehDrvgMod": "element_at(array(0, 1, 2, 3, 7), k % 5 + 1)",
    "extremumHighestTemp": "array_max(temps)", "extremumLowestTemp": "array_min(temps)",
    "extremumSinBtryHistVolt": "array_max(mv) / 1000.0D",
    "extremumSinBtryLwstVolt": "array_min(mv) / 1000.0D",
    "extremumHistVoltSinglBtrySn": "array_position(mv, array_max(mv))",
    "extremumLwstVoltSinglBtrySn": "array_position(mv, array_min(mv))",
    "extremumHistTempPrbSn": "array_position(temps, array_max(temps))",
    "extremumLwstTempPrbSn": "array_position(temps, array_min(temps))",
    "msgType": "event_type", "processId": "cast(e div 100 AS string)", "sampleTs": "sample_ts",
    "socBtryPakSn": "1", "socBtryPakSum": "1", "socBtryQualActvtn": "e % 7 < 2",
    "socChrgState": "k % 4", "socDumpEnrgy": "k * 0.5D", "socFrmStartBtrySn": "1",
    "socPrbTempLst": "temps", "socSinBtryQuntyOfFrm": "12", "socSinBtryQuntyOfPak": "12",
    "socSinBtryVoltLst": "transform(mv, x -> x / 1000.0D)", "socTempPrbQunty": "6",
    "vehicleChrgState": "element_at(array(1, 2, 3, 4, 254, 255), k % 6 + 1)",
    "vehicleDcDcSts": "element_at(array(1, 2, 254, 255), k % 4 + 1)",
    "vehicleOprtnMode": "element_at(array(1, 2, 3, 254, 255), k % 5 + 1)",
    "vehicleVehlState": "element_at(array(1, 2, 3, 4, 254, 255), k % 6 + 1)",
    "chargingChargerType": "k % 6", "platformType": "b % 2",
    "vehicleId": "concat('D', b)", "vehicleInsulatnResis": "iso", "vehicleMileage": "1000 + e",
    "vehicleSoc": "k", "vehicleSpeed": "k",
    "vehicleVehlTotlCurnt": "if(event_type = 'charging', -50 - k, 20 + k)",
    "vehicleVehlTotlVolt": "aggregate(mv, 0.0D, (a, x) -> a + x) / 1000.0D",
    "vin": "concat('N', b)", "bmsSoc": "k - 1",
    "bmsCellVoltgMaxB": "(array_max(mv) + e % 3 - 1) / 1000.0D",
    "bmsCellVoltgMinB": "(array_min(mv) + e % 3 - 1) / 1000.0D",
    "bmsMaximumCellVoltageNumberB": "k % 12 + 1", "bmsMinimumCellVoltageNumberB": "k % 11 + 1",
    "bmsTempMaxB": "array_max(temps) + e % 3 - 1", "bmsTempMinB": "array_min(temps) + e % 3 - 1",
    "bmsMaximumTempNumberB": "k % 6 + 1", "bmsMinimumTempNumberB": "k % 5 + 1",
    "vehicleVersion": "concat('d', e div 3000)",
    "date": "date_format(sample_ts, 'yyyy-MM-dd')", "hour": "date_format(sample_ts, 'HH')",
}

STATION = {
    "avg_battery_pack_temperature": "aggregate(temps, 0.0D, (a, x) -> a + x) / 6",
    # two decimals, so that single precision does not decide a rounding
    "avg_cell_voltage": "floor(aggregate(mv, 0.0D, (a, x) -> a + x) / 120.0D) / 100.0D",
    "battery_id": "concat('B', b)", "bms_insulation_resistance_value": "iso",
    "bms_version": "concat('v', e div 5000)", "bms_pack_energy_available": "k * 0.5D",
    "charging_start_time": "unix_millis(sample_ts) - 1000 * k",
    "charging_end_time": "unix_seconds(sample_ts) + k",
    "discharging_start_timestamp": "unix_seconds(sample_ts)",
    "expected_charging_ready_time": "unix_millis(sample_ts) + 60000",
    "current": "if(event_type = 'charging', -50 - k, 0)", "customer_usage_soc": "k",
    "device_id": "concat('D', b)", "device_type": "'swap_station'",
    "inlet_water_temperature": "20 + k % 5", "outlet_water_temperature": "22 + k % 5",
    "isolation_level": "k % 3",
    "max_battery_pack_temperature": "array_max(temps)",
    "min_battery_pack_temperature": "array_min(temps)",
    "max_cell_voltage": "array_max(mv) / 1000.0D", "min_cell_voltage": "array_min(mv) / 1000.0D",
    "max_cell_voltage_number": "array_position(mv, array_max(mv))",
    "min_cell_voltage_number": "array_position(mv, array_min(mv))",
    "max_battery_pack_temperature_number": "array_position(temps, array_max(temps))",
    "min_battery_pack_temperature_number": "array_position(temps, array_min(temps))",
    "slot_id": "concat('S', k % 3)", "soc": "k - 1", "soh": "95",
    "time_stamp": "unix_millis(sample_ts)",
    "voltage": "CASE WHEN e % 59 = 0 THEN 0 WHEN e % 37 = 0 THEN 420 ELSE 240 + k END",
    "is_balanced": "e % 7 < 2",
    "battery_charge_state": "if(event_type = 'charging', 1, 0)",
    "temperature_sensor_data_index": "transform(sequence(1, 6), i -> concat('T', i))",
    "temperature_sensor_data": "temps",
    "cell_voltage_sensor_data_index": "transform(sequence(1, 12), i -> concat('C', i))",
    "cell_voltage_sensor_data": "transform(mv, x -> x / 1000.0D)",
    "software_version": "concat('d', e div 3000)", "battery_type": "if(b % 2 = 0, 'T0', 'T1')",
    "max_cell_voltage_b": "(array_max(mv) + e % 3 - 1) / 1000.0D",
    "min_cell_voltage_b": "(array_min(mv) + e % 3 - 1) / 1000.0D",
    "max_cell_voltage_number_b": "k % 12 + 1", "min_cell_voltage_number_b": "k % 11 + 1",
    "source": "'station'",
    "date": "date_format(sample_ts, 'yyyy-MM-dd')", "hour": "date_format(sample_ts, 'HH')",
}


def _shape(df: DataFrame, ddl: str, values: dict[str, str], extra: tuple[str, ...]) -> DataFrame:
    schema = df.sparkSession.createDataFrame([], ddl).schema
    return df.select(*[F.expr(values.get(f.name, "null")).cast(f.dataType).alias(f.name)
                       for f in schema], *extra)


def vehicle(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Raw vehicle messages; ``extra`` keeps columns of the base, such as ``e``."""
    rows = base(events(spark, sf_dir)).filter("not station")
    return _shape(rows, VEHICLE_FRAME_DDL, VEHICLE, extra)


def station(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    rows = base(events(spark, sf_dir)).filter("station")
    return _shape(rows, STATION_FRAME_DDL, STATION, extra)
