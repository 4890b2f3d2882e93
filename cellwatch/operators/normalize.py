"""Raw vehicle and station messages to one canonical frame, and the small repairs before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tags, vectors
from ..schemas import CANONICAL_FRAME_DDL

# Code labels as the tables document them.
ENUM_LABELS: dict[str, dict[int, str]] = {
    "drivingBrkPedalState": {0: "NOT_PRESSED", 1: "PRESSED", 2: "RESERVERD", 3: "ERROR"},
    "drivingBrkPedalValid": {0: "BRK_PED_VALID", 1: "BRK_PED_INVALID"},
    "drivingVehDrvgMod": {0: "automatic mode", 1: "economy mode", 2: "comfort mode",
                          3: "sport mode", 7: "invalid"},
    "socChrgState": {0: "no charging", 1: "charge processing", 2: "charge complete",
                     3: "charge fault"},
    "vehicleChrgState": {1: "parking charging", 2: "driving charging", 3: "not charging",
                         4: "charge complete", 254: "abnormal", 255: "invalid"},
    "vehicleDcDcSts": {1: "working", 2: "disconnected", 254: "abnormal", 255: "invalid"},
    "vehicleOprtnMode": {1: "pure electric", 2: "hydride", 3: "fuel", 254: "abnormal",
                         255: "invalid"},
    "vehicleVehlState": {1: "driving", 2: "parked vehicle", 3: "driver present",
                         4: "sw update", 254: "abnormal", 255: "invalid"},
    "chargingChargerType": {0: "NO_REQUEST", 1: "NORMAL", 2: "AC", 3: "DC",
                            4: "POWER_EXPRESS", 5: "INVALID"},
    "platformType": {0: "nt1", 1: "nt2"},
    "is_test": {0: "user", 1: "test", 4: "rental"},
}

# Codes that mean "no usable reading".
INVALID_CODES: dict[str, tuple[int, ...]] = {
    "drivingBrkPedalState": (2, 3),
    "drivingVehDrvgMod": (7,),
    "vehicleChrgState": (254, 255),
    "vehicleDcDcSts": (254, 255),
    "vehicleOprtnMode": (254, 255),
    "vehicleVehlState": (254, 255),
    "chargingChargerType": (5,),
}


def _canonical(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Projects to the canonical columns in order; what a source lacks becomes null."""
    schema = df.sparkSession.createDataFrame([], CANONICAL_FRAME_DDL).schema
    kept = {"frame_no": {"unique": True}} if "row_no" in df.columns else {}
    return df.select([columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name, metadata=kept.get(f.name, {}))
                      for f in schema])


def _frame_number(df: DataFrame, *cols: str) -> Column:
    """A repeatable tie-break for messages of one battery with the same time.

    Files carry a row position (``row_no``, see ``sources.frames``) that makes it unique;
    without one, equal copies share a number.
    """
    return F.xxhash64(*cols, *(["row_no"] if "row_no" in df.columns else []))


def vehicle_to_frame(df: DataFrame, is_test: Column | None = None,
                     brand: Column | None = None,
                     balancing: str = "socBtryQualActvtn") -> DataFrame:
    """Vehicle messages to canonical frames; decimals become doubles here, once.

    The tables carry no test flag and no brand, so the caller supplies them.
    """
    c = F.col
    cells = c("socSinBtryVoltLst").cast("array<double>")
    probes = c("socPrbTempLst").cast("array<double>")
    return _canonical(df, {
        "battery_id": c("batteryId"), "device_id": c("vehicleId"), "device_name": c("vin"),
        "device_type": F.lit("vehicle"), "source": F.lit("vehicle"),
        "event_type": c("msgType"), "process_id": c("processId"),
        "sample_ts": c("sampleTs"),
        "frame_no": _frame_number(df, "socSinBtryVoltLst", "socPrbTempLst", "vehicleSoc",
                                  "vehicleVehlTotlCurnt", "vehicleVehlTotlVolt",
                                  "vehicleInsulatnResis", "msgType", "vehicleMileage"),
        "user_soc": c("vehicleSoc"), "real_soc": c("bmsSoc"), "soh": c("bmsHealthStatus"),
        "real_energy": c("socDumpEnrgy"),
        "current_a": F.coalesce("vehicleVehlTotlCurnt", "socBtryPakCurnt"),
        "pack_voltage_v": F.coalesce("vehicleVehlTotlVolt", "socBtryPakVoltage"),
        "cell_v": cells, "probe_temp_c": probes,
        "n_cells": c("socSinBtryQuntyOfPak"), "n_probes": c("socTempPrbQunty"),
        "max_cell_v": c("extremumSinBtryHistVolt"), "max_cell_sn": c("extremumHistVoltSinglBtrySn"),
        "min_cell_v": c("extremumSinBtryLwstVolt"), "min_cell_sn": c("extremumLwstVoltSinglBtrySn"),
        "avg_cell_v": c("bmsAvgCellVolt"),
        "max_temp_c": c("extremumHighestTemp"), "max_temp_sn": c("extremumHistTempPrbSn"),
        "min_temp_c": c("extremumLowestTemp"), "min_temp_sn": c("extremumLwstTempPrbSn"),
        "avg_temp_c": c("bmsAvgTemp"),
        "iso_kohm": c("vehicleInsulatnResis"), "iso_level": c("bmsIsolationLevel"),
        "is_balancing": c(balancing), "charge_state": c("socChrgState"),
        "mileage": c("vehicleMileage"), "speed": c("vehicleSpeed"),
        "device_version": c("vehicleVersion"),
        "coolant_in_c": c("bmsInCoolantTemp"), "coolant_out_c": c("bmsOutCoolantTemp"),
        **({"is_test": is_test} if is_test is not None else {}),
        **({"brand": brand} if brand is not None else {}),
    })


def station_to_frame(df: DataFrame, charging_codes: Sequence[int] = (1,),
                     brand: Column | None = None) -> DataFrame:
    """Swap-station messages to canonical frames.

    The table has no event column: the charge state tells charging from resting (which
    codes mean charging is the caller's knowledge), runs are numbered by ``number_processes``.
    """
    c = F.col
    return _canonical(df, {
        "battery_id": c("battery_id"), "device_id": c("device_id"), "device_name": c("device_id"),
        "device_type": c("device_type"), "source": c("source"),
        "event_type": F.when(c("battery_charge_state").isin(*charging_codes), "charging")
        .otherwise("parking"),
        "sample_ts": tags.epoch_ts(c("time_stamp")),
        "frame_no": _frame_number(df, "cell_voltage_sensor_data", "temperature_sensor_data",
                                  "customer_usage_soc", "current", "voltage",
                                  "bms_insulation_resistance_value", "battery_charge_state"),
        "user_soc": c("customer_usage_soc"), "real_soc": c("soc"), "soh": c("soh"),
        "real_energy": c("bms_pack_energy_available"),
        "current_a": c("current"), "pack_voltage_v": c("voltage"),
        "cell_v": c("cell_voltage_sensor_data"), "probe_temp_c": c("temperature_sensor_data"),
        "n_cells": F.size("cell_voltage_sensor_data_index"),
        "n_probes": F.size("temperature_sensor_data_index"),
        "max_cell_v": c("max_cell_voltage"), "max_cell_sn": c("max_cell_voltage_number"),
        "min_cell_v": c("min_cell_voltage"), "min_cell_sn": c("min_cell_voltage_number"),
        "avg_cell_v": c("avg_cell_voltage"),
        "max_temp_c": c("max_battery_pack_temperature"),
        "max_temp_sn": c("max_battery_pack_temperature_number"),
        "min_temp_c": c("min_battery_pack_temperature"),
        "min_temp_sn": c("min_battery_pack_temperature_number"),
        "avg_temp_c": c("avg_battery_pack_temperature"),
        "iso_kohm": c("bms_insulation_resistance_value"), "iso_level": c("isolation_level"),
        "is_balancing": c("is_balanced"), "charge_state": c("battery_charge_state"),
        "bms_version": c("bms_version"), "device_version": c("software_version"),
        "coolant_in_c": c("inlet_water_temperature"), "coolant_out_c": c("outlet_water_temperature"),
        "battery_type": c("battery_type"),
        **({"brand": brand} if brand is not None else {}),
    })


def frames(vehicle: DataFrame, station: DataFrame) -> DataFrame:
    """Both sources in one stream of frames, told apart by ``source``."""
    return vehicle.unionByName(station, allowMissingColumns=True)


def assemble_pack(df: DataFrame, keys: Sequence[str] = ("batteryId", "sampleTs", "socBtryPakSn"),
                  start: str = "socFrmStartBtrySn", cells: str = "socSinBtryVoltLst",
                  declared: str = "socSinBtryQuntyOfPak") -> DataFrame:
    """Joins the partial cell lists of one sample in order of their first cell number.

    A list sent more than once collapses in the first, map-side combined aggregate, so
    what is gathered per sample is never more than the pack's cells.
    """
    keys = list(keys)
    once = df.groupBy(*keys, start).agg(F.min(cells).alias("_part"),
                                        F.max(declared).alias("_declared"))
    parts = F.sort_array(F.collect_list(F.struct(start, "_part")))
    return (once.groupBy(*keys)
            .agg(F.flatten(F.transform(parts, lambda x: x["_part"])).alias("cells"),
                 F.max("_declared").alias("declared_cells"))
            .withColumn("is_complete", F.size("cells") == F.col("declared_cells")))


def decode_enums(df: DataFrame, labels: dict[str, dict[int, str]] | None = None) -> DataFrame:
    """Adds ``<column>_label`` for every coded column present; unknown codes give null."""
    out = {}
    for name, codes in (labels or ENUM_LABELS).items():
        if name in df.columns:
            value = F.col(name).cast("int")
            label = F.lit(None).cast("string")
            for code, text in reversed(codes.items()):
                label = F.when(value == code, text).otherwise(label)
            out[f"{name}_label"] = label
    return df.withColumns(out)


def null_invalid(df: DataFrame, codes: dict[str, tuple[int, ...]] | None = None) -> DataFrame:
    """Replaces codes that mean abnormal or invalid by null."""
    return df.withColumns({
        name: F.when(~F.col(name).isin(*bad), F.col(name))
        for name, bad in (codes or INVALID_CODES).items() if name in df.columns})


def to_mv(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds the mV twin of voltage columns held in V (``x_v`` gives ``x_mv``)."""
    return df.withColumns({c.removesuffix("_v") + "_mv": vectors.to_mv(F.col(c)) for c in columns})


def explode_alarms(df: DataFrame, alarms: str = "alarmCommon") -> DataFrame:
    """One row per alarm of a message: ``alarm_id``, ``alarm_level``."""
    return df.select("*", F.explode(alarms).alias("alarm_id", "alarm_level"))


def alarm_counts(df: DataFrame, keys: Sequence[str], alarms: str = "alarmCommon") -> DataFrame:
    return (explode_alarms(df.select(*keys, alarms), alarms)
            .groupBy(*keys, "alarm_id")
            .agg(F.count("*").alias("n_alarms"), F.max("alarm_level").alias("max_level")))


def sensor_map(df: DataFrame, labels: str, values: str, out: str) -> DataFrame:
    """Pairs the sensor label list with the value list as a map."""
    return df.withColumn(out, F.map_from_arrays(labels, values))


def sensor_rows(df: DataFrame, labels: str, values: str) -> DataFrame:
    """The same pairing as rows: ``sensor``, ``reading``."""
    pairs = F.arrays_zip(F.col(labels).alias("sensor"), F.col(values).alias("reading"))
    return df.select("*", F.inline(pairs).alias("sensor", "reading")).drop(labels, values)


def merge_dual_pack(df: DataFrame, pairs: Sequence[tuple[str, str, str, str, str, str]]) -> DataFrame:
    """Overall extreme of the A and B packs with the number and pack it came from.

    Each pair is (kind, out, value_a, number_a, value_b, number_b), kind ``max`` or ``min``;
    on a tie pack A owns the value.
    """
    out = {}
    for kind, name, va, na, vb, nb in pairs:
        a, b = F.col(va).cast("double"), F.col(vb).cast("double")
        pick_b = a.isNull() | ((b > a) if kind == "max" else (b < a))
        pick_b = F.coalesce(pick_b & b.isNotNull(), F.lit(False))
        out[name] = F.when(pick_b, b).otherwise(a)
        out[f"{name}_sn"] = F.when(pick_b, F.col(nb)).otherwise(F.col(na)).cast("int")
        out[f"{name}_pack"] = F.when(pick_b, "B").when(a.isNotNull(), "A")
    return df.withColumns(out)


def epoch_to_ts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_ts`` for epoch integers in seconds or milliseconds."""
    return df.withColumns({f"{c}_ts": tags.epoch_ts(F.col(c)) for c in columns})


def enrich_static(df: DataFrame, dim: DataFrame, key: str = "battery_type") -> DataFrame:
    """Left join of the static battery facts.

    No broadcast hint: Spark broadcasts ``dim`` only while its size is under the session's
    threshold, and joins by shuffle with skew handling beyond it.
    """
    return df.join(dim, key, "left")


def current_class(df: DataFrame) -> DataFrame:
    return df.withColumn("current_class", tags.current_class(F.col("current_a")))


def frame_derived(df: DataFrame) -> DataFrame:
    """Per-frame signals of the cell and probe vectors, in mV and degC.

    A cell or probe that reads NaN or null takes no part in extremes, means and medians.
    ``deviation_mv`` is the largest distance of a cell from the frame's median. A bus value
    (``max_cell_v`` and peers) is completed from the vector where the message lacks it.
    """
    c = F.col
    df = df.withColumns({"cell_mv": vectors.vector_mv(c("cell_v"))})
    # a column per step: what several signals use is worked out once per frame
    df = df.withColumns({"_cells": vectors.readings(c("cell_mv")), "_probes": vectors.readings(c("probe_temp_c"))})
    df = df.withColumns({"_sorted": F.sort_array("_cells"), "mean_mv": vectors.mean(c("_cells")),
                         "hot_c": F.array_max("_probes"), "cold_c": F.array_min("_probes"),
                         "mean_c": vectors.mean(c("_probes"))})
    df = df.withColumns({"hi_mv": F.get("_sorted", F.size("_sorted") - 1), "lo_mv": F.get("_sorted", 0),
                         "median_mv": vectors.median(c("_sorted"))})
    return df.withColumns({
        "hi_sn": vectors.position(c("cell_mv"), c("hi_mv")), "lo_sn": vectors.position(c("cell_mv"), c("lo_mv")),
        "hot_sn": vectors.position(c("probe_temp_c"), c("hot_c")), "cold_sn": vectors.position(c("probe_temp_c"), c("cold_c")),
    }).withColumns({
        "volt_diff_mv": c("hi_mv") - c("lo_mv"),
        "temp_diff_c": c("hot_c") - c("cold_c"),
        "deviation_mv": F.greatest(c("hi_mv") - c("median_mv"), c("median_mv") - c("lo_mv")),
        "max_cell_v": F.coalesce("max_cell_v", c("hi_mv") / 1e3),
        "max_cell_sn": F.coalesce("max_cell_sn", "hi_sn"),
        "min_cell_v": F.coalesce("min_cell_v", c("lo_mv") / 1e3),
        "min_cell_sn": F.coalesce("min_cell_sn", "lo_sn"),
        "avg_cell_v": F.coalesce("avg_cell_v", c("mean_mv") / 1e3),
        "max_temp_c": F.coalesce("max_temp_c", "hot_c"),
        "max_temp_sn": F.coalesce("max_temp_sn", "hot_sn"),
        "min_temp_c": F.coalesce("min_temp_c", "cold_c"),
        "min_temp_sn": F.coalesce("min_temp_sn", "cold_sn"),
        "avg_temp_c": F.coalesce("avg_temp_c", "mean_c"),
    }).drop("_cells", "_sorted", "_probes")
