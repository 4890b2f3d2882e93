"""The daily job: a day of frames to the block table, and warnings from it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features, normalize, segment
from ..params import DEFAULTS, Params
from ..schemas import BLOCK_FEATURES_DDL
from ..sources.scratch import materialize

# What the block features and the warning layer read; the rest of the frames is left behind.
_NEEDED = (*segment.BLOCK_KEY, "device_name", "device_type", "source", "brand", "battery_type",
           "sample_ts", "frame_no", "user_soc", "real_soc", "soh", "real_energy", "current_a",
           "pack_voltage_v", "cell_v", "cell_mv", "probe_temp_c", "hi_mv", "lo_mv", "mean_mv",
           "median_mv", "hi_sn", "lo_sn", "hot_c", "cold_c", "hot_sn", "cold_sn", "volt_diff_mv",
           "temp_diff_c", "deviation_mv", "max_cell_v", "max_cell_sn", "min_cell_v", "min_cell_sn",
           "avg_cell_v", "max_temp_c", "max_temp_sn", "min_temp_c", "min_temp_sn", "iso_kohm",
           "is_balancing", "mileage", "speed", "bms_version", "device_version", "is_test",
           "cell_init", "probe_init", "cold_init", "iso_init", "is_missing", "is_effective", "n_msgs")


def prepare_sources(vehicle: DataFrame, station: DataFrame, p: Params = DEFAULTS,
                    carry: DataFrame | None = None) -> DataFrame:
    """Prepared frames of both sources. Vehicles number their processes themselves, so only
    station frames, the smaller part, are shuffled to be numbered, on from ``carry``. Ids are text."""
    numbered = features.prepare(station, p, carry=carry)
    return features.prepare(vehicle, p, numbered=True).unionByName(
        numbered.withColumn("process_id", F.col("process_id").cast("string")))


def prepare_day(frames: DataFrame, p: Params = DEFAULTS, numbered: bool = False,
                unique_numbers: bool | None = None, carry: DataFrame | None = None) -> DataFrame:
    """Prepared frames, written once to the shared scratch folder.

    ``carry`` is ``segment.last_processes`` of the day before: the same event has one id on both.

    Three aggregates read them (features, gaps, rests); writing costs less than shuffling
    and deriving three times, and a lost executor costs a re-read, not a recomputation.
    """
    ready = features.prepare(frames, p, numbered, True, unique_numbers, carry, whole=True).select(*_NEEDED)
    return materialize(ready, "prepared", ("date_tag",))


def block_table(prepared: DataFrame, static: DataFrame, as_of: datetime, etl_at: datetime,
                p: Params = DEFAULTS) -> DataFrame:
    """All columns of the block table, in its order and types."""
    blocks = features.table_features(prepared, p)
    blocks = blocks.withColumn("block_duration", F.coalesce("block_duration", F.lit(0)))
    blocks = normalize.enrich_static(blocks, static)
    blocks = segment.with_bookkeeping(blocks, as_of, etl_at)
    schema = blocks.sparkSession.createDataFrame([], BLOCK_FEATURES_DDL).schema
    return blocks.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
