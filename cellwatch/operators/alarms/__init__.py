"""The failure-type algorithms; ``as_alarms`` brings any result to the alarm table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_alarms(df: DataFrame, algorithm: str, at: Column, evidence: Sequence[str],
              fired: Column | None = None, events: DataFrame | None = None) -> DataFrame:
    """Rows of the alarm table from the rows of one algorithm.

    Rows per frame or block keep the event and device they come with. Rows per process take them from
    ``events`` (``segment.events``); an alarm of a whole battery-day belongs to no single event.
    """
    missing = [c for c in ("event_id", "device_id") if c not in df.columns]
    if events is not None and missing and "process_id" in df.columns:
        df = df.join(events.select("battery_id", "process_id", *missing), ["battery_id", "process_id"], "left")

    def named(name):
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    values = F.array(*[F.col(e).cast("double") for e in evidence])
    names = F.array(*[F.lit(e) for e in evidence])
    return df.select(
        "battery_id", named("device_id").alias("device_id"), named("event_id").alias("event_id"),
        at.cast("timestamp").alias("at"), F.lit(algorithm).alias("algorithm"),
        (F.col("fired") if fired is None else fired).alias("fired"),
        F.map_from_arrays(names, values).alias("evidence"))
