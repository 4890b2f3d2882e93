"""Block tags and identifiers as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEFAULTS, Params


def hour_tag(ts: Column, p: Params = DEFAULTS) -> Column:
    """Slot of the day, from 0 (12 of them with 2-hour slots)."""
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.floor(second / p.slot_seconds).cast("int")


def soc_tag(soc: Column, p: Params = DEFAULTS) -> Column:
    """User-SOC bin from 0; a full battery falls into the last bin, an unknown SOC into none."""
    last = F.lit(p.soc_bins - 1)
    return F.when(soc.isNotNull(), F.least(F.floor(soc / p.soc_bin), last)).cast("int")


def curr_tag(current: Column, edges: Sequence[float] = DEFAULTS.curr_edges) -> Column:
    """Current bin over sorted edges; a value on the 0 edge has a bin of its own.

    With edges -100, 0, 100: below -100 is 0, up to 0 is 1, exactly 0 is 2, then 3 and 4.
    """
    tag, number = None, 0
    for edge in edges:
        hit = current < edge
        tag = F.when(hit, number) if tag is None else tag.when(hit, number)
        number += 1
        if edge == 0:
            tag = tag.when(current == 0, number)
            number += 1
    return tag.when(current.isNotNull(), number).cast("int")


def date_tag(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def event_id(process_id: Column, device_name: Column, battery_id: Column,
             event_type: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit(""))
             for c in (process_id, device_name, battery_id, event_type)]
    return F.sha2(F.concat_ws("#", *parts), 256)


def epoch_ts(value: Column) -> Column:
    """Epoch integer to timestamp: milliseconds when above 1e11, else seconds."""
    millis = F.when(value > 100_000_000_000, value).otherwise(value * 1000)
    return F.timestamp_millis(millis)


def current_class(current: Column) -> Column:
    return (F.when(current < 0, "charge").when(current > 0, "discharge")
            .when(current == 0, "rest"))
