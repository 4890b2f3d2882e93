"""Time-ordered operations per key that survive one key holding most of the rows.

A plain ``Window.partitionBy(battery)`` puts a battery's whole history into one task.
Here every ordered operation works on (key, slice), a slice being a short range of the
order column, and a *summary* with one row per (key, slice) carries the state over the
slice borders: the summary is built with a map-side partial aggregate, so it is small
(slices are counted by the clock, not by rows), and is joined back on (key, slice), the
partitioning the slice window already has. Frames cross the network once.

Order columns must be unique together within a key (``sample_ts, frame_no``). A slice is
given either as an expression or as columns the frames keep; with kept columns (the date
and slot tags) a later grouping by key, tags and more needs no further exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIME_ORDER = ("sample_ts", "frame_no")
SLICE = "_slice"
SliceBy = Column | Sequence[str]


def time_slice(seconds: int, ts: str = "sample_ts") -> Column:
    return F.floor(F.unix_seconds(F.col(ts)) / seconds)


def number_slice(column: str, width: int) -> Column:
    return F.floor(F.col(column) / width)


def _sliced(df: DataFrame, slice_by: SliceBy) -> tuple[DataFrame, list[str], list[str]]:
    """The frame, its slice columns and those of them to drop at the end."""
    if isinstance(slice_by, Column):
        return df.withColumn(SLICE, slice_by), [SLICE], [SLICE]
    return df, list(slice_by), []


def previous(df: DataFrame, keys: Sequence[str], cols: Sequence[str], slice_by: SliceBy,
             order: Sequence[str] = TIME_ORDER, out: str = "prev") -> DataFrame:
    """Adds ``out``: a struct of ``cols`` of the preceding row of the key, null at its start."""
    df, cut, extra = _sliced(df, slice_by)
    group, pack = [*keys, *cut], F.struct(*cols)
    across = Window.partitionBy(*keys).orderBy(*cut)
    tails = (df.groupBy(*group)
             .agg(F.max_by(pack, F.struct(*order)).alias("_tail"))
             .withColumn("_carry", F.lag("_tail").over(across))
             .drop("_tail"))
    near = F.lag(pack).over(Window.partitionBy(*group).orderBy(*order))
    return (df.withColumn("_near", near).join(tails, group, "left")
            .withColumn(out, F.coalesce("_near", "_carry"))
            .drop("_near", "_carry", *extra))


def running_total(df: DataFrame, keys: Sequence[str], value: Column, slice_by: SliceBy,
                  order: Sequence[str] = TIME_ORDER, out: str = "total") -> DataFrame:
    """Adds ``out``: the sum of an integer ``value`` up to and including the row."""
    df, cut, extra = _sliced(df, slice_by)
    group = [*keys, *cut]
    df = df.withColumn("_value", value.cast("long"))
    earlier = (Window.partitionBy(*keys).orderBy(*cut)
               .rowsBetween(Window.unboundedPreceding, -1))
    before = (df.groupBy(*group).agg(F.sum("_value").alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
              .drop("_sum"))
    here = F.sum("_value").over(Window.partitionBy(*group).orderBy(*order)
                                .rowsBetween(Window.unboundedPreceding, 0))
    return (df.withColumn("_here", here).join(before, group, "left")
            .withColumn(out, F.coalesce("_here", F.lit(0)) + F.coalesce("_before", F.lit(0)))
            .drop("_here", "_before", "_value", *extra))


def number_runs(df: DataFrame, keys: Sequence[str], kind: str, slice_by: SliceBy,
                order: Sequence[str] = TIME_ORDER, out: str = "run") -> DataFrame:
    """Adds ``out``: the number, from 1, of the run of equal ``kind`` a row belongs to."""
    df, cut, extra = _sliced(df, slice_by)
    group = [*keys, *cut]
    local = Window.partitionBy(*group).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(*cut)

    def with_change(frame):
        first = F.row_number().over(local) == 1
        same = F.lag(kind).over(local).eqNullSafe(F.col(kind))
        return frame.withColumn("_change", F.when(first | same, 0).otherwise(1))

    at = F.struct(*order)
    edges = (with_change(df.select(*group, *order, kind))
             .groupBy(*group)
             .agg(F.sum("_change").alias("_inner"),
                  F.min_by(F.struct(kind), at).alias("_first"),
                  F.max_by(F.struct(kind), at).alias("_last")))
    last = F.lag("_last").over(across)
    up_to = across.rowsBetween(Window.unboundedPreceding, 0)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    starts = (edges
              .withColumn("_border", F.when(last.isNull() | last.eqNullSafe(F.col("_first")), 0)
                          .otherwise(1))
              .withColumn("_base", F.sum("_border").over(up_to)
                          + F.coalesce(F.sum("_inner").over(before), F.lit(0)))
              .select(*group, "_base"))
    inner = F.sum("_change").over(local.rowsBetween(Window.unboundedPreceding, 0))
    return (with_change(df).withColumn("_run", inner).join(starts, group, "left")
            .withColumn(out, (F.lit(1) + F.col("_run") + F.col("_base")).cast("long"))
            .drop("_run", "_base", "_change", *extra))


def number_long_runs(df: DataFrame, keys: Sequence[str], kind: str, slice_by: SliceBy,
                     order: Sequence[str] = TIME_ORDER, out: str = "run",
                     carry: DataFrame | None = None) -> DataFrame:
    """``number_runs`` for kinds that change seldom: wide rows pass no window and no sort.

    Only the order and kind columns are put in order. Each slice then has a short list of
    the places where the kind changes, and a row's number is the slice's base plus the
    changes up to the row. The list never exceeds the slice's rows, but the cost of a row
    grows with it: for kinds that change every few rows use ``number_runs``.

    ``carry`` is one earlier row per key: its slice, order columns, kind and number, ``run``.
    """
    df, cut, extra = _sliced(df, slice_by)
    starts = run_starts(df, keys, kind, cut, order, carry)
    return place_in_runs(df.join(starts, [*keys, *cut], "left"), order, out).drop(*extra)


def run_starts(df: DataFrame, keys: Sequence[str], kind: str, cut: Sequence[str], order: Sequence[str] = TIME_ORDER,
               carry: DataFrame | None = None, more: Sequence[Column] = ()) -> DataFrame:
    """One row per slice: ``_base`` and ``_cuts`` of ``number_long_runs``, and ``more`` aggregates of the slice's rows."""
    group, at = [*keys, *cut], F.struct(*order)
    local = Window.partitionBy(*group).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(*cut)
    changed = (F.row_number().over(local) > 1) & ~F.lag(kind).over(local).eqNullSafe(F.col(kind))
    thin = (df if more else df.select(*group, *order, kind)).withColumn("_add", F.lit(0).cast("long"))
    if carry is not None:
        thin = thin.unionByName(carry.select(*group, *order, kind, (F.col("run") - 1).alias("_add")), allowMissingColumns=True)
    edges = (thin.withColumn("_change", changed).groupBy(*group)
             .agg(F.max("_add").alias("_add"), F.collect_list(F.when(F.col("_change"), at)).alias("_cuts"),
                  F.min_by(F.struct(kind), at).alias("_first"),
                  F.max_by(F.struct(kind), at).alias("_last"), *more))
    last = F.lag("_last").over(across)
    border = F.when(last.isNull() | last.eqNullSafe(F.col("_first")), 0).otherwise(1)
    return (edges.withColumn("_border", border)
            .withColumn("_base", F.sum("_border").over(
                across.rowsBetween(Window.unboundedPreceding, 0))
                + F.coalesce(F.sum(F.size("_cuts")).over(
                    across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                + F.max("_add").over(Window.partitionBy(*keys)))
            .drop("_border", "_add", "_first", "_last"))


def place_in_runs(df: DataFrame, order: Sequence[str] = TIME_ORDER, out: str = "run") -> DataFrame:
    """The numbers of rows that have met the ``run_starts`` of their slice."""
    at = F.struct(*order)
    passed = F.when(F.size("_cuts") > 0, F.size(F.filter("_cuts", lambda c: c <= at))).otherwise(0)
    return df.withColumn(out, (F.lit(1) + F.col("_base") + passed).cast("long")).drop("_base", "_cuts")


def condition_runs(df: DataFrame, keys: Sequence[str], condition: Column, slice_by: SliceBy,
                   aggs: Sequence[Column], order: Sequence[str] = TIME_ORDER) -> DataFrame:
    """One row per maximal run of rows where ``condition`` holds, with ``aggs`` of it.

    Rows where the condition fails are the borders: their running count names the run,
    so no neighbour has to be looked at and a run of any length is a partial aggregate.
    """
    df = df.withColumn("_hold", F.coalesce(condition, F.lit(False)))
    named = running_total(df, keys, F.when(F.col("_hold"), 0).otherwise(1), slice_by, order,
                          out="_island")
    return named.filter("_hold").groupBy(*keys, "_island").agg(*aggs).drop("_island")


def rolling(df: DataFrame, keys: Sequence[str], rows: int, aggs: dict[str, Column],
            slice_by: SliceBy, order: Sequence[str] = TIME_ORDER,
            chunk_rows: int = 50_000, number: str | None = None) -> DataFrame:
    """Adds ``aggs`` over the last ``rows`` rows of the key, the current one included, and as ``number`` the
    row's number within the key.

    Rows are numbered per key, cut into chunks of ``chunk_rows``, and the last ``rows - 1``
    of a chunk are also handed to the next one, so the windows are exact and no task
    holds more than a chunk, however long the key's history is.
    """
    keys, chunk_rows = list(keys), max(chunk_rows, rows)
    numbered = running_total(df, keys, F.lit(1), slice_by, order, out="_no")
    at = F.col("_no") - 1
    chunk = F.floor(at / chunk_rows)
    halo = at % chunk_rows >= chunk_rows - (rows - 1)

    def place(number, is_copy):
        return F.struct(number.alias("chunk"), F.lit(is_copy).alias("copy"))

    placed = numbered.withColumn("_place", F.explode(
        F.when(halo, F.array(place(chunk, False), place(chunk + 1, True)))
        .otherwise(F.array(place(chunk, False)))))
    span = (Window.partitionBy(*keys, "_place.chunk").orderBy("_no")
            .rowsBetween(-(rows - 1), 0))
    out = placed.select("*", *[a.over(span).alias(n) for n, a in aggs.items()])
    out = out.filter(~F.col("_place.copy")).drop("_place")
    return out.withColumnRenamed("_no", number) if number else out.drop("_no")
