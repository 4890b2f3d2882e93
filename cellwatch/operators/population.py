"""Population statistics per group, exact, with no group gathered into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Statistics are broadcast up to so many rows and bytes; beyond that they are joined salted.
GROUPS, GROUP_BYTES, SALTS = 100_000, 8 << 20, 64


def join_groups(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "inner",
                most: int = GROUPS) -> DataFrame:
    """``df`` with the row of ``stats``, one per group, of its group: groups may hold any share of the rows.

    ``df`` is not dealt by group. Statistics of up to ``most`` groups and ``GROUP_BYTES`` are read and
    broadcast; more are repeated once per salt, and rows meet them on (group, salt), so a group is
    spread over all salts. ``stats`` is computed here, so ``df`` should be a stored table.
    """
    keys = list(keys)
    few = stats.limit(most + 1).collect()
    if len(few) <= most and sum(len(str(v)) for row in few for v in row) <= GROUP_BYTES:
        return df.join(F.broadcast(df.sparkSession.createDataFrame(few, stats.schema)), keys, how)
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(SALTS)).cast("int"))
    repeated = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def principal(df: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int, squarings: int = 40) -> DataFrame:
    """keys and ``projector``: per group the projection on the first ``k`` principal axes of ``columns``, whose
    means are 0, as a matrix row by row.

    The covariance is a matter of built-in sums. A symmetric matrix squared again and again, its
    trace kept at 1, becomes the projector on its first axis; taken out of the covariance, the next
    follows. Axes of equal variance are projected on together.
    """
    n = len(columns)
    cells = [(i, j) for i in range(n) for j in range(n)]
    sums = df.groupBy(*keys).agg(*[F.avg(F.col(columns[i]) * F.col(columns[j])).alias(f"_c{i}_{j}") for i, j in cells])
    left = sums.select(*keys, F.array(*[F.col(f"_c{i}_{j}") for i, j in cells]).alias("_left"),
                       F.array(*[F.lit(0.0)] * (n * n)).alias("projector"))

    def scaled(m: Column) -> Column:
        trace = sum((F.get(m, i * n + i) for i in range(1, n)), F.get(m, 0))
        return F.transform(m, lambda x: F.when(trace > 0, x / trace).otherwise(0.0))

    def squared(m: Column) -> Column:
        return F.array(*[sum((F.get(m, i * n + x) * F.get(m, x * n + j) for x in range(1, n)),
                             F.get(m, i * n) * F.get(m, j)) for i, j in cells])

    for _ in range(k):
        axis = F.aggregate(F.sequence(F.lit(1), F.lit(squarings)), scaled(F.col("_left")), lambda m, _: scaled(squared(m)))
        left = left.withColumn("_axis", axis)
        # the variance along the axis
        along = F.aggregate(F.zip_with("_left", "_axis", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
        left = left.withColumn("_along", along).withColumns({
            "projector": F.zip_with("projector", "_axis", lambda a, b: a + b),
            "_left": F.zip_with("_left", "_axis", lambda a, b: a - F.col("_along") * b)})
    return left.select(*keys, "projector")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, points: Sequence[float],
                    accuracy: int = 10_000) -> DataFrame:
    """Exact linear-interpolated quantiles per group: keys, ``n``, ``quantiles``.

    ``percentile`` would hold every distinct value of a group in one place. Here a sketch,
    merged from partial aggregates, first brackets each point; its rank error is at most
    n / accuracy, so a bracket four times that wide surely holds the point. A second pass
    counts what lies below a bracket and the values inside it, combined map-side. Only the
    bracket's values, at most 8 / accuracy of the group, are then put in order. The bracket of a
    group of up to ``accuracy`` rows, in which the margin is less than a rank, is the whole group. A
    rank outside its bracket is an error.
    """
    keys = list(keys)
    df = df.select(*keys, F.col(value).cast("double").alias("_x")).filter("_x is not null")
    margin = 4.0 / accuracy
    probes = [max(0.0, q - margin) for q in points] + [min(1.0, q + margin) for q in points]
    k = len(points)
    brackets = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.percentile_approx("_x", [float(q) for q in probes], accuracy).alias("_b"))
    wide = F.col("n") > accuracy
    joined = join_groups(df, brackets, keys)

    def place(i):
        below = wide & F.lit(points[i] - margin > 0) & (F.col("_x") < F.get("_b", i))
        above = wide & F.lit(points[i] + margin < 1) & (F.col("_x") > F.get("_b", k + i))
        # null stands for everything below the bracket
        return F.when(~above, F.struct(F.lit(i).alias("_i"),
                                       F.when(~below, F.col("_x")).alias("_v")))

    counts = (joined.select(*keys, "n", F.inline(F.array_compact(F.array(*[place(i) for i in range(k)]))))
              .groupBy(*keys, "n", "_i", "_v").agg(F.count("*").alias("_c")))
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_i").orderBy(F.asc_nulls_first("_v")))
    at = (F.col("n") - 1) * F.get(F.array(*[F.lit(float(q)) for q in points]), F.col("_i"))
    picked = (counts.withColumns({"_upto": upto, "_at": at})
              .groupBy(*keys, "n", "_i", "_at")
              .agg(F.max(F.when(F.col("_v").isNull(), F.col("_upto")).otherwise(0)).alias("_below"),
                   F.max("_upto").alias("_inside"),
                   F.min(F.when(F.col("_upto") > F.floor("_at"), F.col("_v"))).alias("_lo"),
                   F.min(F.when(F.col("_upto") > F.ceil("_at"), F.col("_v"))).alias("_hi"))
              .withColumn("_q", F.when(
                  (F.col("_below") > F.floor("_at")) | (F.col("_inside") <= F.ceil("_at")),
                  F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")).otherwise(
                      F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at")))))
    return picked.groupBy(*keys, "n").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_i", "_q"))), lambda s: s["_q"])
        .alias("quantiles"))


def upper_fences(df: DataFrame, keys: Sequence[str], fences: dict[str, str], factor: float) -> DataFrame:
    """keys and, for each ``column: name`` of ``fences``, Q3 + factor * IQR of the column.

    The columns go through one quantile pass together, as rows of (column, value).
    """
    long = df.unpivot(list(keys), [F.col(c).cast("double").alias(c) for c in fences], "_of", "_value")
    q = exact_quantiles(long, [*keys, "_of"], "_value", (0.25, 0.75))
    q1, q3 = F.get("quantiles", 0), F.get("quantiles", 1)
    fence = q3 + factor * (q3 - q1)
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("_of") == c, fence)).alias(n)
                                  for c, n in fences.items()])


def z_scores(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Adds ``z_<column>``: distance from the group mean in standard deviations.

    0 where the group is flat; a deviation that is rounding noise of the mean counts as flat.
    """
    stats = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in columns],
                                  *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])

    def z(c) -> Column:
        mean, sd = F.col(f"_m_{c}"), F.col(f"_s_{c}")
        alive = F.when(sd > F.abs(mean) * 1e-9, sd)
        return F.when(F.col(c).isNotNull(), F.coalesce((F.col(c) - mean) / alive, F.lit(0.0)))

    return (join_groups(df, stats, keys).withColumns({f"z_{c}": z(c) for c in columns})
            .drop(*[f"_m_{c}" for c in columns], *[f"_s_{c}" for c in columns]))
