"""Ranks and prefix sums over groups of any size.

A window over a group runs in one task however large the group is. These operators cut each group into value ranges
first, so a task holds one range, and combine the ranges through their (few) totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def group_ranks(df: DataFrame, keys: Sequence[str], score: str, higher_is_better: Column | bool = True, out: str = "rank", buckets: int = 1024) -> DataFrame:
    """Mid-rank of every row's score within its group: rows strictly better, plus half of those tied, plus a half.

    Rows with a null or NaN score get the mid-rank behind all scored rows. Ties share one rank. Equal scores are counted
    before any ordering, so a group in which a third of the table is tied costs one row there. Distinct scores are then
    ranked per (group, range of 1/buckets of the group's span of scores).
    Output: df's columns plus `out` DOUBLE. Empty input gives an empty result. Infinite scores rank at the ends.
    """
    keys = list(keys)
    s = F.when(F.isnan(score), None).otherwise(F.col(score).cast("double"))
    sign = F.when(F.lit(higher_is_better) if isinstance(higher_is_better, bool) else higher_is_better, F.lit(-1.0)).otherwise(F.lit(1.0))
    base = df.withColumn("_o", s * sign)
    counts = base.groupBy(*keys, "_o").agg(F.count(F.lit(1)).alias("_n"))
    span = counts.groupBy(*keys).agg(
        F.min(F.when(F.abs("_o") < F.lit(float("inf")), F.col("_o"))).alias("_lo"),
        F.max(F.when(F.abs("_o") < F.lit(float("inf")), F.col("_o"))).alias("_hi"),
    )
    counts = _null_safe(counts, span, keys)
    width = (F.col("_hi") / 2 - F.col("_lo") / 2)
    cell = F.floor((F.col("_o") / 2 - F.col("_lo") / 2) / F.nullif(width, F.lit(0.0)) * buckets)
    counts = counts.withColumn(
        "_b",
        F.when(F.col("_o").isNull(), F.lit(buckets + 2))
        .when(F.col("_o") == F.lit(float("-inf")), F.lit(-1))
        .when(F.col("_o") == F.lit(float("inf")), F.lit(buckets + 1))
        .otherwise(F.coalesce(cell, F.lit(0)).cast("int")),
    ).drop("_lo", "_hi")
    totals = counts.groupBy(*keys, "_b").agg(F.sum("_n").alias("_t"))
    before = F.coalesce(F.sum("_t").over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select(*keys, "_b", before.alias("_before"))
    local = Window.partitionBy(*keys, "_b").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_in", F.coalesce(F.sum("_n").over(local), F.lit(0)))
    counts = _null_safe(counts, totals, [*keys, "_b"])
    ranks = counts.select(*keys, "_o", (F.col("_before") + F.col("_in") + (F.col("_n") + 1) / F.lit(2.0)).alias(out))
    return _null_safe(base, ranks, [*keys, "_o"]).drop("_o")


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], counted: Column, out: str) -> DataFrame:
    """df with `out` BIGINT: the rows of the same group up to this one, in ascending `order`, for which `counted` holds.

    The whole order is range-partitioned and written once; counts within a range and group are shifted by the group's counts in the
    ranges before it. A group of any size is in as many tasks as it fills. `order` should be unique within a group.
    """
    keys, order = list(keys), list(order)
    ranged = df.withColumn("_c", counted.cast("bigint")).repartitionByRange(*keys, *order).withColumn("_p", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    n = ranged.groupBy(*keys, "_p").agg(F.sum("_c").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    within = F.sum("_c").over(Window.partitionBy(*keys, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shifted = _null_safe(ranged.withColumn("_i", within), n.select(*keys, "_p", before.alias("_before")), [*keys, "_p"])
    return shifted.withColumn(out, F.col("_before") + F.col("_i")).drop("_c", "_p", "_i", "_before")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be null, keeping left's key columns once."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(r, cond, "inner").drop(*[f"_r_{k}" for k in keys])


def take_until(df: DataFrame, key: str, order: Column, size: str, target: str, buckets: int = 4096) -> DataFrame:
    """The rows of each group, in ascending order of `order` (a value in [0, 1)), whose sizes add up to at most `target`.

    Two passes: sizes are summed per (group, 1/buckets of the order); whole cells below the cut are taken, and only rows
    of the one cell that holds the cut are sorted. Rows of size 0 at or before the cut are taken. `order` must be unique
    within a group, or ties are broken arbitrarily but repeatably by the row's hash. The row that crosses the target is
    taken iff more than half of it fits, so totals differ from the target by at most half of one row.
    """
    rows = df.withColumn("_p", order).withColumn("_b", F.least(F.floor(F.col("_p") * buckets), F.lit(buckets - 1)).cast("int"))
    cells = rows.groupBy(key, "_b").agg(F.sum(size).alias("_s"))
    w = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col(key).alias("_k"), F.col("_b").alias("_c"), F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_before"), F.col("_s").alias("_cell"))
    rows = rows.join(cells, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_c"))).drop("_k", "_c")
    whole = rows.filter(F.col("_before") + F.col("_cell") <= F.col(target))
    edge = rows.filter((F.col("_before") < F.col(target)) & (F.col("_before") + F.col("_cell") > F.col(target)))
    run = Window.partitionBy(key, "_b").orderBy("_p", F.xxhash64(*[c for c in df.columns])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("_run", F.col("_before") + F.sum(size).over(run)).filter(F.col("_run") - F.col(size) / 2 <= F.col(target)).drop("_run")
    return whole.unionByName(edge).drop("_p", "_b", "_before", "_cell")
