"""Distinct rows, one row per key and top-n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyra.sinks.writers import hand_off


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in ``order``, which should be a total order.

    Spark cuts each key to one row before the shuffle (WindowGroupLimit), so
    a hot key sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


#: Rows that may reach one task to be sorted there.
MAX_SORTED = 1_000_000
#: Relative error of the quantile sketch is one in this.
ACCURACY = 100_000


def top_n(df: DataFrame, n: int, order: list[Column], key: Column | None = None) -> DataFrame:
    """The first ``n`` rows in ``order``, which should be a total order.

    Every task would send ``n`` rows to the one that merges them. Where that is
    more than ``MAX_SORTED`` in all, and ``key`` is a number that ``order``
    sorts by first, ascending and without nulls, a mergeable sketch gives a
    value of ``key`` that at least ``n`` rows do not exceed. Rows above it are
    left out where they lie. If very many rows share the last key, the rest is
    settled in ranges of the whole order.
    """
    if key is None or n * df.rdd.getNumPartitions() <= MAX_SORTED:
        return df.orderBy(*order).limit(n)
    cut = cut_value(df, n, key)
    if cut is not None:
        df = df.where(key <= F.lit(cut))
    left = df.count()
    return df.orderBy(*order).limit(n) if left <= 2 * n + MAX_SORTED else first_ranges(df, n, order)


def cut_value(df: DataFrame, n: int, key: Column) -> float | None:
    """A value that at least ``n`` keys do not exceed, and few more; None: all rows are needed."""
    total = df.count()
    share = n / max(total, 1)
    while share < 1:
        share = min(1.0, share + 2 / ACCURACY)
        cut = df.agg(F.percentile_approx(key, share, ACCURACY)).first()[0]
        if df.where(key <= F.lit(cut)).count() >= n:
            return cut
        share *= 1.5
    return None


def first_ranges(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows by ranges of ``order``: whole ranges, and a part of one.

    Only counts reach the driver, one per range; the range that is cut is
    sorted by its own task.
    """
    ranged = hand_off(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect())
    whole, room = [], n
    for number, size in sizes:
        if size > room:
            part = ranged.where(F.col("_range") == number).orderBy(*order).limit(room)
            return ranged.where(F.col("_range").isin(whole)).unionByName(part).drop("_range")
        whole.append(number)
        room -= size
    return ranged.drop("_range")
