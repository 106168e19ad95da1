"""Joins of a large table with one-row-per-key tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate of ``df`` is below the broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return 0 <= size <= limit


def hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Hashes of the keys that hold more than ``share`` of the rows.

    One pass with a mergeable frequent-items sketch: no shuffle of the keys,
    and at most ``1 / share`` result rows whatever the table's size.
    """
    tops = df.dropna(subset=keys).select(F.xxhash64(*keys).alias("hot")).agg(
        F.expr(f"approx_top_k(hot, {int(1 / share) + 1}, 10000)").alias("tops"),
        F.count("*").alias("total"),
    )
    return (
        tops.select(F.explode("tops").alias("t"), "total")
        .where(F.col("t.count") > F.col("total") * F.lit(share))
        .select(F.col("t.item").alias("hot"))
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "left",
    spread_by: list[str] | None = None,
    salts: int = 32,
    hot_share: float = 0.01,
    sketch: bool = True,
) -> DataFrame:
    """Join ``left``, whose keys may be skewed, with one-row-per-key ``right``.

    A right side below Spark's broadcast limit is broadcast: no shuffle, hence
    no skew, and the left side keeps its partitions. Beyond that size the rows of hot keys, and rows with a null key, are spread over
    ``salts`` partitions by a hash of ``spread_by`` (default: all other
    columns, so a re-run task salts alike), and only the matching rows of
    ``right`` are repeated. Works for left, inner, left_semi and left_anti.

    Hot keys are found by a second pass over the key columns of ``left``.
    ``sketch=False`` leaves it out, for a left side that is unique by key or
    costly to compute twice; adaptive execution then splits a partition that
    turns out too large.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(right):
        return left.join(F.broadcast(right), keys, how)
    # Shuffled hash join: with one row per key the partitions of `right` stay
    # small, and the wide rows of `left` need no sort.
    if not sketch:
        return left.join(right.hint("shuffle_hash"), keys, how)
    hot = hot_keys(left, keys, hot_share)
    spread_by = spread_by or [c for c in left.columns if c not in keys]
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int") if spread_by else F.lit(0)
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    is_hot = F.col("hot").isNotNull()
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_hash", F.xxhash64(*keys)).join(
            F.broadcast(hot), F.col("_hash") == F.col("hot"), "left"
        )

    salted = marked(left).withColumn("_salt", F.when(is_hot | no_key, salt).otherwise(F.lit(0)))
    repeated = marked(right).withColumn(
        "_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))
    )
    helpers = ["_hash", "hot"]
    repeated = repeated.drop(*helpers).hint("shuffle_hash")
    return salted.drop(*helpers).join(repeated, keys + ["_salt"], how).drop("_salt")
