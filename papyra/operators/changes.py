"""Change sets between two snapshots of a keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.operators.joins import lookup_join


#: Timestamps keep their microseconds.
DIGEST_FORMAT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def content_hash(columns: list[str]) -> Column:
    """Digest of the row content that tells null and absent values apart."""
    return F.md5(F.to_json(F.struct(*columns), DIGEST_FORMAT))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that differ, with ``change`` = insert, update or delete.

    One shuffle per side on the key and no sort; the old side sends only key
    and digest. Deleted rows carry the key, other columns null.
    """
    rest = [c for c in new.columns if c not in keys]
    before = old.select(*keys, content_hash(rest).alias("_before"))
    after = new.withColumn("_after", content_hash(rest))
    change = (
        F.when(F.col("_before").isNull(), "insert")
        .when(F.col("_after").isNull(), "delete")
        .when(F.col("_before") != F.col("_after"), "update")
    )
    return (
        after.join(before.hint("shuffle_hash"), keys, "full")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(*keys, *rest, "change")
    )


def apply_changes(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The snapshot after the change set: changed keys replaced, deletes gone."""
    kept = lookup_join(table, changes.select(*keys), keys, "left_anti", sketch=False)
    return kept.unionByName(changes.where("change <> 'delete'").drop("change").select(*table.columns))
