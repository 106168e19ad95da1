"""On-demand refresh of a stored table from change sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.operators.changes import apply_changes
from papyra.operators.dedupe import best_per_key
from papyra.sinks.writers import write_parquet


def refresh(
    spark: SparkSession, changes_dir: str, schema: str, keys: list[str], index_dir: str, checkpoint: str
) -> None:
    """Take in the change files not seen before and stop.

    ``index_dir/base`` is the stored snapshot and stays as it is; a batch adds
    only its own changes below ``index_dir/changes``, so a refresh costs as
    much as what changed. A batch that is run again overwrites its folder.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        # Of several changes to a key in one batch the newest file's one holds.
        latest = best_per_key(batch, keys, [F.desc("_at"), F.asc("change")]).drop("_at")
        write_parquet(latest, f"{index_dir}/changes/batch={batch_id}")

    stream = (
        spark.readStream.schema(schema)
        .parquet(changes_dir)
        .withColumn("_at", F.col("_metadata.file_modification_time"))
    )
    query = (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current(spark: SparkSession, index_dir: str, keys: list[str]) -> DataFrame:
    """The stored snapshot with the newest change of each key applied."""
    base = spark.read.parquet(f"{index_dir}/base")
    changes = spark.read.parquet(f"{index_dir}/changes")
    return apply_changes(base, best_per_key(changes, keys, [F.desc("batch")]).drop("batch"), keys)


def compact(spark: SparkSession, index_dir: str, keys: list[str], new_dir: str) -> None:
    """Write the current snapshot as the base of a new index folder."""
    write_parquet(current(spark, index_dir, keys), f"{new_dir}/base")
