"""Resumable matching of bibliographic files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.plans.enrich import match_records
from papyra.sinks.writers import hand_off
from papyra.sources.files import whole_records
from papyra.sources.schemas import CORRUPT, RECORD


def match_records_incremental(
    spark: SparkSession,
    in_dir: str,
    dois: DataFrame,
    out_dir: str,
    checkpoint: str,
    schema: str = RECORD,
    max_files: int = 1_000,
) -> None:
    """Match the files not seen by an earlier run and stop.

    The checkpoint replaces a progress list: a batch that failed is run
    again, and because a batch overwrites its own folder a re-run adds no
    row twice.
    """

    dois = hand_off(dois, "dois")  # once, not in every batch

    def write(batch: DataFrame, batch_id: int) -> None:
        match_records(batch, dois).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    stream = (
        spark.readStream.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .json(in_dir)
        .transform(whole_records)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def matched_records(spark: SparkSession, out_dir: str) -> DataFrame:
    """All matches so far, with the ``file`` each came from."""
    return spark.read.parquet(out_dir).drop("batch")


def matches_per_file(matched: DataFrame) -> DataFrame:
    return matched.groupBy("file").agg(F.count("*").alias("matches"))
