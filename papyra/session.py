"""Session and shared scratch space."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "papyra", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the pipeline relies on; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the Python workers of all executors this package, once.

    The archive is made on the driver, and Spark serves it to the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_papyra_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="papyra-")) / package.name
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    context._papyra_shipped = True


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the cluster's shared ``spark.checkpoint.dir``.

    Executors must all see it, so a local folder is made only where the
    setting is absent, as in a single-machine test.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_papyra_scratch", None)
    if not base:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        base = context._papyra_scratch = tempfile.mkdtemp(prefix="papyra-")
    return f"{base.rstrip('/')}/papyra/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, key: str, factor: int = 2) -> DataFrame:
    """Use all cores for a CPU-bound stage when the scan has too few splits.

    Unsplittable inputs (gzip, one row group, multi-line JSON) reach the job
    as a handful of partitions. A corpus with at least one split per core is
    returned as it is, so large inputs pay no shuffle. Call it on a scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * factor, key)
