"""A vector index that follows the changes of its table.

``path/rows/v=N`` holds whole cells, ``path/delta/batch=B`` the rows that a
change set brought, by cell, and ``path/gone/batch=B`` the keys it touched.
``path/manifest/version=N`` says for every cell which folder is valid and up
to which batch. A refresh writes what changed; a compaction rewrites only the
cells that changes reached, and a reader sees the old or the new manifest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.operators import knn as exact
from papyra.operators.ivf import search_cells, unit
from papyra.operators.joins import lookup_join
from papyra.session import ship
from papyra.sinks.writers import hand_off, write_by, write_parquet

MANIFEST = "cell int, center array<double>, v int, upto long, rows long, spread double, built double"
SPLIT = 3.0
MERGE = 0.1
#: Centres are broadcast to assign rows; more cells than this need another index.
MAX_CELLS = 65_536


def prepared(column: str, metric: str):
    return unit(F.col(column)) if metric == "cosine" else F.col(column).cast("array<double>")


def assigned(rows: DataFrame, centers: dict[int, list[float]], column: str, metric: str) -> DataFrame:
    """``rows`` with the nearest ``cell`` and ``_gap``, the squared distance to its centre."""
    if len(centers) > MAX_CELLS:
        raise ValueError(f"{len(centers)} cells; at most {MAX_CELLS} can be shipped to every task")
    ship(rows.sparkSession)
    cells = np.array(sorted(centers), np.int32)
    shared = rows.sparkSession.sparkContext.broadcast((cells, np.array([centers[c] for c in cells.tolist()], float)))
    kept = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("_gap", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, places = shared.value
        for batch in batches:
            points = exact.matrix(batch.column(len(kept)))
            best, gap = np.zeros(len(points), np.int64), np.zeros(len(points))
            for low in range(0, len(points), 1024):
                part = points[low : low + 1024]
                gaps = (part**2).sum(1)[:, None] - 2 * part @ places.T + (places**2).sum(1)[None, :]
                best[low : low + 1024] = gaps.argmin(1)
                gap[low : low + 1024] = np.maximum(gaps.min(1), 0)
            made = [pa.array(names[best]), pa.array(gap)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + made, names=[*kept, "cell", "_gap"])

    return rows.withColumn("_point", prepared(column, metric)).mapInArrow(run, schema)


def trained(rows: DataFrame, cells: int, column: str, metric: str, seed: int) -> list[list[float]]:
    points = rows.select(array_to_vector(prepared(column, metric)).alias("features")).persist()
    centers = KMeans(k=cells, seed=seed, maxIter=10).fit(points).clusterCenters()
    points.unpersist()
    return [[float(x) for x in c] for c in centers]


def measures(rows: DataFrame) -> dict[int, tuple[int, float]]:
    """Rows and mean squared distance per cell; one row per cell."""
    found = rows.groupBy("cell").agg(F.count("*").alias("n"), F.avg("_gap").alias("g")).collect()
    return {r.cell: (r.n, r.g) for r in found}


def commit(spark: SparkSession, path: str, version: int, cells: dict[int, tuple]) -> None:
    rows = [(cell, *of) for cell, of in sorted(cells.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/version={version}")


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[int, T.Row]]:
    """The newest version of the manifest; one row per cell."""
    versions = spark.read.schema(f"{MANIFEST}, version int").parquet(f"{path}/manifest")
    newest = versions.agg(F.max("version")).first()[0]
    return newest, {r.cell: r for r in versions.where(F.col("version") == newest).drop("version").collect()}


def build(corpus: DataFrame, path: str, cells: int, column: str, metric: str = "cosine", seed: int = 7) -> None:
    """Train ``cells`` cells, write all rows that have a vector, commit version 0."""
    corpus = corpus.where(F.col(column).isNotNull())
    centers = dict(enumerate(trained(corpus, cells, column, metric, seed)))
    write_by(assigned(corpus, centers, column, metric), f"{path}/rows/v=0", "cell")
    spark = corpus.sparkSession
    found = measures(spark.read.parquet(f"{path}/rows/v=0").select("cell", "_gap"))
    commit(spark, path, 0, {c: (centers[c], 0, -1, n, g, g) for c, (n, g) in found.items()})
    write_parquet(spark.createDataFrame([], corpus.schema), f"{path}/empty")


def refresh(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], column: str, metric: str = "cosine", batch: int = 0) -> None:
    """Take in a change set: ``change`` is insert, update or delete, one row per key.

    Batches are numbered upwards from 0; one that runs again overwrites itself.
    Keys must not be null. The rest of the index is neither read nor written.
    """
    _, cells = manifest(spark, path)
    columns = spark.read.parquet(f"{path}/empty").columns
    write_parquet(changes.select(*keys), f"{path}/gone/batch={batch}")
    arrived = changes.where((F.col("change") != "delete") & F.col(column).isNotNull()).select(*columns)
    write_by(assigned(arrived, {c: list(r.center) for c, r in cells.items()}, column, metric), f"{path}/delta/batch={batch}", "cell")


def batches(spark: SparkSession, path: str, folder: str, schema: T.StructType) -> DataFrame | None:
    """All batches below a folder with their number, or None where there is none yet."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
    if not base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(base):
        return None
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{path}/{folder}")


def current(spark: SparkSession, path: str, keys: list[str], only: list[int] | None = None) -> DataFrame:
    """The rows of the index as they stand, with ``cell``; of some cells if ``only`` is given."""
    _, cells = manifest(spark, path)
    wanted = {c: r for c, r in cells.items() if only is None or c in only}
    empty = spark.read.parquet(f"{path}/empty").schema
    schema = T.StructType([*empty.fields, T.StructField("_gap", T.DoubleType()), T.StructField("cell", T.IntegerType())])
    upto = F.broadcast(spark.createDataFrame([(c, int(r.upto)) for c, r in wanted.items()], "cell int, _upto long"))
    rows = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_at", T.LongType())]))
    versions: dict[int, list[int]] = {}
    for cell, r in wanted.items():
        if r.rows:
            versions.setdefault(r.v, []).append(cell)
    for v, held in sorted(versions.items()):
        # The cell folders are partitions: those not asked for are not read.
        whole = spark.read.schema(schema).parquet(f"{path}/rows/v={v}").where(F.col("cell").isin(held))
        rows = rows.unionByName(whole.join(upto, "cell").withColumnRenamed("_upto", "_at"))
    delta = batches(spark, path, "delta", schema)
    if delta is not None:
        later = delta.where(F.col("cell").isin(sorted(wanted))).join(upto, "cell").where(F.col("batch") > F.col("_upto"))
        rows = rows.unionByName(later.drop("_upto").withColumnRenamed("batch", "_at"))
    gone = batches(spark, path, "gone", T.StructType([f for f in empty.fields if f.name in keys]))
    if gone is None:
        return rows.drop("_at")
    last = gone.groupBy(*keys).agg(F.max("batch").alias("_gone"))
    return lookup_join(rows, last, keys, "left", sketch=False).where(F.col("_gone").isNull() | (F.col("_gone") <= F.col("_at"))).drop("_gone", "_at")


def drift(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Per cell its rows and spread now, and how far the spread has grown since it was built."""
    _, cells = manifest(spark, path)
    now = current(spark, path, keys).groupBy("cell").agg(F.count("*").alias("rows"), F.avg("_gap").alias("spread"))
    built = F.broadcast(spark.createDataFrame([(c, r.built) for c, r in cells.items()], "cell int, built double"))
    return built.join(now, "cell", "left").select("cell", F.coalesce("rows", F.lit(0)).alias("rows"), "spread", "built",
                                                  F.try_divide("spread", "built").alias("drift"))


def touched_cells(spark: SparkSession, path: str, keys: list[str]) -> tuple[set[int], int]:
    """Cells that a batch not yet taken in reaches, and the last batch; no vector is read."""
    version, cells = manifest(spark, path)
    empty = spark.read.parquet(f"{path}/empty").schema
    key_schema = T.StructType([f for f in empty.fields if f.name in keys])
    gone = batches(spark, path, "gone", key_schema)
    if gone is None:
        return set(), -1
    newest = gone.agg(F.max("batch")).first()[0]
    upto = F.broadcast(spark.createDataFrame([(c, int(r.upto)) for c, r in cells.items()], "cell int, _upto long"))
    found = batches(spark, path, "delta", T.StructType([T.StructField("cell", T.IntegerType())]))
    reached = {r.cell for r in found.join(upto, "cell").where(F.col("batch") > F.col("_upto")).select("cell").distinct().collect()} if found is not None else set()
    at = T.StructType([*key_schema.fields, T.StructField("cell", T.IntegerType())])
    for v in {r.v for r in cells.values() if r.rows}:
        held = spark.read.schema(at).parquet(f"{path}/rows/v={v}").where(F.col("cell").isin([c for c, r in cells.items() if r.v == v]))
        lost = held.join(gone, keys).join(upto, "cell").where(F.col("batch") > F.col("_upto"))
        reached |= {r.cell for r in lost.select("cell").distinct().collect()}
    return reached, -1 if newest is None else newest


def compact(spark: SparkSession, path: str, keys: list[str], column: str, metric: str = "cosine", split: float = SPLIT, merge: float = MERGE, seed: int = 7) -> list[int]:
    """Rewrite the cells that changes reached; returns the cells written.

    A cell with more than ``split`` times the mean rows is split into two, and
    one with less than ``merge`` times the mean is given up, its rows going to
    the nearest other cells. All other cells keep their files.
    """
    version, cells = manifest(spark, path)
    reached, newest = touched_cells(spark, path, keys)
    if not reached:
        return []
    new = version + 1
    fresh = hand_off(current(spark, path, keys, sorted(reached)), "cells")
    sizes = {c: r.rows for c, r in cells.items() if c not in reached} | dict.fromkeys(reached, 0) | {c: n for c, (n, _) in measures(fresh).items()}
    mean = max(1.0, sum(sizes.values()) / len(sizes))
    centers = {c: list(r.center) for c, r in cells.items()}
    high = max(cells)
    small = sorted(c for c in reached if sizes[c] < merge * mean)[: max(0, len(centers) - 1)]
    targets = set(reached) - set(small)
    parts = [fresh.where(F.col("cell").isin(sorted(targets))).drop("_gap", "cell")]
    if small:
        centers = {c: p for c, p in centers.items() if c not in small}
        moved = hand_off(assigned(fresh.where(F.col("cell").isin(small)).drop("_gap", "cell"), centers, column, metric), "moved")
        outside = sorted({r.cell for r in moved.select("cell").distinct().collect()} - targets)
        parts.append(moved.drop("_gap", "cell"))
        if outside:
            # A cell that takes rows in is rewritten too.
            parts.append(current(spark, path, keys, outside).drop("_gap", "cell"))
            targets |= set(outside)
    pool = {c: centers[c] for c in targets}
    for cell in sorted(targets & reached):
        if sizes[cell] > split * mean:
            halves = trained(fresh.where(F.col("cell") == cell), 2, column, metric, seed)
            if len(halves) == 2:
                pool.pop(cell)
                pool[high + 1], pool[high + 2] = halves
                high += 2
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    write_by(assigned(rows, pool, column, metric), f"{path}/rows/v={new}", "cell")
    written = measures(spark.read.schema("_gap double, cell int").parquet(f"{path}/rows/v={new}"))
    dropped = set(small) | (targets - set(pool))
    made = {c: tuple(r)[1:] for c, r in cells.items() if c not in dropped and c not in pool}
    for c, center in pool.items():
        n, g = written.get(c, (0, 0.0))
        built = cells[c].built if c in cells else g
        made[c] = (center, new, newest, n, g, built)
    commit(spark, path, new, made)
    return sorted(pool)


def search(spark: SparkSession, path: str, queries: DataFrame, k: int, nprobe: int, keys: list[str], column: str, query_id: str = "query_id",
           query_column: str = "query_vector", metric: str = "cosine", columns: list[str] | None = None, exclude_self: bool = False,
           max_broadcast_queries: int = exact.MAX_BROADCAST_QUERIES) -> DataFrame:
    """The ``k`` nearest current rows among the ``nprobe`` nearest cells; all cells: exact."""
    _, cells = manifest(spark, path)
    centroids = spark.createDataFrame([(c, list(r.center)) for c, r in cells.items()], "cell int, center array<double>")
    rows = current(spark, path, keys).drop("_gap").withColumnRenamed("cell", "_cell")
    return search_cells(rows, centroids, queries, k, nprobe, keys, column, query_id, query_column, metric, columns, exclude_self, max_broadcast_queries)
