"""Vector index: k-means cells stored as partitions, searched cell-wise."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import numpy as np
import pyarrow as pa

from papyra.functions import vectors
from papyra.operators import knn as exact
from papyra.sinks.writers import write_by, write_parquet


def unit(c: Column) -> Column:
    """Doubles of a vector scaled to unit length; a zero vector stays."""
    scaled = lambda n: F.transform(
        c, lambda x: F.coalesce(F.try_divide(x.cast("double"), n), F.lit(0.0))
    )
    return vectors.let(vectors.norm(c), scaled)


def ivf_build(
    corpus: DataFrame,
    path: str,
    cells: int,
    column: str = "chunk_text_vector",
    metric: str = "cosine",
    train_share: float | None = None,
    seed: int = 7,
) -> None:
    """Write ``path/centroids`` and ``path/rows`` (partitioned by cell).

    Cells are trained on all rows, or on a sampled share if ``train_share`` is
    given. Every row with a vector is assigned to a cell and stored; rows
    without one are not. The corpus is read twice (training, assignment), so it
    should be a stored table.
    """
    corpus = corpus.where(F.col(column).isNotNull())
    place = unit(F.col(column)) if metric == "cosine" else F.col(column).cast("array<double>")
    train = corpus.select(array_to_vector(place).alias("features"))
    if train_share is not None:
        train = train.sample(train_share, seed=seed)
    train = train.persist()
    model = KMeans(k=cells, seed=seed, maxIter=10, featuresCol="features", predictionCol="cell").fit(train)
    train.unpersist()
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    spark = corpus.sparkSession
    write_parquet(spark.createDataFrame(centers, "cell int, center array<double>"), f"{path}/centroids")
    placed = model.transform(corpus.withColumn("features", array_to_vector(place))).drop("features")
    write_by(placed, f"{path}/rows", "cell")


def ivf_search(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int,
    nprobe: int,
    ids: list[str],
    column: str = "chunk_text_vector",
    query_id: str = "query_id",
    query_column: str = "query_vector",
    metric: str = "cosine",
    columns: list[str] | None = None,
    exclude_self: bool = False,
    max_broadcast_queries: int = exact.MAX_BROADCAST_QUERIES,
) -> DataFrame:
    """The ``k`` nearest rows among the ``nprobe`` cells nearest to each query.

    Exact when ``nprobe`` is the number of cells. Cells no query probes are
    pruned as partitions and not read.
    """
    rows = spark.read.parquet(f"{path}/rows").withColumnRenamed("cell", "_cell")
    centroids = spark.read.parquet(f"{path}/centroids")
    return search_cells(rows, centroids, queries, k, nprobe, ids, column, query_id, query_column, metric, columns, exclude_self, max_broadcast_queries)


def search_cells(
    rows: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    k: int,
    nprobe: int,
    ids: list[str],
    column: str,
    query_id: str,
    query_column: str,
    metric: str,
    columns: list[str] | None,
    exclude_self: bool,
    max_broadcast_queries: int,
) -> DataFrame:
    """Hits among ``rows (_cell, ...)`` in the ``nprobe`` nearest ``centroids (cell, center)``.

    Queries are routed by position, so repeated and null ids are answered row by row.
    """
    spark = rows.sparkSession
    rows, tie = exact.tied(rows, list(columns or []))
    search = exact.Search(k, metric, ids + tie, column, list(columns or []), exclude_self)
    schema = exact.result_schema(rows, queries, query_id, search.ids, search.carried)
    point = unit(F.col(query_column)) if metric == "cosine" else F.col(query_column).cast("array<double>")
    asked = queries.where(F.col(query_column).isNotNull()).select(
        F.col(query_id), F.col(query_column).alias("_query_vector"), point.alias("_point")
    )
    small = exact.few_queries(asked, query_id, max_broadcast_queries)
    if small is None:
        asked = exact.numbered(asked)
        points = asked.select(F.col("_q").alias("_asked"), "_point")
    else:
        places = small.select(["_point"]).append_column("_asked", pa.array(np.arange(small.num_rows), pa.int64()))
        points = spark.createDataFrame(places, "_point array<double>, _asked long") if small.num_rows else asked.select("_point", F.lit(0).cast("long").alias("_asked"))
    probes = exact.knn(
        centroids,
        points,
        nprobe,
        ids=["cell"],
        column="center",
        query_id="_asked",
        query_column="_point",
        metric="l2",
        max_broadcast_queries=max_broadcast_queries,
    ).select(F.col("_asked").alias("_q"), F.col("cell").alias("_cell"))
    if small is None:
        hits = exact.grid_search(rows, asked.join(probes, "_q"), search, query_id, schema)
    else:
        search = search.asking(*exact.query_block(small, query_id))
        # One row per (query, probed cell) of a bounded number of queries.
        table = probes.toArrow().to_pandas()
        search.by_cell = {int(cell): np.sort(q.to_numpy()) for cell, q in table.groupby("_cell")["_q"]}
        hits = exact.scan_search(rows.where(F.col("_cell").isin(sorted(search.by_cell))), search, schema)
    return exact.finished(exact.ranked(hits, search.ids, k), query_id, ids, search.carried)
