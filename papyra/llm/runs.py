"""Line dedup against levelled sorted runs of line digests."""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.llm.common import arrow_map, free_name, stored, utf8, with_columns
from papyra.session import scratch_dir

MIN_POINTS = 20
MIN_DOCS = 3
RUN = "h1 long, h2 long, docs long, keeper long"


def line_digest(line: bytes, min_points: int) -> bytes | None:
    """128-bit digest of a line's key; none where the key is too short."""
    key = line.strip().lower()
    if len(key) < min_points or len(key) < 4 * min_points and len(key.decode("utf-8", "replace")) < min_points:
        return None
    return xxhash.xxh3_128_digest(key)


def halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def document_lines(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """``(doc_id, text_hash, h1, h2)``: each distinct key of each document."""

    def run(batches):
        for batch in batches:
            rows, h1, h2 = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for digest in {line_digest(line, min_points) for line in text.split(b"\n")} - {None}:
                    a, b = halves(digest)
                    rows.append(i)
                    h1.append(a)
                    h2.append(b)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("text_hash").take(take), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())],
                names=["doc_id", "text_hash", "h1", "h2"],
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), utf8(F.col("text")).alias("text"))
    return arrow_map(columns, run, "doc_id long, text_hash long, h1 long, h2 long")


class LineRuns:
    """Runs of ``(h1, h2, docs, keeper)``, hashed into buckets and sorted by digest.

    A batch is merge-anti-joined with the runs there are. What no run holds
    becomes a new run, so a digest lies in one run only; what some run holds
    goes to a second row of levels, as counts to be added. When a level holds
    ``fanout`` tables they are merged into one of the next level, so a digest
    is rewritten once per level and the number of tables grows with the
    logarithm of the batches. All share bucket and sort columns: joins with a
    run do not shuffle it.

    ``docs`` counts documents holding the line, ``keeper`` is the largest
    ``doc_id`` among them. A document's lines must come in one batch.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark = spark
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.new: list[list[str]] = [[]]
        self.more: list[list[str]] = [[]]

    def _write(self, run: DataFrame) -> str:
        name = f"papyra_run_{uuid.uuid4().hex}"
        (
            run.repartition(self.buckets, "h1", "h2")
            .write.format("parquet")
            .option("path", scratch_dir(self.spark, "run"))
            .bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .saveAsTable(name)
        )
        return name

    def _merged(self, levels: list[list[str]]) -> DataFrame:
        """Tables added up, one row per digest.

        A union of tables with equal buckets counts as dealt out by digest
        already and would not be shuffled, though parts of one count may lie
        apart. Turning the bits of a bucket column over hides the buckets.
        """
        tables = [self.spark.table(name) for level in levels for name in level]
        if not tables:
            return self.spark.createDataFrame([], RUN)
        hidden = [t.select(F.bitwise_not("h1").alias("n1"), "h2", "docs", "keeper") for t in tables]
        rows = reduce(DataFrame.union, hidden).groupBy("n1", "h2").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))
        return rows.select(F.bitwise_not("n1").alias("h1"), "h2", "docs", "keeper")

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose digest no run holds: a merge anti-join per run."""
        for name in [n for level in self.new for n in level]:
            batch = batch.join(self.spark.table(name).select("h1", "h2"), ["h1", "h2"], "left_anti")
        return batch

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of ``(doc_id, h1, h2)``; returns its digests not seen before."""
        batch = stored(lines.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper")), "batch")
        if not any(self.new):
            self.new[0].append(self._write(batch))
            return batch
        fresh = stored(self.unseen(batch), "fresh")
        known = batch.join(fresh.select("h1", "h2"), ["h1", "h2"], "left_anti")
        self.more[0].append(self._write(known))
        self.new[0].append(self._write(fresh))
        self._compact(self.new)
        self._compact(self.more)
        return fresh

    def _compact(self, levels: list[list[str]]) -> None:
        depth = 0
        while depth < len(levels):
            if len(levels[depth]) >= self.fanout:
                if depth + 1 == len(levels):
                    levels.append([])
                names, levels[depth] = levels[depth], []
                levels[depth + 1].append(self._write(self._merged([names])))
                self._drop(names)
            depth += 1

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def repeated(self, min_docs: int) -> DataFrame:
        """``(h1, h2, keeper)`` of digests in at least ``min_docs`` documents."""
        more = self._write(self._merged(self.more))
        self.more = [[], [more]]
        added = self.spark.table(more).select("h1", "h2", F.col("docs").alias("_docs"), F.col("keeper").alias("_keeper"))
        found = []
        for name in [n for level in self.new for n in level]:
            both = self.spark.table(name).join(added, ["h1", "h2"], "left")
            often = both.filter(F.col("docs") + F.coalesce("_docs", F.lit(0)) >= min_docs)
            found.append(often.select("h1", "h2", F.greatest("keeper", "_keeper").alias("keeper")))
        return reduce(DataFrame.union, found) if found else self.spark.createDataFrame([], "h1 long, h2 long, keeper long")

    def close(self) -> None:
        """Remove the tables' names; files stay with the shared folder."""
        self._drop([n for level in self.new + self.more for n in level])
        self.new, self.more = [[]], [[]]


def collect_runs(lines: DataFrame, batches: int = 4, fanout: int = 3) -> LineRuns:
    """Runs of all lines, added in ``batches`` batches of documents."""
    runs = LineRuns(lines.sparkSession, fanout)
    number = F.pmod(F.xxhash64("doc_id"), batches)
    for k in range(batches):
        runs.add(lines.filter(number == k))
    return runs


def once_per_id(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """``(doc_id, h1, h2)`` without repeats; only ids of several rows are looked at."""
    lines = lines.select("doc_id", "h1", "h2")
    ids = stored(docs.groupBy(F.col("doc_id").cast("long").alias("_id")).count().filter("count > 1").select("_id"), "repeated_ids")
    if ids.isEmpty():
        return lines
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    return stored(lines.join(ids, same, "left_anti").union(lines.join(ids, same, "left_semi").distinct()), "lines_once")


def drop_lines(docs: DataFrame, min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS, batches: int = 4, fanout: int = 3) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII white space, with A-Z in lower
    case. Keys of at least ``min_points`` code points held by at least
    ``min_docs`` different ids lose all their lines but those of the largest
    ``doc_id`` that holds them. Null text is one empty line and comes back
    empty. Rows of one id count as one document, and all of them keep the line
    if the id is the largest. A null ``doc_id`` is an id, smaller than any other.
    Columns called ``n_lines`` and ``n_dropped`` are replaced.
    """
    lines = stored(document_lines(docs, min_points), "lines")
    runs = collect_runs(once_per_id(lines, docs), batches, fanout)
    repeated = stored(runs.repeated(min_docs), "repeated")
    runs.close()
    lost = lines.join(repeated, ["h1", "h2"]).filter(F.col("keeper").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("keeper"))))
    lost = lost.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))

    row, digest, gone, bytes_, lost_row, lost_digest = (
        free_name([*docs.columns, "n_lines", "n_dropped"], n) for n in ("_row", "_digest", "_gone", "_bytes", "_lost_row", "_lost_digest")
    )
    lost = lost.toDF(lost_row, lost_digest, gone)
    rows = docs.withColumns({row: F.col("doc_id").cast("long"), digest: F.xxhash64("text")})
    same = F.col(row).eqNullSafe(F.col(lost_row)) & (F.col(digest) == F.col(lost_digest))
    joined = rows.join(lost, same, "left").withColumn(bytes_, utf8(F.col("text")))
    kept = [c for c in docs.columns if c.lower() not in ("text", "n_lines", "n_dropped")]
    joined = joined.select(*kept, gone, bytes_)

    def run(columns):
        for text, drops in columns:
            texts, totals, dropped = [], [], []
            for t, d in zip(text.to_pylist(), drops.to_pylist()):
                parts = t.split(b"\n")
                totals.append(len(parts))
                if d:
                    d = {(x["h1"], x["h2"]) for x in d}
                    stay = []
                    for part in parts:
                        key = line_digest(part, min_points)
                        if key is None or halves(key) not in d:
                            stay.append(part)
                    dropped.append(len(parts) - len(stay))
                    t = b"\n".join(stay)
                else:
                    dropped.append(0)
                texts.append(t)
            yield [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())]

    added = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return with_columns(joined, [bytes_, gone], added, run)


def keep_fresh(docs: DataFrame, min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without repeated lines; all columns but ``text`` and all names unchanged.

    Null text becomes empty text, as in ``drop_lines``.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    of = lambda name: names[docs.columns.index(name)]
    named = docs.toDF(*names).withColumnsRenamed({of("text"): "text", of("doc_id"): "doc_id"})
    back = [F.col({of("text"): "text", of("doc_id"): "doc_id"}.get(n, n)).alias(n) for n in names]
    return drop_lines(named, min_points, min_docs).select(*back).toDF(*docs.columns)
