"""CSV, JSON, Parquet and table readers, plus file-level audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.functions.text import file_stem
from papyra.sources.schemas import ARTICLE, CORRUPT, IDS, METADATA, RANKS, RECORD


def read_csv(
    spark: SparkSession, path: str, schema: str, tolerant: bool = False, multi_line: bool = True
) -> DataFrame:
    """CSV with a header, doubled quotes and line breaks inside quotes.

    ``multi_line=False`` lets Spark split large files whose cells hold no line
    breaks. ``tolerant`` adds a ``_corrupt_record`` column holding the lines that do
    not fit the schema; their cells that do fit are kept.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
    )
    if tolerant:
        schema = f"{schema}, {CORRUPT} string"
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_metadata(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """Article metadata, every column a string; ``columns`` narrows the scan.

    Without ``multi_line`` a large file is split, if no cell holds a line break.
    """
    df = read_csv(spark, path, METADATA, multi_line=multi_line)
    return df.select(*columns) if columns else df


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """Journal rank list."""
    return read_csv(spark, path, RANKS)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One-column id list."""
    return read_csv(spark, path, IDS)


def read_json(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """JSON below ``path`` at any depth, with rejects in ``_corrupt_record``.

    ``multi_line`` reads one object (or one array of objects) per file;
    otherwise one object per line. Gzip files are read as they are.
    """
    return (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .option("multiLine", multi_line)
        .json(path)
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Bibliographic JSON lines without the malformed ones, whatever is selected."""
    return whole_records(read_json(spark, path, RECORD))


def whole_records(df: DataFrame) -> DataFrame:
    """Rows that fit the reader's whole schema.

    A reader parses only the columns that a query needs, and then takes a line
    for well formed that is not; the digest makes it parse them all.
    """
    columns = df.drop(CORRUPT).columns
    parsed = F.pmod(F.xxhash64(*columns), F.lit(2)) < 2
    return df.where(F.col(CORRUPT).isNull() & parsed).drop(CORRUPT)


def rejected_records(spark: SparkSession, path: str) -> DataFrame:
    """``(_corrupt_record)``: the lines that ``read_records`` leaves out."""
    df = read_json(spark, path, RECORD)
    columns = df.drop(CORRUPT).columns
    return df.where(F.col(CORRUPT).isNotNull() & (F.pmod(F.xxhash64(*columns), F.lit(2)) < 2)).select(CORRUPT)


def read_articles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Nested article documents; malformed documents carry ``_corrupt_record``."""
    return read_json(spark, path, ARTICLE, multi_line)


def well_formed(df: DataFrame) -> DataFrame:
    """Rows that parsed, without the reject column."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def file_audit(df: DataFrame) -> DataFrame:
    """Good and corrupt record counts per input file of a tolerant read.

    All declared columns take part, because with fewer the parser would
    accept records whose other columns are broken.
    """
    ok = F.col(CORRUPT).isNull()
    declared = [c for c in df.columns if c != CORRUPT]
    return (
        df.withColumn("file", F.col("_metadata.file_path"))
        .groupBy("file")
        .agg(
            # The hash keeps every declared column in the scan.
            F.count(F.when(ok, F.hash(*declared))).alias("good"),
            F.count_if(~ok).alias("corrupt"),
        )
    )


def list_documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """``(file, sha, bytes)`` of the non-empty files below ``path``.

    Only the listing is used: the content column is never selected, so Spark
    opens no file.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(F.col("path").alias("file"), file_stem("path").alias("sha"), F.col("length").alias("bytes"))
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
