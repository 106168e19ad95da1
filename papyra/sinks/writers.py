"""CSV, JSON, Parquet, year-partitioned and table writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from papyra.session import scratch_dir


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that ``read_csv`` reads back; an empty text comes back as null."""
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode("overwrite")
        .csv(path)
    )


def write_jsonl(df: DataFrame, path: str, gzip: bool = False, by: list[str] | None = None) -> None:
    """JSON lines, one part file per task.

    With ``by`` every task puts its own folders in place: there may be one per
    row, too many for the driver to move one after another when the job ends.
    """
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.json(path, compression="gzip" if gzip else "none")


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def hand_off(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it from there.

    For a table that several later steps read: it is computed once, and a lost
    executor costs a re-read.
    """
    path = scratch_dir(df.sparkSession, label)
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def write_by(df: DataFrame, path: str, column: str, max_rows_per_file: int = 1_000_000) -> None:
    """Parquet folders per value of ``column``.

    The rebalance groups each value's rows into few files, and adaptive
    execution splits a value that holds much of the table over many tasks.
    """
    (
        df.hint("rebalance", column)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(column)
        .parquet(path)
    )


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Overwrite a table; its schema becomes that of ``df``."""
    writer = df.write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
