"""Audits and acceptance checks: one aggregation each, or measured by the write itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from papyra.sinks.writers import hand_off

Bounds = dict[str, tuple[float | None, float | None]]


def enrichment_measures(rank: str = "Rank", flag: str = "paper_br") -> list[Column]:
    """Rows, rows with a rank and their percentage, flagged rows."""
    total = F.count(F.lit(1))
    matched = F.count(rank)
    return [
        total.alias("total"),
        matched.alias("matched"),
        F.round(F.try_divide(matched * 100.0, total), 2).alias("matched_pct"),
        F.count_if(F.col(flag) == 1).alias("flagged"),
    ]


def enrichment_audit(df: DataFrame, rank: str = "Rank", flag: str = "paper_br") -> DataFrame:
    return df.agg(*enrichment_measures(rank, flag))


def chunk_measures(size: int, key: str = "cord_uid", text: str = "chunk_text") -> list[Column]:
    """Rows, null ids, null chunks, chunks over the size limit, longest chunk."""
    return [
        F.count(F.lit(1)).alias("chunks"),
        F.count_if(F.col(key).isNull()).alias("null_ids"),
        F.count_if(F.col(text).isNull()).alias("null_chunks"),
        F.count_if(F.length(text) > size).alias("too_long"),
        F.max(F.length(text)).alias("longest"),
    ]


def chunk_quality(chunks: DataFrame, size: int, key: str = "cord_uid", text: str = "chunk_text") -> DataFrame:
    return chunks.agg(*chunk_measures(size, key, text))


class OutOfBounds(ValueError):
    """A written table's figures that leave their bounds, in ``figures``."""

    def __init__(self, label: str, broken: list[str], figures: dict):
        super().__init__(f"{label}: {'; '.join(broken)}")
        self.figures = figures


def audited_hand_off(df: DataFrame, label: str, measures: list[Column], bounds: Bounds | None = None) -> tuple[DataFrame, dict]:
    """``hand_off`` that measures the rows as they are written: no second scan.

    ``measures`` are named aggregates without DISTINCT. ``bounds`` gives the
    lowest and highest allowed value by name, None for no limit on that side. A
    figure outside, or null where there is a bound, raises ``OutOfBounds``, and
    the table is not handed on. The figures belong to the last stage of the
    write, whose tasks count once each however often they are tried.
    """
    observed = Observation(label)
    table = hand_off(df.observe(observed, *measures), label)
    figures = observed.get
    broken = []
    for name, (low, high) in (bounds or {}).items():
        value = figures[name]
        if value is None or low is not None and value < low or high is not None and value > high:
            broken.append(f"{name} is {value}, allowed {low} to {high}")
    if broken:
        raise OutOfBounds(label, broken, figures)
    return table, figures


def counts_with_total(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column`` and in total (null value)."""
    return df.rollup(column).agg(F.count("*").alias("n"))
