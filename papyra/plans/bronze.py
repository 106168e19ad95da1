"""Raw metadata to bronze: recent articles, single ids, one folder per year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.functions.text import parsed_year
from papyra.operators.documents import explode_ids
from papyra.operators.joins import lookup_join
from papyra.sinks.writers import write_by

MIN_YEAR = 2020


def bronze_metadata(meta: DataFrame, min_year: int = MIN_YEAR) -> DataFrame:
    """``(sha, publish_time, year)`` from ``min_year`` on, distinct."""
    recent = meta.select("sha", "publish_time", parsed_year("publish_time").alias("year"))
    return explode_ids(recent.where(F.col("year") >= min_year)).distinct()


def ids_by_year(meta: DataFrame, docs: DataFrame) -> DataFrame:
    """``(year, sha)`` of the articles that have a document, as rows.

    A year may hold much of the corpus, so its ids stay rows and are never
    gathered into one set value.
    """
    return lookup_join(meta.select("year", "sha"), docs.select("sha").distinct(), "sha", "left_semi").distinct()


def year_sizes(by_year: DataFrame) -> DataFrame:
    """Distinct ids per year; two-step aggregation, safe for a hot year."""
    return by_year.groupBy("year").agg(F.countDistinct("sha").alias("n"))


def write_by_year(docs: DataFrame, by_year: DataFrame, path: str) -> None:
    """Documents of the listed ids, in one folder per publication year."""
    write_by(lookup_join(docs, by_year, "sha", "inner", sketch=False), path, "year")
