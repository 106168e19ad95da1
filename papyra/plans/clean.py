"""Filtered, typed and renamed metadata, and its citation columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.functions.text import prefix_year
from papyra.operators.dedupe import best_per_key
from papyra.operators.documents import explode_ids
from papyra.plans.bronze import MIN_YEAR
from papyra.sources.schemas import METADATA_COLUMNS, RANK_COLUMNS

# Column names of the cleaned table, in order.
CONTRACT = METADATA_COLUMNS + ["issn", "issn_key", "full_journal_title", "rank", "journal_impact_factor", "paper_br"]

RENAMES = {"DOI": "doi", **{c: c.lower().replace(" ", "_") for c in RANK_COLUMNS}}

# Citation column -> cleaned column.
CITATION = {
    "cord_uid": "sha",
    "title": "title",
    "authors": "authors",
    "doi": "doi",
    "url": "url",
    "dt_publicacao": "publish_time",
    "journal_name": "full_journal_title",
    "ranking": "rank",
    "paper_br": "paper_br",
}


def valid_rows(min_year: int, require_rank: bool) -> Column:
    """Known id, 0/1 flag, recent enough, and (optionally) a numeric rank."""
    ok = (
        F.col("sha").isNotNull()
        & F.col("paper_br").isin(0, 1)
        & (prefix_year("publish_time") >= min_year)
    )
    return ok & F.col("Rank").isNotNull() if require_rank else ok


def to_contract(df: DataFrame, renames: dict[str, str], columns: list[str]) -> DataFrame:
    """Rename the columns that exist and project to the contract's order."""
    return df.withColumnsRenamed(renames).select(*columns)


def clean_metadata(df: DataFrame, min_year: int = MIN_YEAR, require_rank: bool = True) -> DataFrame:
    """The 25-column cleaned table, rank as double.

    ``require_rank=False`` keeps flagged articles without a rank, so that each
    selected article can have citation columns.
    """
    typed = (
        df.withColumn("paper_br", F.col("paper_br").try_cast("int"))
        .withColumn("Rank", F.col("Rank").try_cast("double"))
        .where(valid_rows(min_year, require_rank))
    )
    return to_contract(typed, RENAMES, CONTRACT)


def citation_table(clean: DataFrame) -> DataFrame:
    """Citation columns, one row per single id (best rank, then title)."""
    named = explode_ids(clean).select(*[F.col(c).alias(name) for name, c in CITATION.items()])
    order = [F.asc_nulls_last("ranking"), F.desc("paper_br")]
    order += [F.asc_nulls_last(c) for c in ("title", "doi", "dt_publicacao", "authors", "journal_name", "url")]
    return best_per_key(named, ["cord_uid"], order)
