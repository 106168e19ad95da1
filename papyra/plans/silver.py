"""Selection of the articles whose documents go on to chunking."""

from __future__ import annotations

from pyspark.sql import DataFrame

from papyra.functions.text import non_empty, prefix_year
from papyra.operators.documents import explode_ids, select_articles
from papyra.plans.bronze import MIN_YEAR


def selection(
    enriched: DataFrame, n: int = 10_000, min_year: int = MIN_YEAR, require_abstract: bool = False
) -> DataFrame:
    """Recent articles by single id: flagged ones plus the ``n`` best ranked."""
    recent = explode_ids(enriched).where(prefix_year("publish_time") >= min_year)
    if require_abstract:
        recent = recent.where(non_empty("abstract"))
    return select_articles(recent, n, key="sha", rank="Rank", flag="paper_br")
