"""Documents to chunks, vectors and the citable search table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from papyra.operators.chunk import chunk_fixed, chunk_recursive
from papyra.operators.documents import flatten_articles
from papyra.operators.embed import embed_terms
from papyra.operators.joins import lookup_join


def article_chunks(articles: DataFrame, recursive: bool = True, **options) -> DataFrame:
    """``(cord_uid, chunk_no, chunk_text)`` of nested article documents."""
    cut = chunk_recursive if recursive else chunk_fixed
    chunks = cut(flatten_articles(articles), ["cord_uid"], **options)
    return chunks.select("cord_uid", "chunk_no", "chunk_text")


def with_citations(chunks: DataFrame, citations: DataFrame) -> DataFrame:
    """Stored chunks with citation columns; ``citations`` has one row per id.

    An article may own much of the chunk table, hence the guarded join.
    """
    return lookup_join(chunks, citations, "cord_uid", "inner", spread_by=["chunk_no"])


def without_citations(chunks: DataFrame, citations: DataFrame) -> DataFrame:
    """Chunks the inner join loses, for the report."""
    return lookup_join(chunks, citations.select("cord_uid"), "cord_uid", "left_anti", spread_by=["chunk_no"])


def cited_vectors(texts: DataFrame, citations: DataFrame, recursive: bool = True, **options) -> DataFrame:
    """Chunk, vector and citation columns of ``(cord_uid, text)``.

    Citations are joined to whole articles, one row per id on both sides: far
    fewer rows are shuffled than after chunking, no id can be hot, and an
    article without citation is never chunked.
    """
    cited = lookup_join(texts, citations, "cord_uid", "inner", sketch=False)
    cut = chunk_recursive if recursive else chunk_fixed
    chunks = cut(cited, [c for c in cited.columns if c != "text"], **options)
    return embed_terms(chunks.drop("start_at", "end_at"))


def gold_table(articles: DataFrame, citations: DataFrame, recursive: bool = True, **options) -> DataFrame:
    """The search table of nested articles, key ``(cord_uid, chunk_no)``."""
    return cited_vectors(flatten_articles(articles), citations, recursive, **options)
