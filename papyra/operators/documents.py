"""Document-level operators: ids, selection, flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.functions.text import any_affiliation, joined_texts, non_empty, split_ids, strip
from papyra.operators.dedupe import best_per_key, top_n
from papyra.operators.joins import lookup_join


def explode_ids(df: DataFrame, column: str = "sha", keep_rows: bool = False) -> DataFrame:
    """One row per id of a multi-id cell.

    Rows without an id are dropped, or kept with a null id on ``keep_rows``.
    """
    ids = F.filter(split_ids(column), lambda i: i != "")
    return df.withColumn(column, F.explode_outer(ids) if keep_rows else F.explode(ids))


def select_articles(
    meta: DataFrame, n: int = 10_000, key: str = "sha", rank: str = "rank", flag: str = "paper_br"
) -> DataFrame:
    """Flagged articles plus the ``n`` best-ranked of the others, one row per id.

    Rows of one id and flag are made one first, so a repeated id takes one of the
    ``n`` places: the best-ranked stays, and all other columns settle ties. Of an
    id that is chosen both ways the flagged row stays.
    """
    typed = meta.withColumn(rank, F.col(rank).try_cast("double")).withColumn(flag, F.col(flag).try_cast("int"))
    is_flagged = F.col(flag) == 1
    eligible = typed.where(is_flagged | ((F.col(flag) == 0) & F.col(rank).isNotNull()))
    ties = [F.asc(c) for c in meta.columns if c not in (key, rank, flag)]
    single = best_per_key(eligible, [key, flag], [F.asc_nulls_last(rank), *ties])
    # Only id and rank take part in the sort, and at most n of them come out.
    best = top_n(single.where(F.col(flag) == 0).select(F.col(key).alias("_id"), rank), n, [F.asc(rank), F.asc("_id")], F.col(rank))
    best = best.select("_id", F.lit(True).alias("_best"))
    marked = single.join(best, F.col(key).eqNullSafe(F.col("_id")), "left")
    chosen = marked.where(is_flagged | F.col("_best")).select(*meta.columns)
    return best_per_key(chosen, [key], [F.desc(flag)])


def selected_documents(docs: DataFrame, selected: DataFrame, key: str = "sha") -> DataFrame:
    """Documents whose id was selected; ids are unique among documents."""
    return lookup_join(docs, selected.select(key).distinct(), key, "left_semi", sketch=False)


def missing_documents(docs: DataFrame, selected: DataFrame, key: str = "sha") -> DataFrame:
    """Selected rows without a document, column names free of blanks."""
    lost = lookup_join(selected, docs.select(key).distinct(), key, "left_anti", sketch=False)
    return lost.toDF(*[c.replace(" ", "_") for c in lost.columns])


def affiliated_ids(articles: DataFrame, countries: tuple[str, ...] = ("brazil", "brasil")) -> DataFrame:
    """Distinct ids of articles with an author from one of ``countries``."""
    hit = any_affiliation(F.col("metadata.authors"), countries)
    return articles.where(hit).select(strip("paper_id").alias("sha")).distinct()


def flatten_articles(articles: DataFrame, require_abstract: bool = False) -> DataFrame:
    """``(cord_uid, text)``: abstract and body joined, empty articles dropped."""
    has_text = lambda part: F.coalesce(F.exists(F.col(part)["text"], non_empty), F.lit(False))
    # Stops at the first text; a test of the joined text would join it twice.
    kept = articles.where(has_text("abstract") if require_abstract else has_text("abstract") | has_text("body_text"))
    return kept.select(
        F.col("paper_id").alias("cord_uid"),
        F.concat_ws(" \n ", joined_texts("abstract"), joined_texts("body_text")).alias("text"),
    )
