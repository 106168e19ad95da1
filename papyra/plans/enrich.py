"""Journal rank and country flag for article metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.functions.text import issn_key, strip
from papyra.operators.dedupe import best_per_key
from papyra.operators.documents import explode_ids
from papyra.operators.joins import lookup_join


def doi_set(meta: DataFrame, column: str = "doi") -> DataFrame:
    """Distinct stripped DOIs."""
    dois = meta.where(F.col(column).isNotNull()).select(strip(column).alias("DOI"))
    return dois.where("DOI <> ''").distinct()


def match_records(records: DataFrame, dois: DataFrame) -> DataFrame:
    """Bibliographic records whose DOI is in the corpus; the files are read once."""
    return lookup_join(records.withColumn("DOI", strip("DOI")), dois, "DOI", "left_semi", sketch=False)


def rank_by_issn(records: DataFrame, ranks: DataFrame) -> DataFrame:
    """The best rank per DOI over all serial numbers of its records.

    Best: lowest numeric rank, then serial number.
    """
    numeric = F.asc_nulls_last(F.col("Rank").try_cast("double"))
    listed = best_per_key(
        ranks.withColumn("ISSN_key", issn_key("ISSN")).drop("ISSN").where("ISSN_key <> ''"),
        ["ISSN_key"],
        [numeric, F.asc("Full Journal Title"), F.asc("Journal Impact Factor")],
    )
    exploded = (
        records.where(F.col("ISSN").isNotNull())
        .select(strip("DOI").alias("DOI"), F.explode("ISSN").alias("ISSN"))
        .withColumn("ISSN_key", issn_key("ISSN"))
    )
    joined = lookup_join(exploded, listed, "ISSN_key", "inner", spread_by=["DOI"])
    best = best_per_key(joined, ["DOI"], [numeric, F.asc("ISSN_key"), F.asc("ISSN")])
    return best.select("DOI", "ISSN", "ISSN_key", "Full Journal Title", "Rank", "Journal Impact Factor")


def enrich_metadata(meta: DataFrame, doi_rank: DataFrame, flagged: DataFrame) -> DataFrame:
    """Metadata by single id with rank columns and ``paper_br`` (1: flagged).

    Keys are stripped before both lookup tables are made unique, so neither
    join can multiply rows.
    """
    numeric = F.asc_nulls_last(F.col("Rank").try_cast("double"))
    rest = [F.asc(c) for c in doi_rank.columns if c not in ("DOI", "Rank", "ISSN_key", "ISSN")]
    ranks = best_per_key(
        doi_rank.withColumn("DOI", strip("DOI")), ["DOI"], [numeric, F.asc("ISSN_key"), F.asc("ISSN"), *rest]
    )
    flags = flagged.select(strip("sha").alias("sha")).distinct().withColumn("paper_br", F.lit(1))
    base = explode_ids(meta.withColumnsRenamed({"doi": "DOI"}).withColumn("DOI", strip("DOI")), keep_rows=True)
    enriched = lookup_join(lookup_join(base, ranks, "DOI"), flags, "sha")
    ordered = base.columns + [c for c in ranks.columns if c != "DOI"] + ["paper_br"]
    return enriched.withColumn("paper_br", F.coalesce("paper_br", F.lit(0))).select(*ordered)
