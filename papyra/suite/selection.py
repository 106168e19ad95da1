"""Metadata filters, ids and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.operators.documents import explode_ids, missing_documents, select_articles, selected_documents
from papyra.operators.joins import lookup_join
from papyra.operators.quality import counts_with_total
from papyra.plans.bronze import bronze_metadata, ids_by_year, year_sizes
from papyra.plans.clean import CITATION, CONTRACT, citation_table, clean_metadata
from papyra.plans.silver import selection
from papyra.suite.tables import table

TOP = 100


def ranked_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return lookup_join(docs, labels, "doc_id").select(
        F.col("doc_id").alias("sha"),
        "lang",
        (F.col("lang") == "fr").cast("int").alias("paper_br"),
        F.when(F.col("quality").isNotNull(), F.col("n_chars").cast("double")).alias("rank"),
    )


RANKED_META_SQL = """
    SELECT d.doc_id AS sha, lang, (lang = 'fr')::INT AS paper_br,
           CASE WHEN quality IS NOT NULL THEN n_chars::DOUBLE END AS rank
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

SELECTED_SQL = f"""
    SELECT * FROM ({RANKED_META_SQL}) WHERE paper_br = 1
    UNION ALL
    SELECT * FROM (SELECT * FROM ({RANKED_META_SQL}) WHERE paper_br = 0 AND rank IS NOT NULL
                   ORDER BY rank, sha LIMIT {TOP})"""


def select_flag_or_topn(spark, sf_dir):
    return select_articles(ranked_meta(spark, sf_dir), TOP)


def selected_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sha"), "source", "n_chars")
    return selected_documents(docs, select_flag_or_topn(spark, sf_dir))


def selected_counts(spark, sf_dir):
    return counts_with_total(selected_docs(spark, sf_dir), "source")


def missing_docs(spark, sf_dir):
    found = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("sha"))
    wanted = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("sha"), "lang", F.col("source").alias("source name")
    )
    return missing_documents(found, wanted)


def missing_count(spark, sf_dir):
    return missing_docs(spark, sf_dir).agg(F.count("*").alias("missing"))


def part_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as enriched metadata; economy parts have a text for a rank."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    given = {
        "sha": key,
        "publish_time": F.concat((F.lit(2000) + F.col("p_size")).cast("string"), F.lit("-01-01")),
        "Rank": F.when(F.col("p_type") == "ECONOMY", F.col("p_name")).otherwise(
            F.regexp_extract("p_brand", "#(.*)$", 1)
        ),
        "paper_br": F.when(F.col("p_size") > 25, "1").otherwise("0"),
        "title": F.col("p_name"),
    }
    sources = {"doi": "DOI", "issn": "ISSN", "issn_key": "ISSN_key", "full_journal_title": "Full Journal Title",
               "rank": "Rank", "journal_impact_factor": "Journal Impact Factor"}
    names = [sources.get(c, c) for c in CONTRACT]
    return part.select(*[given.get(c, F.concat(F.lit(f"{c} "), key)).alias(c) for c in names])


def _part_column(c: str) -> str:
    labels = {"doi": "DOI", "issn": "ISSN", "issn_key": "ISSN_key", "full_journal_title": "Full Journal Title",
              "journal_impact_factor": "Journal Impact Factor"}
    given = {
        "sha": "p_partkey::VARCHAR",
        "publish_time": "(2000 + p_size) || '-01-01'",
        "rank": "try_cast(CASE WHEN p_type = 'ECONOMY' THEN p_name "
                "ELSE regexp_extract(p_brand, '#(.*)$', 1) END AS DOUBLE)",
        "paper_br": "(p_size > 25)::INT",
        "title": "p_name",
    }
    return f"{given.get(c, repr(labels.get(c, c) + ' ') + ' || p_partkey')} AS {c}"


CLEAN_SQL = f"""
    SELECT * FROM (SELECT {', '.join(_part_column(c) for c in CONTRACT)} FROM part)
    WHERE rank IS NOT NULL AND substr(publish_time, 1, 4)::INT >= 2020"""


def clean_contract(spark, sf_dir):
    return clean_metadata(part_metadata(spark, sf_dir))


def clean_keep_unranked(spark, sf_dir):
    kept = clean_metadata(part_metadata(spark, sf_dir), min_year=2021, require_rank=False)
    return kept.select("sha", "rank", "paper_br")


def citation_columns(spark, sf_dir):
    return citation_table(clean_contract(spark, sf_dir))


def silver_selection(spark, sf_dir):
    return selection(part_metadata(spark, sf_dir), n=TOP).select("sha", F.col("Rank").alias("rank"), "paper_br")


def silver_with_abstract(spark, sf_dir):
    """Flagged articles have blank abstracts here, so only ranked ones are chosen."""
    blank = F.when(F.col("paper_br") == "1", F.lit(" \t\n")).otherwise(F.col("abstract"))
    meta = part_metadata(spark, sf_dir).withColumn("abstract", blank)
    return selection(meta, n=TOP, require_abstract=True).select("sha", F.col("Rank").alias("rank"), "paper_br")


def order_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat_ws("; ", "o_orderkey", "o_custkey").alias("sha"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("publish_time"),
    )


def year_filter(spark, sf_dir):
    return bronze_metadata(order_metadata(spark, sf_dir), min_year=1998)


YEAR_FILTER_SQL = """
    SELECT DISTINCT unnest([o_orderkey, o_custkey])::VARCHAR AS sha,
           strftime(o_orderdate, '%Y-%m-%d') AS publish_time, year(o_orderdate)::INT AS year
    FROM orders WHERE year(o_orderdate) >= 1998"""


def document_ids_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("sha"))
    return ids_by_year(year_filter(spark, sf_dir), docs)


BY_YEAR_SQL = f"""
    SELECT DISTINCT year, sha FROM ({YEAR_FILTER_SQL})
    WHERE sha IN (SELECT l_orderkey::VARCHAR FROM lineitem)"""


def year_ids(spark, sf_dir):
    return document_ids_by_year(spark, sf_dir)


def year_sets(spark, sf_dir):
    return year_sizes(document_ids_by_year(spark, sf_dir))


def year_totals(spark, sf_dir):
    return counts_with_total(document_ids_by_year(spark, sf_dir), "year")


def explode_multi_id(spark, sf_dir):
    cells = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit(";")).alias("sha"))
    return explode_ids(cells)


EXPLODE_SQL = r"""
    SELECT doc_id, sha
    FROM (SELECT doc_id, unnest(string_split_regex(
              trim(replace(text, chr(10), ';'), ' ' || chr(9) || chr(10) || chr(13)), '\s*[;,]\s*')) AS sha
          FROM documents)
    WHERE sha <> ''"""


SUITE = {
    "select_flag_or_topn": (select_flag_or_topn, SELECTED_SQL),
    "selected_docs": (
        selected_docs,
        f"SELECT doc_id AS sha, source, n_chars FROM documents WHERE doc_id IN (SELECT sha FROM ({SELECTED_SQL}))",
    ),
    "selected_counts": (
        selected_counts,
        f"""SELECT source, count(*) AS n FROM documents WHERE doc_id IN (SELECT sha FROM ({SELECTED_SQL}))
            GROUP BY ROLLUP (source)""",
    ),
    "missing_docs": (
        missing_docs,
        "SELECT doc_id AS sha, lang, source AS source_name FROM documents "
        "WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    ),
    "missing_count": (
        missing_count,
        "SELECT count(*) AS missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    ),
    "clean_contract": (clean_contract, CLEAN_SQL),
    "clean_keep_unranked": (
        clean_keep_unranked,
        f"SELECT sha, rank, paper_br FROM (SELECT {', '.join(_part_column(c) for c in CONTRACT)} FROM part) "
        "WHERE substr(publish_time, 1, 4)::INT >= 2021",
    ),
    "citation_columns": (
        citation_columns,
        f"SELECT {', '.join(f'{c} AS {name}' for name, c in CITATION.items())} FROM ({CLEAN_SQL})",
    ),
    "silver_selection": (
        silver_selection,
        f"""
        WITH m AS (SELECT sha, rank, paper_br FROM (SELECT {', '.join(_part_column(c) for c in CONTRACT)} FROM part)
                   WHERE substr(publish_time, 1, 4)::INT >= 2020)
        SELECT * FROM m WHERE paper_br = 1
        UNION ALL
        SELECT * FROM (SELECT * FROM m WHERE paper_br = 0 AND rank IS NOT NULL ORDER BY rank, sha LIMIT {TOP})""",
    ),
    "silver_with_abstract": (
        silver_with_abstract,
        f"""SELECT sha, rank, paper_br FROM (SELECT {', '.join(_part_column(c) for c in CONTRACT)} FROM part)
            WHERE substr(publish_time, 1, 4)::INT >= 2020 AND paper_br = 0 AND rank IS NOT NULL
            ORDER BY rank, sha LIMIT {TOP}""",
    ),
    "year_filter": (year_filter, YEAR_FILTER_SQL),
    "year_ids": (year_ids, BY_YEAR_SQL),
    "year_sets": (year_sets, f"SELECT year, count(*) AS n FROM ({BY_YEAR_SQL}) GROUP BY year"),
    "year_totals": (year_totals, f"SELECT year, count(*) AS n FROM ({BY_YEAR_SQL}) GROUP BY ROLLUP (year)"),
    "explode_multi_id": (explode_multi_id, EXPLODE_SQL),
}
