"""Record matching, journal rank and country flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.operators.documents import affiliated_ids
from papyra.operators.quality import audited_hand_off, enrichment_audit, enrichment_measures
from papyra.plans.clean import citation_table, clean_metadata
from papyra.plans.enrich import doi_set, enrich_metadata, match_records, rank_by_issn
from papyra.plans.silver import selection
from papyra.sinks.writers import hand_off
from papyra.sources.schemas import METADATA_COLUMNS
from papyra.suite.selection import TOP
from papyra.suite.tables import ARTICLES_SQL, articles, documents, table

# Rank list: one serial number twice, one without a number for a rank.
RANK_ROWS = [
    ("1-URGENT", "Journal A", "12", "3.5"),
    ("2-HIGH", "Journal B", "7", "4.1"),
    ("2HIGH", "Journal B again", "9", "4.0"),
    ("3-MEDIUM", "Journal C", "n/a", "1.0"),
    ("0-F", "Journal D", "30", "0.5"),
]

COUNTRIES = ("the", "la", "und")


def doi_semi(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    records = orders.select(F.col("o_custkey").cast("string").alias("DOI"), "o_orderkey")
    customers = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return match_records(records, doi_set(customers.select(F.format_string(" %d\t", "c_custkey").alias("doi"))))


def issn_rank(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("DOI"),
        F.array("o_orderpriority", F.concat(F.lit("0-"), F.col("o_orderstatus"))).alias("ISSN"),
    )
    listed = ", ".join(str(row) for row in RANK_ROWS)
    ranks = spark.sql(f"SELECT * FROM VALUES {listed} AS r(ISSN, `Full Journal Title`, Rank, `Journal Impact Factor`)")
    return rank_by_issn(records, ranks).withColumnsRenamed(
        {"Full Journal Title": "title", "Rank": "rank", "Journal Impact Factor": "impact"}
    )


ISSN_SQL = f"""
    WITH ranks(issn, title, rank, impact) AS (VALUES {', '.join(str(r) for r in RANK_ROWS)}),
    listed AS (
        SELECT * FROM (SELECT replace(issn, '-', '') AS "ISSN_key", title, rank, impact,
                              row_number() OVER (PARTITION BY replace(issn, '-', '')
                                                 ORDER BY try_cast(rank AS DOUBLE) NULLS LAST, title) AS rn FROM ranks)
        WHERE rn = 1),
    records AS (
        SELECT o_custkey::VARCHAR AS "DOI", unnest([o_orderpriority, '0-' || o_orderstatus]) AS "ISSN" FROM orders)
    SELECT "DOI", "ISSN", "ISSN_key", title, rank, impact FROM (
        SELECT r.*, l.*, row_number() OVER (PARTITION BY "DOI" ORDER BY try_cast(rank AS DOUBLE) NULLS LAST,
                                            "ISSN_key", "ISSN") AS best
        FROM records r JOIN listed l ON replace("ISSN", '-', '') = "ISSN_key")
    WHERE best = 1"""


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    meta = table(spark, sf_dir, "documents").select(
        F.concat(F.lit(" "), F.col("doc_id").cast("string"), F.lit(" ")).alias("doi"),
        F.col("doc_id").cast("string").alias("sha"),
        F.col("source").alias("journal"),
    )
    ranks = labels.select(
        F.concat(F.col("doc_id").cast("string"), F.lit("\t")).alias("DOI"),
        F.lit("1-1").alias("ISSN"),
        F.lit("11").alias("ISSN_key"),
        F.col("quality").cast("string").alias("Rank"),
    )
    flagged = labels.where("toxic = 1").select(F.col("doc_id").cast("string").alias("sha"))
    return enrich_metadata(meta, ranks, flagged)


ENRICHED_SQL = """
    SELECT d.doc_id::VARCHAR AS "DOI", d.doc_id::VARCHAR AS sha, source AS journal, quality::VARCHAR AS "Rank",
           coalesce(toxic = 1, false)::INT AS paper_br
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def enrich_left_flag(spark, sf_dir):
    return enriched(spark, sf_dir).select("DOI", "sha", "journal", "Rank", "paper_br")


def audit_rates(spark, sf_dir):
    return enrichment_audit(enriched(spark, sf_dir))


def audit_rates_of_write(spark, sf_dir):
    """The same figures, taken while the enriched table is written."""
    written, figures = audited_hand_off(enriched(spark, sf_dir), "enriched", enrichment_measures(), {"total": (1, None)})
    return spark.createDataFrame([figures], "total long, matched long, matched_pct double, flagged long")


def any_affiliation(spark, sf_dir):
    return affiliated_ids(articles(documents(spark, sf_dir)), COUNTRIES)


AFFILIATION_SQL = f"""
    SELECT doc_id::VARCHAR AS sha FROM ({ARTICLES_SQL})
    WHERE len(list_filter(lines,
        lambda l: lower(regexp_replace(string_split(l, ' ')[-1], '[^A-Za-z]', '', 'g')) IN {COUNTRIES})) > 0"""


def article_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw article metadata: two ids per cell, padded DOIs."""
    key = F.col("doc_id").cast("string")
    given = {
        "sha": F.concat(key, F.lit("; x"), key),
        "doi": F.concat(F.lit(" 10.5555/"), key, F.lit(" ")),
        "publish_time": F.when(F.col("lang") == "de", "2019-12-31").when(F.col("lang") == "es", "2020").otherwise("2021-05-01"),
    }
    docs = table(spark, sf_dir, "documents")
    return docs.select(*[given.get(c, F.concat(F.lit(f"{c} "), key)).alias(c) for c in METADATA_COLUMNS])


def labelled_serials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as bibliographic records of two serial numbers each."""
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit("10.5555/"), F.col("doc_id").cast("string")).alias("DOI"),
        F.array(F.format_string("a-%d", "quality"), F.format_string("b-%d", "toxic")).alias("ISSN"),
    )


def metadata_pipeline(spark, sf_dir):
    """Match, rank, flag, select, clean and cite in one plan."""
    meta = article_metadata(spark, sf_dir)
    serials = labelled_serials(spark, sf_dir)
    ranks = serials.select(F.explode("ISSN").alias("ISSN")).groupBy("ISSN").agg(
        F.concat(F.lit("Journal "), F.col("ISSN")).alias("Full Journal Title"),
        F.count("*").cast("string").alias("Rank"),
        F.lit("1.0").alias("Journal Impact Factor"),
    )
    doi_rank = rank_by_issn(match_records(serials, doi_set(meta)), ranks)
    flagged = affiliated_ids(articles(documents(spark, sf_dir)), COUNTRIES)
    enriched_meta = hand_off(enrich_metadata(meta, doi_rank, flagged), "enriched")
    chosen = selection(enriched_meta, n=TOP)
    return citation_table(clean_metadata(chosen, require_rank=False)).select(
        "cord_uid", "title", "doi", "dt_publicacao", "journal_name", "ranking", "paper_br"
    )


PIPELINE_SQL = f"""
    WITH serials AS (SELECT doc_id, unnest(['a-' || quality, 'b-' || toxic]) AS issn FROM labels),
    ranks AS (SELECT issn, count(*)::DOUBLE AS rank FROM serials GROUP BY issn),
    best AS (SELECT doc_id, issn, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rank, replace(issn, '-', '')) AS rn
        FROM serials JOIN ranks USING (issn)) WHERE rn = 1),
    flagged AS ({AFFILIATION_SQL}),
    meta AS (SELECT doc_id, lang, unnest([doc_id::VARCHAR, 'x' || doc_id]) AS sha FROM documents WHERE lang <> 'de'),
    enriched AS (
        SELECT m.*, issn, rank, (sha IN (SELECT sha FROM flagged))::INT AS paper_br
        FROM meta m LEFT JOIN best b ON m.doc_id = b.doc_id),
    chosen AS (
        SELECT * FROM enriched WHERE paper_br = 1
        UNION ALL
        SELECT * FROM (SELECT * FROM enriched WHERE paper_br = 0 AND rank IS NOT NULL ORDER BY rank, sha LIMIT {TOP}))
    SELECT sha AS cord_uid, 'title ' || doc_id AS title, '10.5555/' || doc_id AS doi,
           CASE WHEN lang = 'es' THEN '2020' ELSE '2021-05-01' END AS dt_publicacao,
           'Journal ' || issn AS journal_name, rank AS ranking, paper_br
    FROM chosen"""


AUDIT_SQL = f"""
    SELECT count(*) AS total, count("Rank") AS matched,
           round(count("Rank") * 100.0::DOUBLE / count(*), 2) AS matched_pct,
           count(*) FILTER (WHERE paper_br = 1) AS flagged FROM ({ENRICHED_SQL})"""


SUITE = {
    "doi_semi": (
        doi_semi,
        """SELECT o_custkey::VARCHAR AS "DOI", o_orderkey FROM orders
           WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    ),
    "issn_rank": (issn_rank, ISSN_SQL),
    "enrich_left_flag": (enrich_left_flag, ENRICHED_SQL),
    "audit_rates": (audit_rates, AUDIT_SQL),
    "audit_rates_of_write": (audit_rates_of_write, AUDIT_SQL),
    "any_affiliation": (any_affiliation, AFFILIATION_SQL),
    "metadata_pipeline": (metadata_pipeline, PIPELINE_SQL),
}
