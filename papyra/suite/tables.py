"""Stand-ins for the pipeline's inputs, derived from the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, over all cores when the file has too few splits."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def articles(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested articles: first line abstract, other lines body.

    Each line also names an author whose country is its last word, padded and
    in capitals. ``keep`` adds columns of the documents.
    """
    lines = F.filter(F.split("text", "\n"), lambda l: l != "")
    paragraph = lambda l: F.struct(l.alias("text"))
    author = lambda l: F.struct(
        F.struct(
            F.struct(
                F.concat(F.lit(" "), F.upper(F.regexp_replace(F.substring_index(l, " ", -1), "[^A-Za-z]", "")), F.lit("\t"))
                .alias("country")
            ).alias("location")
        ).alias("affiliation")
    )
    return docs.select(
        F.col("doc_id").cast("string").alias("paper_id"),
        F.struct(F.transform(lines, author).alias("authors")).alias("metadata"),
        F.transform(F.slice(lines, 1, 1), paragraph).alias("abstract"),
        F.transform(F.slice(lines, 2, F.size(lines)), paragraph).alias("body_text"),
        *keep,
    )


def citations(docs: DataFrame) -> DataFrame:
    """Citation columns of the documents; German ones have no date."""
    return docs.select(
        F.col("doc_id").cast("string").alias("cord_uid"),
        F.concat_ws("/", "source", "doc_id").alias("title"),
        F.concat(F.lit("authors of "), F.col("lang")).alias("authors"),
        F.concat(F.lit("10.5555/"), F.col("doc_id").cast("string")).alias("doi"),
        F.when(F.col("lang") != "de", F.lit("2021-03-04")).alias("dt_publicacao"),
        F.col("source").alias("journal_name"),
        F.when(F.col("lang") != "fr", F.col("n_chars").cast("double")).alias("ranking"),
        (F.col("lang") == "fr").cast("int").alias("paper_br"),
    )


CITATIONS_SQL = """
    SELECT doc_id::VARCHAR AS cord_uid, source || '/' || doc_id AS title,
           'authors of ' || lang AS authors, '10.5555/' || doc_id AS doi,
           CASE WHEN lang <> 'de' THEN '2021-03-04' END AS dt_publicacao,
           source AS journal_name,
           CASE WHEN lang <> 'fr' THEN n_chars::DOUBLE END AS ranking,
           (lang = 'fr')::INT AS paper_br
    FROM documents"""

ARTICLES_SQL = """
    SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: l <> '') AS lines
    FROM documents"""

FLAT_SQL = f"""
    SELECT doc_id::VARCHAR AS cord_uid,
           coalesce(lines[1], '') || ' ' || chr(10) || ' ' || array_to_string(lines[2:], ' ') AS text
    FROM ({ARTICLES_SQL})"""


def windows_sql(source: str, key: str) -> str:
    """Fixed windows of a ``(key, text)`` relation."""
    return f"""
    SELECT {key}, w::INT AS chunk_no, substr(text, w * 900 + 1, 1000) AS chunk_text
    FROM (SELECT {key}, text,
                 unnest(range(0, greatest(1, ceil((length(text) - 100) / 900.0))::BIGINT)) AS w
          FROM {source})"""


def terms_sql(source: str, keys: str, text: str) -> str:
    """Sparse unit vectors (float precision) of a relation's texts."""
    return f"""
    SELECT {keys}, bucket, (n / sqrt(sum(n * n) OVER (PARTITION BY {keys})))::FLOAT AS weight
    FROM (SELECT {keys}, bucket, count(*)::DOUBLE AS n
          FROM (SELECT {keys}, (('0x' || substr(md5(word), 1, 7))::BIGINT % 384)::INT AS bucket
                FROM (SELECT {keys}, unnest(string_split_regex(lower({text}), '[^a-z0-9]+')) AS word
                      FROM {source})
                WHERE word <> '')
          GROUP BY ALL)"""
