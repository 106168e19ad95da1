"""Readers, writers, incremental runs and change sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.functions.text import file_stem
from papyra.operators.changes import apply_changes, snapshot_diff
from papyra.operators.documents import affiliated_ids, flatten_articles
from papyra.plans.bronze import write_by_year
from papyra.plans.enrich import doi_set
from papyra.session import scratch_dir, spread
from papyra.sinks.writers import write_csv, write_jsonl, write_parquet, write_table
from papyra.sources.files import (
    file_audit,
    list_documents,
    read_articles,
    read_csv,
    read_ids,
    read_json,
    read_metadata,
    read_parquet,
    read_ranks,
    read_records,
    read_table,
    well_formed,
    whole_records,
)
from papyra.sources.schemas import CORRUPT, METADATA_COLUMNS, RECORD
from papyra.streaming.records import match_records_incremental, matched_records, matches_per_file
from papyra.streaming.refresh import current, refresh
from papyra.suite.enrichment import AFFILIATION_SQL, COUNTRIES
from papyra.suite.selection import BY_YEAR_SQL, document_ids_by_year
from papyra.suite.tables import FLAT_SQL, articles, documents, table


def csv_roundtrip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit('say "'), "text", F.lit('", ')).alias("text"), "lang", "n_chars"
    )
    path = scratch_dir(spark, "csv")
    write_csv(docs, path)
    return read_csv(spark, path, "doc_id bigint, text string, lang string, n_chars bigint")


def csv_tolerant(spark, sf_dir):
    """Cells that do not fit become null and their lines are counted."""
    parts = table(spark, sf_dir, "part")
    cell = F.when(F.col("p_type") == "ECONOMY", F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    path = scratch_dir(spark, "csv")
    write_csv(parts.select("p_partkey", cell.alias("p_size")), path)
    back = read_csv(spark, path, "p_partkey bigint, p_size int", tolerant=True)
    return back.select("p_partkey", "p_size", F.col(CORRUPT).isNotNull().alias("corrupt"))


def stored_metadata(spark: SparkSession, sf_dir: str) -> str:
    """Documents as a metadata file: quotes, commas and line breaks in its cells."""
    given = {
        "sha": F.concat_ws("; ", F.col("doc_id").cast("string"), F.concat(F.lit("x"), F.col("doc_id").cast("string"))),
        "publish_time": F.concat(F.lit("2021-0"), (F.length("lang") % 9 + 1).cast("string"), F.lit("-01")),
        "title": F.concat(F.lit('a "title", of '), F.col("source")),
        "abstract": F.col("text"),
        "journal": F.when(F.col("lang") != "de", F.col("lang")),
    }
    docs = table(spark, sf_dir, "documents")
    path = scratch_dir(spark, "metadata")
    write_csv(docs.select(*[given.get(c, F.lit(c)).alias(c) for c in METADATA_COLUMNS]), path)
    return path


def csv_two_columns(spark, sf_dir):
    return read_metadata(spark, stored_metadata(spark, sf_dir), columns=["sha", "publish_time"])


def csv_all_strings(spark, sf_dir):
    """A number stays the text it is; every column comes back, in order."""
    meta = read_metadata(spark, stored_metadata(spark, sf_dir))
    return meta.select("sha", "title", F.md5("abstract").alias("digest"), "journal", "s2_id", F.lit(len(meta.columns)).alias("width"))


def csv_ranks_of_ids(spark, sf_dir):
    """A rank list and an id list, read by their own schemas and joined."""
    parts = table(spark, sf_dir, "part")
    ranks, ids = scratch_dir(spark, "ranks"), scratch_dir(spark, "ids")
    write_csv(parts.select(F.col("p_partkey").cast("string").alias("ISSN"), F.col("p_name").alias("Full Journal Title"),
                           F.col("p_size").cast("string").alias("Rank"), F.col("p_brand").alias("Journal Impact Factor")), ranks)
    write_csv(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("sha")).distinct(), ids)
    return read_ranks(spark, ranks).join(read_ids(spark, ids), F.col("ISSN") == F.col("sha"), "left_semi").select(
        "ISSN", F.col("Full Journal Title").alias("title"), F.col("Rank").alias("rank"), F.col("Journal Impact Factor").alias("impact"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bibliographic records; sign-ups have no serial number."""
    return table(spark, sf_dir, "events").select(
        "event_type",
        F.col("user_id").cast("string").alias("DOI"),
        F.when(F.col("event_type") != "signup", F.array("event_type", "props")).alias("ISSN"),
    )


RECORDS_SQL = """
    SELECT event_type, user_id::VARCHAR AS "DOI",
           CASE WHEN event_type <> 'signup' THEN [event_type, props] END AS "ISSN" FROM events"""


def jsonl_gz_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "jsonl")
    write_jsonl(event_records(spark, sf_dir), path, gzip=True)
    serials = read_records(spark, path).where(F.col("ISSN").isNotNull())
    return serials.select("DOI", F.explode("ISSN").alias("ISSN")).groupBy("DOI", "ISSN").agg(F.count("*").alias("n"))


def file_audit_by_folder(spark, sf_dir):
    """Lines of error events are cut short, so they must count as corrupt."""
    line = F.to_json(F.struct("DOI", "ISSN"))
    written = event_records(spark, sf_dir).select(
        "event_type", F.when(F.col("event_type") == "error", F.substring(line, 1, 9)).otherwise(line).alias("value")
    )
    path = scratch_dir(spark, "audit")
    written.write.partitionBy("event_type").option("compression", "gzip").text(path)
    audit = file_audit(read_json(spark, path, RECORD))
    folder = F.regexp_extract("file", "event_type=([^/]*)/", 1)
    return audit.groupBy(folder.alias("event_type")).agg(F.sum("good").alias("good"), F.sum("corrupt").alias("corrupt"))


def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles written as JSON in one sub-folder per language, read back."""
    path = scratch_dir(spark, "articles")
    write_jsonl(articles(documents(spark, sf_dir), keep=("lang",)), path, by=["lang"])
    return well_formed(read_articles(spark, path, multi_line=False))


def nested_json_scan(spark, sf_dir):
    return flatten_articles(stored_articles(spark, sf_dir))


def nested_json_affiliation(spark, sf_dir):
    return affiliated_ids(stored_articles(spark, sf_dir), COUNTRIES)


#: Documents in one stored file.
PER_FILE = 64


def stored_files(spark: SparkSession, sf_dir: str) -> str:
    """Articles in files of several, spread over many lines; Spanish files are cut short."""
    made = articles(documents(spark, sf_dir), keep=("doc_id", "lang"))
    text = F.to_json(F.struct("paper_id", "metadata", "abstract", "body_text"), {"pretty": "true"})
    files = made.groupBy("lang", F.floor(F.col("doc_id") / PER_FILE).alias("file")).agg(F.concat_ws(",\n", F.collect_list(text)).alias("objects"))
    whole = F.concat(F.lit("[\n"), "objects", F.lit("\n]\n"))
    cut = F.substring(whole, F.lit(1), F.length(whole) - F.lit(20))
    path = scratch_dir(spark, "files")
    rows = files.select("lang", F.when(F.col("lang") == "es", cut).otherwise(whole).alias("value"))
    rows.write.partitionBy("lang").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
    return path


def articles_of_files(spark, sf_dir):
    """Whole files of the default layout, at any depth; malformed files are left out."""
    return flatten_articles(whole_records(read_articles(spark, stored_files(spark, sf_dir))))


def affiliation_of_files(spark, sf_dir):
    return affiliated_ids(whole_records(read_articles(spark, stored_files(spark, sf_dir))), COUNTRIES)


def malformed_files(spark, sf_dir):
    """Malformed files counted by folder, the others by document."""
    audit = file_audit(read_articles(spark, stored_files(spark, sf_dir)))
    lang = F.regexp_extract("file", "lang=([^/]*)/", 1).alias("lang")
    return audit.groupBy(lang).agg(F.sum("good").alias("good"), F.sum("corrupt").alias("corrupt"))


def id_listing(spark, sf_dir):
    """Ids from names alone: one folder, named like a document, per supplier."""
    path = scratch_dir(spark, "named")
    name = F.concat(F.col("s_suppkey").cast("string"), F.lit(".json"))
    suppliers = spread(table(spark, sf_dir, "supplier"), "s_suppkey")
    write_jsonl(suppliers.select(name.alias("name"), "s_nationkey"), path, by=["name"])
    folder = F.regexp_replace("file", "/[^/]*$", "")
    return list_documents(spark, path).select(F.regexp_replace(file_stem(folder), "^name=", "").alias("sha")).distinct()


def doc_listing(spark, sf_dir):
    """Folders named by source, listed back to ids from the paths alone."""
    path = scratch_dir(spark, "listing")
    write_jsonl(table(spark, sf_dir, "documents").select("source", "doc_id"), path, by=["source"])
    return list_documents(spark, path).select(F.regexp_extract("file", "source=([^/]*)/", 1).alias("source")).distinct()


def year_archive(spark, sf_dir):
    """Line items of the listed orders, stored by year and read back."""
    by_year = document_ids_by_year(spark, sf_dir)
    docs = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("sha"), "l_partkey", "l_linenumber"
    )
    path = scratch_dir(spark, "years")
    # Order and customer ids share the id column, so an id may have two years.
    write_by_year(docs, by_year, path)
    return read_parquet(spark, path).select("year", "sha", "l_partkey", "l_linenumber")


def table_roundtrip(spark, sf_dir):
    """A table overwritten with another schema reads with the new one."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_dir(spark, "orders")
    name = "papyra_" + path.rsplit("-", 1)[1]
    write_table(orders.select("o_orderkey"), name, path)
    write_table(orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), name, path)
    return read_table(spark, name)


def dropped_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Records arriving in two drops, matched after each; a third run is idle."""
    records = event_records(spark, sf_dir)
    in_dir, out_dir, checkpoint = (scratch_dir(spark, x) for x in ("drops", "matches", "progress"))
    dois = doi_set(records.where("event_type = 'purchase'").select(F.col("DOI").alias("doi")))
    drops = [F.col("event_type").isin("view", "click"), ~F.col("event_type").isin("view", "click")]
    for number, drop in enumerate(drops):
        write_jsonl(records.where(drop), f"{in_dir}/drop={number}", gzip=True, by=["event_type"])
        match_records_incremental(spark, in_dir, dois, out_dir, checkpoint)
    match_records_incremental(spark, in_dir, dois, out_dir, checkpoint)
    return matched_records(spark, out_dir), in_dir


MATCHED_SQL = f"""
    SELECT * FROM ({RECORDS_SQL})
    WHERE "DOI" IN (SELECT user_id::VARCHAR FROM events WHERE event_type = 'purchase')"""


def incremental_append(spark, sf_dir):
    matched, _ = dropped_records(spark, sf_dir)
    return matched.groupBy("DOI").agg(F.count("*").alias("n"), F.count("ISSN").alias("with_issn"))


def incremental_file_counts(spark, sf_dir):
    matched, _ = dropped_records(spark, sf_dir)
    folder = F.regexp_extract("file", "event_type=([^/]*)/", 1)
    return matches_per_file(matched).groupBy(folder.alias("event_type")).agg(F.sum("matches").alias("matches"))


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents before and after: toxic gone, French changed, German re-keyed."""
    old = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    new = old.join(toxic, "doc_id", "left_anti").select(
        F.when(F.col("lang") == "de", F.col("doc_id") + 1_000_000_000).otherwise(F.col("doc_id")).alias("doc_id"),
        F.when(F.col("lang") == "fr", F.concat(F.lit("* "), "text")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("lang") == "es", F.lit(None)).otherwise(F.col("lang")).alias("lang"),
    )
    return old, new


NEW_SQL = """
    SELECT CASE WHEN lang = 'de' THEN doc_id + 1000000000 ELSE doc_id END AS doc_id,
           CASE WHEN lang = 'fr' THEN '* ' || text ELSE text END AS text,
           CASE WHEN lang <> 'es' THEN lang END AS lang
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"""

DIFF_SQL = f"""
    SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, n.text, n.lang,
           CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END AS change
    FROM ({NEW_SQL}) n FULL JOIN documents o ON n.doc_id = o.doc_id
    WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR n.text <> o.text OR n.lang IS DISTINCT FROM o.lang"""


def diff(spark, sf_dir):
    return snapshot_diff(*snapshots(spark, sf_dir), ["doc_id"])


def snapshot_apply(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return apply_changes(old, snapshot_diff(old, new, ["doc_id"]), ["doc_id"])


def index_refresh(spark, sf_dir):
    """The stored snapshot brought up to date by two change files in turn."""
    old, new = snapshots(spark, sf_dir)
    index, inbox, checkpoint = (scratch_dir(spark, x) for x in ("index", "changes", "progress"))
    write_parquet(old, f"{index}/base")
    changes = snapshot_diff(old, new, ["doc_id"])
    schema = "doc_id bigint, text string, lang string, change string"
    for kind in (F.col("change") == "delete", F.col("change") != "delete"):
        changes.where(kind).write.mode("append").parquet(inbox)
        refresh(spark, inbox, schema, ["doc_id"], index, checkpoint)
    return current(spark, index, ["doc_id"])


SUITE = {
    "csv_roundtrip": (
        csv_roundtrip,
        """SELECT doc_id, 'say "' || text || '", ' AS text, lang, n_chars FROM documents""",
    ),
    "csv_tolerant": (
        csv_tolerant,
        """SELECT p_partkey, CASE WHEN p_type <> 'ECONOMY' THEN p_size END AS p_size, p_type = 'ECONOMY' AS corrupt
           FROM part""",
    ),
    "csv_two_columns": (
        csv_two_columns,
        """SELECT doc_id || '; x' || doc_id AS sha, '2021-0' || (length(lang) % 9 + 1) || '-01' AS publish_time FROM documents""",
    ),
    "csv_all_strings": (
        csv_all_strings,
        f"""SELECT doc_id || '; x' || doc_id AS sha, 'a "title", of ' || source AS title, md5(text) AS digest,
                   CASE WHEN lang <> 'de' THEN lang END AS journal, 's2_id' AS s2_id, {len(METADATA_COLUMNS)}::INT AS width FROM documents""",
    ),
    "csv_ranks_of_ids": (
        csv_ranks_of_ids,
        """SELECT p_partkey::VARCHAR AS "ISSN", p_name AS title, p_size::VARCHAR AS rank, p_brand AS impact
           FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""",
    ),
    "jsonl_gz_roundtrip": (
        jsonl_gz_roundtrip,
        f"""SELECT "DOI", "ISSN", count(*) AS n FROM (SELECT "DOI", unnest("ISSN") AS "ISSN" FROM ({RECORDS_SQL}))
            GROUP BY ALL""",
    ),
    "file_audit": (
        file_audit_by_folder,
        """SELECT event_type, count(*) FILTER (WHERE event_type <> 'error') AS good,
                  count(*) FILTER (WHERE event_type = 'error') AS corrupt FROM events GROUP BY event_type""",
    ),
    "nested_json_scan": (nested_json_scan, FLAT_SQL),
    "nested_json_affiliation": (nested_json_affiliation, AFFILIATION_SQL),
    "articles_of_files": (articles_of_files, f"{FLAT_SQL} WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'es')"),
    "affiliation_of_files": (
        affiliation_of_files,
        f"SELECT * FROM ({AFFILIATION_SQL}) WHERE sha NOT IN (SELECT doc_id::VARCHAR FROM documents WHERE lang = 'es')",
    ),
    "malformed_files": (
        malformed_files,
        f"""SELECT lang, CASE WHEN lang <> 'es' THEN count(*) ELSE 0 END::BIGINT AS good,
                   CASE WHEN lang = 'es' THEN count(DISTINCT doc_id // {PER_FILE}) ELSE 0 END::BIGINT AS corrupt
            FROM documents GROUP BY lang""",
    ),
    "id_listing": (id_listing, "SELECT DISTINCT s_suppkey::VARCHAR AS sha FROM supplier"),
    "doc_listing": (doc_listing, "SELECT DISTINCT source FROM documents"),
    "year_archive": (
        year_archive,
        f"""SELECT year, sha, l_partkey, l_linenumber FROM ({BY_YEAR_SQL})
            JOIN lineitem ON l_orderkey::VARCHAR = sha""",
    ),
    "table_roundtrip": (table_roundtrip, "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders"),
    "incremental_append": (
        incremental_append,
        f"""SELECT "DOI", count(*) AS n, count("ISSN") AS with_issn FROM ({MATCHED_SQL}) GROUP BY "DOI" """,
    ),
    "incremental_file_counts": (
        incremental_file_counts,
        f"SELECT event_type, count(*) AS matches FROM ({MATCHED_SQL}) GROUP BY event_type",
    ),
    "snapshot_diff": (diff, DIFF_SQL),
    "snapshot_apply": (snapshot_apply, NEW_SQL),
    "index_refresh": (index_refresh, NEW_SQL),
}
