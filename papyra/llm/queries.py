"""Each operator as a query on the shared test tables, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.llm import collocations, decontaminate, fptree, graph, language, ngrams, packing, passages, runs, simhash, slots, toxicity, warc
from papyra.llm.common import fold
from papyra.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
FOLDS, HELD_OUT = 4, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> F.Column:
    return fold(F.col("doc_id"), FOLDS) == HELD_OUT


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every text under interpolated pair and word estimates."""
    return ngrams.scores(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece's place in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs.withColumn("held_out", held_out()), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.93 within a label."""
    return graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document that an earlier document already holds."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, four words, four bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a test item, with the item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    folder = scratch_dir(spark, "warc")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc.read_archives(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
    d AS (
        SELECT page_id, strlen(html) AS payload_bytes,
               list_aggregate(list_transform(range(0, 8), lambda k:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(hex, k * 5 + 1, 5))::BIGINT >> 15)::INT % 32 + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(hex, k * 5 + 1, 5))::BIGINT >> 10)::INT % 32 + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(hex, k * 5 + 1, 5))::BIGINT >> 5)::INT % 32 + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ('0x' || substr(hex, k * 5 + 1, 5))::BIGINT::INT % 32 + 1, 1)
               ), 'string_agg', '') AS payload_digest
        FROM p),
    f AS (SELECT payload_digest, min(page_id) AS first FROM d GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id > first OR page_id IS NULL AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id > first OR page_id IS NULL AND first IS NOT NULL THEN first END AS refers_to
    FROM d JOIN f USING (payload_digest)"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before and after repeated ones are dropped."""
    kept = runs.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_points=20, min_docs=3)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT id, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM d),
    k AS (
        SELECT id, doc_id, line, place,
               translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM l),
    r AS (
        SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) + count(DISTINCT doc_id IS NULL) FILTER (doc_id IS NULL) >= 3),
    s AS (
        SELECT k.id, k.doc_id, k.line, k.place, r.keeper IS NOT NULL AND coalesce(k.doc_id < r.keeper, true) AS dropped
        FROM k LEFT JOIN r USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
    FROM s GROUP BY id, doc_id"""


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.filter(~held_out()))
    found = language.predict(docs.select("doc_id", "text", held_out().alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every test item."""
    return fptree.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP11_SQL = r"""
    WITH d AS (
        SELECT row_number() OVER () AS row_id, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    i AS (
        SELECT row_number() OVER () AS item, item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM benchmark),
    totals AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms))::BIGINT AS tokens FROM d),
    asked AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
    held AS (
        SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM d)
        WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY term, docs),
    norms AS (SELECT row_id, doc_id, 100 - 75 + ((75 * len(terms) * docs) // tokens) AS m FROM d, totals WHERE len(terms) > 0),
    scored AS (
        SELECT item, item_id, row_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN norms USING (row_id) GROUP BY ALL)
    SELECT item_id, rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
    WHERE rank <= 10"""


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and place in it, by virtual slots."""
    return slots.shard(table(spark, sf_dir, "documents"), shards=8)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of two to five words per language."""
    return collocations.collocations(table(spark, sf_dir, "documents"), min_count=100, longest=5, top=2000)


OP13_SQL = r"""
    WITH pieces AS (
        SELECT row_number() OVER () AS piece, lang, words FROM (
            SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words FROM (
                SELECT coalesce(lang, 'und') AS lang,
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents))
        WHERE len(words) > 0),
    totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
    starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
    grams AS (
        SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM starts, range(1, 6) AS r(k) WHERE i + k - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 100),
    candidates AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS words FROM grams WHERE k > 1),
    inside AS (
        SELECT DISTINCT c.lang, array_to_string(c.words[i:i + s - 1], ' ') AS phrase, c.a AS longer
        FROM candidates c, range(2, 5) AS t(s), range(1, 5) AS u(i) WHERE s < size AND i + s - 1 <= size),
    alone AS (
        SELECT * FROM candidates c
        WHERE NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.longer >= 100 * c.a)),
    cuts AS (
        SELECT c.lang, c.phrase, c.a, t.n, i AS k, l.f AS l, r.f AS r,
               (1000::HUGEINT * c.a * t.n // (l.f::HUGEINT * r.f))::BIGINT AS score
        FROM alone c, range(1, 5) AS u(i), totals t, grams l, grams r
        WHERE i < size AND t.lang = c.lang AND l.lang = c.lang AND r.lang = c.lang
          AND l.phrase = array_to_string(words[1:i], ' ') AND r.phrase = array_to_string(words[i + 1:size], ' ')),
    worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM worst QUALIFY rank <= 2000"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through all stages of the corpus pipeline."""
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (op1_lm_scoring, op2_best_fit_packing, op3_toxicity, op4_embedding_near_dedup, op5_substring_dedup, op6_simhash_near_dedup,
              op7_benchmark_decontamination, op8_warc, op9_line_dedup, op10_language_id, op11_ranked_lexical_search, op12_sharding, op13_phrase_collocations, pipeline)
}
ORACLES = {"op8_warc": OP8_SQL, "op9_line_dedup": OP9_SQL, "op11_ranked_lexical_search": OP11_SQL, "op13_phrase_collocations": OP13_SQL}
