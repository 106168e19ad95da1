"""Nearest-vector search, index, contexts and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.operators.context import RULE, contexts, hits_json
from papyra.operators import ivf_refresh as live
from papyra.operators.ivf import ivf_build, ivf_search
from papyra.operators.knn import knn, nearest, nearest_expr
from papyra.plans.gold import cited_vectors
from papyra.plans.retrieve import HITS, question_hits, question_prompts
from papyra.session import scratch_dir
from papyra.suite.tables import CITATIONS_SQL, citations, documents, table, terms_sql, windows_sql

K = 5
CELLS = 16


#: Heads the prompts of these queries.
INSTRUCTIONS = "Answer from the context."


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def as_queries(corpus: DataFrame) -> DataFrame:
    return corpus.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


def mean_vector(corpus: DataFrame) -> list[float]:
    """Mean of all vectors: one number per dimension reaches the driver."""
    places = corpus.select(F.posexplode("embedding").alias("i", "x"))
    means = places.groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return [row.m for row in means.orderBy("i").collect()]


def knn_one(spark, sf_dir):
    corpus = vectors(spark, sf_dir)
    return nearest(corpus, mean_vector(corpus), K, ["vec_id"], "embedding", columns=["label"]).drop("rank")


def knn_one_expr(spark, sf_dir):
    corpus = vectors(spark, sf_dir)
    return nearest_expr(corpus, mean_vector(corpus), K, ["vec_id"], "embedding", columns=["label"])


KNN_ONE_SQL = f"""
    WITH places AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i
                    FROM embeddings),
    means AS (SELECT list(m ORDER BY i) AS q FROM (SELECT i, avg(x) AS m FROM places GROUP BY i))
    SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS score
    FROM embeddings, means ORDER BY score DESC, vec_id LIMIT {K}"""

SCORES = {
    "cosine": "list_cosine_similarity({a}, {b})",
    "dot": "list_dot_product({a}, {b})",
    "l2": "-list_distance({a}, {b})",
}


def knn_sql(metric: str) -> str:
    score = SCORES[metric].format(a="q.embedding::DOUBLE[]", b="c.embedding::DOUBLE[]")
    return f"""
    SELECT query_id, vec_id, label, score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM (
            SELECT q.vec_id AS query_id, c.vec_id, c.label, round({score}, 6) AS score
            FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id))
    WHERE rank <= {K}"""


def all_pairs(metric: str, **options):
    def query(spark, sf_dir):
        corpus = vectors(spark, sf_dir)
        return knn(corpus, as_queries(corpus), K, ["vec_id"], "embedding", metric=metric,
                   columns=["label"], exclude_self=True, **options)

    return query


def built_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    corpus = vectors(spark, sf_dir)
    path = scratch_dir(spark, "ivf")
    ivf_build(corpus, path, CELLS, "embedding")
    return corpus, path


def searched(spark, sf_dir, nprobe: int, **options) -> DataFrame:
    corpus, path = built_index(spark, sf_dir)
    return ivf_search(spark, path, as_queries(corpus), K, nprobe, ["vec_id"], "embedding",
                      columns=["label"], exclude_self=True, **options)


def ivf_exact(spark, sf_dir):
    return searched(spark, sf_dir, CELLS)


def ivf_exact_grid(spark, sf_dir):
    return searched(spark, sf_dir, CELLS, max_broadcast_queries=0)


def ivf_recall(spark, sf_dir):
    """Share of the true neighbours found in a quarter of the cells, checked."""
    exact = all_pairs("cosine")(spark, sf_dir).select("query_id", "vec_id")
    found = searched(spark, sf_dir, CELLS // 4).select("query_id", "vec_id", F.lit(1).alias("hit"))
    both = exact.join(found, ["query_id", "vec_id"], "left")
    return both.agg(
        F.count("*").alias("true_neighbours"),
        (F.count("hit") >= 0.4 * F.count("*")).alias("enough_found"),
    )


def ivf_refresh(spark, sf_dir):
    """An index built without some labels, brought up to date in two batches.

    The first adds label 0 and deletes label 1, and is compacted; the second
    turns the vectors of label 2 round and brings label 1 back.
    """
    corpus = vectors(spark, sf_dir)
    path = scratch_dir(spark, "live")
    live.build(corpus.where("label <> 0"), path, CELLS, "embedding")
    change = lambda label, kind: corpus.where(F.col("label") == label).withColumn("change", F.lit(kind))
    live.refresh(spark, path, change(0, "insert").unionByName(change(1, "delete")), ["vec_id"], "embedding", batch=0)
    live.compact(spark, path, ["vec_id"], "embedding")
    turned = change(2, "update").withColumn("embedding", F.transform("embedding", lambda x: -x))
    live.refresh(spark, path, turned.unionByName(change(1, "insert")), ["vec_id"], "embedding", batch=1)
    return live.search(spark, path, as_queries(corpus), K, 4 * CELLS, ["vec_id"], "embedding", columns=["label"], exclude_self=True)


IVF_REFRESH_SQL = f"""
    WITH now AS (
        SELECT vec_id, label, CASE WHEN label = 2 THEN list_transform(embedding, lambda x: -x) ELSE embedding END::DOUBLE[] AS v
        FROM embeddings)
    SELECT query_id, vec_id, label, score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM (
            SELECT q.vec_id AS query_id, c.vec_id, c.label, round(list_cosine_similarity(q.embedding::DOUBLE[], c.v), 6) AS score
            FROM embeddings q JOIN now c ON q.vec_id <> c.vec_id))
    WHERE rank <= {K}"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )


def searchable(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("cord_uid"), "text")
    return cited_vectors(texts, citations(table(spark, sf_dir, "documents")), recursive=False)


HITS_SQL = f"""
    docs AS (SELECT doc_id::VARCHAR AS cord_uid, text FROM documents),
    chunks AS ({windows_sql('docs', 'cord_uid')}),
    terms AS ({terms_sql('chunks', 'cord_uid, chunk_no', 'chunk_text')}),
    asked AS ({terms_sql('benchmark', 'item_id', 'text')}),
    lengths AS (SELECT cord_uid, chunk_no, sqrt(sum(weight::DOUBLE * weight::DOUBLE)) AS n FROM terms GROUP BY ALL),
    asked_lengths AS (SELECT item_id, sqrt(sum(weight::DOUBLE * weight::DOUBLE)) AS n FROM asked GROUP BY ALL),
    dots AS (SELECT item_id, cord_uid, chunk_no, sum(a.weight::DOUBLE * t.weight::DOUBLE) AS dot
             FROM asked a JOIN terms t ON a.bucket = t.bucket GROUP BY ALL),
    scored AS (
        SELECT b.item_id AS query_id, c.cord_uid, c.chunk_no, c.chunk_text,
               round(coalesce(d.dot, 0) / (al.n * l.n), 6) AS score
        FROM benchmark b CROSS JOIN chunks c
        LEFT JOIN asked_lengths al ON al.item_id = b.item_id
        LEFT JOIN lengths l ON l.cord_uid = c.cord_uid AND l.chunk_no = c.chunk_no
        LEFT JOIN dots d ON d.item_id = b.item_id AND d.cord_uid = c.cord_uid AND d.chunk_no = c.chunk_no),
    hits AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id
                              ORDER BY score DESC NULLS LAST, cord_uid, chunk_no)::INT AS rank FROM scored)
        WHERE rank <= {HITS}),
    cited AS (
        SELECT h.*, title, authors, doi, dt_publicacao, journal_name
        FROM hits h JOIN ({CITATIONS_SQL}) c ON h.cord_uid = c.cord_uid),
    contexts AS (
        SELECT query_id, string_agg('SOURCE: ' || title || chr(10) || 'AUTHORS: ' || authors || chr(10) ||
                   'JOURNAL: ' || journal_name || ' (' || coalesce(dt_publicacao[:4], 'N/A') || ')' || chr(10) ||
                   'DOI: ' || doi || chr(10) || 'CONTENT: ' || chunk_text || chr(10) || '{RULE}',
                   chr(10) ORDER BY rank) AS context
        FROM cited GROUP BY query_id)"""


def rag_hits(spark, sf_dir):
    return question_hits(searchable(spark, sf_dir), questions(spark, sf_dir), columns=["title"]).drop("chunk_text")


def rag_hits_json(spark, sf_dir):
    return hits_json(rag_hits(spark, sf_dir), ["cord_uid", "chunk_no", "title"])


def rag_context(spark, sf_dir):
    return contexts(question_hits(searchable(spark, sf_dir), questions(spark, sf_dir)))


def rag_prompt(spark, sf_dir):
    return question_prompts(searchable(spark, sf_dir), questions(spark, sf_dir), INSTRUCTIONS)


PROMPT_SQL = f"""
    SELECT item_id AS query_id,
           '{INSTRUCTIONS}' || chr(10) || chr(10) || 'CONTEXT:' || chr(10) || coalesce(context, '') ||
           chr(10) || chr(10) || 'QUESTION: ' || text || chr(10) || chr(10) || 'ANSWER:' AS prompt
    FROM benchmark LEFT JOIN contexts ON query_id = item_id"""


SUITE = {
    "knn_one": (knn_one, KNN_ONE_SQL),
    "knn_one_expr": (knn_one_expr, KNN_ONE_SQL),
    "knn_batch": (all_pairs("cosine"), knn_sql("cosine")),
    "knn_batch_dot": (all_pairs("dot"), knn_sql("dot")),
    "knn_batch_l2": (all_pairs("l2"), knn_sql("l2")),
    "knn_batch_grid": (all_pairs("cosine", max_broadcast_queries=0), knn_sql("cosine")),
    "ivf_exact": (ivf_exact, knn_sql("cosine")),
    "ivf_exact_grid": (ivf_exact_grid, knn_sql("cosine")),
    "ivf_recall": (
        ivf_recall,
        f"SELECT count(*) * {K} AS true_neighbours, true AS enough_found FROM embeddings",
    ),
    "ivf_refresh": (ivf_refresh, IVF_REFRESH_SQL),
    "rag_hits": (rag_hits, f"WITH {HITS_SQL} SELECT query_id, cord_uid, chunk_no, score, title, rank FROM cited"),
    "rag_hits_json": (
        rag_hits_json,
        f"""WITH {HITS_SQL}
            SELECT query_id, rank, to_json({{cord_uid: cord_uid, chunk_no: chunk_no, title: title}})::VARCHAR AS hit
            FROM cited""",
    ),
    "rag_context": (rag_context, f"WITH {HITS_SQL} SELECT query_id, context FROM contexts"),
    "rag_prompt": (rag_prompt, f"WITH {HITS_SQL} {PROMPT_SQL}"),
}
