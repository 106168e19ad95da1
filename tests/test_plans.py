"""Plans keep the shape that large inputs need."""

import pytest
from pyspark.sql import functions as F

from oracle import DATA
from papyra.operators.chunk import chunk_fixed, chunk_recursive
from papyra.operators.dedupe import best_per_key
from papyra.operators.embed import embed_terms
from papyra.operators.knn import knn
from papyra.suite import QUERIES

SF = f"{DATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_product_and_no_global_window(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    for line in text.splitlines():
        if "Window [" in line:
            assert "], [" in line.split("windowspecdefinition", 1)[1], line


@pytest.fixture
def stored(spark, tmp_path):
    """A corpus with at least one split per core, as any large one has."""
    path = str(tmp_path / "docs")
    spark.read.parquet(f"{SF}/documents.parquet").repartition(32).write.parquet(path)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    yield spark.read.parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", before)


@pytest.mark.parametrize("cut", [chunk_fixed, chunk_recursive])
def test_chunk_and_embed_do_not_shuffle(stored, cut):
    text = plan(embed_terms(cut(stored, ["doc_id"])))
    assert "Exchange" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_chunk_and_embed_are_one_job(spark, stored):
    spark.sparkContext.setJobGroup("chunks", "chunks")
    embed_terms(chunk_recursive(stored, ["doc_id"])).write.format("noop").mode("overwrite").save()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chunks")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


def test_costly_vector_is_computed_once(stored):
    vectors = embed_terms(chunk_fixed(stored, ["doc_id"])).withColumnRenamed("doc_id", "id")
    asked = stored.limit(3).select(F.col("doc_id").alias("query_id"), F.array(F.lit(1.0)).alias("query_vector"))
    text = plan(knn(vectors, asked, 2, ["id", "chunk_no"]))
    assert text.count("md5(") == 1


def test_corpus_is_not_shuffled_by_search(spark, stored):
    corpus = spark.read.parquet(f"{SF}/embeddings.parquet")
    asked = corpus.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    text = plan(knn(corpus, asked, 2, ["vec_id"], "embedding"))
    below = text.split("MapInArrow", 1)[1]
    assert "Exchange" not in below and "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in below
    assert "WindowGroupLimit" in text.split("MapInArrow", 1)[0]


def test_dedupe_is_limited_before_the_shuffle(stored):
    text = plan(best_per_key(stored.select("source", "doc_id"), ["source"], [F.asc("doc_id")]))
    assert "WindowGroupLimit" in text.split("Exchange", 1)[1]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["select_flag_or_topn"](spark, SF))
    assert "EqualTo(lang,fr)" in text and "text:string" not in text
