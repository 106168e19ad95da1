"""Exact and indexed search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from papyra.operators import knn as module
from papyra.operators.ivf import ivf_build, ivf_search
from papyra.operators.knn import knn, nearest, nearest_expr


def table(spark, vectors, ids):
    rows = [(*i, None if v is None else [float(x) for x in v], f"text {i}") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "doc string, no int, v array<float>, note string")


def brute(corpus, ids, queries, metric, k):
    corpus, queries = np.float32(corpus).astype(float), np.float32(queries).astype(float)
    out = {}
    for q, x in enumerate(queries):
        scored = []
        for i, c in zip(ids, corpus):
            if metric == "dot":
                s = x @ c
            elif metric == "l2":
                s = -np.linalg.norm(x - c)
            else:
                n = np.linalg.norm(x) * np.linalg.norm(c)
                s = x @ c / n if n else None
            scored.append((s is None, 0 if s is None else -round(s, 6), i))
        out[q] = [(i, None if none else -s) for none, s, i in sorted(scored)[:k]]
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-2, 3, (240, 6)).astype(float)
    vectors[:80] = vectors[0]  # a third of the rows are copies
    vectors[100] = 0.0
    ids = [(f"d{i % 50}", i // 50) for i in range(240)]
    queries = np.vstack([rng.integers(-2, 3, (29, 6)), vectors[:1]]).astype(float)
    corpus = table(spark, vectors, ids).unionByName(table(spark, [None], [("null", 0)])).repartition(5)
    asked = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(queries)], "query_id int, query_vector array<float>")
    return vectors, ids, queries, corpus, asked


def hits(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r.note == f"text {(r.doc, r.no)}"
        out.setdefault(r.query_id, []).append(((r.doc, r.no), r.score))
    return out


def check(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        for (_, a), (_, b) in zip(got[q], want[q]):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 2e-6)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
@pytest.mark.parametrize("limit", [16384, 10, 0])
def test_knn_equals_brute_force(spark, data, metric, limit):
    vectors, ids, queries, corpus, asked = data
    got = knn(corpus, asked, 7, ["doc", "no"], "v", metric=metric, columns=["note"], max_broadcast_queries=limit)
    check(hits(got), brute(vectors, ids, queries, metric, 7))


def test_small_blocks_and_tiles(spark, data, monkeypatch):
    vectors, ids, queries, corpus, asked = data
    monkeypatch.setattr(module, "TILE", 64)
    want = brute(vectors, ids, queries, "cosine", 7)
    schema = module.result_schema(corpus, asked, "query_id", ["doc", "no"], ["note"])
    asked = asked.withColumn("_q", F.col("query_id").cast("long"))
    search = module.Search(7, "cosine", ["doc", "no"], "v", ["note"], False)
    pairs = module.grid_search(
        module.one_cell(corpus, ["doc", "no"]),
        module.one_cell(asked.withColumnRenamed("query_vector", "_query_vector"), ["query_id"]),
        search, "query_id", schema, block_rows=30, block_queries=4,
    )
    check(hits(module.ranked(pairs, ["doc", "no"], 7)), want)


def test_columns_come_with_the_hits(spark, data):
    vectors, ids, queries, corpus, asked = data
    got = knn(corpus, asked, 7, ["doc", "no"], "v", columns=["note"])
    assert got.columns == ["query_id", "doc", "no", "score", "note", "rank"]
    check(hits(got), brute(vectors, ids, queries, "cosine", 7))


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("limit", [16384, 0])
def test_two_phases_find_the_same(spark, data, monkeypatch, metric, limit):
    vectors, ids, queries, corpus, asked = data
    monkeypatch.setattr(module, "MAX_BARE_PARTITIONS", 0)
    monkeypatch.setattr(module, "PILOT", 3)
    got = knn(corpus, asked, 7, ["doc", "no"], "v", metric=metric, columns=["note"], max_broadcast_queries=limit)
    check(hits(got), brute(vectors, ids, queries, metric, 7))
    rows = nearest(corpus, list(queries[4]), 6, ["doc", "no"], "v", metric).collect()
    assert [(r.doc, r.no) for r in rows] == [i for i, _ in brute(vectors, ids, queries[4:5], metric, 6)[0]]


def test_bars_keep_losing_rows_where_they_are(spark, monkeypatch):
    """With bars, the rows that leave all partitions do not grow with their number."""
    rng = np.random.default_rng(1)
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(8000, 4)))], "id int, v array<double>").repartition(100, "id")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(20, 4)))], "query_id int, query_vector array<double>")
    sent = []
    ranked = module.ranked
    monkeypatch.setattr(module, "ranked", lambda hits, ids, k: (sent.append(hits.count()), ranked(hits, ids, k))[1])
    monkeypatch.setattr(module, "PILOT", 8)
    knn(corpus, asked, 5, ["id"], "v").collect()
    monkeypatch.setattr(module, "MAX_BARE_PARTITIONS", 1000)
    knn(corpus, asked, 5, ["id"], "v").collect()
    assert sent[-1] == 100 * 20 * 5 and sent[-2] < sent[-1] / 5


def same_ids(spark, count):
    """Few vectors, many queries: repeated and null ids on both sides."""
    rows = [("a", [1.0, 0.0], "a1"), ("a", [0.8, 0.6], "a2"), (None, [0.6, 0.8], "n1"), (None, [1.0, 0.0], "n2"), ("b", [0.0, 1.0], "b1"), ("c", None, "c1")]
    corpus = spark.createDataFrame(rows, "id string, v array<double>, note string")
    asked = spark.range(count).select(
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("q"), F.col("id") % 5)).alias("query_id"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))).alias("query_vector"))
    return corpus, asked


@pytest.mark.parametrize("count", [1, 512, 513, 16_385])
def test_ids_need_not_be_unique(spark, tmp_path, count):
    corpus, asked = same_ids(spark, count)
    x = [("a", 1.0, "a1", 1), (None, 1.0, "n2", 2), ("a", 0.8, "a2", 3)]
    y = [("b", 1.0, "b1", 1), (None, 0.8, "n1", 2), ("a", 0.6, "a2", 3)]
    want = {}
    for i in range(count):
        for hit in (y if i % 2 else x):
            key = (None if i % 7 == 0 else f"q{i % 5}", *hit)
            want[key] = want.get(key, 0) + 1
    path = str(tmp_path / "index")
    ivf_build(corpus, path, 2, "v")
    cells = spark.read.parquet(f"{path}/centroids").count()
    found = {
        "knn": knn(corpus, asked, 3, ["id"], "v", columns=["note"]),
        "ivf": ivf_search(spark, path, asked, 3, cells, ["id"], "v", columns=["note"]),
    }
    for name, df in found.items():
        got = {(r.query_id, r.id, round(r.score, 6), r.note, r["rank"]): r.n for r in df.groupBy("query_id", "id", "score", "note", "rank").agg(F.count("*").alias("n")).collect()}
        assert got == want, name


def test_exclude_self_with_repeated_queries(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 1.0])], "id int, v array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [1.0, 0.0])], "query_id int, query_vector array<double>")
    for limit in (100, 0):
        rows = knn(corpus, asked, 3, ["id"], "v", exclude_self=True, max_broadcast_queries=limit).collect()
        assert sorted((str(r.query_id), str(r.id)) for r in rows) == [("1", "2")] * 2 + [("1", "None")] * 2 + [("None", "1"), ("None", "2"), ("None", "None")]


def test_fewer_rows_than_k(spark, data):
    vectors, ids, queries, corpus, asked = data
    got = knn(corpus, asked, 500, ["doc", "no"], "v", columns=["note"])
    check(hits(got), brute(vectors, ids, queries, "cosine", 500))


def test_zero_query_scores_are_null_and_last(spark):
    corpus = table(spark, [[0, 0], [1, 0], [0, -1]], [("z", 0), ("a", 0), ("b", 0)])
    asked = spark.createDataFrame([(0, [0.0, 1.0])], "query_id int, query_vector array<float>")
    rows = knn(corpus, asked, 3, ["doc", "no"], "v").orderBy("rank").collect()
    assert [(r.doc, r.score) for r in rows] == [("a", 0.0), ("b", -1.0), ("z", None)]


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_one_vector(spark, data, metric):
    vectors, ids, queries, corpus, _ = data
    want = brute(vectors, ids, queries[4:5], metric, 6)[0]
    for search in (nearest, nearest_expr):
        rows = search(corpus, list(queries[4]), 6, ["doc", "no"], "v", metric).collect()
        assert [(r.doc, r.no) for r in rows] == [i for i, _ in want]
        assert np.allclose([r.score for r in rows], [s for _, s in want], atol=2e-6)


def test_exclude_self(spark):
    corpus = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(9)], "id int, v array<float>")
    asked = corpus.select(F.col("id").alias("query_id"), F.col("v").alias("query_vector"))
    for limit in (100, 0):
        rows = knn(corpus, asked, 8, ["id"], "v", exclude_self=True, max_broadcast_queries=limit).collect()
        assert len(rows) == 72 and all(r.id != r.query_id for r in rows)


def test_bad_arguments(spark, data):
    *_, corpus, asked = data
    with pytest.raises(ValueError):
        knn(corpus, asked, 3, ["doc", "no"], "v", metric="hamming")
    with pytest.raises(ValueError):
        knn(corpus, asked, 3, ["doc", "no"], "v", exclude_self=True)


@pytest.mark.parametrize("limit", [100, 0])
def test_index(spark, data, tmp_path, limit):
    vectors, ids, queries, corpus, asked = data
    path = str(tmp_path / "index")
    ivf_build(corpus, path, 6, "v")
    options = dict(ids=["doc", "no"], column="v", columns=["note"], max_broadcast_queries=limit)
    cells = spark.read.parquet(f"{path}/centroids").count()
    want = brute(vectors, ids, queries, "cosine", 7)
    check(hits(ivf_search(spark, path, asked, 7, cells, **options)), want)
    some = hits(ivf_search(spark, path, asked, 7, 2, **options))
    found = [i in dict(want[q]) for q in some for i, _ in some[q]]
    assert np.mean(found) > 0.3
    assert spark.read.parquet(f"{path}/rows").count() == 240
