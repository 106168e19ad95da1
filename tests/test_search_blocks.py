"""Scoring of a block: little memory, few scores settled, the same hits as a plain sort."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from papyra.operators import knn as module


def block(vectors, ids):
    return pa.table({"id": pa.array(ids, pa.int64()), "v": pa.array([list(v) for v in vectors], pa.list_(pa.float64()))})


def scored(metric, rows, ids, queries, query_ids, k=5, exclude_self=True, bars=None):
    search = module.Search(k, metric, ["id"], "v", [], exclude_self).asking(queries, pa.array(query_ids, pa.int64()))
    bars = search.first_bars() if bars is None else bars
    return search.merge(list(search.candidates(block(rows, ids), np.arange(len(queries)), bars)))


def plain(metric, rows, ids, queries, query_ids, k=5):
    found = []
    for q, (x, own) in enumerate(zip(queries, query_ids)):
        with np.errstate(invalid="ignore"):
            s = {"dot": rows @ x, "l2": -np.linalg.norm(rows - x, axis=1), "cosine": rows @ x / (np.linalg.norm(rows, axis=1) * np.linalg.norm(x))}[metric]
        s = np.where(np.isnan(s), module.UNDEFINED, [round(float(v), 6) if not np.isnan(v) else 0.0 for v in s])
        order = sorted((-v, i) for v, i in zip(s.tolist(), ids) if i != own)[:k]
        found += [(q, i, round(-v, 5) if v < 1e300 else None) for v, i in order]
    return found


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
@pytest.mark.parametrize("tile", [1 << 9, 1 << 12, 1 << 18])
def test_blocks_equal_a_plain_sort(monkeypatch, metric, tile):
    monkeypatch.setattr(module, "TILE", tile)
    monkeypatch.setattr(module, "STRIP", 32)
    rng = np.random.default_rng(tile)
    rows = rng.integers(-3, 4, (700, 5)).astype(float)
    rows[100:400] = rows[100]  # many equal scores
    rows[500:510] = 0.0
    ids = rng.permutation(700).tolist()
    ids[3] = ids[4] = ids[5]  # a repeated id is excluded as a whole
    queries = np.vstack([rows[90:160], np.zeros((2, 5)), rng.normal(size=(30, 5))])
    query_ids = ids[90:160] + [ids[4], ids[0]] + [None] * 29 + [10_000]
    (got,) = scored(metric, rows, ids, queries, query_ids)
    got = [(r["_q"], r["id"], None if r["score"] == module.UNDEFINED else round(r["score"], 5)) for r in got.to_pylist()]
    want = plain(metric, rows, ids, queries, query_ids)
    assert [(q, i) for q, i, _ in got] == [(q, i) for q, i, _ in want]
    assert all((a is None) == (b is None) and (a is None or abs(a - b) < 2e-5) for (_, _, a), (_, _, b) in zip(got, want))


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_memory_of_a_block_is_that_of_its_vectors(metric):
    """Not that of its scores, and not more with more queries."""
    rng = np.random.default_rng(5)
    rows, queries = rng.normal(size=(6_000, 16)), rng.normal(size=(3_000, 16))
    search = module.Search(5, metric, ["id"], "v", [], False).asking(queries, pa.array(range(len(queries)), pa.int64()))
    table = block(rows, range(len(rows)))
    tracemalloc.start()
    held = sum(t.num_rows for t in search.candidates(table, np.arange(len(queries)), search.first_bars()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held == 5 * len(queries) and peak < 24_000_000


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_few_scores_are_settled(monkeypatch, metric):
    rng = np.random.default_rng(6)
    rows, queries = rng.normal(size=(8_000, 8)), rng.normal(size=(300, 8))
    seen = []
    settle = module.settle
    monkeypatch.setattr(module, "settle", lambda scores, *more: seen.append(scores.size) or settle(scores, *more))
    scored(metric, rows, range(8_000), queries, [None] * 300)
    assert sum(seen) < 8_000 * 300 / 10


def test_grid_copies_both_sides_alike(spark, monkeypatch):
    """Each side is read once for each block of the other: few, equal blocks."""
    rows = spark.range(40_000).select(F.col("id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    asked = rows.select(F.col("id").alias("_q"), F.col("id").alias("query_id"), F.col("v").alias("_query_vector"))
    search = module.Search(1, "l2", ["id"], "v", [], True)
    schema = module.result_schema(rows, asked, "query_id", ["id"], [])
    hits = module.grid_search(module.one_cell(rows, ["id"]), module.one_cell(asked, ["_q"]), search, "query_id", schema)
    found = hits.groupBy("_q").count().agg(F.count("*").alias("n"), F.max("count").alias("blocks"), F.min("count").alias("least")).first()
    assert found.n == 40_000 and found.least == found.blocks <= 4


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_few_pairs_are_scored_in_double_precision(monkeypatch, metric):
    """A pass in single precision rules out nearly all pairs."""
    rng = np.random.default_rng(8)
    rows, queries = rng.normal(size=(8_000, 8)), rng.normal(size=(300, 8))
    seen = []
    whole, pairs = module.score_block, module.pair_scores
    monkeypatch.setattr(module, "score_block", lambda q, r, m: seen.append(len(q) * len(r)) or whole(q, r, m))
    monkeypatch.setattr(module, "pair_scores", lambda a, b, q, r, m: seen.append(q.size) or pairs(a, b, q, r, m))
    (got,) = scored(metric, rows, range(8_000), queries, [None] * 300)
    assert 5 * 300 <= sum(seen) < 8_000 * 300 / 10
    assert [(r["_q"], r["id"]) for r in got.to_pylist()] == [(q, i) for q, i, _ in plain(metric, rows, range(8_000), queries, [None] * 300)]


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
@pytest.mark.parametrize("k", [1, 5, 60])
def test_screen_loses_no_row(metric, k):
    """Lengths from 1e-9 to 10, and scores closer than single precision tells apart."""
    rng = np.random.default_rng(k)
    rows = rng.normal(size=(3_000, 12)) * 10.0 ** rng.integers(-9, 2, (3_000, 1))
    rows[1_000:2_000] = rows[1_000] + rng.normal(size=(1_000, 12)) * 1e-7
    rows[5] = rows[2_500] = 0.0
    queries = np.vstack([rows[990:1_010], rows[::150], np.zeros((1, 12)), rng.normal(size=(40, 12))])
    own = rng.permutation(3_000)[: len(queries)]
    search = module.Search(k, metric, ["id"], "v", [], True).asking(queries, pa.array(own, pa.int64()))
    (got,) = search.merge(list(search.candidates(block(rows, range(3_000)), np.arange(len(queries)), search.first_bars())))
    raw = module.score_block(search.queries, module.unit_rows(rows) if metric == "cosine" else rows, metric)
    raw[np.arange(len(queries)), own] = module.EXCLUDED
    want = np.where(np.isinf(raw), module.EXCLUDED, module.settle(raw, metric))
    mask, _ = module.best_mask(want, k)
    q = got.column("_q").to_numpy()
    assert (np.bincount(q, minlength=len(queries)) == k).all()
    score = got.column("score").to_numpy().reshape(-1, k)
    best = -np.sort(-np.where(mask, want, -np.inf), axis=1)[:, :k]
    assert np.allclose(score, best, rtol=1e-9, atol=2e-6)


def test_vectors_beyond_single_precision():
    rows = np.array([[1e200, 0.0], [3.0, 0.0], [2.0, 0.0], [np.nan, 0.0], [np.inf, 1.0], [1e-200, 0.0], [0.0, 0.0]])
    queries = np.array([[1.0, 1.0], [1e-200, 1.0], [0.0, 0.0], [np.nan, 1.0]])
    (got,) = scored("dot", rows, range(7), queries, [None] * 4, k=7)
    hits = [[r["id"] for r in got.to_pylist() if r["_q"] == q] for q in range(4)]
    assert hits == [[4, 0, 1, 2, 5, 6, 3], [4, 0, 1, 2, 5, 6, 3], [0, 1, 2, 5, 6, 3, 4], list(range(7))]


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_screened_scores_stay_in_the_cache(monkeypatch, metric):
    """At most TILE of them at a time, and pairs are scored exactly once a strip, not once a tile."""
    monkeypatch.setattr(module, "TILE", 1 << 13)
    monkeypatch.setattr(module, "STRIP", 32)
    rng = np.random.default_rng(9)
    rows, queries = rng.normal(size=(8_000, 8)), rng.normal(size=(64, 8))
    sizes, calls = [], []

    class Seen(module.Screen):
        def winners(self, *args):
            found = super().winners(*args)
            sizes.append(self.room.size)
            return found

    monkeypatch.setattr(module, "Screen", Seen)
    exact = module.pair_scores
    monkeypatch.setattr(module, "pair_scores", lambda *args: calls.append(args[2].size) or exact(*args))
    (got,) = scored(metric, rows, range(8_000), queries, [None] * len(queries))
    assert max(sizes) <= module.TILE and len(calls) == 2
    assert [(r["_q"], r["id"]) for r in got.to_pylist()] == [(q, i) for q, i, _ in plain(metric, rows, range(8_000), queries, [None] * len(queries))]


@pytest.mark.parametrize("rows", [1, 15, 16, 17, 1_023, 1_040])
def test_rows_that_fill_up_a_group_are_no_hits(monkeypatch, rows):
    monkeypatch.setattr(module, "TILE", 1 << 11)
    monkeypatch.setattr(module, "STRIP", 32)
    vectors = -np.abs(np.random.default_rng(rows).normal(size=(rows, 6)))  # a row of zeros would score higher
    found = scored("dot", vectors, range(rows), -vectors[:40], list(range(40))[: len(vectors[:40])])
    got = [(r["_q"], r["id"]) for table in found for r in table.to_pylist()]
    assert got == [(q, i) for q, i, _ in plain("dot", vectors, range(rows), -vectors[:40], list(range(40)))]
