"""Ranked search over FP-trees equals scoring every document for every item."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from papyra.llm import fptree

DOCS = "doc_id long, text string, item_id string, score string, n long, terms string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(docs, items, k):
    terms = [(d, TERM.findall((t or "").translate(UPPER))) for d, t in docs]
    n = sum(bool(t) for _, t in terms)
    total = sum(len(t) for _, t in terms)
    df = Counter(w for _, t in terms for w in set(t))
    rows = []
    for item, text in items:
        asked = TERM.findall((text or "").translate(UPPER))
        scored = []
        for d, t in terms:
            if t:
                m = 25 + 75 * len(t) * n // total
                tf = Counter(t)
                s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * tf[w] // (1000 * tf[w] + 8 * m)) for w in asked if w in tf)
                if s > 0:
                    scored.append((-s, d is None, d or 0, d))
        rows += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(rows, key=repr)


def corpus(seed, size):
    rng = np.random.default_rng(seed)
    word = lambda: f"Wört{min(rng.zipf(1.25), 400)}"
    docs = [(int(i), " ".join(word() for _ in range(int(rng.integers(1, 60))))) for i in rng.permutation(size)]
    same = docs[3][1]
    docs += [(10_000 + i, same) for i in range(size // 3)]
    docs += [(None, same), (None, "x1"), (20_000, None), (20_001, ""), (20_002, "?! ."), (5, docs[0][1]), (5, docs[0][1]), (20_003, "wört1 " * 30_000), (20_004, "A-b_c é中文 ٣")]
    items = [(i, " ".join(word() for _ in range(int(rng.integers(1, 30))))) for i in range(40)]
    items += [(7, items[7][1]), (None, "WÖRT1 b é中文"), (50, None), (51, ""), (52, "..."), (53, "nowhere"), (54, same), (55, "wört2 " * 3000)]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"block_cells": 3000, "block_bytes": 2000}])
def test_search_equals_scoring_all(spark, limits):
    docs, items = corpus(5, 400)
    frame = spark.createDataFrame([(d, t, "x", "y", 1, "z") for d, t in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = fptree.ranked_search(frame, asked, **limits).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(docs, items, 10)


def test_trees_of_any_size_find_the_same():
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 12, 500)
    terms = np.concatenate([np.sort(rng.choice(30, s, False)) for s in sizes]).astype(np.int64)
    tfs, norms = rng.integers(1, 9, len(terms)), rng.integers(25, 200, 500)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    weights = (rng.integers(0, 5000, (20, 30)) * (rng.random((20, 30)) < 0.3)).astype(np.float64)
    weights[0] = 0
    added = np.zeros((30, 500))
    for d in range(500):
        for e in range(starts[d], starts[d + 1]):
            added[terms[e], d] = fptree.contribution(tfs[e], norms[d])
    scores = weights @ added
    hits = fptree.Hits(np.ones(20, np.int64), 10)
    fptree.Tree(np.arange(500), np.zeros(500, bool), norms, starts, terms, tfs).search(weights, hits)
    item, score, doc, _ = hits.cut()
    for i in range(20):
        want = sorted((-s, d) for d, s in enumerate(scores[i]) if s > 0)[:10]
        assert list(zip(-score[item == i], doc[item == i])) == want


def test_subtrees_are_left_out():
    """Once the bar is high, a subtree without the rare term is not scored."""
    docs, size = 4000, 6
    terms = np.tile(np.arange(size), docs)

    terms[size - 1 :: size] = 10 + np.arange(docs) % 50
    weights = np.zeros((1, 60))
    weights[0, 59] = 1000
    seen = []
    tree = fptree.Tree(np.arange(docs), np.zeros(docs, bool), np.full(docs, 100), np.arange(0, size * docs + 1, size), terms, np.ones(len(terms), np.int64))
    tree.score = lambda low, high, *rest: seen.append(high - low)
    tree.search(weights, fptree.Hits(np.ones(1, np.int64), 10))
    assert 80 <= sum(seen) < docs // 10


def test_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert fptree.ranked_search(docs.limit(0), items).collect() == []
    none = fptree.ranked_search(docs, items.limit(0))
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert [tuple(r)[:3] for r in fptree.ranked_search(docs, items).collect()] == [(1, 1, 1)]
