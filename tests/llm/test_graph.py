import numpy as np
import pytest

from papyra.llm import graph

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(vectors, threshold=0.93):
    """Links per row, all pairs."""
    unit = np.array([v for _, v, _ in vectors])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    labels = np.array([l for *_, l in vectors])
    linked = (unit @ unit.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    return linked


def roots(linked):
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        front = [i] if root[i] < 0 else []
        while front:
            at = front.pop()
            if root[at] < 0:
                root[at] = i
                front += np.flatnonzero(linked[at] & (root < 0)).tolist()
    return root


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows one tight group, and many pairs beside it."""
    rng = np.random.default_rng(11)
    near = lambda v: v + rng.normal(size=v.size) * 0.03
    centre = rng.normal(size=16)
    rows = [near(centre) for _ in range(500)]
    for _ in range(500):
        v = rng.normal(size=16)
        rows += [v, near(v)]
    return [(i, rows[at].tolist(), 0) for i, at in enumerate(rng.permutation(len(rows)))]


def test_counts_and_components_of_a_hot_group(spark, skewed):
    got = {r.vec_id: r for r in graph.near_duplicates(spark.createDataFrame(skewed, SCHEMA), cap=128).collect()}
    linked = brute(skewed)
    degree, root = linked.sum(axis=1), roots(linked)
    assert all(got[i].n_links <= degree[i] for i in got)
    shares = np.array([got[i].n_links / degree[i] for i in got if degree[i]])
    assert shares.mean() >= 0.98
    measured = got[0]
    assert abs(measured.recall_large - 1) < 0.05 and abs(measured.recall_small - shares.mean()) < 0.05
    if (shares == 1).all():
        assert all(got[i].component_id == root[i] for i in got)
    # A row without links is alone, one with links is not.
    sizes = np.bincount([r.component_id for r in got.values()], minlength=len(got))
    assert all((r.n_links > 0) == (sizes[r.component_id] > 1) for r in got.values())


def test_audit_sees_links_lost_beside_a_hot_group(spark, skewed):
    """All pairs lost, the hot group whole: by links 0.996, by nodes a third."""
    rows = graph.placed(spark.createDataFrame(skewed, SCHEMA))
    nodes = rows.selectExpr("node", "space", "vec", "1L AS n", "vec_id AS first")
    linked = brute(skewed)
    hot = np.flatnonzero(linked.sum(axis=1) > 100)
    place = {r.first: r.node for r in nodes.collect()}
    counts = spark.createDataFrame([(place[int(i)], int(linked[i].sum())) for i in hot], "node long, links long")
    rooted = spark.createDataFrame([(place[int(i)], place[int(hot[0])]) for i in hot], "node long, root long")
    small, large, lost = graph.audit(nodes, counts, rooted, 0.93, cap=128)
    assert large == 1 and small == 0 and lost > 100


def test_low_recall_is_not_returned(spark, skewed, monkeypatch):
    monkeypatch.setattr(graph, "audit", lambda *_: (0.5, 1.0, 100))
    with pytest.raises(RuntimeError, match="more probes"):
        graph.near_duplicates(spark.createDataFrame(skewed[:40], SCHEMA))


def test_counts_of_pairs_held_by_several_cells(spark):
    """Cells 1 and 2 hold both nodes of a link, cell 2 one of another link, cell 3 copies."""
    at = lambda degrees: np.array([np.cos(np.radians(degrees)), np.sin(np.radians(degrees))]).tobytes()
    nodes = spark.createDataFrame([(1, 1), (2, 5), (3, 1), (4, 1)], "node long, n long")
    held = [(1, 1, 0), (1, 2, 10), (2, 1, 0), (2, 2, 10), (2, 3, 20), (3, 4, 90)]
    shards = spark.createDataFrame([(c, 0, 1, n, at(d)) for c, n, d in held], "cell long, tile long, tiles long, node long, vec binary")
    rooted = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node long, root long")
    counts = {r.node: r.links for r in graph.link_counts(nodes, shards, rooted, 0.93).collect()}
    # cos 20 degrees is 0.9397: all three pairs link.
    assert counts == {1: 5 + 1, 2: 1 + 1, 3: 1 + 5}
