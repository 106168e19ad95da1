"""A refreshed index holds what a table built anew would hold."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from papyra.operators import ivf_refresh as index
from papyra.operators.knn import knn


def rows(spark, data):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], n) for i, (v, n) in sorted(data.items())], "id int, v array<double>, note string")


def changes(spark, data):
    made = [(i, None if v is None else [float(x) for x in v], n, c) for i, v, n, c in data]
    return spark.createDataFrame(made, "id int, v array<double>, note string, change string")


def listed(df):
    return sorted(tuple(r) for r in df.select("query_id", "id", "score", "note", "rank").collect())


@pytest.fixture
def state(spark, tmp_path):
    rng = np.random.default_rng(5)
    data = {i: (rng.normal(size=4) + 6 * np.eye(4)[i % 4], f"n{i}") for i in range(200)}
    path = f"file://{tmp_path}/index"
    index.build(rows(spark, data), path, 4, "v", "l2")
    asked = rows(spark, dict(list(data.items())[:12])).select(F.col("id").alias("query_id"), F.col("v").alias("query_vector"))
    return rng, data, path, asked


def check(spark, path, data, asked):
    want = listed(knn(rows(spark, data), asked, 5, ["id"], "v", metric="l2", columns=["note"]))
    cells = len(index.manifest(spark, path)[1])
    assert listed(index.search(spark, path, asked, 5, cells, ["id"], "v", metric="l2", columns=["note"])) == want
    held = sorted(r.id for r in index.current(spark, path, ["id"]).select("id").collect())
    assert held == sorted(i for i, (v, _) in data.items() if v is not None)


def test_changes_then_compaction(spark, state):
    rng, data, path, asked = state
    check(spark, path, data, asked)
    assert index.compact(spark, path, ["id"], "v", "l2") == []
    batch = [(i, None, None, "delete") for i in range(0, 40, 4)] + [(1, data[2][0], "moved", "update"), (300, data[0][0] * 1.1, "new", "insert"), (301, None, "no vector", "insert")]
    index.refresh(spark, path, changes(spark, batch), ["id"], "v", "l2", batch=0)
    for i in range(0, 40, 4):
        del data[i]
    data |= {1: (data[2][0], "moved"), 300: (np.array(batch[-2][1]), "new"), 301: (None, "no vector")}
    check(spark, path, data, asked)
    # The same batch again changes nothing; a deleted key may come back, an update may come again.
    index.refresh(spark, path, changes(spark, batch), ["id"], "v", "l2", batch=0)
    check(spark, path, data, asked)
    again = [(0, rng.normal(size=4), "back", "insert"), (1, rng.normal(size=4), "moved on", "update"), (300, None, None, "delete")]
    index.refresh(spark, path, changes(spark, again), ["id"], "v", "l2", batch=1)
    data |= {0: (again[0][1], "back"), 1: (again[1][1], "moved on")}
    del data[300]
    check(spark, path, data, asked)
    assert index.compact(spark, path, ["id"], "v", "l2")
    check(spark, path, data, asked)
    index.refresh(spark, path, changes(spark, [(0, None, None, "delete")]), ["id"], "v", "l2", batch=2)
    del data[0]
    check(spark, path, data, asked)


def test_only_reached_cells_are_written(spark, state, tmp_path):
    rng, data, path, asked = state
    cell = {r.id: r.cell for r in index.current(spark, path, ["id"]).select("id", "cell").collect()}
    index.refresh(spark, path, changes(spark, [(3, None, None, "delete")]), ["id"], "v", "l2", batch=0)
    del data[3]
    assert index.compact(spark, path, ["id"], "v", "l2") == [cell[3]]
    assert [d for d in os.listdir(f"{tmp_path}/index/rows/v=1") if d.startswith("cell=")] == [f"cell={cell[3]}"]
    check(spark, path, data, asked)
    assert index.compact(spark, path, ["id"], "v", "l2") == []


def test_cells_split_and_merge(spark, state):
    rng, data, path, asked = state
    cells = index.manifest(spark, path)[1]
    crowd = [(1000 + i, 6 * np.eye(4)[0] + [0, 0, 0, 12.0 * (i % 2)] + rng.normal(size=4) * 0.1, "c", "insert") for i in range(900)]
    leave = [(i, None, None, "delete") for i in range(1, 200, 4)]
    index.refresh(spark, path, changes(spark, crowd + leave), ["id"], "v", "l2", batch=0)
    for i in range(1, 200, 4):
        del data[i]
    data |= {i: (np.asarray(v), n) for i, v, n, _ in crowd}
    grown = {r.cell: r for r in index.drift(spark, path, ["id"]).collect()}
    assert set(grown) == set(cells) and max(r.drift or 0 for r in grown.values()) > 1.5
    index.compact(spark, path, ["id"], "v", "l2", split=1.5, merge=0.2)
    after = index.manifest(spark, path)[1]
    assert set(after) - set(cells) and set(cells) - set(after)
    assert sum(r.rows for r in after.values()) == len(data)
    check(spark, path, data, asked)


def test_everything_deleted(spark, state):
    _, data, path, asked = state
    index.refresh(spark, path, changes(spark, [(i, None, None, "delete") for i in data]), ["id"], "v", "l2", batch=0)
    assert index.search(spark, path, asked, 3, 4, ["id"], "v", metric="l2").collect() == []
    index.compact(spark, path, ["id"], "v", "l2")
    assert index.current(spark, path, ["id"]).collect() == []
    index.refresh(spark, path, changes(spark, [(1, [1.0, 0, 0, 0], "a", "insert")]), ["id"], "v", "l2", batch=1)
    assert [r.id for r in index.current(spark, path, ["id"]).collect()] == [1]
