"""The first n rows, whatever the ties, without n rows from every task in one."""

import pytest
from pyspark.sql import functions as F

from papyra.operators import dedupe
from papyra.operators.documents import select_articles


def ranked(spark, keys, parts=40):
    return spark.createDataFrame([(float(k), f"id{i:05d}") for i, k in enumerate(keys)], "rank double, id string").repartition(parts)


CASES = {
    "distinct": [(i * 7919) % 5000 for i in range(5000)],
    "a third tied at the cut": [0 if i % 9 == 0 else 1 if i % 3 == 0 else 2 + i for i in range(5000)],
    "all tied": [3] * 5000,
}


@pytest.mark.parametrize("name", list(CASES))
@pytest.mark.parametrize("n", [1, 600, 4999, 5000, 9000])
def test_equals_a_sort(spark, monkeypatch, name, n):
    rows = CASES[name]
    df = ranked(spark, rows)
    monkeypatch.setattr(dedupe, "MAX_SORTED", 0)
    got = dedupe.top_n(df, n, [F.asc("rank"), F.asc("id")], F.col("rank"))
    want = sorted((float(k), f"id{i:05d}") for i, k in enumerate(rows))[:n]
    assert sorted(map(tuple, got.collect())) == want


def test_few_rows_are_sorted_in_one_task(spark, monkeypatch):
    df = ranked(spark, CASES["distinct"])
    monkeypatch.setattr(dedupe, "MAX_SORTED", 100)
    cut = dedupe.cut_value(df, 600, F.col("rank"))
    assert 599 <= cut <= 700
    monkeypatch.setattr(dedupe, "first_ranges", None)
    text = dedupe.top_n(df, 600, [F.asc("rank"), F.asc("id")], F.col("rank"))._jdf.queryExecution().executedPlan().toString()
    assert f"rank#" in text and f"<= {float(cut)}" in text


def test_no_rows(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "MAX_SORTED", 0)
    df = ranked(spark, [1.0]).limit(0)
    assert dedupe.top_n(df, 5, [F.asc("rank"), F.asc("id")], F.col("rank")).collect() == []


def test_selection_by_sketch_is_the_same(spark, monkeypatch):
    rows = [(f"a{i % 700}", float(i % 13), int(i % 5 == 0), i) for i in range(3000)]
    meta = spark.createDataFrame(rows, "sha string, rank double, paper_br int, other int").repartition(20)
    want = sorted(map(tuple, select_articles(meta, 100).collect()))
    monkeypatch.setattr(dedupe, "MAX_SORTED", 0)
    assert sorted(map(tuple, select_articles(meta, 100).collect())) == want
