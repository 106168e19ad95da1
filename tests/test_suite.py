"""Every registered query equals its SQL."""

import pytest

from oracle import difference, duck
from papyra.suite import ORACLES, QUERIES

SF = "0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, name, QUERIES[name], ORACLES[name], SF, con) is None


@pytest.mark.parametrize("name", ["selected_docs", "missing_docs", "issn_rank", "enrich_left_flag", "doi_semi",
                                  "year_archive", "chunk_citation_join", "gold_table", "rag_prompt"])
def test_query_equals_sql_without_broadcast(spark, con, no_broadcast, name):
    assert difference(spark, name, QUERIES[name], ORACLES[name], SF, con) is None


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).columns == ["query_id", "prompt"]
