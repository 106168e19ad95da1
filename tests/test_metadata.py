"""Hand-made edge rows for ids, dates, ranks, joins and selection."""

import pytest
from pyspark.sql import functions as F

from papyra.functions.text import file_stem, issn_key, parsed_year, prefix_year, strip, year_label
from papyra.operators.dedupe import best_per_key
from papyra.operators.documents import affiliated_ids, explode_ids, missing_documents, select_articles
from papyra.operators.joins import fits_broadcast, hot_keys, lookup_join
from papyra.plans.bronze import bronze_metadata, ids_by_year, year_sizes
from papyra.plans.clean import CONTRACT, citation_table, clean_metadata
from papyra.plans.enrich import doi_set, enrich_metadata, match_records, rank_by_issn
from papyra.plans.gold import with_citations, without_citations
from papyra.plans.silver import selection
from papyra.sources.schemas import METADATA_COLUMNS, RANK_COLUMNS, RANKS


def column(df, name):
    return [r[name] for r in df.collect()]


def texts(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_multi_id_cells_split_on_both_marks(spark):
    df = explode_ids(texts(spark, ["a; b", "c, d", " e ", None, "", "f;"], "sha"))
    assert sorted(column(df, "sha")) == list("abcdef")


def test_dates(spark):
    df = texts(spark, ["2020", "2020-03", "2019-12-31", "2021-03-04", "n/a", None, ""])
    assert column(df.select(parsed_year("x").alias("y")), "y") == [2020, 2020, 2019, 2021, None, None, None]
    assert column(df.select(prefix_year("x").alias("y")), "y") == [2020, 2020, 2019, 2021, None, None, None]
    labels = column(df.select(year_label("x").alias("y")), "y")
    assert labels == ["2020", "2020", "2019", "2021", "n/a", "N/A", "N/A"]


def test_bronze_keeps_recent_single_ids_once(spark):
    meta = spark.createDataFrame(
        [("a; b", "2020"), ("a", "2020"), ("c", "2019-12-31"), ("d", "n/a"), (None, "2021"), ("e", "2021-03")],
        "sha string, publish_time string",
    )
    rows = sorted((r.sha, r.year) for r in bronze_metadata(meta).collect())
    assert rows == [("a", 2020), ("b", 2020), ("e", 2021)]
    docs = texts(spark, ["a", "e", "z"], "sha")
    by_year = ids_by_year(bronze_metadata(meta), docs)
    assert sorted(map(tuple, year_sizes(by_year).collect())) == [(2020, 1), (2021, 1)]


def test_strip_and_keys(spark):
    df = texts(spark, ["\t10.1/x \n"])
    assert column(df.select(strip("x").alias("x")), "x") == ["10.1/x"]
    assert column(texts(spark, [" 1234-567X "]).select(issn_key("x").alias("x")), "x") == ["1234567X"]
    assert column(texts(spark, ["/a/b/c.json", "d.e.json", "f"]).select(file_stem("x").alias("x")), "x") == ["c", "d.e", "f"]


def metadata(spark, rows):
    """Enriched metadata rows from (sha, publish_time, Rank, paper_br)."""
    names = [("DOI" if c == "doi" else c) for c in METADATA_COLUMNS] + RANK_COLUMNS + ["paper_br"]
    df = spark.createDataFrame(rows, "sha string, publish_time string, Rank string, paper_br string")
    return df.select(*[F.col(c) if c in df.columns else F.concat(F.lit(c), F.col("sha")).alias(c) for c in names])


def test_clean_filters_and_contract(spark):
    df = metadata(
        spark,
        [("a", "2020", "5", "0"), ("b", "2021-01-01", "n/a", "0"), ("c", "2022", "10", "1"), ("d", "2022", None, "1"),
         ("e", "2019", "1", "1"), (None, "2022", "1", "1"), ("f", "2022", "1", "7"), ("g", "n/a", "1", "1")],
    )
    clean = clean_metadata(df)
    assert clean.columns == CONTRACT and len(CONTRACT) == 25
    assert sorted((r.sha, r.rank) for r in clean.collect()) == [("a", 5.0), ("c", 10.0)]
    assert dict(clean.dtypes)["rank"] == "double"
    assert sorted(column(clean_metadata(df, 2021), "sha")) == ["c"]
    kept = {r.sha: r.rank for r in clean_metadata(df, require_rank=False).collect()}
    assert kept == {"a": 5.0, "b": None, "c": 10.0, "d": None}


def test_rank_order_is_numeric_and_ties_go_to_the_lower_id(spark):
    meta = spark.createDataFrame(
        [("a", "10", 0), ("b", "5", 0), ("c", "n/a", 0), ("d", None, 0), ("e", "10", 0), ("f", None, 1), ("f", "3", 0)],
        "sha string, rank string, paper_br int",
    )
    assert sorted(column(select_articles(meta, 2), "sha")) == ["b", "f"]
    assert sorted(column(select_articles(meta, 3), "sha")) == ["a", "b", "f"]
    chosen = {r.sha: (r.paper_br, r.rank) for r in select_articles(meta, 9).collect()}
    assert chosen == {"a": (0, 10.0), "b": (0, 5.0), "e": (0, 10.0), "f": (1, None)}


def test_flagged_article_without_rank_is_selected_and_cited(spark):
    df = metadata(spark, [("a; b", "2020", None, "1"), ("c", "2020", "4", "0"), ("d", "2018", "1", "1")])
    chosen = selection(df, n=5)
    assert sorted(column(chosen, "sha")) == ["a", "b", "c"]
    cited = citation_table(clean_metadata(chosen, require_rank=False))
    assert sorted(column(cited, "cord_uid")) == ["a", "b", "c"]


def test_repeated_citation_ids_do_not_multiply_chunks(spark):
    clean = clean_metadata(metadata(spark, [("a", "2021", "5", "1"), ("a", "2021", "2", "0"), ("b", "2021", "1", "0")]))
    cited = citation_table(clean)
    assert sorted((r.cord_uid, r.ranking) for r in cited.collect()) == [("a", 2.0), ("b", 1.0)]
    chunks = spark.createDataFrame([("a", 0), ("a", 1), ("z", 0)], "cord_uid string, chunk_no int")
    assert with_citations(chunks, cited).count() == 2
    assert column(without_citations(chunks, cited), "cord_uid") == ["z"]


def test_best_rank_per_doi(spark):
    records = spark.createDataFrame(
        [("10.1/x", ["1111-1111", "2222-2222"]), (" 10.1/x ", ["33333333"]), ("10.1/y", None), ("10.1/z", ["9999-9999"])],
        "DOI string, ISSN array<string>",
    )
    ranks = spark.createDataFrame(
        [("1111-1111", "A", "10", "1"), ("22222222", "B", "9", "1"), ("2222-2222", "B2", "n/a", "1"), ("3333-3333", "C", "n/a", "1")],
        RANKS,
    )
    got = [tuple(r) for r in rank_by_issn(records, ranks).collect()]
    assert got == [("10.1/x", "2222-2222", "22222222", "B", "9", "1")]


def test_padded_keys_match_once(spark):
    meta = spark.createDataFrame(
        [(" 10.1/x ", " s1\t"), (None, "s2; s1"), ("10.1/q", None), ("10.1/r", " ; ")], "doi string, sha string"
    )
    ranks = spark.createDataFrame(
        [("10.1/x", "1", "1", "A", "7", "1"), (" 10.1/x", "2", "2", "B", "3", "1")],
        "DOI string, ISSN string, ISSN_key string, `Full Journal Title` string, Rank string, `Journal Impact Factor` string",
    )
    flagged = texts(spark, ["s1", " s1"], "sha")
    rows = sorted((str(r.DOI), str(r.sha), r.Rank, r.paper_br) for r in enrich_metadata(meta, ranks, flagged).collect())
    assert rows == [("10.1/q", "None", None, 0), ("10.1/r", "None", None, 0), ("10.1/x", "s1", "3", 1),
                    ("None", "s1", None, 1), ("None", "s2", None, 0)]


def test_match_records(spark):
    dois = doi_set(texts(spark, [" 10.1/x", "10.1/x", None, ""], "doi"))
    assert column(dois, "DOI") == ["10.1/x"]
    records = spark.createDataFrame([("10.1/x ", ["1"]), ("10.1/y", None)], "DOI string, ISSN array<string>")
    assert column(match_records(records, dois), "DOI") == ["10.1/x"]


def test_affiliation(spark):
    rows = [("1", [["Brazil"]]), ("2", [["Chile"], [" BRASIL "]]), ("3", [[None]]), ("4", []), ("5", None), ("6", [None])]
    nested = [
        (i, None if a is None else ([None if x is None else ((({"country": x[0]},),),) for x in a],)) for i, a in rows
    ]
    schema = (
        "paper_id string, metadata struct<authors: array<struct<affiliation: struct<location: struct<country: string>>>>>"
    )
    flat = [(i, None if m is None else {"authors": [None if x is None else {"affiliation": {"location": x[0][0][0]}} for x in m[0]]})
            for i, m in nested]
    assert sorted(column(affiliated_ids(spark.createDataFrame(flat, schema)), "sha")) == ["1", "2"]


def test_missing_documents_have_plain_names(spark):
    chosen = spark.createDataFrame([("a", 1), ("b", 2)], "sha string, `Full Journal Title` int")
    lost = missing_documents(texts(spark, ["a"], "sha"), chosen)
    assert lost.columns == ["sha", "Full_Journal_Title"] and column(lost, "sha") == ["b"]


def test_no_row_is_lost_at_old_batch_sizes(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("cord_uid"), F.lit("some text").alias("text"))
    from papyra.operators.chunk import chunk_fixed, chunk_recursive

    assert chunk_fixed(df, ["cord_uid"]).count() == 20
    assert chunk_recursive(df, ["cord_uid"]).count() == 20


@pytest.fixture
def skewed(spark):
    """A third of the rows share a key, a tenth have none."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise((F.col("id") % 700).cast("string"))
    )
    left = spark.range(0, 6000, 1, 4).select("id", key.alias("k"))
    right = spark.range(0, 500).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    return left, right.unionByName(spark.createDataFrame([("hot", -1), (None, -2)], "k string, v long"))


def test_hot_keys_are_found(spark, skewed):
    found = hot_keys(skewed[0], ["k"], 0.05)
    want = spark.sql("SELECT xxhash64('hot') AS h").first().h
    assert [r.hot for r in found.collect()] == [want]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("sketch", [False, True])
def test_lookup_join_equals_plain_join(spark, skewed, no_broadcast, how, sketch):
    left, right = skewed
    assert not fits_broadcast(right)
    got = lookup_join(left, right, "k", how, salts=4, sketch=sketch)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_rows_are_spread(spark, skewed, no_broadcast):
    left, right = skewed
    joined = lookup_join(left, right, "k", "inner", salts=8).where("k = 'hot'")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 2


def test_best_per_key_takes_the_first(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", None, "z")], "k string, n int, v string")
    got = {r.k: r.v for r in best_per_key(df, ["k"], [F.asc_nulls_last("n")]).collect()}
    assert got == {"a": "y", "b": "z"}


def test_repeated_ids_take_one_place(spark):
    from papyra.operators.documents import select_articles

    meta = spark.createDataFrame(
        [("a", 1.0, 0, "y"), ("a", 1.0, 0, "x"), ("b", 2.0, 0, "z"), ("c", 3.0, 0, "w"), ("d", None, 1, "v")],
        "sha string, rank double, paper_br int, title string",
    )
    for parts in (1, 3):
        chosen = select_articles(meta.repartition(parts), n=2).select("sha", "title").collect()
        assert sorted(map(tuple, chosen)) == [("a", "x"), ("b", "z"), ("d", "v")]
