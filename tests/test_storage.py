"""Files, tables, incremental runs and change sets."""

import gzip
import json

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from papyra.operators.changes import apply_changes, snapshot_diff
from papyra.plans.enrich import doi_set
from papyra.sinks.writers import write_by, write_csv, write_jsonl, write_parquet, write_table
from papyra.sources.files import (
    file_audit,
    list_documents,
    read_articles,
    read_csv,
    read_ids,
    read_json,
    read_metadata,
    read_ranks,
    read_records,
    read_table,
    well_formed,
)
from papyra.sources.schemas import METADATA_COLUMNS, RECORD
from papyra.streaming.records import match_records_incremental, matched_records, matches_per_file
from papyra.streaming.refresh import compact, current, refresh
from papyra.suite import storage


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "metadata.csv"
    header = ",".join(METADATA_COLUMNS)
    line = lambda uid, abstract: ",".join([uid, "s"] + [""] * 6 + [abstract, "2020"] + [""] * 9)
    path.write_text("\n".join([header, line("a", '"has ""q"", in"'), line("b", '"two\nlines"'), ""]))
    df = read_metadata(spark, str(path), ["cord_uid", "abstract", "publish_time"])
    assert rows(df) == [("a", 'has "q", in', "2020"), ("b", "two\nlines", "2020")]


def test_csv_roundtrip_keeps_blanks_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 1), ('"', None), ("x\r\ny", 3), ("", 4), (None, 5)], "t string, n int")
    write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), "t string, n int")
    want = df.withColumn("t", F.when(F.col("t") != "", F.col("t")))
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))


def test_rank_and_id_lists(spark, tmp_path):
    (tmp_path / "jcr.csv").write_text("ISSN,Full Journal Title,Rank,Journal Impact Factor\n1234-5678,\"A, B\",n/a,1.5\n")
    assert rows(read_ranks(spark, str(tmp_path / "jcr.csv"))) == [("1234-5678", "A, B", "n/a", "1.5")]
    (tmp_path / "ids.csv").write_text("sha\nabc\n")
    assert rows(read_ids(spark, str(tmp_path / "ids.csv"))) == [("abc",)]


def test_pretty_printed_articles_in_folders(spark, tmp_path):
    doc = {"paper_id": "p1", "metadata": {"authors": []}, "abstract": [{"text": "x"}], "body_text": [], "more": 1}
    for i, folder in enumerate(["a", "b/c"]):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / f"d{i}.json").write_text(json.dumps({**doc, "paper_id": f"p{i}"}, indent=2))
    (tmp_path / "a" / "bad.json").write_text('{"paper_id": "p9", ')
    (tmp_path / "a" / "empty.json").write_text("")
    df = read_articles(spark, str(tmp_path))
    assert rows(well_formed(df).select("paper_id", F.col("abstract.text")[0])) == [("p0", "x"), ("p1", "x")]
    audit = {r.file.rsplit("/", 1)[1]: (r.good, r.corrupt) for r in file_audit(df).collect()}
    assert audit == {"d0.json": (1, 0), "d1.json": (1, 0), "bad.json": (0, 1)}
    listed = list_documents(spark, str(tmp_path))
    assert rows(listed.select("sha")) == [("bad",), ("d0",), ("d1",)]


def test_file_audit_reads_all_columns(spark, tmp_path):
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write('{"DOI": "1", "ISSN": ["x"]}\n{"DOI": "2", "ISSN": "not an array"}\nnonsense\n')
    (tmp_path / "b.jsonl").write_text('{"DOI": "3"}\n')
    (tmp_path / "c.jsonl").write_text("")
    audit = file_audit(read_json(spark, str(tmp_path), RECORD))
    got = {r.file.rsplit("/", 1)[1]: (r.good, r.corrupt) for r in audit.collect()}
    assert got == {"a.jsonl.gz": (1, 2), "b.jsonl": (1, 0)}
    assert sorted(r.DOI for r in read_records(spark, str(tmp_path)).where("ISSN IS NOT NULL").collect()) == ["1"]


def test_folders_per_year_are_pruned(spark, tmp_path):
    df = spark.range(100).select("id", (F.lit(2020) + F.when(F.col("id") < 60, 0).otherwise(1)).alias("year"))
    write_by(df, str(tmp_path / "y"), "year")
    back = spark.read.parquet(str(tmp_path / "y")).where("year = 2021")
    assert back.count() == 40
    assert "PartitionFilters: [isnotnull(year" in back._jdf.queryExecution().executedPlan().toString()
    assert {p.name for p in (tmp_path / "y").glob("year=*")} == {"year=2020", "year=2021"}


def test_table_overwrite_replaces_schema(spark, tmp_path):
    write_table(spark.range(3), "papyra_test_table", str(tmp_path / "t"))
    write_table(spark.range(2).select(F.lit("x").alias("a"), "id"), "papyra_test_table", str(tmp_path / "t"))
    assert read_table(spark, "papyra_test_table").columns == ["a", "id"]
    assert read_table(spark, "papyra_test_table").count() == 2
    spark.sql("DROP TABLE papyra_test_table")


def test_record_matching_resumes(spark, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    records = lambda ids: spark.createDataFrame([(i, ["1"]) for i in ids], RECORD).coalesce(1)
    dois = doi_set(spark.createDataFrame([("a",), ("b",)], "doi string"))
    run = lambda: match_records_incremental(spark, source, dois, out, progress)
    write_jsonl(records(["a", "x", "a "]), f"{source}/1", gzip=True)
    run()
    assert matched_records(spark, out).count() == 2
    run()
    assert matched_records(spark, out).count() == 2
    write_jsonl(records(["b"]), f"{source}/2", gzip=True)
    run()
    assert rows(matched_records(spark, out).select("DOI")) == [("a",), ("a",), ("b",)]
    assert sorted(r.matches for r in matches_per_file(matched_records(spark, out)).collect()) == [1, 2]


def test_diff_and_apply(spark):
    schema = "id int, a string, b string"
    old = spark.createDataFrame([(1, "x", None), (2, None, "y"), (3, "z", "z"), (4, "", "")], schema)
    new = spark.createDataFrame([(1, None, "x"), (3, "z", "z"), (4, "", None), (5, "n", "n")], schema)
    changes = snapshot_diff(old, new, ["id"])
    assert sorted((r.id, r.change) for r in changes.collect()) == [(1, "update"), (2, "delete"), (4, "update"), (5, "insert")]
    after = apply_changes(old, changes, ["id"])
    assert sorted(map(str, after.collect())) == sorted(map(str, new.collect()))
    assert snapshot_diff(new, after, ["id"]).count() == 0


def test_refresh_applies_each_change_once(spark, tmp_path):
    index, inbox, progress = (str(tmp_path / x) for x in ("index", "inbox", "progress"))
    schema = "id int, t string, change string"
    write_parquet(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, t string"), f"{index}/base")
    drops = [[(1, "a2", "update"), (2, None, "delete")], [(2, "b3", "insert"), (4, "d", "insert"), (1, "a3", "update")]]
    for drop in drops:
        spark.createDataFrame(drop, schema).coalesce(1).write.mode("append").parquet(inbox)
        refresh(spark, inbox, schema, ["id"], index, progress)
        refresh(spark, inbox, schema, ["id"], index, progress)
    want = [(1, "a3"), (2, "b3"), (3, "c"), (4, "d")]
    assert rows(current(spark, index, ["id"])) == want
    compact(spark, index, ["id"], str(tmp_path / "new"))
    assert rows(spark.read.parquet(str(tmp_path / "new" / "base"))) == want


def test_records_are_the_same_whatever_is_selected(spark, tmp_path):
    from papyra.sources.files import read_records, rejected_records

    good = '{"DOI": "10.1/a", "ISSN": ["1"], "title": ["t"]}'
    scalar = '{"DOI": "10.1/b", "ISSN": "1"}'
    (tmp_path / "r.json").write_text(f"{good}\n{scalar}\n{{broken\n")
    rows = read_records(spark, str(tmp_path))
    assert rows.count() == 1
    assert [r.DOI for r in rows.select("DOI").collect()] == ["10.1/a"]
    assert len(rows.collect()) == 1
    assert rejected_records(spark, str(tmp_path)).count() == 2


def test_diff_sees_microseconds(spark):
    from papyra.operators.changes import snapshot_diff

    row = lambda text: spark.sql(f"SELECT 1 AS id, timestamp '{text}' AS at")
    changed = snapshot_diff(row("2024-01-01 00:00:00.000001"), row("2024-01-01 00:00:00.000002"), ["id"])
    assert [r.change for r in changed.collect()] == ["update"]


def test_folders_per_row_are_written_by_all_cores(spark, tmp_path, monkeypatch):
    suppliers = [(i, i % 5) for i in range(60)] + [(7, 1), (None, 2)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    seen = []
    monkeypatch.setattr(storage, "list_documents", lambda spark, path: seen.append(list_documents(spark, path)) or seen[0])
    found = [r.sha for r in storage.id_listing(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted([*map(str, range(60)), "__HIVE_DEFAULT_PARTITION__"])
    tasks = {r.task for r in seen[0].select(F.regexp_extract("file", "/part-([0-9]+)-", 1).alias("task")).collect()}
    assert len(tasks) > 1


def test_folders_need_no_move_when_the_job_ends(spark, tmp_path, monkeypatch):
    options = {}
    kept = DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, key, value: options.update({key: value}) or kept(self, key, value))
    write_jsonl(spark.createDataFrame([(1, "a"), (2, "b")], "id long, k string"), f"{tmp_path}/named", by=["k"])
    assert options["mapreduce.fileoutputcommitter.algorithm.version"] == "2"
    assert sorted((r.id, r.k) for r in spark.read.json(f"{tmp_path}/named").collect()) == [(1, "a"), (2, "b")]
