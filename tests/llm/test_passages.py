import random
import re
from collections import Counter

from papyra.llm.passages import Pieces, candidates, repeated_passages, without_passages

WORDS = [f"word{i}" for i in range(5000)]


def line(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def covered(spans, doc_id):
    return sum(s["words"] for s in spans if s["doc_id"] == doc_id)


def test_run_inside_longer_lines(spark):
    """A shared run that holds no whole sentence or line."""
    run = line(1, 60)
    rows = [(i, f"{line(10 * i, 40)} {run} {line(10 * i + 1, 40)}") for i in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = repeated_passages(docs).collect()
    assert covered(spans, 1) == 0
    for i in range(2, 9):
        assert 60 - 27 <= covered(spans, i) <= 60
    for s in spans:
        cut = dict(rows)[s["doc_id"]].encode()[s["start"] : s["stop"]].decode()
        assert cut in run and len(cut.split()) == s["words"] and s["keeper_doc_id"] < s["doc_id"]


def test_run_of_few_whole_sentences(spark):
    """Whole sentences of 20 words between halves of others: under 30 words in whole units."""
    first, whole, last = line(2, 15), line(3, 20), line(4, 15)
    run = f"{first}. {whole}. {last}"
    docs = spark.createDataFrame([(1, f"{line(5, 9)} {run} {line(6, 9)}."), (2, f"{line(7, 9)} {run} {line(8, 9)}.")], "doc_id long, text string")
    assert covered(repeated_passages(docs).collect(), 2) >= 30


def test_whole_lines_as_before_and_no_loss(spark):
    block = f"{line(20, 20)}.\n{line(21, 20)}."
    docs = spark.createDataFrame([(1, f"One.\n{block}\nTwo."), (2, f"Three.\n{block}\nFour."), (3, "same " * 100)], "doc_id long, text string")
    spans = repeated_passages(docs)
    left = {r["doc_id"]: r["text"] for r in without_passages(docs, spans).collect()}
    assert left[1].count("word") == 40 and left[2].split() == ["Three.", "Four."]
    assert len(left[3].split()) >= 30


def test_pieces_equal_a_plain_reading():
    """Units and windows of odd texts, made one by one from the same rules."""

    def plain(text):
        rows, word, unit = set(), 0, 0
        for found in re.finditer(rb"[^\n]+?(?:[.!?]+(?=\s)|(?=\n)|\Z)", text):
            words = found.group().split()
            if words:
                rows.add((unit, word, found.start(), found.end(), len(words)))
                word, unit = word + len(words), unit + 1
        return rows

    rng = random.Random(3)
    marks = ["a", "B", "c.", "!", ".", "?!", " ", " ", "\n", "\n ", "\t", " \n", "...", "\x0b", "é", "\r\n"]
    texts = ["".join(rng.choices(marks, k=rng.randint(0, 200))).encode() for _ in range(400)] + [b"", b"\n", b" ", b".", b"a"]
    pieces = Pieces(texts, 12)
    made = [set() for _ in texts]
    for doc, *row in zip(*(getattr(pieces, c).tolist() for c in ("doc", "unit", "word", "start", "stop", "words"))):
        if row[0] >= 0:
            made[doc].add(tuple(row))
        else:
            cut = texts[doc][row[2] : row[3]].split()
            assert cut == texts[doc].split()[row[1] : row[1] + 12] and row[4] == 12
    assert made == [plain(t) for t in texts]
    alone = [Pieces([t], 12) for t in texts]
    assert pieces.unit.size == sum(p.unit.size for p in alone)
    assert sorted(pieces.hashes.tolist()) == sorted(h for p in alone for h in p.hashes.tolist())


def test_candidates_equal_counting(spark):
    """Every hash that occurs twice, in one part or in several, and no other."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        texts = [f"{line(i % 4, 35)}. {line(100 + i, 35)}." for i in range(24)] + [f"{line(7, 4)}."] * 3 + ["", "One. One."]
        docs = spark.createDataFrame(list(enumerate(t.encode() for t in texts)), "doc long, text binary").repartition(5)
        got = {(r.doc, h) for r in candidates(docs, 30).collect() for h in r.hashes}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    hashes = [Pieces([t.encode()], 30).hashes.tolist() for t in texts]
    counts = Counter(h for found in hashes for h in found)
    assert got == {(i, h) for i, found in enumerate(hashes) for h in found if counts[h] > 1} and len(got) > 40


def test_odd_rows(spark):
    """Null ids rank last, rows alike are one document, other columns stay."""
    run = f"{line(30, 40)}."
    rows = [(None, run, "x", 1), (5, run, "y", 2), (5, run, "z", 3), (2, f"{run}\nMore.", None, 4), (7, None, "n", 5), (8, "", "e", 6),
            (9, " ".join([run] * 3000), "long", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, words long")
    spans = repeated_passages(docs)
    assert {(s.doc_id, s.keeper_doc_id) for s in spans.collect()} == {(None, 2), (5, 2), (9, 2)}
    left = without_passages(docs, spans)
    assert sorted(left.columns) == sorted(docs.columns)
    kept = {r["words"]: (r["text"], r["start"]) for r in left.collect()}
    assert kept == {1: ("", "x"), 2: ("", "y"), 3: ("", "z"), 4: (f"{run}\nMore.", None), 5: ("", "n"), 6: ("", "e"), 7: ("", "long")}
    none = docs.filter("false")
    assert repeated_passages(none).collect() == [] and without_passages(none, repeated_passages(none)).collect() == []
