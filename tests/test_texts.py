"""Flattening, chunking, vectors and prompts on hand-made texts."""

import hashlib
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from papyra.operators.chunk import SEPARATORS, chunk_fixed, chunk_recursive, split_spans
from papyra.operators.context import contexts, prompts
from papyra.operators.documents import flatten_articles
from papyra.operators.embed import embed_terms, embed_with
from papyra.operators.quality import chunk_quality
from papyra.plans.gold import gold_table
from papyra.sources.schemas import ARTICLE


def docs(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def article(key, abstract, body):
    part = lambda texts: None if texts is None else [{"text": t} for t in texts]
    return (key, None, part(abstract), part(body))


def test_flatten(spark):
    rows = [article("a", ["x", "y"], ["z"]), article("b", [], []), article("c", None, ["w"]), article("d", [" "], None)]
    df = spark.createDataFrame(rows, ARTICLE)
    assert {r.cord_uid: r.text for r in flatten_articles(df).collect()} == {"a": "x y \n z", "c": " \n w"}
    assert [r.cord_uid for r in flatten_articles(df, require_abstract=True).collect()] == ["a"]


def test_fixed_window_counts(spark):
    lengths = [0, 1, 999, 1000, 1001, 1900, 1901]
    df = docs(spark, ["x" * n for n in lengths] + ["  \n\t ", None])
    counts = {r.id: r["count"] for r in chunk_fixed(df, ["id"]).groupBy("id").count().collect()}
    assert [counts.get(i, 0) for i in range(9)] == [0, 1, 1, 1, 2, 2, 3, 0, 0]


@pytest.mark.parametrize("size,overlap", [(10, 0), (10, 3), (10, 5), (10, 8), (7, 6)])
def test_fixed_windows_equal_slices(spark, size, overlap):
    values = ["é🙂" * 5 + "ab\ncd" * n for n in range(0, 9)] + ["x" * n for n in range(1, 40)]
    got = {}
    for r in chunk_fixed(docs(spark, values), ["id"], size=size, overlap=overlap).collect():
        got.setdefault(r.id, []).append((r.chunk_no, r.chunk_text))
    step = size - overlap
    for i, text in enumerate(values):
        n = max(1, math.ceil((len(text) - overlap) / step))
        assert sorted(got[i]) == [(k, text[k * step : k * step + size]) for k in range(n)]


def naive_chunks(text, size, overlap, separators):
    """The contract again, with strings and lists instead of offsets."""

    def pack(pieces):
        out, now = [], []
        for p in pieces:
            if now and sum(map(len, now)) + len(p) > size:
                out.append("".join(now))
                while now and (sum(map(len, now)) > overlap or sum(map(len, now)) + len(p) > size):
                    now.pop(0)
            now.append(p)
        if now:
            out.append("".join(now))
        return out

    def run(part, seps):
        while seps and seps[0] and seps[0] not in part:
            seps = seps[1:]
        if not seps:
            return [part]
        if seps[0]:
            head, *tail = part.split(seps[0])
            pieces = [p for p in [head] + [seps[0] + t for t in tail] if p]
        else:
            return pack(list(part))
        out, short = [], []
        for p in pieces:
            if len(p) < size:
                short.append(p)
            else:
                out += pack(short) + run(p, seps[1:])
                short = []
        return out + pack(short)

    return [c.strip() for c in run(text, list(separators)) if c.strip()]


@settings(max_examples=400, deadline=None)
@given(
    st.text(alphabet="ab. \né", max_size=160),
    st.integers(4, 24),
    st.integers(0, 6),
)
def test_recursive_equals_naive(text, size, overlap):
    overlap = min(overlap, size - 1)
    spans = split_spans(text, size, overlap)
    assert [text[a:b] for a, b in spans] == naive_chunks(text, size, overlap, SEPARATORS)
    assert all(b - a <= size for a, b in spans)
    covered = 0
    for a, b in spans:
        assert not text[covered:a].strip()
        covered = max(covered, b)
    assert not text[covered:].strip()


def test_recursive_prefers_blank_lines(spark):
    first, second = "word " * 150, "other " * 100
    rows = chunk_recursive(docs(spark, [f"{first}\n\n{second}\n\n{'z' * 2500}", None, " \n "]), ["id"]).orderBy("chunk_no").collect()
    assert rows[0].chunk_text == first.strip() and rows[1].chunk_text == second.strip()
    assert max(len(r.chunk_text) for r in rows) <= 1000
    assert [r.chunk_no for r in rows] == list(range(len(rows)))
    assert {r.id for r in rows} == {0}


def test_recursive_flushes_large_results(spark):
    df = docs(spark, ["lorem ipsum. " * 500] * 50)
    rows = chunk_recursive(df, ["id"], rows_per_batch=7)
    want = naive_chunks("lorem ipsum. " * 500, 1000, 100, SEPARATORS)
    assert rows.count() == 50 * len(want)
    assert rows.where("id = 31").select("chunk_text").distinct().count() == len(set(want))


def test_term_vectors(spark):
    values = ["The cat, the CAT! the dog", "", "éàü ç", None, "x" * 3 + " 42"]
    got = {r.id: r.v for r in embed_terms(docs(spark, values), "text", "v").collect()}
    for i, text in enumerate(values):
        if text is None:
            continue
        want = np.zeros(384)
        for word in re.findall("[a-z0-9]+", text.lower()):
            want[int(hashlib.md5(word.encode()).hexdigest()[:7], 16) % 384] += 1
        length = np.linalg.norm(want)
        assert np.allclose(got[i], want / length if length else want, atol=1e-7)


def test_model_hook(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    got = {r.id: r.v for r in embed_with(docs(spark, ["abc", None]), load, "text", "v").collect()}
    assert got == {0: [3.0, 1.0], 1: [0.0, 1.0]}


def test_gold_table(spark):
    articles = spark.createDataFrame([article("a", ["one"], ["two " * 600]), article("b", ["lost"], [])], ARTICLE)
    cited = spark.createDataFrame([("a", "T", None)], "cord_uid string, title string, ranking double")
    gold = gold_table(articles, cited)
    rows = gold.collect()
    # The long second line is cut by itself, so the first line stays alone.
    want = naive_chunks("one \n " + "two " * 600, 1000, 100, SEPARATORS)
    assert [r.chunk_text for r in sorted(rows, key=lambda r: r.chunk_no)] == want
    assert {(r.cord_uid, r.title) for r in rows} == {("a", "T")}
    assert set(gold.columns) == {"cord_uid", "title", "ranking", "chunk_no", "chunk_text", "chunk_text_vector"}


def test_quality(spark):
    df = spark.createDataFrame([("a", "x" * 5), (None, "y"), ("b", None)], "cord_uid string, chunk_text string")
    assert tuple(chunk_quality(df, 4).first()) == (3, 1, 1, 1, 5)


def test_prompt(spark):
    hits = spark.createDataFrame(
        [(1, 2, "second", "T2", "A", "J", "2020", "d2"), (1, 1, "first", "T1", None, "J", None, "d1")],
        "query_id int, rank int, chunk_text string, title string, authors string, journal_name string, "
        "dt_publicacao string, doi string",
    )
    context = contexts(hits)
    text = context.first().context
    assert text.startswith("SOURCE: T1\nAUTHORS: N/A\nJOURNAL: J (N/A)\nDOI: d1\nCONTENT: first\n---")
    assert text.index("T1") < text.index("T2") and "J (2020)" in text
    asked = spark.createDataFrame([(1, "why?"), (2, "none?")], "query_id int, question string")
    made = {r.query_id: r.prompt for r in prompts(asked, context, "Read.").collect()}
    assert text in made[1] and made[1].endswith("QUESTION: why?\n\nANSWER:")
    assert "none?" in made[2]
