"""Class-conditional models: equal to a plain one, and they find what they should."""

import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from papyra.llm import toxicity

EDGE = "doc_id long, text string, score string, predicted string, _text string"


def labelled(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")


def plain_evidence(texts, discount, asked):
    """Both models word by word, from dictionaries; no arrays, no tables."""
    around = [set(), set()]
    for text, label in texts:
        words = text.lower().split()
        around[label].update(zip(["", ""] + words, [""] + words, words, words[1:] + [""]))
    n = [Counter((v, w) for _, v, w, _ in found) for found in around]
    either = Counter(w for _, w in {*n[0], *n[1]})
    kinds, everything = len(either), sum(either.values())
    shared = lambda w: (max(either[w] - 0.75, 0) + 0.75 * kinds / (kinds + 1)) / everything

    def level(counts):
        """Shares above the discount and what is left, for one context."""
        totals = [sum(c.values()) for c in counts]
        scaled = [discount * t / max(max(totals), 1e-300) for t in totals]
        own = [{w: max(x - d, 0) for w, x in c.items()} for c, d in zip(counts, scaled)]
        kept = [sum(o.values()) for o in own]
        left = [1 - k / t if t else 1.0 for k, t in zip(kept, totals)]
        if all(kept):
            left = [max(left)] * 2
        return [{w: x * (1 - l) / k for w, x in o.items() if k} for o, k, l in zip(own, kept, left)], left

    follows = [Counter(w for _, w in c) for c in n]
    single_own, single_left = level(follows)
    contexts = defaultdict(lambda: [Counter(), Counter()])
    for label in (0, 1):
        for (v, w), x in n[label].items():
            contexts[v][label][w] += x

    def p(label, v, w):
        q = single_own[label].get(w, 0) + single_left[label] * shared(w)
        if v not in contexts:
            return q
        own, left = level(contexts[v])
        return own[label].get(w, 0) + left[label] * q

    found = []
    for text in asked:
        words = text.lower().split()
        ratios = [math.log(p(1, v, w) / p(0, v, w)) if either[w] else (math.log(level(contexts[v])[1][1] / level(contexts[v])[1][0]) if v in contexts else 0.0)
                  for v, w in zip([""] + words, words)]
        width = min(12, len(words))
        found.append(max((sum(ratios[i : i + width]) / width for i in range(len(words) - width + 1)), default=0.0) if words else 0.0)
    return found


def corpus(seed, size=200):
    rng = np.random.default_rng(seed)
    word = lambda: "w" + "abcdefghijklmnopqrstuvwxyz"[min(int(rng.zipf(1.4)), 26) - 1]
    texts = []
    for i in range(size):
        words = [word() for _ in range(int(rng.integers(1, 40)))]
        if i % 3 == 0:
            words[len(words) // 2 : 0] = ["you", "vile"]
        elif i % 3 == 1:
            words += ["kind", "regards"]
        texts.append((" ".join(words), int(i % 3 == 0)))
    return texts


@pytest.mark.parametrize("discount", [0.75, 3.0, 12.0])
def test_evidence_equals_plain_models(spark, discount):
    texts = corpus(1)
    rows = spark.createDataFrame([(t, y) for t, y in texts], "text string, toxic int").repartition(3)
    model = toxicity.ToxicModel.fit(toxicity.Counts.of(toxicity.pair_counts(rows).toArrow()), discount)
    asked = [t for t, _ in corpus(2, 60)] + ["", "never seen words", "you vile", "vile", "kind regards " * 20, "wa vile unknown kind"]
    assert np.allclose([model.evidence(t) for t in asked], plain_evidence(texts, discount, asked), atol=1e-9)


def test_marker_after_many_words_phrase_and_fixed_pair(spark):
    rng = np.random.default_rng(3)
    word = lambda: "plain" + "abcdefghijklmnopqrst"[min(int(rng.zipf(1.3)), 20) - 1]
    made = lambda: [word() for _ in range(60)]
    texts = []
    for i in range(2400):
        words = made()
        kind = i % 8
        if kind == 0:
            words.insert(int(rng.integers(60)), "markerword")
        if kind == 1:
            words += ["you", "absolute", "vilething"]
        if kind == 2:
            words[20:20] = ["go", "back", "home"]
        if kind > 2:  # the words of the phrase are common apart
            for w in ("go", "back", "home", "you"):
                words.insert(int(rng.integers(60)), w)
        texts.append((" ".join(words), int(kind < 3)))
    model = toxicity.train(*labelled(spark, texts))
    say = lambda *words: model.evidence(" ".join(["plaina", *words, "plainb"]))
    assert min(say("markerword"), say("you", "absolute", "vilething"), say("go", "back", "home")) > model.cut
    assert max(say("go"), say("back", "go", "home"), say("you"), say("plainc")) < model.cut
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    wrong = [r for r in toxicity.score(docs, model).collect() if r.predicted != texts[r.doc_id][1]]
    assert len(wrong) <= 24


def test_ordinary_evidence_lowers_a_score(spark):
    name = lambda i: "name" + "abcdefghij"[i % 10] + "abcdefghij"[i // 10 % 10] + "abc"[i // 100]
    texts = [(f"some words here {name(i)} and {'vile' if i % 2 else 'kind'}", i % 2) for i in range(300)]
    model = toxicity.train(*labelled(spark, texts))
    scores = [model.score(model.evidence(t)) for t in ("and vile", "and vile and kind and kind", "nothing known", "and kind and kind")]
    assert scores[0] > scores[1] > scores[3] and scores[0] >= toxicity.THRESHOLD > scores[3]


def test_edge_rows(spark):
    model = toxicity.train(*labelled(spark, corpus(4) + [(None, 1), ("", 0)]))
    rows = [(1, None), (2, ""), (3, "wa vile " * 20_000), (4, "123 !?"), (None, "you vile"), (5, "same"), (5, "same")]
    docs = spark.createDataFrame([(i, t, "s", "p", "x") for i, t in rows], EDGE)
    scored = toxicity.score(docs, model)
    assert scored.columns == ["doc_id", "text", "_text", "score", "predicted"] and scored.schema["score"].dataType.simpleString() == "double"
    got = scored.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[1] == by_id[2] == by_id[4] < by_id[None]
    none = docs.limit(0)
    assert toxicity.score(none, model).collect() == []
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(docs, toxicity.train(none.select("doc_id", "text"), labels)).collect()} == {0}
    only = toxicity.train(docs.select("doc_id", "text"), labels.filter("toxic = 1"))
    assert toxicity.score(docs, only).count() == len(rows)


def test_fitting_needs_little_memory():
    """Several hundred thousand pairs: no list of their words, no many numbers of each."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrst"))
    word = lambda i: "".join(letters[[i % 20, i // 20 % 20, i // 400 % 20]])
    codes = np.unique(rng.integers(0, 8_000 * 8_000, 500_000))
    column = lambda numbers: pa.array([word(i) for i in numbers])
    table = pa.table({"before": column(codes // 8_000), "word": column(codes % 8_000),
                      "ordinary": rng.integers(0, 3, codes.size), "toxic": rng.integers(0, 3, codes.size)})
    tracemalloc.start()
    counts = toxicity.Counts.of(table)
    model = toxicity.ToxicModel.fit(counts, 0.75)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.words == sorted(counts.words) and counts.words[0] == toxicity.START
    assert model.pairs.size > 300_000 and peak < 60_000_000
