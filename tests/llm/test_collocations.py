"""Collocations from the de Bruijn graph equal counting every phrase."""

import re
from collections import Counter, defaultdict

import numpy as np

from papyra.llm import collocations

DOCS = "doc_id long, text string, lang string, n long, phrase string, gram string, words int"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_counts(docs):
    count, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, 6):
                count[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return count, total


def plain(docs, least, top):
    count, total = plain_counts(docs)
    rows = []
    for lang, f in count.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        scored = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(p, q) for q, b in often.items()):
                continue
            score, _, l, r = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        rows += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(rows)


def corpus(seed):
    rng = np.random.default_rng(seed)
    word = lambda: ["Ab", "ça", "the", "of", "x"][min(rng.zipf(1.5), 5) - 1] if rng.random() < 0.6 else f"w{min(rng.zipf(1.3), 300)}"
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [("".join(word() + ["  ", " ", " ", "\t", ". ", "\n", "?! "][rng.integers(7)] for _ in range(int(rng.integers(0, 90)))), [None, "en", "de"][i % 3]) for i in range(300)]
    docs += [(passage, "en")] * 25 + [(f"{passage} and {passage.upper()} tail", "en")] * 7
    docs += [("la la la la la la la la la", "de")] * 6 + [(None, "fr"), ("", "fr"), ("...", None), ("a\x1cb \x85c\xa0d " * 20, "und"), ("very long " * 3000, "en")]
    return docs


def test_phrases_equal_brute_force(spark):
    docs = corpus(1)
    frame = spark.createDataFrame([(i, t, l, 1, "p", "g", 2) for i, (t, l) in enumerate(docs)], DOCS).repartition(5)
    for least, top in ((12, 60), (25, 2000)):
        got = collocations.collocations(frame, min_count=least, top=top).collect()
        assert sorted(map(tuple, got)) == plain(docs, least, top) and len(got) > 20


def test_only_true_prefixes_are_kept():
    """Rare phrases end a piece; frequent ones stay whole, within pieces."""
    words = collocations.marked_words(b"a b c d. a b c d, a b x")
    hashes = collocations.WordHashes().of(words)
    bits = [np.zeros((1 << collocations.CELL_BITS) // 8, np.uint8) for _ in range(2)]
    count = Counter()
    for k, cells, whole in collocations.gram_hashes(hashes, b"en", 5):
        count.update((k, int(c)) for c in cells[whole])
    for (k, cell), n in count.items():
        if n >= 2:
            bits[k > 2][cell >> 3] |= 1 << (cell & 7)
    lengths = collocations.frequent_lengths(hashes, b"en", 5, *bits)
    assert lengths.tolist() == [4, 3, 2, 1, 0, 4, 3, 2, 1, 0, 2, 1, 1]
    everything = np.full((1 << collocations.CELL_BITS) // 8, 255, np.uint8)
    assert collocations.frequent_lengths(hashes, b"en", 5, everything, everything).tolist() == [4, 3, 2, 1, 0, 4, 3, 2, 1, 0, 3, 2, 1]


def test_counts_of_all_frequent_phrases(spark):
    docs = corpus(3)
    count, _ = plain_counts(docs)
    frame = spark.createDataFrame([(t, l) for t, l in docs], "text string, lang string")
    for k, level in collocations.phrase_counts(frame, min_count=12).items():
        got = {(r.lang, tuple(r.gram.split(" "))): r.n for r in level.collect()}
        want = {(lang, p): a for lang, f in count.items() for p, a in f.items() if len(p) == k and (k == 1 or a >= 12)}
        assert all(got[p] == a for p, a in want.items())
        assert all(a <= count[lang][p] for (lang, p), a in got.items())


def test_paths_hold_every_edge_once(spark):
    chain = [f"c{i}" for i in range(60)]
    edges = [("en", " ".join(chain[i : i + 5]), 7) for i in range(56)] + [("en", "r r r r r", 3), ("en", "r r r r s", 3)]
    loop = ["a", "b", "c", "d", "e", "f"] * 2
    edges += [("de", " ".join(loop[i : i + 5]), 4) for i in range(6)] + [("fr", " ".join(chain[:5]), 2), ("fr", " ".join(chain[1:6]), 3)]
    paths = collocations.compact(spark.createDataFrame(edges, "lang string, gram string, n long"), 5).collect()
    got = Counter()
    for r in paths:
        words = r.path.split(" ")
        assert len(words) == r.edges + 4
        got.update({(r.lang, " ".join(words[i : i + 5]), r.n): 1 for i in range(r.edges)})
    assert got == Counter(edges)
    assert len([r for r in paths if r.lang == "en" and r.n == 7]) < 40 and len([r for r in paths if r.lang == "fr"]) == 2


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.collocations(frame).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None)], "text string, lang string")).collect() == []
