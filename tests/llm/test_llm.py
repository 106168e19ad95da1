"""Operators of the training-data subpackage on edge rows and against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from papyra.llm import decontaminate, graph, language, ngrams, packing, passages, runs, simhash, toxicity, warc
from papyra.llm.components import components
from papyra.llm.queries import OP9_SQL, ORACLES, QUERIES

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LONG = "lorem ipsum dolor sit amet " * 4000
SENTENCE = "One rather long line that several documents hold in common."
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, _text string"
ROWS = [
    (1, None, "en", "s", 0, "x", "y"), (2, "", "en", "s", 0, None, None), (3, LONG, None, None, None, None, None),
    (4, f"{SENTENCE}\nAlpha", "en", "s", 1, "x", "y"), (5, f"  {SENTENCE.upper()}\t\nBeta", "en", "s", 1, "x", "y"),
    (6, f"{SENTENCE}\nGamma", "de", "s", 1, "x", "y"), (7, "12345 !!", "en", "s", 1, "x", "y"),
    (None, "a text without an id", "en", "s", 1, "x", "y"), (8, "twice the same row", "en", "s", 1, "x", "y"), (8, "twice the same row", "en", "s", 1, "x", "y"),
]
KEYS = [r[0] for r in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def ids(rows):
    return sorted((r.doc_id for r in rows), key=lambda i: (i is None, i))


def rooted(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(60)] + [(999, i) for i in range(100, 140)] + [(5, 5), (700, 700)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = rooted({n for e in edges[:-1] for n in e}, edges[:-1])
    groups = lambda m: sorted(sorted(n for n in m if m[n] == r) for r in set(m.values()))
    assert groups(got) == groups(want)


def test_scores(spark, docs, none):
    rows = ngrams.scores(docs, block_tokens=50, bucket_entries=30).collect()
    assert ids(rows) == ids([type("R", (), {"doc_id": k}) for k in KEYS])
    tokens = [(k, (t or "").encode().lower().split() + [None]) for k, t, *_ in ROWS]
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0
    count = Counter(w for k, t in tokens if not held(k) for w in t)
    total, kinds = sum(count.values()), len(count)
    base = defaultdict(list)
    for k, t in tokens:
        base[k].append((len(t), sum(count[w] > 0 for w in t), round(sum(np.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in t), 6)))
    for r in rows:
        assert (r.n_tokens, r.n_known, round(r.base_score, 6)) in base[r.doc_id]
        assert r.held_out == held(r.doc_id) and r.train_tokens == total and r.score <= 0
    assert ngrams.scores(none).collect() == []


def test_pair_probabilities_sum_to_one():
    mixture = ngrams.learn([(3, 16, 0, 40), (3, -32768, 0, 60), (0, -32768, -32768, 5)])
    assert all(abs(sum(w) - 1) < 1e-9 for w in mixture.values()) and mixture[0][0] < 1e-6


def test_packing(spark, docs, none):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = packing.pack(docs, TOKENIZER, capacity=64, group=5).collect()
    want = Counter()
    for k, t, *_ in ROWS:
        made = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.update((k, i, a, made[a : a + 64].size, zlib.crc32(made[a : a + 64].tobytes())) for i, a in enumerate(range(0, made.size, 64)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(none, TOKENIZER).collect() == []


def test_packing_comes_near_the_bound_of_the_whole_table(spark):
    """Small parts, each with gaps of its own: the exchange saves bins over parts packed apart."""
    rng = np.random.default_rng(12)
    texts = [(i, "the " * int(n)) for i, n in enumerate(rng.integers(10, 50, 600))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = packing.pack(docs, TOKENIZER, capacity=64, group=30).collect()
    lengths = np.array([r.length for r in rows])
    bound = packing.lower_bound(np.bincount(lengths, minlength=65), 64)
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    alone = packing.best_fit(lengths, 64)[0].max() + 1
    assert max(fill.values()) <= 64 and len(rows) == 600
    apart = packing.packed(packing.pieces(docs, TOKENIZER, 64, 1), 64, 30, 0).select("part", "bin").distinct().count()
    assert bound <= len(fill) < apart and len(fill) <= alone * 1.05


def test_word_memory_equals_the_tokenizer():
    memory = packing.WordIds(open(TOKENIZER, encoding="utf-8").read())
    texts = ["Idiot's don't <|endoftext|> x", "İSTANBUL ΟΔΟΣ. ΟΔΟΣ", "é́ é,  x\x1cz\x85w", "a.b,c... 12,34%½", "中文 字,。 it'll_we've!", "\t\n\r\n x  y"]
    texts += ["ÀÉ İİ ŉ ǅ ﬁne ßẞ straße ªº ʰ ต ไทย नमस्ते हिन्दी", " ".join(f"Wort{chr(97 + i % 26)}{chr(97 + i // 26)}," for i in range(600)), "l" * 300 + " x"]
    want = [np.array(memory.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert memory.encode(texts) == want and memory.encode(texts) == want


def test_word_memory_when_full(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    memory = packing.WordIds(open(TOKENIZER, encoding="utf-8").read())
    for texts in (["a few words, to fill it"], ["other words. to find", "few, (rare) words!"], [""]):
        assert memory.encode(texts) == [np.array(memory.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert len(memory.known) < 20


def test_other_tokenizers_get_whole_texts():
    memory = packing.WordIds(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    texts = ["Two words,  and\nmore", "", "İ ΟΔΟΣ"]
    assert memory.encode(texts) == [np.array(memory.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_bounds_hold_for_every_packing():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins, offsets = packing.best_fit(lengths, 100)
        assert packing.lower_bound(np.bincount(lengths, minlength=101), 100) <= bins.max() + 1
        assert (np.bincount(bins, lengths) <= 100).all() and (offsets + lengths <= 100).all()


def test_graph_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    vectors = [(i, (centres[i % 40] + rng.normal(size=16) * (0.05 if i % 2 else 2)).tolist(), i % 2) for i in range(600)]
    vectors += [(1000, vectors[1][1], 1), (1001, None, 1), (1002, [0.0] * 16, 1), (1003, [float("nan")] * 16, 1), (1004, vectors[1][1], None), (None, vectors[1][1], 1), (1005, [], 1)]
    rows = graph.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int"), cap=64).collect()
    assert len(rows) == len(vectors)
    valid = [(i, np.array(v), l) for i, v, l in vectors if v and l is not None and np.isfinite(v).all() and any(v)]
    edges = [(a[0], b[0]) for x, a in enumerate(valid) for b in valid[x + 1 :]
             if a[2] == b[2] and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.93]
    degree = Counter(i for e in edges for i in e)
    got = {r.vec_id: r for r in rows}
    assert all(got[i].n_links <= degree[i] for i, *_ in vectors)
    assert sum(got[i].n_links for i, *_ in vectors) >= 0.98 * sum(degree.values())
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (1001, 1002, 1003, 1004, 1005))
    assert got[1000].component_id == got[1].component_id == got[None].component_id and not got[None].kept


def test_graph_of_no_rows(spark):
    assert graph.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_passages_keep_the_first_and_their_offsets(spark, none):
    shared = " ".join(f"shared{i}" for i in range(60)) + "."
    texts = {1: f"Intro one. {shared} End.", 2: f"Other. {shared.upper()} Tail", 3: f"{shared}\n{shared}"}
    docs = spark.createDataFrame([*texts.items(), (4, None), (5, "")], "doc_id long, text string")
    spans = passages.repeated_passages(docs)
    rows = spans.collect()
    assert {r.doc_id for r in rows} == {2, 3} and {r.keeper_doc_id for r in rows} == {1}
    assert all(texts[r.doc_id].encode()[r.start : r.stop].lower().split() == shared.encode().split() * (r.words // 60) for r in rows)
    left = {r.doc_id: r.text for r in passages.without_passages(docs, spans).collect()}
    assert left[1] == texts[1] and "shared" not in left[2].lower() and "shared" not in left[3]
    assert passages.repeated_passages(none).collect() == []


def test_simhash_equals_brute_force(spark, docs, none):
    rows = simhash.near_duplicates(docs).collect()

    def plain(text):
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = Counter((k, f"{plain(t):016x}") for k, t, *_ in ROWS)
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == prints
    nodes = sorted({int(f, 16) for _, f in prints})
    root = rooted(nodes, [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 4])
    first = {}
    for k, f in prints:
        r = root[int(f, 16)]
        first[r] = min((i for i in (first.get(r), k) if i is not None), default=None)
    assert all(r.component_id == first[root[int(r.fingerprint, 16)]] for r in rows)
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == len(first) and kept[0].__fields__ == docs.columns
    assert simhash.near_duplicates(none).collect() == []


def test_links_span_what_all_pairs_would(spark):
    rng = np.random.default_rng(3)
    values = [int(rng.integers(1 << 62)) for _ in range(40)]
    values += [values[0] ^ sum(1 << int(b) for b in rng.choice(64, 3, False)) for _ in range(200)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), tile=16).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 4 for r in edges)
    whole = rooted(signed, [(a, b) for a in signed for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= 4])
    assert rooted(signed, [(r.a, r.b) for r in edges]) == whole


def test_decontamination_equals_brute_force(spark, docs, none):
    rng = np.random.default_rng(4)
    word = lambda: "w" + str(int(rng.zipf(1.3)) % 500)
    items = [(i, " ".join(word() for _ in range(int(rng.integers(3, 40))))) for i in range(60)] + [(60, None), (61, ""), (62, "one"), (62, "one")]
    texts = []
    for i in range(120):
        words = [word() for _ in range(150)]
        if i % 3 == 0:
            planted = items[i % 60][1].split()
            if i % 2 and len(planted) > 20:
                planted[0] = "changed"
            words[40:40] = planted
        texts.append((i, " ".join(words).title()))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), benchmark).collect()}
    index = decontaminate.Index.build(items, 0.8)
    step, want = max(index.longest, 32), set()
    for i, text in texts:
        raw = text.lower().split()
        for low in range(0, max(len(raw) - step, 1), step):
            words = re.findall(r"\w+", " ".join(raw[low : low + 2 * step]))
            want |= {(i, x.item_id) for x in index.items if min(x.overlap(words)) >= 0.8}
    assert got == want and len(got) > 30
    # The item "one" stands in three of the edge rows.
    clean = decontaminate.keep_clean(docs, benchmark)
    assert clean.columns == docs.columns and ids(clean.collect()) == [1, 2, 3, 7, 8, 8, None]
    clean = decontaminate.keep_clean(docs, benchmark.filter("text <> 'one'"))
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    assert decontaminate.contaminated(none, benchmark).collect() == []
    assert decontaminate.contaminated(docs, benchmark.limit(0)).collect() == []


def test_archives_are_the_same_twice(spark, tmp_path):
    pages = [(i, f"http://x/{i}", "same" if i % 5 == 0 else f"page {i}") for i in range(100)]
    pages += [(None, None, "same"), (7, "http://x/7", "page 7"), (200, "http://x/\r\nX: y", None), (201, "http://x/201", "")]
    manifests = []
    for k, parts in enumerate((1, 4)):
        frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(parts)
        manifest = warc.write_archives(frame, f"file://{tmp_path}/{k}", shard_bytes=300, roll_bytes=900)
        manifests.append(warc.manifest_text(manifest))
        rows = warc.read_archives(warc.read_manifest(spark, f"file://{tmp_path}/{k}"), f"file://{tmp_path}/{k}").collect()
        assert len(rows) == len(pages)
        kind = {(r.page_id, r.record_type, r.refers_to) for r in rows}
        assert {(0, "response", None), (5, "revisit", 0), (None, "revisit", 0), (7, "response", None), (201, "revisit", 200)} <= kind
    assert manifests[0] == manifests[1] and len(manifests[0]) > 3
    empty = warc.write_archives(frame.limit(0), f"file://{tmp_path}/none")
    assert warc.read_archives(empty, f"file://{tmp_path}/none").collect() == []


LINES = [f"{SENTENCE}\nown line {i} of this text alone\n{SENTENCE if i % 3 else 'seldom repeated, yet long enough ' + str(i // 12)}" for i in range(60)]


@pytest.mark.parametrize("batches,fanout", [(1, 2), (2, 2), (4, 2), (4, 4), (5, 3), (8, 2), (8, 4)])
def test_lines_equal_sql(spark, batches, fanout):
    from pyspark.sql import functions as F

    rows = [(k, t) for k, t, *_ in ROWS] + [(100 + i, t) for i, t in enumerate(LINES)]
    # One id with two rows is one document; null ids are one document together.
    rows += [(300, "a line that two ids hold, one twice"), (300, "a line that two ids hold, one twice"), (301, "a line that two ids hold, one twice")]
    rows += [(None, SENTENCE), (None, SENTENCE), (310, "null ids count once, not each"), (None, "null ids count once, not each"), (None, "null ids count once, not each")]
    rows += [(320, "one id less than null and two"), (321, "one id less than null and two"), (None, "one id less than null and two")]
    kept = runs.drop_lines(spark.createDataFrame(rows, "doc_id long, text string"), batches=batches, fanout=fanout)
    got = kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(OP9_SQL).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and sum(r[2] for r in want) > 60


def test_lines_of_edge_rows(spark, docs, none):
    kept = runs.drop_lines(docs)
    assert kept.count() == len(ROWS) and set(docs.columns) <= set(kept.columns)
    assert runs.drop_lines(none).collect() == []


def test_runs_find_what_is_new(spark):
    held = runs.LineRuns(spark, fanout=2, buckets=2)
    batch = lambda *keys: spark.createDataFrame([(i, k, k) for i, k in enumerate(keys)], "doc_id long, h1 long, h2 long")
    assert {r.h1 for r in held.add(batch(1, 2)).collect()} == {1, 2}
    assert {r.h1 for r in held.add(batch(2, 3)).collect()} == {3}
    assert {r.h1 for r in held.add(batch(1, 3, 4)).collect()} == {4}
    assert {(r.h1, r.keeper) for r in held.repeated(2).collect()} == {(1, 0), (2, 1), (3, 1)}
    assert {r.h1 for r in held.add(batch(4, 5)).collect()} == {5}
    assert sorted(r.h1 for r in held.repeated(2).collect()) == [1, 2, 3, 4]
    assert {r.h1 for r in held.repeated(1).collect()} == {1, 2, 3, 4, 5}
    held.close()


def test_languages(spark, docs, none):
    words = {"aa": "mara tala sana kana", "bb": "brok vrot gluk prusk"}
    train = spark.createDataFrame([(i, " ".join([words[l]] * (i % 5 + 1)), l) for l in words for i in range(200)], "doc_id long, text string, lang string")
    model = language.train(train)
    asked = spark.createDataFrame([(1, "tala mara"), (2, "gluk! BROK"), (3, None), (4, "12 ?!")], "doc_id long, text string")
    got = {r.doc_id: r for r in language.predict(asked, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["aa", "bb", "und", "und"]
    assert got[3].rejected and got[4].rejected and all(0 <= r.score <= 1 for r in got.values())
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and not {1, 2, 7} & {r.doc_id for r in kept.collect()}
    assert language.predict(none, model).collect() == []
    assert language.predict(docs, language.train(none)).filter("lang_pred <> 'und'").count() == 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    from oracle import difference

    assert difference(spark, name, QUERIES[name], ORACLES[name], "0.001") is None


def test_pipeline_stages_keep_columns(spark, docs):
    import corpus_pipeline

    at = docs
    for name, stage in corpus_pipeline.STAGES[1:3]:
        at = stage(spark, at, "/root/testdata/sf0.001")
        assert at.columns == docs.columns, name
    packed = QUERIES["pipeline"](spark, "/root/testdata/sf0.001")
    fill = packed.groupBy("sequence_id").sum("length").collect()
    assert fill and max(r[1] for r in fill) <= 4096


@pytest.mark.parametrize("stage", range(4))
def test_pipeline_stages_on_edge_rows(spark, stage):
    """Columns with the operators' names keep their values; no row without cause goes."""
    import corpus_pipeline

    names = "doc_id long, text string, lang string, source string, n_chars long, n_lines long, n_dropped long, score double, lang_pred string, rejected boolean, fingerprint string, component_id long, gone long"
    plain = "the quick brown fox jumps over the lazy dog while the old man reads a book about the sea "
    rows = [(i, t, "en", "s", 1, 77, 5, 0.5, "q", True, "f", 9, 3) for i, t in enumerate([None, "", "123 !", plain * 3000, f"{plain}{SENTENCE}", SENTENCE, SENTENCE, plain])]
    rows.append((None, plain + "and waits", "en", "s", 1, 77, 5, 0.5, "q", True, "f", 9, 3))
    frame = spark.createDataFrame(rows, names)
    name, function = corpus_pipeline.STAGES[stage]
    made = function(spark, frame, "/root/testdata/sf0.001")
    assert made.columns == frame.columns, name
    got = made.collect()
    assert all(tuple(r)[2:] == rows[0][2:] for r in got) and {r.doc_id for r in got} <= {r[0] for r in rows}
    assert function(spark, frame.limit(0), "/root/testdata/sf0.001").collect() == []
    if name == "line_dedup":
        assert len(got) == len(rows) and {r.doc_id: r.text for r in got}[0] == ""
    if name == "benchmark_decontamination":
        assert len(got) == len(rows)
