"""Benchmark decontamination: BM25 over test items with block-max WAND."""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.llm.common import arrow_map, free_name, record_batch, remembered, with_columns

WORD = re.compile(r"\w+")
SHINGLE = 5
OVERLAP = 0.8
K1, B = 1.2, 0.75
BLOCK = 4
#: Bytes of test text that one index may hold; more items make further indexes.
INDEX_BYTES = 8_000_000
#: Documents in which the words of items are counted, to tell rare from common.
SAMPLE_ROWS = 1_000
CACHED_WORDS = 300_000


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    size = min(SHINGLE, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


@dataclass
class Item:
    """A test item; its first half is the question, its second the answer.

    Shingles that cross the middle count for the question.
    """

    item_id: int
    words: list[str]

    def __post_init__(self) -> None:
        middle = len(self.words) - len(self.words) // 2
        tail = self.words[middle:]
        self.answer = shingles(tail)
        self.question = shingles(self.words) - self.answer if len(self.words) >= 2 * SHINGLE else shingles(self.words)
        if len(tail) < SHINGLE:
            self.answer = set()

    def overlap(self, words: list[str]) -> tuple[float, float, float]:
        """Shares of the whole item's, the question's and the answer's shingles that ``words`` hold."""
        by_size: dict[int, set] = {}
        for part in (self.question, self.answer):
            for size in {len(s) for s in part}:
                by_size.setdefault(size, {tuple(words[i : i + size]) for i in range(len(words) - size + 1)})
        held = lambda part: sum(s in by_size[len(s)] for s in part)
        question, answer = held(self.question), held(self.answer)
        share = lambda n, part: n / len(part) if part else 1.0
        return (question + answer) / len(self.question | self.answer), share(question, self.question), share(answer, self.answer)


@dataclass
class Index:
    """Posting lists of test items, cut into blocks with their largest weight.

    A weight is a term's BM25 part of the item's score, divided by the lowest
    score that a passage with enough overlap can have: every shingle a passage
    lacks costs at most one term that it lacks, so the lowest is the full score
    less the largest parts of as many terms as shingles may be missing. So one
    threshold, 1, serves all items, and retrieval loses none that would pass
    the check of the overlap.

    An item's gates are sets of its words, apart from each other, that each
    weigh more than a passage may lack. They are made from the rarest words on,
    by the document counts ``seldom``.
    """

    items: list[Item]
    lists: dict[str, tuple[list[int], list[float], float, list[float]]] = field(default_factory=dict)
    longest: int = 1
    token: str = field(default_factory=lambda: uuid.uuid4().hex)
    essential: dict[str, list[int]] = field(default_factory=dict)
    gates: list[list[frozenset[str]]] = field(default_factory=list)

    @staticmethod
    def build(rows: list[tuple[int, str]], overlap: float, seldom: dict[str, int] | None = None) -> Index:
        items = [Item(i, w) for i, text in rows if (w := WORD.findall((text or "").lower()))]
        index, seldom = Index(items), seldom or {}
        if not items:
            return index
        index.longest = max(max(len(x.words) for x in items), max(len((text or "").split()) for _, text in rows))
        seen = Counter(w for x in items for w in set(x.words))
        mean = sum(len(x.words) for x in items) / len(items)
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for place, item in enumerate(items):
            parts = {}
            for word, n in Counter(item.words).items():
                idf = math.log(1 + (len(items) - seen[word] + 0.5) / (seen[word] + 0.5))
                parts[word] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * len(item.words) / mean))
            spared = math.floor((1 - overlap) * len(item.question | item.answer) + 1e-9)
            least = sum(sorted(parts.values())[: max(len(parts) - spared, 1)])
            # A passage that lacks all of a gate lacks more than can be spared.
            # Rare words come first, so that few passages go on.
            needed = sum(sorted(parts.values())[max(len(parts) - spared, 1) :]) * (1 + 1e-9)
            gates, gate, at_stake = [], set(), 0.0
            for word in sorted(parts, key=lambda w: (seldom.get(w, 0), -len(w), w)):
                gate.add(word)
                at_stake += parts[word]
                if at_stake > needed:
                    gates.append(frozenset(gate))
                    gate, at_stake = set(), 0.0
            for word in gates[0]:
                index.essential.setdefault(word, []).append(place)
            index.gates.append(gates[1:])
            for word, part in parts.items():
                postings[word].append((place, part / (least * (1 - 1e-9))))
        for word, found in postings.items():
            places, weights = [p for p, _ in found], [w for _, w in found]
            tops = [max(weights[i : i + BLOCK]) for i in range(0, len(weights), BLOCK)]
            index.lists[word] = places, weights, max(weights), tops
        return index

    def reachable(self, words: set[str]) -> bool:
        """Whether some item has a word of each of its gates in ``words``."""
        for word in words & self.essential.keys():
            for place in self.essential[word]:
                if not any(words.isdisjoint(gate) for gate in self.gates[place]):
                    return True
        return False

    def search(self, words: set[str]) -> list[tuple[int, float]]:
        """Items whose score for the query reaches 1: ``(place, score)``.

        Block-max WAND: lists stand in order of their current item; the pivot is
        the first item that the lists' largest weights let reach 1. If the
        blocks at the pivot cannot reach it, all lists jump over the nearest
        block end; otherwise the item is scored.
        """
        cursors = [[lists[0][0], 0, lists] for w in words if (lists := self.lists.get(w))]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += c[2][2]
                if bound >= 1:
                    pivot = k
                    break
            if pivot is None:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            ahead = cursors[: pivot + 1]
            block_bound, end = 0.0, len(self.items)
            for c in ahead:
                places, _, _, tops = c[2]
                at = bisect_left(places, item, c[1])
                if at < len(places):
                    block = at // BLOCK
                    block_bound += tops[block]
                    end = min(end, places[min((block + 1) * BLOCK, len(places)) - 1] + 1)
            if block_bound >= 1:
                target = item + 1
                score = 0.0
                for c in ahead:
                    places, weights = c[2][0], c[2][1]
                    at = bisect_left(places, item, c[1])
                    if at < len(places) and places[at] == item:
                        score += weights[at]
                if score >= 1:
                    found.append((item, score))
            else:
                target = max(end, item + 1)
                if pivot + 1 < len(cursors):
                    target = max(min(target, cursors[pivot + 1][0]), item + 1)
            for c in ahead:
                places = c[2][0]
                c[1] = bisect_left(places, target, c[1])
                c[0] = places[c[1]] if c[1] < len(places) else None
            cursors = [c for c in cursors if c[0] is not None]
        return found


class Bounds(dict):
    """Largest weight that a word as it stands in a text can add in any item.

    It is negated where the word is essential, in the first gate of an item: an
    item reaches the threshold only if a word of each of its gates is there.
    """

    def __init__(self, index: Index):
        super().__init__()
        self.lists, self.essential = index.lists, index.essential

    def __missing__(self, word: str) -> float:
        words = [w for w in WORD.findall(word) if w in self.lists]
        value = 0.0
        if words:
            value = sum(self.lists[w][2] for w in words)
            if any(w in self.essential for w in words):
                value = -value
        if len(word) <= 64 and len(self) < CACHED_WORDS:
            self[word] = value
        return value


def leaks(text: str, index: Index, bounds: Bounds, overlap: float) -> dict[int, tuple[float, float, float]]:
    """``place: (score, question overlap, answer overlap)`` of items in a text.

    The text is read in passages that overlap by the longest item, so every
    item that a text holds lies whole in one of them. A passage whose words
    cannot reach the threshold together, or that misses a gate of every item,
    has no pivot and is passed over; so is, before that, a whole text that
    misses a gate of every item.
    """
    text = text.lower()
    if not index.reachable(set(WORD.findall(text))):
        return {}
    raw = text.split()
    parts = np.fromiter(map(bounds.__getitem__, raw), float, len(raw))
    essential = parts < 0
    if not essential.any():
        return {}
    sums = np.concatenate(([0.0], np.cumsum(np.abs(parts))))
    # A word here may hold several of an item's words, never fewer than one.
    step = max(index.longest, 32)
    found: dict[int, tuple[float, float, float]] = {}
    for low in range(0, max(len(raw) - step, 1), step):
        high = min(low + 2 * step, len(raw))
        if sums[high] - sums[low] < 1 - 1e-9 or not essential[low:high].any():
            continue
        words = WORD.findall(" ".join(raw[low:high]))
        query = set(words)
        if not index.reachable(query):
            continue
        for place, score in index.search(query):
            whole, question, answer = index.items[place].overlap(words)
            if whole >= overlap and score > found.get(place, (0.0,))[0]:
                found[place] = score, question, answer
    return found


def frequencies(docs: DataFrame, items: list[tuple[int, str]]) -> dict[str, int]:
    """Some documents that hold each word of the items: which words to ask for first.

    Counted in ``SAMPLE_ROWS`` documents at most. Any numbers give the same
    results; good ones let more passages be passed over.
    """
    wanted = docs.sparkSession.sparkContext.broadcast({w for _, text in items for w in WORD.findall((text or "").lower())})

    def run(batches):
        for batch in batches:
            held = [list(wanted.value.intersection(WORD.findall((text.as_py() or "").lower()))) for text in batch.column("text")]
            yield record_batch(words=pa.array(held, pa.list_(pa.string())))

    rows = arrow_map(docs.select(F.col("text").cast("string").alias("text")), run, "words array<string>")
    # Spark reads partitions one after the other until it has the rows asked for.
    found = Counter(w for row in rows.limit(SAMPLE_ROWS).collect() for w in row.words)
    wanted.unpersist()
    return found


def indexes(docs: DataFrame, benchmark: DataFrame, overlap: float, index_bytes: int = INDEX_BYTES):
    """Indexes over all items, each of a bounded size, made one at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-total // index_bytes)
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(shards, 1)))
    for k in range(max(shards, 1)):
        part = rows.filter(shard == k) if shards > 1 else rows
        items = sorted(((r[0], r[1]) for r in part.toLocalIterator()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        yield Index.build(items, overlap, frequencies(docs, items))


def contaminated(docs: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)`` of all leaks.

    One row per document and test item that the document holds: BM25 score (1
    is the threshold) and the shares of five-word shingles of the item's first
    and second half. The passage holds at least ``overlap`` of the whole item's
    shingles; the shares of the halves are reported only. Case and punctuation do not
    count; items shorter than a shingle must occur whole. Null and empty texts
    and items match nothing; repeated rows are reported one by one.

    The test set is cut into indexes of at most about ``index_bytes`` bytes,
    and each is broadcast in turn against all documents.
    """
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = None
    for index in indexes(docs, benchmark, overlap, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            bounds = remembered(f"bounds {index.token}", lambda: Bounds(index))
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    for place, values in sorted(leaks(text.as_py() or "", index, bounds, overlap).items()):
                        rows.append((doc_id, index.items[place].item_id, *values))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        part = arrow_map(columns, run, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")
        result = part if result is None else result.union(part)
    return result


def keep_clean(docs: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` without those that hold a test item; columns unchanged."""
    for index in indexes(docs, benchmark, overlap, index_bytes):
        read, flag = free_name(docs.columns, "_text"), free_name(docs.columns, "_leak")
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(columns, shared=shared):
            index = shared.value
            bounds = remembered(f"bounds {index.token}", lambda: Bounds(index))
            for (texts,) in columns:
                yield [pa.array([bool(leaks(t.as_py() or "", index, bounds, overlap)) for t in texts], pa.bool_())]

        flagged = with_columns(docs.withColumn(read, F.col("text").cast("string")), [read], T.StructType([T.StructField(flag, T.BooleanType())]), run)
        docs = flagged.filter(~F.col(flag)).drop(flag)
    return docs
