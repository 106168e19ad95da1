"""Ranked lexical search over document FP-trees.

A document is reduced to the terms that occur in a block of items, written in
order of falling document frequency. Documents that begin alike share a path
of the tree; a subtree knows the largest frequency of each of its terms and
the smallest length norm. Together they bound every score below it, so that a
depth-first search leaves a subtree out as soon as no document in it can be
among an item's best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.llm.common import arrow_map, longs, record_batch, stored, utf8

K = 10
#: Bounds of a block of items: cells of its item x term table, and bytes of text.
BLOCK_CELLS = 1 << 22
BLOCK_BYTES = 8 << 20
#: Entries of a tree, documents of a leaf, answers kept before they are cut.
TREE_ENTRIES = 1 << 19
LEAF_DOCS = 32
HELD_HITS = 1 << 15
#: One document in so many answers first, to give each item a bar to pass.
PILOT = 64

TERM_BYTES = [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]
FOLD = bytes((i + 32 if 65 <= i <= 90 else i) if i in TERM_BYTES else 32 for i in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters beyond ASCII, A-Z lowered."""
    return text.translate(FOLD).split()


@dataclass
class Block:
    """Some items and their terms."""

    ids: list
    counts: list[Counter]
    terms: dict[bytes, int]


def item_blocks(items: DataFrame, cells: int, size: int) -> Iterator[Block]:
    """Items in blocks of bounded size, streamed through the driver one block at a time."""
    block, held = Block([], [], {}), 0
    for row in items.select("item_id", utf8(F.col("text")).alias("text")).toLocalIterator():
        text = bytes(row.text)
        count = Counter(terms_of(text))
        if not count:
            continue
        fresh = sum(t not in block.terms for t in count)
        if block.ids and (held + len(text) > size or (len(block.ids) + 1) * (len(block.terms) + fresh) > cells):
            yield block
            block, held = Block([], [], {}), 0
        block.ids.append(row.item_id)
        block.counts.append(count)
        for term in count:
            block.terms.setdefault(term, len(block.terms))
        held += len(text)
    if block.ids:
        yield block


def restricted(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: all terms counted, those of the block kept."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            totals, offsets, numbers, tfs = [], [0], [], []
            for text in batch.column("text").to_pylist():
                found = terms_of(text)
                totals.append(len(found))
                count = Counter(found)
                held = known.keys() & count.keys()
                numbers.extend(map(known.__getitem__, held))
                tfs.extend(map(count.__getitem__, held))
                offsets.append(len(numbers))
            bounds = pa.array(offsets, pa.int32())
            yield record_batch(
                doc_id=batch.column("doc_id"),
                n=pa.array(totals, pa.int64()),
                terms=pa.ListArray.from_arrays(bounds, pa.array(numbers, pa.int32())),
                tfs=pa.ListArray.from_arrays(bounds, pa.array(tfs, pa.int64())),
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    made = stored(arrow_map(columns, run, "doc_id long, n long, terms array<int>, tfs array<long>"), "vectors")
    shared.unpersist()
    return made


def contribution(tfs: np.ndarray, m) -> np.ndarray:
    """What a term adds per unit of weight; grows with ``tfs``, falls with ``m``."""
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * m)


class Hits:
    """The best documents of each item so far and the score that the next must reach."""

    def __init__(self, bars: np.ndarray, k: int):
        self.bars, self.k, self.held, self.size = bars.copy(), k, [], 0

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, nameless: np.ndarray) -> None:
        self.held.append((item, score, doc, nameless))
        self.size += len(item)
        if self.size >= HELD_HITS:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """The ``k`` best per item: high scores, then small ids, null ids last."""
        if not self.held:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        item, score, doc, nameless = (np.concatenate(c) for c in zip(*self.held))
        order = np.lexsort((doc, nameless, -score, item))
        order = order[np.arange(len(order)) - np.searchsorted(item[order], item[order]) < self.k]
        kept = item[order], score[order], doc[order], nameless[order]
        full = np.flatnonzero(np.bincount(kept[0], minlength=len(self.bars)) >= self.k)
        lowest = np.searchsorted(kept[0], full, side="right") - 1
        self.bars[full] = np.maximum(self.bars[full], kept[1][lowest])
        self.held, self.size = [kept], len(order)
        return kept


class Tree:
    """FP-tree of some documents, stored as their sorted vectors.

    A node is a range of documents that share a path; its children begin where
    neighbours share no more than the node's path. Ranges of few documents are
    leaves and scored at once.
    """

    def __init__(self, docs: np.ndarray, nameless: np.ndarray, norms: np.ndarray, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        words = terms.astype(">u4").tobytes()
        keys = [words[4 * a : 4 * b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys = [keys[i] for i in order]
        order = np.array(order, np.int64)
        sizes = np.diff(starts)[order]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat(starts[:-1][order] - self.starts[:-1], sizes) + np.arange(self.starts[-1])
        self.terms, self.tfs = terms[place], tfs[place]
        self.docs, self.nameless, self.norms = docs[order], nameless[order], norms[order]
        self.shared = np.array([0, *(shared_words(a, b) for a, b in zip(keys, keys[1:]))], np.int64)
        self.width = int(terms.max()) + 1 if len(terms) else 0
        self.highest = np.zeros(self.width, np.int64)

    def maxima(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms of a range, each one's largest frequency, and their rows."""
        rows = slice(self.starts[low], self.starts[high])
        terms, tfs = self.terms[rows], self.tfs[rows]
        np.maximum.at(self.highest, terms, tfs)
        present = np.unique(terms)
        most = self.highest[present]
        self.highest[present] = 0
        return present, most, terms

    def children(self, low: int, high: int) -> Iterator[tuple[int, int]]:
        """Subranges below a node; small neighbours come together as one leaf."""
        inner = self.shared[low + 1 : high]
        cuts = low + 1 + np.flatnonzero(inner == inner.min())
        edges = [low, *cuts.tolist(), high]
        begin = low
        for a, b in zip(edges, edges[1:]):
            if b - begin > LEAF_DOCS:
                if a > begin:
                    yield begin, a
                begin = a
                # One path for all: equal documents, or a true subtree.
                if b - a > LEAF_DOCS:
                    yield a, b
                    begin = b
        if begin < high:
            yield begin, high

    def search(self, weights: np.ndarray, hits: Hits) -> None:
        """Depth first, all items along: each leaves as soon as the bound shuts it out."""
        stack = [(0, len(self.docs), np.arange(len(weights)))] if len(self.docs) else []
        while stack:
            low, high, items = stack.pop()
            present, most, terms = self.maxima(low, high)
            if not len(present):
                continue
            table = weights[np.ix_(items, present)]
            bound = table @ contribution(most, self.norms[low:high].min()).astype(weights.dtype)
            open_ = bound >= hits.bars[items]
            if not open_.any():
                continue
            items = items[open_]
            if high - low <= LEAF_DOCS:
                self.score(low, high, items, table[open_], present, terms, hits)
                continue
            alike = self.shared[low + 1 : high].min() == np.diff(self.starts[low : high + 1]).max()
            parts = ((a, min(a + LEAF_DOCS, high)) for a in range(low, high, LEAF_DOCS)) if alike else self.children(low, high)
            stack.extend((a, b, items) for a, b in reversed(list(parts)))

    def score(self, low: int, high: int, items: np.ndarray, table: np.ndarray, present: np.ndarray, terms: np.ndarray, hits: Hits) -> None:
        rows = slice(self.starts[low], self.starts[high])
        column = np.repeat(np.arange(high - low), np.diff(self.starts[low : high + 1]))
        added = np.zeros((len(present), high - low), table.dtype)
        added[np.searchsorted(present, terms), column] = contribution(self.tfs[rows], self.norms[low:high][column])
        scores = table @ added
        i, d = np.nonzero(scores >= hits.bars[items][:, None])
        if len(i):
            hits.add(items[i], scores[i, d].astype(np.int64), self.docs[low:high][d], self.nameless[low:high][d])


def shared_words(a: bytes, b: bytes) -> int:
    """How many leading terms of four bytes two paths share."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // 4
    x, y = np.frombuffer(a, ">u4", size // 4), np.frombuffer(b, ">u4", size // 4)
    return int((x != y).argmax())


def search(vectors: DataFrame, shared, k: int) -> DataFrame:
    """``(item, doc_id, score)``: up to ``k`` rows per item from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, rank, docs_in, terms_in, bars = shared.value
        hits = Hits(bars, k)
        held, entries = [], 0

        def grown() -> None:
            docs, nameless, norms, sizes, terms, tfs = (np.concatenate(c) for c in zip(*held))
            Tree(docs, nameless, norms, np.concatenate([[0], np.cumsum(sizes)]), terms, tfs).search(weights, hits)
            held.clear()

        for batch in batches:
            ids = batch.column("doc_id")
            sizes = np.diff(batch.column("terms").offsets.to_numpy().astype(np.int64))
            terms = rank[batch.column("terms").flatten().to_numpy()]
            tfs = longs(batch.column("tfs").flatten())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((terms, owner))
            order = order[terms[order] >= 0]
            sizes = np.bincount(owner[order], minlength=len(sizes))
            norms = 25 + 75 * longs(batch.column("n")) * docs_in // terms_in
            edges = np.concatenate([[0], np.cumsum(sizes)])
            low = 0
            while low < len(sizes):
                high = max(low + 1, int(np.searchsorted(edges, edges[low] + TREE_ENTRIES - entries, side="right")) - 1)
                rows = order[edges[low] : edges[high]]
                held.append((longs(ids.fill_null(0))[low:high], ids.is_null().to_numpy(zero_copy_only=False)[low:high], norms[low:high],
                             sizes[low:high], terms[rows], tfs[rows]))
                entries += len(rows) + high - low
                low = high
                if entries >= TREE_ENTRIES or low < len(sizes):
                    grown()
                    entries = 0
        if held:
            grown()
        item, score, doc, nameless = hits.cut()
        yield record_batch(item=pa.array(item.astype(np.int32)), doc_id=pa.array(doc, mask=nameless), score=pa.array(score))

    return arrow_map(vectors, run, "item int, doc_id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_block(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """``(item, rank, doc_id, score)`` of one block of items against all documents."""
    spark = docs.sparkSession
    vectors = restricted(docs, block.terms)
    docs_in, terms_in = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the block.
    held_by = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    df = np.array([held_by.get(t, 0) for t in range(len(block.terms))], np.int64)
    # Frequent terms first, so that documents share the upper parts of their paths.
    order = np.argsort(-df, kind="stable")
    weight = np.array([math.floor(1000 * math.log((2 * docs_in + 2) / (2 * int(df[t]) + 1))) for t in order], np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.where((df[order] > 0) & (weight > 0), np.arange(len(order)), -1)
    table = np.zeros((len(block.ids), len(order)), np.int64)
    for i, count in enumerate(block.counts):
        for term, times in count.items():
            at = rank[block.terms[term]]
            if at >= 0:
                table[i, at] = times * weight[at]
    # No score reaches 10**6 a unit of weight. Below 2**53 doubles are exact, and faster.
    if table.sum(1).max(initial=0) * 10**6 < 2**53:
        table = table.astype(np.float64)
    bars = np.ones(len(block.ids), np.int64)
    for pilot in (True, False):
        shared = spark.sparkContext.broadcast((table, rank, docs_in, max(1, terms_in), bars))
        rows = vectors.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(PILOT)) == 0) if pilot else vectors
        found = best(search(rows, shared, k), k)
        if pilot:
            # At most one row per item of the block.
            for row in found.filter(F.col("rank") == k).select("item", "score").collect():
                bars[row.item] = row.score
        else:
            found = stored(found, "ranked")
        shared.unpersist()
    return found


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block_cells: int = BLOCK_CELLS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents, exactly.

    Every row of ``items (item_id, text)`` is a query of its own, repeated ids
    too, and every row of ``docs (doc_id, text)`` a document. Equal scores go
    by ascending ``doc_id``, null ids last. Null texts and texts without a
    term hold nothing; an item without a term, or without a document of score
    above 0, has no rows. Other columns are not looked at. Documents are read
    once per block of items.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    results = []
    for block in item_blocks(items, block_cells, block_bytes):
        names = spark.createDataFrame(list(enumerate(block.ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)]))
        results.append(ranked_block(docs, block, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.union, results)
