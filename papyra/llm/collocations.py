"""Collocations: phrases whose words meet more often than chance, by language.

The text is a weighted de Bruijn graph. An edge is a phrase of the greatest
length, between the nodes that are its first and its last words; its weight is
how often it occurs. Every word starts one such phrase, or, near the end of a
piece, a shorter one: those are the corrections. How often a shorter phrase
occurs is what flows out of it, plus what ends at it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, record_batch, stored, utf8

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
#: Phrases are counted by hash in this many cells; a broadcast is one bit a cell (32 MB).
CELL_BITS = 28
#: Size of one of Spark's bitmaps.
BITMAP_BYTES = 4096
#: What a task holds before it hands its counts on, and of word hashes.
HELD_CELLS = 1 << 22
HELD_GRAMS = 1 << 18
HELD_MEMORY = 1 << 19
#: Doublings of the path compaction: a path has at most 2 to this power edges.
DOUBLINGS = 4
SALTS = 64

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BREAK = b"."
FOLD = bytes(BREAK[0] if i in BREAKS else i + 32 if 65 <= i <= 90 else i for i in range(256))


def marked_words(text: bytes) -> list[bytes]:
    """Words of a text in order, with ``BREAK`` wherever a piece ends."""
    return text.translate(FOLD).replace(BREAK, b" . ").split()


class WordHashes(dict):
    """Hash of a word, worked out once; ``BREAK`` is 0."""

    def __missing__(self, word: bytes) -> int:
        value = 0 if word == BREAK else xxhash.xxh3_64_intdigest(word) | 1
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > HELD_MEMORY:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, lang: bytes, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length from 2 on: hash of the phrase at each word, and whether it lies in one piece."""
    mixed = (hashes ^ np.uint64(xxhash.xxh3_64_intdigest(lang))) * np.uint64(0x9E3779B97F4A7C15)
    whole = hashes != 0
    for k in range(2, longest + 1):
        mixed = ((mixed[:-1] ^ (mixed[:-1] >> np.uint64(29))) + hashes[k - 1 :]) * np.uint64(0xBF58476D1CE4E5B9)
        whole = whole[:-1] & (hashes[k - 1 :] != 0)
        yield k, (mixed >> np.uint64(64 - CELL_BITS)).astype(np.int64), whole


def is_set(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1


def frequent_lengths(hashes: np.ndarray, lang: bytes, longest: int, pairs: np.ndarray, more: np.ndarray | None) -> np.ndarray:
    """How many words the longest phrase at each word may have, to occur often.

    Without ``more``, only neighbours are looked up.
    """
    size = len(hashes)
    length = np.minimum(hashes, 1).astype(np.int64)
    linked = None
    for k, cells, whole in gram_hashes(hashes, lang, longest):
        room = size - k + 1
        if room <= 0:
            break
        if k == 2:
            linked = whole & is_set(pairs, cells)
            open_ = linked
        else:
            open_ = open_[:room] & linked[k - 2 :]
            if more is not None:
                open_ = open_ & is_set(more, cells)
        length[:room][open_] = k
    # What follows a phrase's first word is as frequent as the phrase.
    for _ in range(longest - 2):
        np.minimum(length[:-1], length[1:] + 1, out=length[:-1])
    return length


def texts_by_language(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("lang"), utf8(F.col("text")).alias("text"))


def frequent_cells(texts: DataFrame, min_count: int, longest: int, pairs=None) -> np.ndarray:
    """Bit per cell: may a phrase in it occur ``min_count`` times?

    Phrases of two words are counted by hash; given the bits of those,
    ``pairs``, the longer ones made of frequent pairs. A cell counts all
    phrases that share it, so no frequent one is missed; a rare one in a
    frequent cell only costs work later. Counts are combined within tasks.
    What reaches the driver is bounded by the number of cells, whatever the
    corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, held, size = WordHashes(), [], 0

        def counted() -> pa.RecordBatch:
            cell, n = np.unique(np.concatenate(held), return_counts=True)
            return record_batch(cell=cell, n=n.astype(np.int64))

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                hashes = memory.of(marked_words(text))
                if len(hashes) < 2:
                    continue
                if pairs is not None:
                    length = frequent_lengths(hashes, lang, longest, pairs.value, None)
                for k, cells, whole in gram_hashes(hashes, lang, 2 if pairs is None else longest):
                    if pairs is None or k > 2:
                        held.append(cells[whole if pairs is None else length[: len(cells)] >= k].astype(np.int32))
                        size += len(held[-1])
                if size >= HELD_CELLS:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    counts = arrow_map(texts, run, "cell int, n long")
    often = counts.groupBy("cell").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    # Spark's bitmaps count from 1: bit 0 of bitmap 1 is cell 0.
    place = F.col("cell").cast("long") + 1
    rows = often.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(((1 << CELL_BITS) // 8 // BITMAP_BYTES, BITMAP_BYTES), np.uint8)
    for row in rows.toLocalIterator():
        bits[row.b - 1] = np.frombuffer(row.bits, np.uint8)
    return bits.reshape(-1)


def longest_grams(texts: DataFrame, min_count: int, longest: int) -> DataFrame:
    """``(lang, gram, words, n)``: the phrase that each word starts, counted.

    It has ``longest`` words, or fewer where its piece ends. A phrase that
    cannot occur ``min_count`` times ends a piece too, at its last word: none
    that occurs so often holds it, so the counts of frequent phrases, and of
    all words, stay exact.
    """
    context = texts.sparkSession.sparkContext
    pairs = context.broadcast(frequent_cells(texts, min_count, longest))
    more = context.broadcast(frequent_cells(texts, min_count, longest, pairs))

    def flush(held: dict[bytes, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, grams in held.items():
            keys = list(grams)
            for low in range(0, len(keys), 50_000):
                part = keys[low : low + 50_000]
                yield record_batch(
                    lang=pa.array([lang] * len(part), pa.binary()).cast(pa.string()),
                    gram=pa.array(part, pa.binary()).cast(pa.string()),
                    words=pa.array([k.count(b" ") + 1 for k in part], pa.int32()),
                    n=pa.array([grams[k] for k in part], pa.int64()),
                )
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, held, size = WordHashes(), {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words = marked_words(text)
                if not words:
                    continue
                length = frequent_lengths(memory.of(words), lang, longest, pairs.value, more.value)
                grams = held.setdefault(lang, Counter())
                before = len(grams)
                grams.update(map(words.__getitem__, np.flatnonzero(length == 1).tolist()))
                at = np.flatnonzero(length > 1)
                grams.update(b" ".join(words[a:b]) for a, b in zip(at.tolist(), (at + length[at]).tolist()))
                size += len(grams) - before
                if size >= HELD_GRAMS:
                    yield from flush(held)
                    size = 0
        yield from flush(held)

    counted = arrow_map(texts, run, "lang string, gram string, words int, n long")
    made = stored(counted.groupBy("lang", "gram", "words").agg(F.sum("n").alias("n")), "grams")
    pairs.unpersist()
    more.unpersist()
    return made


def node_id(lang: str, gram) -> list:
    return [F.xxhash64(F.lit(1), F.col(lang), gram), F.xxhash64(F.lit(2), F.col(lang), gram)]


def compact(edges: DataFrame, longest: int, doublings: int = DOUBLINGS) -> DataFrame:
    """``(lang, path, n, edges)``: unary paths of ``edges (lang, gram, n)``, each in one row.

    Two edges belong to one path where the node between them has no other edge
    and both weigh the same. A path is cut at nodes chosen by hash, so that it
    stays short, and found by doubling: each edge learns which edge lies 1, 2,
    4, ... places before it, until that is the path's first. An edge that gets
    no such answer, in a loop or far along, stays a path of its own; counts
    taken from paths do not depend on where they are cut.
    """
    head, tail = (F.substring_index("gram", " ", s * (longest - 1)) for s in (1, -1))
    edges = edges.select("lang", "gram", "n", F.struct(*node_id("lang", head)).alias("head"), F.struct(*node_id("lang", tail)).alias("tail"),
                         F.struct(*node_id("lang", F.col("gram"))).alias("id"))
    edges = stored(edges, "debruijn")
    leaves = edges.groupBy(F.col("head").alias("node")).agg(F.count("*").alias("d"), F.min("n").alias("w"), F.min("id").alias("after")).filter("d = 1").drop("d")
    enters = edges.groupBy(F.col("tail").alias("node")).agg(F.count("*").alias("d"), F.min("n").alias("w"), F.min("id").alias("before")).filter("d = 1").drop("d")
    keep = 1 << max(1, doublings - 1)
    unary = leaves.join(enters, ["node", "w"]).filter((F.col("after") != F.col("before")) & (F.pmod(F.col("node.col1"), F.lit(keep)) != 0))
    at = stored(unary.select(F.col("after").alias("id"), F.col("before").alias("far"), F.lit(1).alias("steps")), "steps")
    # Every row names an edge some steps before its own; that edge's row, if any, leads on.
    for _ in range(doublings):
        on = at.select(F.col("id").alias("far"), F.col("far").alias("further"), F.col("steps").alias("more"))
        at = stored(at.join(on, "far", "left").select("id", F.coalesce("further", "far").alias("far"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "steps")
    moving = at.select(F.col("id").alias("far"))
    settled = at.join(moving, "far", "left_anti")
    placed = edges.join(settled, "id", "left").select(
        "lang", "gram", "n", F.coalesce("far", "id").alias("path"), F.coalesce("steps", F.lit(0)).alias("place"))
    last = F.substring_index("gram", " ", -1)
    grouped = placed.groupBy("path").agg(
        F.first("lang").alias("lang"), F.first("n").alias("n"), F.count("*").cast("int").alias("edges"),
        F.min(F.struct("place", "gram")).alias("first"), F.sort_array(F.collect_list(F.struct("place", last.alias("word")))).alias("rest"))
    rest = F.transform(F.slice("rest", 2, F.greatest(F.size("rest") - 1, F.lit(0))), lambda x: x["word"])
    return stored(grouped.select("lang", F.concat_ws(" ", F.col("first.gram"), rest).alias("path"), "n", "edges"), "paths")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> dict[int, DataFrame]:
    """Per length, ``(lang, gram, words, n)``: how often phrases occur.

    Exact for every phrase that occurs ``min_count`` times, and for all words.
    A rarer phrase may be missing or counted short.
    """
    grams = longest_grams(texts_by_language(docs), min_count, longest)
    level = grams.filter(F.col("words") == longest)
    counts = {longest: level}
    paths = compact(level.select("lang", "gram", "n"), longest)
    words = F.split("path", " ")
    starts = F.sequence(F.lit(1), F.col("edges"))
    nodes = F.transform(starts, lambda i: F.array_join(F.slice(F.col("_words"), i, longest - 1), " "))
    flow = paths.withColumn("_words", words).select("lang", F.explode(nodes).alias("gram"), "n")
    for k in range(longest - 1, 0, -1):
        ends = grams.filter(F.col("words") == k).select("lang", "gram", "n")
        level = stored(flow.union(ends).groupBy("lang", "gram").agg(F.lit(k).alias("words"), F.sum("n").alias("n")), f"phrases{k}")
        counts[k] = level
        flow = level.select("lang", F.substring_index("gram", " ", k - 1).alias("gram"), "n")
    return counts


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, inside_percent: int = 100) -> DataFrame:
    """The ``top`` phrases of two to ``longest`` words of every language.

    Texts have A-Z lowered, are cut at ``.,;:!?`` and line ends into pieces,
    and those at spaces and tabs into words. A phrase that occurs ``a >=
    min_count`` times scores ``1000 * a * n // (l * r)`` at its worst cut,
    ``l`` and ``r`` being the counts of the two parts and ``n`` the words of
    the language. One whose words lie in a longer such phrase that occurs
    ``inside_percent`` of ``a`` times or more goes. Null texts are empty, a
    null language is ``und``; rows count one by one, repeated ones too; other
    columns are not looked at.
    """
    counts = phrase_counts(docs, min_count, longest)
    totals = counts[1].groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = reduce(DataFrame.union, [counts[k].select("lang", "gram", "words", F.col("n").alias("a")).filter(F.col("a") >= min_count) for k in sorted(counts)])
    frequent = stored(frequent, "frequent")
    # Whatever lies in a longer phrase lies in one that is longer by a word and no rarer than that.
    shorter = F.array(F.expr("substring_index(gram, ' ', words - 1)"), F.expr("substring_index(gram, ' ', 1 - words)"))
    around = frequent.filter("words > 2").select("lang", F.explode(shorter).alias("gram"), "a")
    around = around.groupBy("lang", "gram").agg(F.max("a").alias("longer"))
    alone = frequent.filter("words > 1").join(around, ["lang", "gram"], "left")
    alone = alone.filter(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))).drop("longer")
    cuts = alone.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).withColumn("left", F.expr("substring_index(gram, ' ', k)"))
    cuts = cuts.withColumn("right", F.expr("substring(gram, length(left) + 2)"))
    part = lambda side, name: frequent.select("lang", F.col("gram").alias(side), F.col("a").alias(name))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
    exact = "1000BD * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(16,0)) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"
    worst = cuts.withColumn("score", F.expr(exact)).groupBy("lang", F.col("gram").alias("phrase"), "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = worst.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A bounded number of rows of each salt reaches the task that ranks the language.
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top).drop("salt", "rank")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
