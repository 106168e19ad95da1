"""Removal of passages that repeat across documents, by hashed units and word windows."""

from __future__ import annotations

from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.llm.common import arrow_map, free_name, in_parts, longs, record_batch, utf8, with_columns

MIN_WORDS = 30
#: Of each so many neighbouring words the one with the least hash begins a window.
REACH = 10
SPACES = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
ENDS = np.isin(np.arange(256), list(b".!?"))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
#: Two numbers below 32 bits share a long.
LOW = (1 << 32) - 1
FIRST_TWO = itemgetter(0, 1)
#: Bits of 64 left out of hashes that only preselect, and of the numbers of documents
#: that they travel with. Chance equality sends more to the exact step, never less.
SPARE, DOC_SPARE = np.uint64(16), 24
#: Bytes of text whose pieces are made together.
PART_BYTES = 1 << 21


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which the words of a text start and stop."""
    inside = np.concatenate(([False], ~SPACES[np.frombuffer(text, np.uint8)], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(lower: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word, for a bounded number of bytes at a time."""
    data = np.frombuffer(lower, np.uint8)
    sizes = stops - starts
    powers = np.cumprod(np.full(int(sizes.max()), MULTIPLIER))
    ends, made, low = np.cumsum(sizes), [], 0
    while low < sizes.size:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + PART_BYTES, side="right")))
        some = sizes[low:high]
        firsts = np.cumsum(some) - some
        back = np.arange(some.sum()) - np.repeat(firsts, some)
        letters = data[np.repeat(starts[low:high], some) + back].astype(np.uint64) + np.uint64(1)
        made.append(np.add.reduceat(letters * powers[back], firsts))
        low = high
    return mixed(np.concatenate(made))


def mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * MULTIPLIER
    return hashes ^ (hashes >> np.uint64(29))


def anchors(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words that have the least hash of some ``REACH`` words in a row of one text.

    The choice depends on the words around only, so texts that share a run of
    words share the anchors inside it.
    """
    if hashes.size < REACH:
        return np.zeros(0, np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(hashes, REACH)
    least = np.arange(len(rows)) + REACH - 1 - rows[:, ::-1].argmin(axis=1)
    return np.unique(least[doc[: len(rows)] == doc[REACH - 1 :]])


class Pieces:
    """Units and windows of some texts, as arrays with one entry per piece.

    ``doc`` numbers the texts, ``unit`` the units of a text (-1: a window),
    ``word`` is the place of the first word in its text, ``start`` and ``stop``
    are byte offsets into it. ``hashes`` are 48 bits of the words in a row:
    equal pieces have equal hashes, and few others do.
    """

    def __init__(self, texts: list[bytes], min_words: int):
        joined = b"\n".join(texts)  # no unit goes beyond a line end
        starts, stops = word_places(joined)
        self.lower = joined.lower()
        if not starts.size:
            self.doc = self.unit = self.word = self.words = self.start = self.stop = self.first = np.zeros(0, np.int64)
            self.hashes = np.zeros(0, np.int64)
            return
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        doc = np.searchsorted(offsets, starts, side="right") - 1
        hashes = word_hashes(self.lower, starts, stops)
        unit_first, unit_words, unit_start, unit_stop = self.units(joined, starts, stops)
        unit_doc = doc[unit_first]
        first = anchors(hashes, doc)
        first = first[first + min_words <= starts.size]
        first = first[doc[first] == doc[first + min_words - 1]]
        self.first = np.concatenate((unit_first, first))
        self.words = np.concatenate((unit_words, np.full(first.size, min_words)))
        self.doc = doc[self.first]
        self.unit = np.concatenate((np.arange(unit_first.size) - np.searchsorted(unit_doc, unit_doc), np.full(first.size, -1)))
        self.word = self.first - np.searchsorted(starts, offsets)[self.doc]
        self.start = np.concatenate((unit_start, starts[first])) - offsets[self.doc]
        self.stop = np.concatenate((unit_stop, stops[first + min_words - 1])) - offsets[self.doc]
        # A row of words is a polynomial in MULTIPLIER, cut out of running sums.
        powers = np.cumprod(np.full(starts.size, MULTIPLIER))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers)))
        down = np.cumprod(np.full(starts.size, INVERSE))
        rows = (sums[self.first + self.words] - sums[self.first]) * down[self.first]
        kind = 2 * self.words + (self.unit < 0)
        self.hashes = (mixed(mixed(rows) + kind.astype(np.uint64)) >> SPARE).view(np.int64)

    @staticmethod
    def units(joined: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(first word, words, start, stop)`` of the units.

        A unit ends at a line end, or after a word that ends a sentence; a mark
        that stands alone at the start of a line ends none. White space before
        a unit is its own.
        """
        data = np.frombuffer(joined, np.uint8)
        lines = np.flatnonzero(data == 10)
        bounds = np.concatenate((lines, [len(joined)]))
        line_end = bounds[np.searchsorted(lines, stops)]
        line_start = np.concatenate(([0], lines + 1))[np.searchsorted(lines, starts)]
        closing = ENDS[data[stops - 1]] & ~((stops - starts == 1) & (starts == line_start))
        last = np.flatnonzero(closing | (np.concatenate((starts[1:], [len(joined) + 1])) > line_end))
        first = np.concatenate(([0], last[:-1] + 1))
        stop = np.where(closing[last], stops[last], line_end[last])
        start = np.maximum(np.concatenate(([0], stop[:-1])), line_start[first])
        return first, last - first + 1, start, stop

    def in_long_runs(self, which: np.ndarray, min_words: int) -> np.ndarray:
        """Which of some pieces (in order) are windows, or make ``min_words`` words with neighbouring units among them."""
        doc, unit, words = self.doc[which], self.unit[which], self.words[which]
        begins = np.concatenate(([True], (doc[1:] != doc[:-1]) | (unit[1:] != unit[:-1] + 1)))[: which.size]
        run = np.cumsum(begins) - 1
        return (unit < 0) | (np.bincount(run, words)[run] >= min_words) if which.size else np.zeros(0, bool)

    def digests(self, which: np.ndarray) -> tuple[list[int], list[int]]:
        """96 bits of the words of some pieces, as a long and an int."""
        words, h1, h2 = self.lower.split(), [], []
        for first, size, unit in zip(self.first[which].tolist(), self.words[which].tolist(), self.unit[which].tolist()):
            key = b" ".join(words[first : first + size])
            # A unit's key holds no line end, so the two kinds do not meet.
            digest = xxhash.xxh3_128_digest(key if unit >= 0 else b"\n" + key)
            h1.append(int.from_bytes(digest[:8], "big", signed=True))
            h2.append(int.from_bytes(digest[8:12], "big", signed=True))
        return h1, h2


def candidates(docs: DataFrame, min_words: int) -> DataFrame:
    """``(doc, hashes)``: per document the hashes of its pieces that may repeat.

    A hash travels once per part of the input: pieces that repeat inside a part
    are known to repeat and are dealt out by document, so no hash, however
    common, gathers more rows in a task than there are parts. Each part sends
    one witness of them to where the hash is sought.
    """

    def made(batches):
        for batch in batches:
            names, at = longs(batch.column("doc")), 0
            for texts in in_parts(batch.column("text"), PART_BYTES):
                pieces = Pieces(texts.to_pylist(), min_words)
                doc = names[at : at + len(texts)][pieces.doc]
                at += len(texts)
                hashes, back, counts = np.unique(pieces.hashes, return_inverse=True, return_counts=True)
                known = counts[back] > 1
                witness = np.zeros(hashes.size, np.int64)
                witness[back] = doc
                yield record_batch(
                    hash=np.concatenate((hashes, hashes[back][known])),
                    known=np.concatenate((np.zeros(hashes.size, bool), np.ones(int(known.sum()), bool))),
                    doc=np.concatenate((witness, doc[known])),
                )

    def repeated(batches):
        before = None  # last row so far: hash, document, whether it is out
        for batch in batches:
            hashes, doc, known = longs(batch.column("hash")), longs(batch.column("doc")), batch.column("known").to_numpy(zero_copy_only=False)
            if not hashes.size:
                continue
            level = hashes[1:] == hashes[:-1]
            met = before is not None and before[0] == hashes[0]
            out = known | np.concatenate(([met], level)) | np.concatenate((level, [False]))
            if met and not before[2]:
                yield record_batch(doc=np.array([before[1]]), hash=hashes[:1])
            yield record_batch(doc=doc[out], hash=hashes[out])
            before = hashes[-1], doc[-1], bool(out[-1])

    sent = arrow_map(docs.select("doc", "text"), made, "hash long, known boolean, doc long")
    sought = sent.repartition(F.when(F.col("known"), F.col("doc")).otherwise(F.col("hash"))).sortWithinPartitions("hash")
    return arrow_map(sought, repeated, "doc long, hash long").groupBy("doc").agg(F.collect_set("hash").alias("hashes"))


def pack(columns):
    """Texts made small for a shuffle."""
    press = zstandard.ZstdCompressor(level=1)
    for (texts,) in columns:
        yield [pa.array([press.compress(t.as_buffer()) for t in texts], pa.binary())]


def unpacked(column: pa.Array):
    """Lists of texts of at most ``PART_BYTES`` together, one text at least."""
    texts, size, press = [], 0, zstandard.ZstdDecompressor()
    for item in column:
        length = zstandard.frame_content_size(item.as_buffer())
        if texts and size + length > PART_BYTES:
            yield texts
            texts, size = [], 0
        texts.append(press.decompress(item.as_buffer()))
        size += length
    if texts:
        yield texts


def repeated_pieces(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, text_hash, word, unit_words, start_size, h1, h2, may_go)`` of pieces that may repeat.

    Every piece that occurs twice is there, and few others. ``word`` is the
    place of the first word; ``unit_words`` holds the unit's number, from 1 (0:
    a window), above 32 bits and the number of words below; ``start_size``
    likewise the place and length in bytes of UTF-8. Units among fewer than ``min_words`` words of
    such neighbours can only be what others repeat: ``may_go`` is false. Only hashes travel in the first pass; the second
    makes the pieces of documents that hold repeats again.
    """
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), utf8(F.col("text")).alias("text"))
    columns = columns.withColumn("doc", F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash"), DOC_SPARE))

    def run(batches):
        for batch in batches:
            ids, digests, wanted, at = batch.column("doc_id"), batch.column("text_hash"), batch.column("hashes"), 0
            for texts in unpacked(batch.column("packed")):
                pieces = Pieces(texts, min_words)
                sought = wanted.slice(at, len(texts)).flatten()
                which = np.flatnonzero(np.isin(pieces.hashes, longs(sought)))
                rows = pa.array(pieces.doc[which] + at)
                at += len(texts)
                h1, h2 = pieces.digests(which)
                may_go = pieces.in_long_runs(which, min_words)
                yield record_batch(
                    doc_id=ids.take(rows), text_hash=digests.take(rows), word=pa.array(pieces.word[which], pa.int32()),
                    unit_words=pieces.unit[which] + 1 << 32 | pieces.words[which],
                    start_size=pieces.start[which] << 32 | pieces.stop[which] - pieces.start[which],
                    h1=pa.array(h1, pa.int64()), h2=pa.array(h2, pa.int32()), may_go=may_go,
                )

    packed = with_columns(columns, ["text"], T.StructType([T.StructField("packed", T.BinaryType())]), pack)
    held = packed.join(candidates(columns, min_words), "doc").select("doc_id", "text_hash", "packed", "hashes")
    return arrow_map(held, run, "doc_id long, text_hash long, word int, unit_words long, start_size long, h1 long, h2 int, may_go boolean")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Spans to remove: ``(doc_id, text_hash, start, stop, words, units, keeper_doc_id, keeper_word)``.

    White space and the case of A-Z do not count. Two kinds of pieces are
    hashed. Units are the sentences of lines; neighbouring repeated units of at
    least ``min_words`` words together are removed. Windows are runs of
    ``min_words`` words that begin at anchors, wherever sentences end; each
    repeated one is removed. Of the pieces with one digest all but the earliest
    (by ``doc_id``, then place) are repeats. What overlaps is one span.

    So every run of at least ``min_words + 2 * REACH - 2`` words that an earlier
    document holds is found, less at most ``2 * REACH - 2`` words at its start
    and ``REACH - 1`` at its end. ``start`` and ``stop`` are byte offsets into
    the original text, ``units`` counts the repeated pieces, and the keeper is
    where the span's first piece stays.

    Null and empty texts have no pieces. Rows with a null ``doc_id`` rank last.
    Rows equal in id and text are one document. A unit or window repeated inside
    one document stays once, at its first place.
    """
    # Read twice and made twice: the shuffles below it are run once, and its rows
    # would take more disk than making them again takes time.
    shared = repeated_pieces(docs, min_words)
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash", "word")
    keeper = shared.groupBy("h1", "h2").agg(F.min(rank).alias("keeper"))
    # A window that overlaps its keeper, as in a text with a short period, stays.
    beside = (
        F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("text_hash") == F.col("keeper.text_hash"))
        & (F.col("word") < F.col("keeper.word") + F.col("unit_words").bitwiseAND(F.lit(LOW)))
    )
    repeats = (
        shared.filter("may_go")
        .join(keeper, ["h1", "h2"])
        .filter(~beside)
        .select("doc_id", "text_hash", "word", "unit_words", "start_size",
                F.col("keeper.doc_id").alias("keeper_doc_id"), F.col("keeper.word").alias("keeper_word"))
    )
    return merged_spans(repeats, min_words)


def spans(items: list[tuple], min_words: int) -> list[list]:
    """``[word, end word, start, stop, pieces, keeper_doc_id, keeper_word]`` of one document.

    Items are ``(unit, word, words, start, size, keeper_doc_id, keeper_word)``.
    """
    runs, windows, before = [], [], None
    for unit, word, words, start, size, keeper, place in sorted(items, key=FIRST_TWO):
        if not unit:
            windows.append([word, word + words, start, start + size, 1, keeper, place])
        elif unit - 1 == before:
            run = runs[-1]
            run[1], run[3], run[4], before = word + words, start + size, run[4] + 1, unit
        else:
            runs.append([word, word + words, start, start + size, 1, keeper, place])
            before = unit
    found = [r for r in runs if r[1] - r[0] >= min_words] + windows
    merged: list[list] = []
    for span in sorted(found, key=FIRST_TWO):
        if merged and span[0] <= merged[-1][1]:
            last = merged[-1]
            last[1], last[2], last[3], last[4] = max(last[1], span[1]), min(last[2], span[2]), max(last[3], span[3]), last[4] + span[4]
        else:
            merged.append(span)
    return merged


def merged_spans(repeats: DataFrame, min_words: int) -> DataFrame:
    """Overlapping and neighbouring repeats of a document, as one row each."""
    parts = repeats.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("word", "unit_words", "start_size", "keeper_doc_id", "keeper_word")).alias("parts"))

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("words", pa.int64()),
                            ("units", pa.int64()), ("keeper_doc_id", pa.int64()), ("keeper_word", pa.int32())])
        for batch in batches:
            rows, parts_ = [], batch.column("parts")
            flat = dict(zip(("word", "unit_words", "start_size", "keeper_doc_id", "keeper_word"), parts_.flatten().flatten()))
            unit_words, start_size = longs(flat["unit_words"]), longs(flat["start_size"])
            items = list(zip((unit_words >> 32).tolist(), flat["word"].to_pylist(), (unit_words & LOW).tolist(), (start_size >> 32).tolist(),
                             (start_size & LOW).tolist(), flat["keeper_doc_id"].to_pylist(), flat["keeper_word"].to_pylist()))
            bounds = np.concatenate(([0], np.cumsum(parts_.value_lengths().to_numpy(zero_copy_only=False)))).tolist()
            for doc_id, text_hash, low, high in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), bounds, bounds[1:]):
                for word, end, start, stop, pieces, keeper, place in spans(items[low:high], min_words):
                    rows.append((doc_id, text_hash, start, stop, end - word, pieces, keeper, place))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return arrow_map(parts, run, "doc_id long, text_hash long, start int, stop int, words long, units long, keeper_doc_id long, keeper_word int")


def without_passages(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of ``text``; offsets are the original ones.

    Null text becomes empty text. All rows of one id and text lose the same spans.
    """
    row, digest, cut_row, cut_digest, cuts, bytes_ = (
        free_name(docs.columns, n) for n in ("_row", "_digest", "_cut_row", "_cut_digest", "_cuts", "_bytes")
    )
    gathered = spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias(cuts))
    gathered = gathered.withColumnsRenamed({"doc_id": cut_row, "text_hash": cut_digest})
    joined = docs.withColumns({row: F.col("doc_id").cast("long"), digest: F.xxhash64("text"), bytes_: utf8(F.col("text"))})
    joined = joined.join(gathered, F.col(row).eqNullSafe(F.col(cut_row)) & (F.col(digest) == F.col(cut_digest)), "left")
    joined = joined.select(*[c for c in docs.columns if c.lower() != "text"], bytes_, cuts)

    def run(columns):
        for text, spans_ in columns:
            made = []
            for t, places in zip(text.to_pylist(), spans_.to_pylist()):
                at, parts = 0, []
                for p in places or ():
                    parts.append(t[at : p["start"]])
                    at = max(at, p["stop"])
                made.append(b"".join(parts) + t[at:])
            yield [pa.array(made, pa.binary()).cast(pa.string())]

    return with_columns(joined, [bytes_, cuts], T.StructType([T.StructField("text", T.StringType())]), run)
