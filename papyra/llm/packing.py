"""Packing of documents into token sequences, with certified bin counts."""

from __future__ import annotations

import itertools
import json
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from papyra.llm.common import arrow_map, in_parts, remembered, stored
from papyra.session import ship

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 8_000
CACHED_WORDS = 300_000
CACHED_LENGTH = 64
#: Runs of letters in one call of the tokenizer, and bytes of text in one of ours.
RUNS = 256
PART_BYTES = 1 << 20
#: Marks that may close a word; none begins a contraction.
MARKS = ".,;:!?()[]{}|&#$%*+=/\\\"-_"


class WordIds:
    """Token ids of texts as little-endian 32-bit bytes; what words give is remembered.

    A tokenizer that marks word ends never joins text across a space or line
    end, so a text's ids are its words' ids in a row; nor across the end of a
    run of letters, so a word's closing marks are looked up on their own. New
    runs of letters are handed over many at a time, and told apart by the ids
    that end a word. The memory is bounded: long words are never kept, and once
    it is full, new words stay for their batch. Any other tokenizer gets whole
    texts.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(model)
        self.known: dict[str, bytes] = {}
        suffix = json.loads(model)["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def plain(self, parts: list[str]) -> list[bytes]:
        return [np.array(made.ids, "<u4").tobytes() for made in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def letter_runs(self, runs: list[str]) -> list[bytes]:
        """Ids of runs of letters, which are one word each to the tokenizer."""
        found: list[bytes] = []
        chunks = [runs[low : low + RUNS] for low in range(0, len(runs), RUNS)]
        for chunk, made in zip(chunks, self.tokenizer.encode_batch_fast([" ".join(c) for c in chunks], add_special_tokens=False)):
            ids = np.array(made.ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(chunk):  # some letter does not stay in its word
                found += self.plain(chunk)
                continue
            raw, places = ids.tobytes(), [0, *(4 * ends).tolist()]
            found += [raw[i:j] for i, j in zip(places, places[1:])]
        return found

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Remember new words; returns those that there is no room for."""
        known, passing, split, runs, others = self.known, {}, {}, set(), set()
        for word in words:
            bare = word.rstrip(MARKS)
            if len(word) <= CACHED_LENGTH and bare.isalpha():
                marks = word[len(bare) :]
                if bare.isascii():
                    bare = bare.lower()
                split[word] = bare, marks
                if bare not in known:
                    runs.add(bare)
                if marks and marks not in known:
                    others.add(marks)
            else:
                others.add(word)
        kept = known if len(known) < CACHED_WORDS else passing
        made = {**dict(zip(runs, self.letter_runs(list(runs)))), **dict(zip(others, self.plain(list(others))))}
        for part, ids in made.items():
            (kept if len(part) <= CACHED_LENGTH else passing)[part] = ids
        find = lambda w: known[w] if w in known else made[w]
        for word, (bare, marks) in split.items():
            kept[word] = find(bare) + (find(marks) if marks else b"")
        return passing

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self.plain(texts)
        words = [text.replace("\n", " ").split(" ") for text in texts]
        unseen = set().union(*words).difference(self.known)
        passing = self.learn(unseen) if unseen else {}
        if not passing:
            return [b"".join(map(self.known.__getitem__, w)) for w in words]
        known = self.known.get
        return [b"".join([ids if (ids := known(x)) is not None else passing[x] for x in w]) for w in words]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document.

    The tokenizer's file is read on the driver and broadcast; its size does
    not depend on the corpus. A null text is empty and holds ``end_id`` only.
    Tokenizers that do not mark word ends get whole texts, which is slower.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        model = spark.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        memory = remembered(f"tokens {zlib.crc32(model.value.encode())}", lambda: WordIds(model.value))
        for batch in batches:
            rows, number, starts, lengths, sums = [], [], [], [], []
            texts = batch.column("text")
            made = (ids for part in in_parts(texts, PART_BYTES) for ids in memory.encode([t or "" for t in part.to_pylist()]))
            for i, ids in enumerate(made):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    rows.append(i)
                    number.append(piece)
                    starts.append(start // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(columns, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Fewest bins that any packing of ``count[i]`` pieces of length i needs, from dual feasible functions.

    Each function maps lengths to weights of which no bin can hold more than
    one bin's worth, so the total weight bounds the bins from below: the plain
    total, the functions that round lengths up or down to k-ths of a bin, and
    those that count lengths over ``capacity - t`` as whole bins and leave out
    lengths below ``t``.
    """
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    for k in range(1, 65):
        # weight in units of 1/k; exact multiples keep their share of capacity
        scaled = size * (k + 1)
        exact = scaled % capacity == 0
        weight = np.where(exact, size * k, (scaled // capacity) * capacity)  # units of 1/(k * capacity)
        best = max(best, -(-int((count * weight).sum()) // (k * capacity)))
    rows, total = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(0, capacity // 2 + 1)
    whole = rows[-1] - rows[capacity - t]
    below = np.where(t > 0, total[np.maximum(t - 1, 0)], 0)
    middle = total[capacity - t] - below
    return max(best, int((whole + -(-middle // capacity)).max()))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: ``(bin, offset)`` of each length.

    Bins wait in stacks by free space, and the bits of ``free`` say which
    stacks hold one, so the tightest fit is the lowest set bit from the length.
    """
    bins, offsets = np.empty(lengths.size, np.int64), np.empty(lengths.size, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, opened = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fits = free >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            bin_ = stacks[room].pop()
            if not stacks[room]:
                free &= ~(1 << room)
        else:
            room, bin_ = capacity, opened
            opened += 1
        bins[i], offsets[i] = bin_, capacity - room
        left = room - length
        if left:
            stacks[left].append(bin_)
            free |= 1 << left
    return bins, offsets


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, bin long, offset long, part_bins long, part_bound long, released boolean"


def packed(rows: DataFrame, capacity: int, group: int, turn: int) -> DataFrame:
    """One round: rows go to parts of about ``group`` pieces, each packed on its own.

    ``released`` marks what the part gives up for exchange: all bins with a gap
    where its count is over its bound, otherwise its emptiest bin.
    """
    n = rows.count()
    parts = max(1, round(n / group))
    spread = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.monotonically_increasing_id(), F.lit(turn)), F.lit(parts))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        lengths = pdf["length"].to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        fill = np.bincount(bins, lengths)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        open_ = fill < capacity
        if fill.size <= bound and open_.any():
            open_ = np.arange(fill.size) == fill.argmin()
        return pdf.assign(bin=bins, offset=offsets, part_bins=fill.size, part_bound=bound, released=open_[bins])[
            [f.split()[0] for f in PACKED.split(", ")]
        ]

    ship(rows.sparkSession)
    return rows.withColumn("part", spread).groupBy("part").applyInPandas(run, PACKED)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         group: int = GROUP_PIECES) -> DataFrame:
    """``docs (doc_id, text)`` packed into sequences of at most ``capacity`` tokens.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``, and the round's part with its count and lower bound. A document
    longer than ``capacity`` is cut; others stay whole. Empty and null texts
    hold the end token; repeated rows are packed one by one; an empty table
    gives no rows.

    Best-fit decreasing packs each part. A part whose bin count equals its
    lower bound is certified. The others release their bins with gaps, and
    every part its emptiest one; the released pieces are dealt to new parts
    and packed again, until a round saves no bin or all parts together reach the
    bound of the whole table. A round that saves nothing is not used.
    """
    rows = stored(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    columns = rows.columns
    count = np.zeros(capacity + 1, np.int64)
    for length, n in rows.groupBy("length").count().collect():
        count[length] = n
    bound, total = lower_bound(count, capacity), 0
    kept, before = None, None
    for turn in itertools.count():
        made = stored(packed(rows.select(*columns), capacity, group, turn), "packed").withColumn("turn", F.lit(turn).cast("long"))
        bins = made.select("part", "part_bins").distinct().agg(F.sum("part_bins")).first()[0] or 0
        if before is not None and bins >= before:
            break
        total += bins - (before or 0)
        whole = kept.union(made) if kept is not None else made
        closed = made.filter(~F.col("released"))
        kept = kept.union(closed) if kept is not None else closed
        rows = made.filter("released")
        before = rows.select("part", "bin").distinct().count()
        if before < 2 or total <= bound:
            break
    sequence = F.shiftleft(F.col("turn"), 52) + F.shiftleft(F.col("part"), 22) + F.col("bin")
    return whole.select(*columns, sequence.alias("sequence_id"), "offset", "part_bins", "part_bound")
