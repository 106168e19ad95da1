"""Language-model scores by deleted interpolation of n-gram estimates."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, fold, stored, utf8
from papyra.session import ship

FOLDS = 10
HELD_OUT, TUNING = 0, 1
ADDED = 0.1
BLOCK_TOKENS = 2_000_000
BUCKET_ENTRIES = 3_000_000
CACHED_WORDS = 300_000
CACHED_LENGTH = 64
ROUNDS = 200
#: Steps of a factor of two in which the ratios of estimates are told apart.
STEPS = 16
UNIGRAM, BIGRAM = 1, 2
#: Hashes of the two marks that are not words; no word is empty.
END, START = xxhash.xxh3_64_intdigest(b""), xxhash.xxh3_64_intdigest(b"", 1)


def packed(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes: equal high bytes cost next to nothing."""
    octets = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(1).compress(octets.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    octets = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(octets.T).view("<u8").ravel()


def packed_sorted(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=np.zeros(1, np.uint64)))


def unpacked_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob), dtype=np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED_LENGTH and len(self) < CACHED_WORDS:
            self[word] = value
        return value


def pairs(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the word before each token and of the pair; texts begin with START."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(lengths) - lengths] = START
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (words + np.uint64(0x632BE59BD9B4E019))
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return before, mixed ^ (mixed >> np.uint64(29))


BLOCKS = "block long, kind int, trained boolean, tokens long, doc_ids array<long>, lengths array<int>, words binary, places binary"


def blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents as blocks of token numbers: one row per about ``block_tokens`` tokens.

    A block holds documents of one fold only: held out, tuning or the rest.
    """

    def run(batches):
        hashes, serial = WordHashes(), 0
        held: dict[int, list] = defaultdict(lambda: [[], [], []])
        names = [f.split()[0] for f in BLOCKS.split(", ")]

        def flush(kind: int):
            nonlocal serial
            ids, lengths, parts = held.pop(kind)
            words, places, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(order.size)
            block = (TaskContext.get().partitionId() << 24) | serial
            serial += 1
            row = [block, kind, kind != HELD_OUT, places.size, ids, lengths, words[order].tobytes(), packed(rank[places])]
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for doc_id, kind, text in zip(batch.column("doc_id").to_pylist(), batch.column("kind").to_pylist(), batch.column("text")):
                tokens = text.as_buffer().to_pybytes().lower().split()
                ids, lengths, parts = held[kind]
                ids.append(doc_id)
                lengths.append(len(tokens) + 1)
                parts.append(np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens)))
                parts.append(np.array([END], np.uint64))
                if sum_at_least(lengths, block_tokens):
                    yield flush(kind)
        for kind in list(held):
            yield flush(kind)

    number = fold(F.col("doc_id"), FOLDS)
    kind = F.when(number == HELD_OUT, HELD_OUT).when(number == TUNING, TUNING).otherwise(2)
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), kind.alias("kind"), utf8(F.col("text")).alias("text"))
    return arrow_map(columns, run, BLOCKS)


def sum_at_least(lengths: list[int], limit: int) -> bool:
    """Whether the lengths reach the limit; looked at every 64 entries or for long texts."""
    return (len(lengths) % 64 == 0 or lengths[-1] > 10_000) and sum(lengths) >= limit


def block_words(row: dict) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(row["words"], np.uint64)
    return words[unpacked(row["places"]).astype(np.int64)], np.array(row["lengths"], np.int64)


def block_grams(row: dict) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per order the sorted different grams of a block, with START among the words,
    and their counts."""
    words, lengths = block_words(row)
    single, n = np.unique(np.concatenate((words, np.full(lengths.size, START, np.uint64))), return_counts=True)
    double, m = np.unique(pairs(words, lengths)[1], return_counts=True)
    return {UNIGRAM: (single, n), BIGRAM: (double, m)}


def requests(made: DataFrame, buckets: int) -> DataFrame:
    """``(gram, bucket, block, kind, hashes, counts)``: a block's grams by range of hashes."""
    edges = np.array([(1 << 64) * k // buckets for k in range(1, buckets)], np.uint64)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for order, (grams, counts) in block_grams(row).items():
                    cuts = np.concatenate(([0], np.searchsorted(grams, edges), [grams.size]))
                    rows = [(order, k, row["block"], row["kind"], packed_sorted(grams[a:b]), packed(counts[a:b]))
                            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=["gram", "bucket", "block", "kind", "hashes", "counts"])

    return arrow_map(made, run, "gram int, bucket int, block long, kind int, hashes binary, counts binary")


REPLIES = "gram int, bucket int, block long, kind int, counts binary, base binary, different long"


def answer(rows: pa.Table) -> pa.Table:
    """Corpus counts of one range of grams, sent back to every block in its own order.

    ``counts`` are over all training texts. Tuning blocks also get ``base``,
    the counts without the tuning texts. ``different`` (in one row) is the
    number of different grams with a count.
    """
    hashes = [unpacked_sorted(b) for b in rows.column("hashes").to_pylist()]
    counts = [unpacked(b).astype(np.int64) for b in rows.column("counts").to_pylist()]
    kinds = rows.column("kind").to_pylist()
    grams, place = np.unique(np.concatenate(hashes), return_inverse=True)
    sizes = [h.size for h in hashes]
    kind, every = np.repeat(kinds, sizes), np.concatenate(counts)
    totals = {k: np.bincount(place[kind == k], every[kind == k], grams.size).astype(np.int64) for k in (TUNING, 2)}
    whole = totals[TUNING] + totals[2]
    ends = np.cumsum(sizes)
    parts = [place[e - s : e] for s, e in zip(sizes, ends)]
    return pa.table({
        "gram": rows.column("gram").cast(pa.int32()), "bucket": rows.column("bucket").cast(pa.int32()), "block": rows.column("block"), "kind": rows.column("kind").cast(pa.int32()),
        "counts": pa.array([packed(whole[p]) for p in parts], pa.binary()),
        "base": pa.array([packed(totals[2][p]) if k == TUNING else None for p, k in zip(parts, kinds)], pa.binary()),
        "different": pa.array([int((whole[grams != START] > 0).sum()) if i == 0 else 0 for i in range(len(parts))], pa.int64()),
    })


@dataclass
class Mixture:
    """Weights of the pair, word and smoothed-word estimates per context bucket."""

    tokens: int
    different: int
    weights: dict[int, tuple[float, float, float]] = field(default_factory=dict)

    def table(self) -> np.ndarray:
        """Weights by bucket; a bucket never seen takes those of the next one below."""
        rows, last = np.zeros((65, 3)), (0.0, 0.0, 1.0)
        for bucket in range(65):
            last = self.weights.get(bucket, last)
            rows[bucket] = last
        return rows


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for none, else one more than the whole part of the count's log2."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 0)


def looked_up(row: dict, replies: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each token, of the word before it and of the pair, and the lengths."""
    words, lengths = block_words(row)
    before, double = pairs(words, lengths)
    found = {}
    for order in (UNIGRAM, BIGRAM):
        own = replies.filter(pa.array(replies.column("gram").to_numpy() == order)).sort_by("bucket")
        found[order] = np.concatenate([unpacked(b) for b in own.column(column).to_pylist()]).astype(float)
    single = np.unique(np.concatenate((words, np.full(1, START, np.uint64))))
    place = np.unique(double, return_inverse=True)[1]
    return found[UNIGRAM][np.searchsorted(single, words)], found[UNIGRAM][np.searchsorted(single, before)], found[BIGRAM][place], lengths


def estimates(word: np.ndarray, before: np.ndarray, double: np.ndarray, tokens: float, different: int):
    pair = np.divide(double, before, out=np.zeros_like(double), where=before > 0)
    return pair, word / max(tokens, 1), (word + ADDED) / (tokens + ADDED * (different + 1))


def learn(histogram: list[tuple[int, int, int, int]]) -> dict[int, tuple[float, float, float]]:
    """Weights by expectation-maximisation on ``(bucket, pair step, word step, tokens)``.

    A step is the rounded log-ratio of an estimate to the smoothed one; a
    token's posterior depends on these ratios only. Step ``-32768`` is zero.
    """
    weights = {}
    ratio = lambda steps: np.where(steps == -32768, 0.0, np.exp2(steps / STEPS))
    rows = np.array(histogram, np.int64).reshape(-1, 4)
    for bucket in np.unique(rows[:, 0]):
        own = rows[rows[:, 0] == bucket]
        each = np.stack([ratio(own[:, 1].astype(float)), ratio(own[:, 2].astype(float)), np.ones(len(own))], axis=1)
        n, w = own[:, 3].astype(float), np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            part = each * w
            new = (part / part.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) / n.sum()
            done = np.abs(new - w).max() < 1e-7
            w = new
            if done:
                break
        w = np.maximum(w, [0, 0, 1e-4])
        weights[int(bucket)] = tuple((w / w.sum()).tolist())
    return weights


def tuning_histogram(made: DataFrame, replies: DataFrame, tokens: int, different: int) -> list[tuple[int, int, int, int]]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        word, before, double, _ = looked_up(left.to_pylist()[0], right, "base")
        pair, single, smooth = estimates(word, before, double, tokens, different)
        step = lambda p: np.where(p > 0, np.rint(np.log2(np.maximum(p, 1e-300) / smooth) * STEPS), -32768).astype(np.int64)
        keys, n = np.unique(np.stack([context_bucket(before), step(pair), step(single)]), axis=1, return_counts=True)
        return pa.table({"bucket": keys[0], "pair": keys[1], "single": keys[2], "n": n})

    tuned = made.filter(F.col("kind") == TUNING).groupBy("block").cogroup(replies.filter(F.col("kind") == TUNING).groupBy("block"))
    rows = tuned.applyInArrow(run, "bucket long, pair long, single long, n long").groupBy("bucket", "pair", "single").agg(F.sum("n").alias("n"))
    return [tuple(r) for r in rows.collect()]


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """``SCORES`` per row of ``docs (doc_id, text)``.

    Tokens are words of A-Z-lower-cased text and one end per text. A token's
    probability mixes the estimate from the pair with the word before it, the
    word's own, and the smoothed word estimate that is also the base, with
    weights by how often the word before was seen. Documents of fold 0 are held
    out. Of the rest, fold 1 is set aside to learn the weights by
    expectation-maximisation with the counts of the others; the final counts
    are over all of them.

    Null and empty texts are one end token. A null id counts as empty text when
    it is dealt to a fold. Repeated rows are scored, and counted, one by one.
    With nothing to train on, the base is uniform and the score equals it.

    Blocks of about ``block_tokens`` tokens ask for the counts of their
    different grams, and ranges of hashes of about ``bucket_entries`` grams
    answer: a gram crosses the shuffle once per block that holds it, however
    often it occurs, and no task holds more than a block or a range.
    """
    ship(docs.sparkSession)
    made = stored(blocks(docs, block_tokens), "blocks")
    sums = made.agg(F.sum("tokens"), F.sum(F.when(F.col("trained"), F.col("tokens")))).first()
    total, tokens = (int(s or 0) for s in sums)
    buckets = max(1, -(-total // bucket_entries))
    replies = requests(made, buckets).groupBy("gram", "bucket").applyInArrow(answer, REPLIES)
    replies = stored(replies, "replies")
    different = replies.filter(F.col("gram") == UNIGRAM).agg(F.sum("different")).first()[0] or 0
    set_aside = made.filter(F.col("kind") == TUNING).agg(F.sum("tokens")).first()[0] or 0
    mixture = Mixture(tokens, int(different), learn(tuning_histogram(made, replies, tokens - int(set_aside), int(different))))
    table = mixture.table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        word, before, double, lengths = looked_up(row, right, "counts")
        pair, single, smooth = estimates(word, before, double, tokens, mixture.different)
        weights = table[context_bucket(before)]
        mixed = weights[:, 0] * pair + weights[:, 1] * single + weights[:, 2] * smooth
        first = np.cumsum(lengths) - lengths
        n = len(lengths)
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array([row["kind"] == HELD_OUT] * n), "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array(np.add.reduceat((word > 0).astype(np.int64), first)), "train_tokens": pa.array([tokens] * n, pa.int64()),
            "base_score": pa.array(np.add.reduceat(np.log10(smooth), first)), "score": pa.array(np.add.reduceat(np.log10(mixed), first)),
        })

    return made.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, SCORES)
