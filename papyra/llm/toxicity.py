"""Toxicity by class-conditional Kneser-Ney models with a shared backoff.

Each class has a model of word pairs that backs off to its own model of words,
by the different words they follow, and that to one shared by both classes.
Counts up to a discount are left to the backoff, so a rare expression, which
one class may hold by chance, costs the same under both models.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.llm.common import arrow_map, free_name, record_batch, stored, with_columns
from papyra.llm.language import CACHED_LENGTH, CACHED_WORDS, letters, sampled

SAMPLE_ROWS = 6_000
SAMPLE_BYTES = 16_000_000
#: Discounts tried, in counts of the larger class.
DISCOUNTS = (0.75, 1.5, 3.0, 6.0, 12.0, 24.0, 48.0, 96.0, 192.0, 384.0)
SHARED_DISCOUNT = 0.75
#: Words of the passages that a text is judged by.
WINDOW = 12
#: How fast the score rises with the evidence.
STEEPNESS = 6.0
THRESHOLD = 0.3
#: Pairs worked on at once when a model is fitted.
PART = 1 << 17
#: Stands before the first word of a text.
START = ""


def bare_words(text: str) -> list[str]:
    return [w for w in map(letters, text.lower().split()) if w]


def pair_counts(sample: DataFrame) -> DataFrame:
    """``(before, word, ordinary, toxic)``: neighbouring words of the texts of each class.

    A pair counts once for every different pair of words around it, so that
    copies of a text, or of a passage, count as one.
    """

    def run(batches):
        for batch in batches:
            seen: dict[int, set] = defaultdict(set)
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                words = bare_words(text)
                seen[label].update(zip([START, START, *words], [START, *words], words, [*words[1:], START]))
            for label, found in seen.items():
                rows = list(found)
                around = [xxhash.xxh64_intdigest(f"{r[0]} {r[3]}") >> 1 for r in rows]
                yield record_batch(toxic=pa.array([label] * len(rows), pa.int32()), before=pa.array([r[1] for r in rows], pa.string()),
                                   word=pa.array([r[2] for r in rows], pa.string()), around=pa.array(around, pa.int64()))

    pairs = arrow_map(sample.select("toxic", "text"), run, "toxic int, before string, word string, around long").distinct()
    n = lambda label: F.sum((F.col("toxic") == label).cast("long"))
    return pairs.groupBy("before", "word").agg(n(0).alias("ordinary"), n(1).alias("toxic"))


@dataclass
class Counts:
    """Pairs of the sample; words by number, 0 is the start of a text."""

    words: list[str]
    before: np.ndarray
    word: np.ndarray
    pairs: np.ndarray

    @staticmethod
    def of(table: pa.Table) -> Counts:
        before, word = table.column("before"), table.column("word")
        distinct = pc.unique(pa.chunked_array([*before.chunks, *word.chunks], before.type))
        words = [START, *(w for w in distinct.take(pc.array_sort_indices(distinct)).to_pylist() if w != START)]
        known = pa.array(words, before.type)
        number = lambda column: pc.index_in(column, value_set=known).to_numpy()
        pairs = np.array([table.column(c).to_numpy() for c in ("ordinary", "toxic")], np.int32)
        return Counts(words, number(before), number(word), pairs)

    def parts(self) -> Iterator[slice]:
        return parts(self.before.size)


def parts(size: int) -> Iterator[slice]:
    """Slices for work that would need several numbers for each of very many pairs."""
    return (slice(low, low + PART) for low in range(0, size, PART))


@dataclass
class Discounts:
    """Per class and group: the discount, the share of a count above it, and what is left to the backoff.

    The discount shrinks with the smaller class. Where both classes keep
    something of a group they leave the same share, the larger of the two, so
    that neither gains by its size alone.
    """

    amount: np.ndarray
    rate: np.ndarray
    left: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, group: np.ndarray, groups: int, discount: float) -> Discounts:
        totals = np.array([np.bincount(group, c, groups) for c in counts])
        amount = discount * totals / np.maximum(totals.max(0), 1e-300)
        kept = np.zeros_like(totals)
        for part in parts(group.size):
            own = np.maximum(counts[:, part] - amount[:, group[part]], 0.0)
            kept += [np.bincount(group[part], o, groups) for o in own]
        left = 1 - kept / np.maximum(totals, 1e-300)
        left = np.where((kept > 0).all(0), left.max(0), left)
        return Discounts(amount, (1 - left) / np.maximum(kept, 1e-300), left)

    def shares(self, counts: np.ndarray, group: np.ndarray) -> np.ndarray:
        return np.maximum(counts - self.amount[:, group], 0.0) * self.rate[:, group]


@dataclass
class ToxicModel:
    """Log-likelihood ratios, toxic over ordinary, in the smallest form that gives them.

    ``word`` is the ratio of a word whose pair is in neither class's model,
    ``context`` what a preceding word adds to that, ``pair`` the whole ratio of
    a pair that is. All others are 0: both models back off alike.
    """

    numbers: dict[str, int] = field(default_factory=dict)
    word: np.ndarray = field(default_factory=lambda: np.zeros(1))
    context: np.ndarray = field(default_factory=lambda: np.zeros(1))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cut: float = 1.0

    @staticmethod
    def fit(counts: Counts, discount: float) -> ToxicModel:
        size = len(counts.words)
        if not all((c > 0).any() for c in counts.pairs):
            return ToxicModel()
        # Different words before each word, per class and in either.
        follows = np.array([np.bincount(counts.word[c > 0], minlength=size) for c in counts.pairs], float)
        either = np.bincount(counts.word, minlength=size).astype(float)
        kinds = int((either > 0).sum())
        shared = (np.maximum(either - SHARED_DISCOUNT, 0) + SHARED_DISCOUNT * kinds / (kinds + 1)) / either.sum()
        alone = np.zeros(size, np.int64)
        words = Discounts.of(follows, alone, 1, discount)
        single = words.shares(follows, alone) + words.left * shared
        after = Discounts.of(counts.pairs, counts.before, size, discount)
        with np.errstate(divide="ignore"):
            word = np.log(single[1] / single[0])
            context = np.log(after.left[1] / after.left[0])
        told = (np.abs(word) > 1e-12) | (np.abs(context) > 1e-12)
        told[0] = True
        kept, pair = [], []
        for part in counts.parts():
            v, w = counts.before[part], counts.word[part]
            shares = after.shares(counts.pairs[:, part], v)
            own = (shares > 0).any(0)
            told[v[own]] = told[w[own]] = True
            double = shares + after.left[:, v] * single[:, w]
            with np.errstate(divide="ignore"):
                pair.append(np.log(double[1] / double[0])[own])
            kept.append((np.flatnonzero(own) + part.start).astype(np.int32))
        kept, pair = np.concatenate(kept), np.concatenate(pair)
        number = np.full(size, -1)
        number[told] = np.arange(told.sum())
        codes = number[counts.before[kept]] * int(told.sum())
        codes += number[counts.word[kept]]
        order = np.argsort(codes)
        names = {counts.words[i]: int(number[i]) for i in np.flatnonzero(told)}
        # One more place stands for all words that are not told apart.
        return ToxicModel(names, np.append(word[told], 0.0), np.append(context[told], 0.0), codes[order], pair[order])

    def ratios(self, numbers: np.ndarray) -> np.ndarray:
        """Log-ratio of every word of a text, given the one before it."""
        before = np.concatenate([[self.numbers.get(START, -1)], numbers[:-1]])
        ratios = self.word[numbers] + self.context[before]
        if self.pairs.size:
            codes = np.where((before >= 0) & (numbers >= 0), before * (len(self.word) - 1) + numbers, -1)
            at = np.minimum(np.searchsorted(self.pairs, codes), self.pairs.size - 1)
            ratios = np.where(self.pairs[at] == codes, self.pair[at], ratios)
        return ratios

    def evidence(self, text: str, memory: dict[str, int] | None = None) -> float:
        """Length-normalised toxic less ordinary log-likelihood of the most toxic passage.

        Passages are all runs of ``WINDOW`` words, or the whole of a shorter
        text. Every word counts in its passages, for either class. No words: 0.
        """
        find = (memory if memory is not None else Memory(self)).__getitem__
        numbers = np.fromiter((n for n in map(find, text.lower().split()) if n != SKIP), np.int64)
        if not numbers.size:
            return 0.0
        sums = np.concatenate([[0.0], np.cumsum(self.ratios(numbers))])
        width = min(WINDOW, numbers.size)
        return float((sums[width:] - sums[:-width]).max() / width)

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(min(700.0, STEEPNESS * (self.cut - evidence) - math.log(THRESHOLD / (1 - THRESHOLD)))))


#: Number of a token without letters, which is no word.
SKIP = -2


class Memory(dict):
    """Numbers of words as they stand in texts; -1 for those not told apart."""

    def __init__(self, model: ToxicModel):
        super().__init__()
        self.numbers = model.numbers

    def __missing__(self, word: str) -> int:
        bare = letters(word)
        value = self.numbers.get(bare, -1) if bare else SKIP
        if len(word) <= CACHED_LENGTH and len(self) < CACHED_WORDS // 2:
            self[word] = value
        return value


def best_cut(values: np.ndarray, truth: np.ndarray) -> tuple[float, float, float]:
    """``(area under the ROC curve, best F1, the middle of the gap where F1 is best)``."""
    order = np.argsort(-values, kind="stable")
    v, y = values[order], truth[order]
    ends = np.append(np.flatnonzero(np.diff(v)), v.size - 1)
    hits, found = np.cumsum(y)[ends], ends + 1
    f1 = 2 * hits / (found + y.sum())
    best = int(f1.argmax())
    below = v[ends[best] + 1] if ends[best] + 1 < v.size else v[ends[best]] - 1.0
    misses = found - hits
    area = np.trapezoid(np.append(0, hits) / max(y.sum(), 1), np.append(0, misses) / max((1 - y).sum(), 1))
    return float(area), float(f1[best]), float((v[ends[best]] + below) / 2)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> ToxicModel:
    """A model from the texts of ``docs (doc_id, text)`` that ``labels (doc_id, toxic)`` marks.

    Fitted on a sample of about ``sample_rows`` labels per class, chosen by
    hash, and of these at most about ``sample_bytes`` bytes of whole texts per
    class: the chosen ids, which are broadcast, and the model do not grow with
    the corpus. A quarter of the sample is left out of the counts; it chooses
    the discount and the evidence that a score of ``THRESHOLD`` stands for. An
    id with both labels counts as toxic; other labels and null texts are left
    out. Without texts of both classes every score is the same.
    """
    marked = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy(F.col("doc_id").cast("string").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = dict(marked.groupBy("toxic").count().collect())
    share = lambda label: int(1_000_000 * min(1.0, sample_rows / max(sizes.get(label, 0), 1)))
    chance = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    chosen = stored(marked.filter(chance < F.when(F.col("toxic") == 1, share(1)).otherwise(share(0))), "labels")
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    rows = stored(texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).drop("id"), "labelled")
    sample = sampled(rows, "toxic", sample_bytes)
    spare = F.pmod(F.xxhash64(F.lit("spare"), "text"), F.lit(4)) == 0
    pairs = pair_counts(sample.filter(~spare)).withColumns({c: F.col(c).cast("int") for c in ("ordinary", "toxic")})
    counts = Counts.of(pairs.toArrow())
    pa.default_memory_pool().release_unused()
    model = ToxicModel()
    if not counts.pairs.size:
        return model
    trial = sample.filter(spare).select("text", "toxic").toArrow()
    texts, truth = trial.column("text").to_pylist(), np.array(trial.column("toxic").to_pylist(), float)
    best, found = (0.0, 0.0), None
    for discount in DISCOUNTS:
        tried = ToxicModel.fit(counts, discount)
        if not truth.size or not truth.any():
            return tried
        memory = Memory(tried)
        area, f1, cut = best_cut(np.array([tried.evidence(t, memory) for t in texts]), truth)
        if (round(f1, 3), area) > best:
            best, found = (round(f1, 3), area), (discount, cut)
        # One model at a time: the best is made again.
        del tried, memory
    if found is not None:
        model = ToxicModel.fit(counts, found[0])
        model.cut = found[1]
    return model


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: likelier toxic) and ``predicted``.

    Null and empty texts have no evidence, which scores as low as text that
    speaks for neither class. Columns with these names are replaced.
    """
    added = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    docs = docs.drop(*added.names)
    read = free_name([*docs.columns, *added.names], "_text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(columns):
        model = shared.value
        memory = Memory(model)
        for (texts,) in columns:
            scores = np.array([model.score(model.evidence(t.as_py() or "", memory)) for t in texts])
            yield [pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32), pa.int32())]

    return with_columns(docs.withColumn(read, F.col("text").cast("string")), [read], added, run)
