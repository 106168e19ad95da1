"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.llm.common import arrow_map, free_name, record_batch, remembered, stored, with_columns

ORDER = 4
DISCOUNT = 0.75
SAMPLE_BYTES = 4_000_000
MAX_LABELS = 500
#: Rows of a label to expect in a sample, counted ones and spare ones, if it has them.
FEW = 4
CHANCES = 1 << 40
CACHED_WORDS = 300_000
CACHED_LENGTH = 64
UNKNOWN = "und"
EDGE = "\x02"
STOP = "\x03"
#: Probability of a character that no training text of a language holds.
UNSEEN = 1e-6
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: The evidence of more characters than this counts no further in a score.
EVIDENCE = 40
#: Lengths at which the spread of cross-entropies stops shrinking.
STEADY = 400
TAIL = 0.999
MARGIN = 1.5


def letters(word: str) -> str:
    word = NOT_LETTERS.sub("", word)
    return word if not word or word.isalpha() else "".join(filter(str.isalpha, word))


def rolled(points: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the windows of ``size`` code points that end at each place.

    Windows that would begin before the first place are hashed as if zeros
    stood there; callers do not use them.
    """
    value = np.zeros(points.size, np.uint64)
    for back in range(size - 1, -1, -1):
        shifted = np.zeros(points.size, np.uint64)
        shifted[back:] = points[: points.size - back] if back else points
        value = (value + shifted + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


@dataclass
class Table:
    """Values in order of their hashes."""

    hashes: np.ndarray
    values: np.ndarray

    def find(self, wanted: np.ndarray, missing: float) -> np.ndarray:
        if not self.hashes.size:
            return np.full(wanted.size, missing)
        at = np.minimum(np.searchsorted(self.hashes, wanted), self.hashes.size - 1)
        return np.where(self.hashes[at] == wanted, self.values[at], missing)


def table(values: dict[str, float]) -> Table:
    grams = list(values)
    if not grams:
        return Table(np.zeros(0, np.uint64), np.zeros(0))
    size = len(grams[0])
    hashes = rolled(code_points("".join(grams)), size)[size - 1 :: size]
    order = np.argsort(hashes)
    return Table(hashes[order], np.fromiter(values.values(), float, len(grams))[order])


@dataclass
class KneserNey:
    """One language: per order the discounted shares of grams and what contexts leave."""

    shares: list[Table]
    rests: list[Table]

    @staticmethod
    def fit(grams: dict[str, int], order: int) -> KneserNey:
        """``grams`` counts the windows of ``order`` characters; shorter windows
        count the different characters seen before them."""
        counts = {order: grams}
        for size in range(order - 1, 0, -1):
            longer: dict[str, int] = defaultdict(int)
            for gram in counts[size + 1]:
                longer[gram[1:]] += 1
            counts[size] = longer
        shares, rests = [], []
        for size in range(1, order + 1):
            total, kinds = defaultdict(int), defaultdict(int)
            for gram, n in counts[size].items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            shares.append(table({g: max(n - DISCOUNT, 0.0) / total[g[:-1]] for g, n in counts[size].items()}))
            if size == 1:
                rests.append(DISCOUNT * kinds[""] / max(total[""], 1))
            else:
                rests.append(table({c: DISCOUNT * kinds[c] / total[c] for c in total}))
        return KneserNey(shares, rests)

    def log_probability(self, points: np.ndarray, at: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
        """Natural log of each character at ``at`` given those before it."""
        p = self.shares[0].find(hashes[0][at], 0.0) + self.rests[0] * UNSEEN
        for size in range(2, len(self.shares) + 1):
            rest = self.rests[size - 1].find(hashes[size - 2][at - 1], 1.0)
            p = self.shares[size - 1].find(hashes[size - 1][at], 0.0) + rest * p
        return np.log(p)


@dataclass
class LanguageModel:
    """The learned languages, and per language the mean and spread for rejection."""

    order: int
    names: list[str] = field(default_factory=list)
    models: list[KneserNey] = field(default_factory=list)
    middle: np.ndarray | None = None
    spread: np.ndarray | None = None
    token: str = ""

    def words(self, bare: list[str]) -> np.ndarray:
        """Per word (letters only) the log-probability in every language, then the characters counted."""
        rows = np.zeros((len(bare), len(self.names) + 1))
        some = [i for i, w in enumerate(bare) if w]
        if not some:
            return rows
        pad = EDGE * (self.order - 1)
        points = code_points("".join(f"{pad}{bare[i]}{STOP}" for i in some))
        sizes = np.array([len(bare[i]) + 1 for i in some])
        ends = np.cumsum(sizes + self.order - 1)
        firsts = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(firsts, sizes) + np.repeat(ends - sizes, sizes)
        hashes = [rolled(points, k) for k in range(1, self.order + 1)]
        for column, model in enumerate(self.models):
            rows[some, column] = np.add.reduceat(model.log_probability(points, at, hashes), firsts)
        rows[some, -1] = sizes
        return rows


class Scorer:
    """Cross-entropies of texts; what words cost is remembered, within a bound."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.places: dict[str, int] = {}
        self.used = 0
        self.rows = np.zeros((1024, len(self.model.names) + 1))

    def cost(self, text: str) -> tuple[np.ndarray, float]:
        """Log-probability in every language and the number of characters."""
        words = text.lower().split()
        extra, full = 0.0, len(self.places) >= CACHED_WORDS
        new = [w for w in set(words) if w not in self.places]
        if any(len(w) > CACHED_LENGTH for w in new):
            extra = self.model.words([letters(w) for w in words if len(w) > CACHED_LENGTH]).sum(axis=0)
            words = [w for w in words if len(w) <= CACHED_LENGTH]
            new = [w for w in new if len(w) <= CACHED_LENGTH]
        if new:
            bare = [letters(w) for w in new]
            fresh = [w for w in set(bare) if w not in self.places]
            if fresh:
                start = self.used
                while start + len(fresh) > len(self.rows):
                    self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
                self.rows[start : start + len(fresh)] = self.model.words(fresh)
                self.used += len(fresh)
                self.places.update(zip(fresh, range(start, self.used)))
            self.places.update(zip(new, map(self.places.__getitem__, bare)))
        places = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        total = self.rows[places].sum(axis=0) + extra
        if full and new:  # no room to remember them
            for word in {*new, *fresh}:
                self.places.pop(word, None)
            self.used -= len(fresh)
        return total[:-1], float(total[-1])

    def judge(self, text: str | None) -> tuple[str, float, float | None, float, bool]:
        """``(language, score, cross-entropy, characters, rejected)``."""
        model = self.model
        logs, n = self.cost(text) if text else (None, 0.0)
        if not n or not model.names:
            return UNKNOWN, 0.0, None, 0.0, True
        entropies = -logs / n
        best = int(entropies.argmin())
        weights = np.exp((entropies[best] - entropies) * min(n, EVIDENCE))
        rejected = False
        if model.middle is not None:
            rejected = bool((entropies[best] - model.middle[best]) * math.sqrt(min(n, STEADY)) > model.spread[best])
        return model.names[best], float(1 / weights.sum()), float(entropies[best]), n, rejected


def sampled(rows: DataFrame, label: str, limit: int) -> DataFrame:
    """About ``limit`` bytes of text per label, whole rows chosen by hash, written out.

    A column ``spare`` is added, true for the quarter of the texts that is not
    to be counted. However long its texts are, each label keeps about ``FEW``
    rows or more of either kind, never none of a kind that it has; the texts of
    a label that has spare ones only are all to be counted. More labels than
    ``MAX_LABELS`` are an error: that and ``limit`` bound the model.
    """
    spare = F.pmod(F.xxhash64(F.lit("spare"), "text"), F.lit(4)) == 0
    chance = F.pmod(F.xxhash64("text", "doc_id"), F.lit(CHANCES))
    parts = rows.groupBy(label, spare.alias("spare")).agg(
        F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n"), F.min(chance).alias("least"))
    parts = parts.limit(2 * MAX_LABELS + 1).collect()
    sizes = Counter()
    for r in parts:
        sizes[r[label]] += r["size"]
    if len(sizes) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} different values of {label}: one model cannot hold them, train on parts of them")
    counted = {r[label] for r in parts if not r["spare"]}
    share = lambda r: min(1.0, max(limit / max(sizes[r[label]], 1), FEW / r["n"]))
    shares = [(r[label], r["spare"], r["spare"] and r[label] in counted, max(int(CHANCES * share(r)), r["least"] + 1)) for r in parts]
    kind = rows.schema[label].dataType.simpleString()
    shares = rows.sparkSession.createDataFrame(shares, f"_label {kind}, _part boolean, spare boolean, _share long")
    chosen = rows.join(F.broadcast(shares), (F.col(label) == F.col("_label")) & (spare == F.col("_part"))).filter(chance < F.col("_share"))
    return stored(chosen.drop("_label", "_part", "_share"), "sample")


def gram_counts(sample: DataFrame, order: int) -> DataFrame:
    """``(lang, gram, n)`` of the windows of ``order`` characters inside words."""

    def run(batches):
        for batch in batches:
            words: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words[lang].update(text.lower().split())
            for lang, counts in words.items():
                grams: Counter = Counter()
                for word, n in counts.items():
                    word = letters(word)
                    if word:
                        padded = EDGE * (order - 1) + word + STOP
                        for i in range(len(word) + 1):
                            grams[padded[i : i + order]] += n
                yield record_batch(lang=pa.array([lang] * len(grams), pa.string()), gram=pa.array(list(grams), pa.string()), n=pa.array(list(grams.values()), pa.int64()))

    return arrow_map(sample.select("lang", "text"), run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> LanguageModel:
    """Models of all languages of ``labelled (doc_id, text, lang)``.

    The models are fitted on a sample of about ``sample_bytes`` bytes of whole
    texts per language, and at least one text of each that holds a letter, so what reaches the driver and is broadcast does
    not grow with the corpus. A quarter of the sample is left out of the counts
    and calibrates the rejection: a text is rejected when its cross-entropy lies
    further over its language's mean than ``MARGIN`` times the distance that the
    share ``TAIL`` of those texts keeps, given its length.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").filter(F.col("text").rlike(r"\p{L}")).select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    sample = sampled(rows, "lang", sample_bytes)
    grams: dict[str, dict[str, int]] = defaultdict(dict)
    counted = gram_counts(sample.filter("NOT spare"), order).toArrow()
    for lang, gram, n in zip(*(counted.column(c).to_pylist() for c in ("lang", "gram", "n"))):
        grams[lang][gram] = n
    model = LanguageModel(order)
    for lang in sorted(grams):
        model.names.append(lang)
        model.models.append(KneserNey.fit(grams[lang], order))
    if not model.names:
        return model
    judged = predict(sample.filter("spare"), model).filter("cross_entropy IS NOT NULL AND lang_pred = lang")
    judged = judged.select("lang", "cross_entropy", "n_letters").toArrow().to_pandas()
    model.middle, model.spread = np.zeros(len(model.names)), np.full(len(model.names), np.inf)
    for i, lang in enumerate(model.names):
        own = judged[judged["lang"] == lang]
        if len(own) < 20:
            continue  # too few to calibrate: nothing of this language is rejected
        weights = np.minimum(own["n_letters"].to_numpy(), STEADY)
        values = own["cross_entropy"].to_numpy()
        model.middle[i] = np.average(values, weights=weights)
        model.spread[i] = MARGIN * max(np.quantile((values - model.middle[i]) * np.sqrt(weights), TAIL), 1.0)
    return model


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred, score, cross_entropy, n_letters, rejected``.

    Null texts and texts without a letter get ``und``, score 0 and are rejected.
    Ties go to the language that comes first in the alphabet. Columns of
    ``docs`` with these names are replaced.
    """
    added = T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("cross_entropy", T.DoubleType()),
        T.StructField("n_letters", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
    ])
    docs = docs.drop(*[f.name for f in added])
    read = free_name([*docs.columns, *added.names], "_text")
    model.token = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(columns):
        memory = remembered(f"languages {shared.value.token}", lambda: Scorer(shared.value))
        for (texts,) in columns:
            made = [memory.judge(text.as_py()) for text in texts]
            yield [pa.array(column, kind) for column, kind in zip(zip(*made) if made else [()] * 5, (pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()))]

    return with_columns(docs.withColumn(read, F.col("text").cast("string")), [read], added, run)


def keep_known(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` without the rejected ones; columns and their names unchanged."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    judged = predict(docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index("text")])), model)
    return judged.filter(~F.col("rejected")).select(*names).toDF(*docs.columns)
