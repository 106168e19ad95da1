"""Exact nearest-vector search."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from papyra.functions import vectors
from papyra.functions.vectors import METRICS, SCORE_DIGITS
from papyra.session import ship
from papyra.sinks.writers import hand_off

# Scores below every real one: an undefined score is still a (last) hit, a
# self match is none.
UNDEFINED = float(np.finfo(np.float64).min)
EXCLUDED = float("-inf")

# More than rounding can raise a score.
SLACK = 10.0**-SCORE_DIGITS

# More queries than this take the grid path.
MAX_BROADCAST_QUERIES = 16_384
# A corpus of more partitions is searched in two phases: one row in PILOT first.
MAX_BARE_PARTITIONS = 16
PILOT = 64
# Blocks of the grid: at most so many rows and vector components, the same on
# both sides, which copies the least; and so few rows only where cores lack work.
BLOCK_ROWS = 32_768
BLOCK_QUERIES = 32_768
BLOCK_NUMBERS = 1 << 24
SMALL_BLOCK = 4_096
# Scores held at once, so few that they stay in a core's cache, and how many of
# them, in a stride, one maximum stands for.
TILE = 1 << 18
STRIP = 256
DEPTH = 16
# Squared lengths that single precision can screen.
SHORTEST, LONGEST = 1e-60, 1e60


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows at unit length; a zero row becomes NaN, so its scores are too."""
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(lengths > 0, rows / lengths, np.nan)


def score_block(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Raw scores of all queries (down) against all rows (across), in the order of scores.

    For cosine both sides come as ``unit_rows``. For l2 they are negated squares.
    """
    scores = queries @ rows.T
    if metric == "l2":
        scores *= 2.0
        scores -= (queries**2).sum(1)[:, None]
        scores -= (rows**2).sum(1)[None, :]
    return scores


def settle(raw: np.ndarray, metric: str) -> np.ndarray:
    """Rounded scores, undefined ones below all others."""
    undefined = np.isnan(raw) | (raw == UNDEFINED)
    with np.errstate(over="ignore", invalid="ignore"):
        scores = -np.sqrt(np.maximum(-raw, 0.0)) if metric == "l2" else raw
        return np.where(undefined, UNDEFINED, np.round(scores, SCORE_DIGITS))


def raw_floor(bars: np.ndarray, metric: str) -> np.ndarray:
    """Raw scores below which no settled score reaches the bar."""
    with np.errstate(over="ignore"):
        floor = bars - np.maximum(SLACK, np.abs(np.where(np.isinf(bars), 0.0, bars)) * 1e-15)
        if metric == "l2":
            floor = np.where(floor > UNDEFINED, -(floor**2) * (1 + 1e-12), floor)
    return floor


def best_mask(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks the ``k`` best columns per row (equal scores: the left one), and
    the score of the k-th, below which no row can be a hit."""
    if scores.shape[1] < k:
        return scores > EXCLUDED, np.full(len(scores), EXCLUDED)
    bar = np.partition(scores, -k, axis=1)[:, -k]
    above = scores > bar[:, None]
    level = scores == bar[:, None]
    room = k - above.sum(1, keepdims=True)
    return (above | (level & (np.cumsum(level, axis=1) <= room))) & (scores > EXCLUDED), bar


def tops(scores: np.ndarray, groups: int) -> np.ndarray:
    """Per row of ``scores`` the maximum of each of ``groups`` groups: columns g, g + groups, ...; NaN wins."""
    height, width = scores.shape
    body = width // groups * groups
    found = scores[:, :body].reshape(height, -1, groups).max(axis=1)
    rest = found[:, : width - body]
    np.maximum(rest, scores[:, body:], out=rest)
    return found


def first_k(q: np.ndarray, place: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best per ``q``, equal scores by place, and which of them are k-th."""
    order = np.lexsort((place, -score, q))
    q, place, score = q[order], place[order], score[order]
    rank = np.arange(q.size) - np.searchsorted(q, q)
    kept = rank < k
    return q[kept], place[kept], score[kept], rank[kept] == k - 1


def winners(scores: np.ndarray, bars: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, column, settled score)`` of the up to ``k`` best columns per row that reach its bar.

    ``scores`` are raw ones, ``bars`` settled ones, which rise. Only groups of columns whose maximum reaches the bar are
    looked into; rows with many such groups are sorted out as a whole. Of equal
    scores the left ones are taken.
    """
    height, width = scores.shape
    groups = max(1, width // DEPTH)
    best = tops(scores, groups)
    if np.isnan(best).any():
        scores[np.isnan(scores)] = UNDEFINED
        best = tops(scores, groups)
    if groups >= k:
        # Each of k groups holds a row with that score or a higher one.
        np.maximum(bars, settle(np.partition(best, groups - k, axis=1)[:, groups - k], metric), out=bars)
    floor = raw_floor(bars, metric)
    hit = (best >= floor[:, None]) & (best > EXCLUDED)
    many = hit.sum(1) > 4 * k
    whole = np.flatnonzero(many)
    settled = settle(scores[whole], metric)
    mask, bar = best_mask(settled, k)
    q, c = np.nonzero(mask & (settled >= bars[whole][:, None]))
    found = [(whole[q], c, settled[q, c])]
    bars[whole] = np.maximum(bars[whole], bar)
    q, g = np.nonzero(hit & ~many[:, None])
    columns = g[:, None] + np.arange(-(-width // groups)) * groups
    inside = columns < width
    values = scores[q[:, None], np.where(inside, columns, 0)]
    which, place = np.nonzero(inside & (values >= floor[q][:, None]) & (values > EXCLUDED))
    q, c, value = q[which], columns[which, place], settle(values[which, place], metric)
    q, c, value, last = first_k(q, c, value, k)
    bars[q[last]] = np.maximum(bars[q[last]], value[last])
    kept = value >= bars[q]
    found.append((q[kept], c[kept], value[kept]))
    return tuple(np.concatenate(part) for part in zip(*found))


def ordinary(vectors: np.ndarray) -> np.ndarray:
    """Which vectors a ``Screen`` takes: zero, or neither tiny, huge nor undefined."""
    with np.errstate(over="ignore", invalid="ignore"):
        squares = np.einsum("ij,ij->i", vectors, vectors)
        return ((squares >= SHORTEST) & (squares <= LONGEST)) | ~vectors.any(axis=1)


def pair_scores(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, r: np.ndarray, metric: str) -> np.ndarray:
    """Raw scores of the pairs ``(q, r)``, in the order of ``score_block``."""
    scores = np.empty(q.size)
    step = max(1, TILE // max(1, rows.shape[1]))
    for i in range(0, q.size, step):
        a, b = queries[q[i : i + step]], rows[r[i : i + step]]
        if metric == "l2":
            a = b = a - b
        scores[i : i + step] = np.einsum("ij,ij->i", a, b)
    if metric == "l2":
        np.negative(scores, out=scores)
    return scores


class Screen:
    """Scores in single precision that tell which pairs are worth an exact one.

    Both sides are scaled to lengths of about 1, so a screened score differs
    from the true one, scaled alike, by less than ``slack``: the rounding of
    the inputs and of a sum in any order. All vectors are ``ordinary``.
    """

    def __init__(self, rows: np.ndarray, metric: str):
        self.rows, self.metric = rows, metric
        self.scale = 1.0
        if metric != "cosine" and rows.size:
            self.scale = float(np.linalg.norm(rows, axis=1).max()) or 1.0
        with np.errstate(under="ignore"):
            self.single = (rows if self.scale == 1.0 else rows / self.scale).astype(np.float32)
            if metric == "l2":
                halves = np.einsum("ij,ij->i", rows, rows)[:, None] / (2 * self.scale**2)
                self.single = np.hstack([self.single, halves.astype(np.float32)])
        self.slack = 2.0 * (self.single.shape[1] + 4) * 2.0**-24
        self.room = np.empty(0, np.float32)

    def ask(self, queries: np.ndarray) -> None:
        """Take a strip of queries; its raw scores are ``factor * screened + shift``."""
        self.queries = queries
        height = len(queries)
        self.factor, self.shift = np.ones(height), np.zeros(height)
        scaled = queries
        if self.metric == "dot":
            lengths = np.linalg.norm(queries, axis=1)
            lengths[lengths == 0] = 1.0
            self.factor, scaled = lengths * self.scale, queries / lengths[:, None]
        elif self.metric == "l2":
            scaled = queries / self.scale
            squares = np.einsum("ij,ij->i", scaled, scaled)
            lengths = np.sqrt(squares + 1.0)
            self.factor, self.shift = 2.0 * self.scale**2 * lengths, -(self.scale**2) * squares
            scaled = np.hstack([scaled, np.full((height, 1), -1.0)]) / lengths[:, None]
        with np.errstate(under="ignore"):
            self.asked = scaled.astype(np.float32)

    def maxima(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Screened maxima of groups of rows (down) against the strip (across), and the rows of each group.

        The rows from ``start`` to ``end`` of a query, its own, do not count.
        Rows that fill up the last group have no place among ``rows``.
        """
        n, height = len(self.single), len(self.asked)
        asked = np.ascontiguousarray(self.asked.T)
        width = max(1, TILE // height // DEPTH) * DEPTH
        if self.room.size < width * height:
            self.room = np.empty(width * height, np.float32)
        best = np.empty((-(-n // DEPTH), height), np.float32)
        members = []
        own = np.flatnonzero(start < end)
        for r0 in range(0, n, width):
            r1 = min(r0 + width, n)
            groups = -(-(r1 - r0) // DEPTH)
            scores = self.room[: groups * DEPTH * height].reshape(-1, height)
            np.matmul(self.single[r0:r1], asked, out=scores[: r1 - r0])
            scores[r1 - r0 :] = EXCLUDED
            for q in own[(start[own] < r1) & (end[own] > r0)]:
                scores[max(start[q] - r0, 0) : end[q] - r0, q] = EXCLUDED
            g0 = r0 // DEPTH
            np.max(scores.reshape(DEPTH, groups, height), axis=0, out=best[g0 : g0 + groups])
            members.append(np.arange(r0, r0 + groups * DEPTH).reshape(DEPTH, groups).T)
        return best, np.concatenate(members)

    def floor(self, bars: np.ndarray) -> np.ndarray:
        """Screened scores below which no settled score reaches the bar; above EXCLUDED."""
        with np.errstate(over="ignore"):
            least = (raw_floor(bars, self.metric) - self.shift) / self.factor - self.slack
            least = np.nextafter(least.astype(np.float32), np.float32(EXCLUDED))
        return np.maximum(least, np.finfo(np.float32).min)

    def winners(self, bars: np.ndarray, k: int, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``winners`` of the whole strip among all rows but each query's own, from ``start`` to ``end``.

        Maxima of groups of rows tell which groups may hold a hit; their rows
        are screened again, one by one, and those left are scored exactly.
        """
        best, members = self.maxima(start, end)
        n, groups = len(self.rows), len(best)
        if groups >= k:
            # Each of k wider groups holds a row with that score or a higher one.
            wide = min(groups, max(DEPTH * k, groups // DEPTH))
            body = groups // wide * wide
            coarse = best[:body].reshape(-1, wide, len(bars)).max(axis=0)
            np.maximum(coarse[: groups - body], best[body:], out=coarse[: groups - body])
            sure = np.partition(coarse, wide - k, axis=0)[wide - k].astype(np.float64) - self.slack
            np.maximum(bars, settle(self.factor * sure + self.shift, self.metric), out=bars)
        floor = self.floor(bars)
        g, q = np.divmod(np.flatnonzero(best >= floor), len(bars))
        many = np.bincount(q, minlength=len(bars)) > max(4 * k, groups // DEPTH)
        g, q = g[~many[q]], q[~many[q]]
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        step = max(1, TILE // (DEPTH * max(1, self.single.shape[1])))
        for i in range(0, q.size, step):
            some, places = q[i : i + step, None], members[g[i : i + step]]
            close = np.einsum("grd,gd->gr", self.single[np.minimum(places, n - 1)], self.asked[some[:, 0]])
            counts = (places < n) & ((places < start[some]) | (places >= end[some]))
            which, slot = np.nonzero(counts & (close >= floor[some]))
            pairs.append((some[which, 0], places[which, slot]))
        q, r = (np.concatenate(part) for part in zip(*pairs))
        value = settle(pair_scores(self.queries, self.rows, q, r, self.metric), self.metric)
        q, r, value, last = first_k(q, r, value, k)
        bars[q[last]] = np.maximum(bars[q[last]], value[last])
        kept = value >= bars[q]
        found = [(q[kept], r[kept], value[kept])]
        whole = np.flatnonzero(many)
        step = max(1, TILE // n)
        for some in (whole[i : i + step] for i in range(0, whole.size, step)):
            raw = score_block(self.queries[some], self.rows, self.metric)
            for scores, q in zip(raw, some):
                scores[start[q] : end[q]] = EXCLUDED
            settled = settle(raw, self.metric)
            mask, bar = best_mask(settled, k)
            q, r = np.nonzero(mask & (settled >= bars[some][:, None]))
            found.append((some[q], r, settled[q, r]))
            bars[some] = np.maximum(bars[some], bar)
        return tuple(np.concatenate(part) for part in zip(*found))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equal-length list column as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def cut(table: pa.Table, k: int, ids: list[str]) -> pa.Table:
    """The ``k`` best rows per query of a candidate table, total order."""
    order = [("_q", "ascending"), ("score", "descending")] + [(c, "ascending") for c in ids]
    table = table.take(pc.sort_indices(table.select([c for c, _ in order]), sort_keys=order))
    query = table.column("_q").to_numpy()
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return table.filter(pa.array(rank < k))


@dataclass
class Search:
    """What a task needs to score its rows; small, shipped once per executor.

    ``ids`` settle equal scores; the last of them is a digest of the carried
    columns, so that rows with the same id have an order too. Queries are told
    apart by position, never by id.
    """

    k: int
    metric: str
    ids: list[str]
    column: str
    carried: list[str]
    exclude_self: bool
    queries: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    query_ids: pa.Array | None = None
    positions: pa.Array | None = None
    bars: np.ndarray | None = None
    by_cell: dict[int, np.ndarray] | None = None

    def asking(self, vectors: np.ndarray, query_ids: pa.Array, positions: pa.Array | None = None, bars: np.ndarray | None = None) -> Search:
        """The same search with its queries, and scores that their hits must reach."""
        wanted = unit_rows(vectors) if self.metric == "cosine" else vectors
        if positions is None:
            positions = pa.array(np.arange(len(wanted)), pa.int64())
        return replace(self, queries=wanted, query_ids=query_ids, positions=positions, bars=bars)

    def first_bars(self) -> np.ndarray:
        return np.full(len(self.queries), EXCLUDED) if self.bars is None else self.bars.copy()

    def candidates(self, table: pa.Table, which: np.ndarray, bars: np.ndarray) -> Iterator[pa.Table]:
        """Candidate tables: up to ``k`` rows per query of ``which`` and tile, a strip of queries at a time.

        ``bars`` holds per query a score that k rows seen so far reach; it
        rises as rows are seen and lets most tiles be passed over.
        """
        table = table.filter(pc.is_valid(table.column(self.column)))
        if not table.num_rows:
            return
        table = table.take(pc.sort_indices(table.select(self.ids), sort_keys=[(c, "ascending") for c in self.ids]))
        kept = table.select(self.ids + self.carried)
        rows = matrix(table.column(self.column))
        if self.metric == "cosine":
            rows = unit_rows(rows)
        first = after = np.zeros(len(self.queries), np.int64)
        if self.exclude_self:
            # Sorted by id: the rows of an id are neighbours.
            kinds = pc.unique(self.query_ids.drop_null())
            own = pc.fill_null(pc.index_in(table.column(self.ids[0]), value_set=kinds), -1).to_numpy()
            asking = pc.fill_null(pc.index_in(self.query_ids, value_set=kinds), len(kinds)).to_numpy(zero_copy_only=False)
            places = np.flatnonzero(own >= 0)
            first, after = np.zeros(len(kinds) + 1, np.int64), np.zeros(len(kinds) + 1, np.int64)
            first[own[places[::-1]]] = places[::-1]
            after[own[places]] = places + 1
            first, after = first[asking], after[asking]
        # Rows and queries that single precision cannot screen are scored exactly, apart.
        fine = ordinary(rows)
        kinds = [np.flatnonzero(fine), np.flatnonzero(~fine)]
        blocks = [(of, rows if of.size == len(rows) else rows[of]) for of in kinds]
        screen = Screen(blocks[0][1], self.metric)
        simple = ordinary(self.queries[which])
        height = max(1, min(len(which), STRIP))
        width = max(self.k, TILE // height)
        for part in (some[q0 : q0 + height] for some in (which[simple], which[~simple]) for q0 in range(0, len(some), height)):
            reached = bars[part]
            strip = []
            asked = self.queries[part]
            plain = not ordinary(asked).all()
            for (of, block), exact in zip(blocks, (plain, True)):
                if not len(block):
                    continue
                start, end = np.searchsorted(of, first[part]), np.searchsorted(of, after[part])
                if not exact:
                    screen.ask(asked)
                    q, r, score = screen.winners(reached, self.k, start, end)
                    strip.append((q, of[r], score))
                    continue
                for r0 in range(0, len(block), width):
                    r1 = min(r0 + width, len(block))
                    scores = score_block(asked, block[r0:r1], self.metric)
                    low, high = np.maximum(start - r0, 0), np.minimum(end - r0, r1 - r0)
                    for q in np.flatnonzero(low < high):
                        scores[q, low[q] : high[q]] = EXCLUDED
                    q, r, score = winners(scores, reached, self.k, self.metric)
                    strip.append((q, of[r0 + r], score))
            bars[part] = reached
            if strip:
                q, r, score = (np.concatenate(of) for of in zip(*strip))
                q, r, score = first_k(q, r, score, self.k)[:3]
                found = kept.take(pa.array(r))
                yield found.append_column("_q", pa.array(part[q].astype(np.int32))).append_column("score", pa.array(score))

    def merge(self, parts: list[pa.Table]) -> list[pa.Table]:
        return [cut(pa.concat_tables(parts).combine_chunks(), self.k, self.ids)] if parts else []

    def finish(self, best: pa.Table, schema: pa.Schema) -> pa.Table:
        """Candidates in the result layout, undefined scores as null."""
        score = best.column("score")
        score = pc.if_else(pc.equal(score, UNDEFINED), pa.scalar(None, pa.float64()), score)
        which = best.column("_q").combine_chunks()
        columns = [self.positions.take(which), self.query_ids.take(which)]
        columns += [best.column(c) for c in self.ids] + [score] + [best.column(c) for c in self.carried]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def result_schema(corpus: DataFrame, queries: DataFrame, query_id: str, ids: list[str], carried: list[str]):
    position = T.StructField("_q", T.LongType())
    return T.StructType([position, queries.schema[query_id]] + result_fields(corpus, ids, carried))


def result_fields(corpus: DataFrame, ids: list[str], carried: list[str]) -> list[T.StructField]:
    score = [T.StructField("score", T.DoubleType())]
    return [corpus.schema[c] for c in ids] + score + [corpus.schema[c] for c in carried]


def scan_search(corpus: DataFrame, search: Search, schema: T.StructType) -> DataFrame:
    """Score the corpus where it lies; each partition sends its own top k.

    The corpus is not shuffled. Only ``k`` rows per query leave a partition.
    """
    ship(corpus.sparkSession)
    arrow = to_arrow_schema(schema)
    shared = corpus.sparkSession.sparkContext.broadcast(search)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Search = shared.value
        everyone = np.arange(len(s.queries))
        bars = s.first_bars()
        best: list[pa.Table] = []
        held = 0
        limit = 8 * s.k * max(1, len(everyone))
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if s.by_cell is None:
                groups = [(table, everyone)]
            else:
                groups = [
                    (table.filter(pc.equal(table.column("_cell"), cell)), s.by_cell[cell])
                    for cell in pc.unique(table.column("_cell")).to_pylist()
                    if cell in s.by_cell
                ]
            for rows, which in groups:
                for found in s.candidates(rows, which, bars):
                    best.append(found)
                    held += found.num_rows
                    if held > limit:
                        best = s.merge(best)
                        held = best[0].num_rows
        for table in s.merge(best):
            yield from s.finish(table, arrow).to_batches()

    cell = ["_cell"] if search.by_cell is not None else []
    return corpus.select(*search.ids, *search.carried, search.column, *cell).mapInArrow(scan, schema)


def grid_search(
    corpus: DataFrame,
    queries: DataFrame,
    search: Search,
    query_id: str,
    schema: T.StructType,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Search with a query table of any size; both sides carry ``_cell``.

    Queries have a position ``_q`` and may have a ``_bar``, both their own.

    Within a cell both sides are hashed into blocks of bounded size and each
    (corpus block, query block) pair is scored in one task, which returns k
    rows per query. A hot cell simply has more blocks.
    """
    ship(corpus.sparkSession)
    arrow = to_arrow_schema(schema)
    # As few blocks as memory allows, for every block is read once for each of the other side.
    enough = F.lit(math.ceil(math.sqrt(2 * corpus.sparkSession.sparkContext.defaultParallelism)))
    blocks = lambda df, size, column, name: df.groupBy("_cell").agg(
        F.greatest(
            F.ceil(F.count("*") / size),
            F.ceil(F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.size(column))), F.lit(0)) / BLOCK_NUMBERS),
            F.least(F.ceil(F.count("*") / SMALL_BLOCK), enough),
        ).cast("int").alias(name)
    )
    # At most one row per cell, so both tables are small whatever the data size.
    sizes = F.broadcast(
        blocks(corpus, block_rows, search.column, "_nc").join(blocks(queries, block_queries, "_query_vector", "_nq"), "_cell")
    )
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        corpus.select(*search.ids, *search.carried, search.column, "_cell")
        .join(sizes, "_cell")
        .withColumn("_cb", F.pmod(F.xxhash64(*search.ids, search.column), F.col("_nc")).cast("int"))
        .withColumn("_qb", up_to("_nq"))
        .drop("_nc", "_nq")
    )
    bar = F.coalesce("_bar", F.lit(EXCLUDED)) if "_bar" in queries.columns else F.lit(EXCLUDED)
    right = (
        queries.select("_q", F.col(query_id).alias("_query_id"), F.col("_query_vector"), bar.alias("_bar"), "_cell")
        .join(sizes, "_cell")
        .withColumn("_qb", F.pmod(F.xxhash64("_q"), F.col("_nq")).cast("int"))
        .withColumn("_cb", up_to("_nc"))
        .drop("_nc", "_nq")
    )

    def pair(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return arrow.empty_table()
        bars = asked.column("_bar").to_numpy()
        one = search.asking(*query_block(asked, "_query_id"), asked.column("_q").combine_chunks(), bars)
        best = one.merge(list(one.candidates(rows, np.arange(len(bars)), one.first_bars())))
        return one.finish(best[0], arrow) if best else arrow.empty_table()

    block = ["_cell", "_cb", "_qb"]
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(pair, schema)


def one_cell(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows in cell 0, as a hash: a literal would be folded out of the
    equi-join with the block counts."""
    return df.withColumn("_cell", F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int"))


def ranked(hits: DataFrame, ids: list[str], k: int) -> DataFrame:
    """Final cut: ``rank`` 1..k per query, equal scores in id order, null ids last."""
    order = Window.partitionBy("_q").orderBy(F.desc_nulls_last("score"), *[F.asc_nulls_last(c) for c in ids])
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def tied(corpus: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """``corpus`` with a digest of the carried columns that settles ties of one id."""
    return (corpus.withColumn("_tie", F.xxhash64(*columns)), ["_tie"]) if columns else (corpus, [])


def pilot_share(corpus: DataFrame, ids: list[str]) -> DataFrame | None:
    """A share of the corpus by hash, or None where few partitions make it pointless."""
    if corpus.rdd.getNumPartitions() <= MAX_BARE_PARTITIONS:
        return None
    return corpus.where(F.pmod(F.xxhash64(F.lit(PILOT), *ids), F.lit(PILOT)) == 0)


def knn(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    ids: list[str],
    column: str = "chunk_text_vector",
    query_id: str = "query_id",
    query_column: str = "query_vector",
    metric: str = "cosine",
    columns: list[str] | None = None,
    exclude_self: bool = False,
    max_broadcast_queries: int = MAX_BROADCAST_QUERIES,
) -> DataFrame:
    """The ``k`` nearest corpus rows of every query row, exactly.

    Up to ``max_broadcast_queries`` queries are shipped to the executors and
    the corpus is scored in place; a larger query table takes the grid path.
    Both give the same rows. Every query row is answered on its own and every
    corpus row may be hit, whether their ids are repeated or null. ``columns``
    of the hits are returned along; they travel with the candidates, so a hit
    has the columns of its own row. On a corpus of many partitions a search of
    a share of the rows finds a score that each query's hits must reach; then
    only rows that can win leave a partition. ``exclude_self`` drops rows whose
    (single) id equals the query id.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if exclude_self and len(ids) != 1:
        raise ValueError("exclude_self needs a single id column")
    corpus, tie = tied(corpus, list(columns or []))
    search = Search(k, metric, ids + tie, column, list(columns or []), exclude_self)
    asked = queries.where(F.col(query_column).isNotNull()).select(
        F.col(query_id), F.col(query_column).alias("_query_vector")
    )
    schema = result_schema(corpus, queries, query_id, search.ids, search.carried)
    share = pilot_share(corpus, ids)
    bare = replace(search, ids=ids, carried=[])
    bare_schema = result_schema(corpus, queries, query_id, ids, [])
    small = few_queries(asked, query_id, max_broadcast_queries)
    if small is None:
        asked = numbered(asked)
        if share is not None:
            first = grid_search(one_cell(share, ids), one_cell(asked, ["_q"]), bare, query_id, bare_schema)
            asked = hand_off(asked.join(reached(first, ids, k), "_q", "left"), "queries")
        hits = grid_search(one_cell(corpus, ids), one_cell(asked, ["_q"]), search, query_id, schema)
    else:
        block = query_block(small, query_id)
        bars = None
        if share is not None:
            bars = collected_bars(scan_search(share, bare.asking(*block), bare_schema), ids, k, small.num_rows)
        hits = scan_search(corpus, search.asking(*block, bars=bars), schema)
    return finished(ranked(hits, search.ids, k), query_id, ids, search.carried)


def finished(hits: DataFrame, query_id: str, ids: list[str], carried: list[str]) -> DataFrame:
    return hits.select(query_id, *ids, "score", *carried, "rank")


def numbered(asked: DataFrame) -> DataFrame:
    """Queries with a position of their own, written once so that it stays."""
    return hand_off(asked.withColumn("_q", F.monotonically_increasing_id()), "queries")


def reached(hits: DataFrame, ids: list[str], k: int) -> DataFrame:
    """``(_q, _bar)``: the score of each query's k-th hit, where it is defined."""
    last = ranked(hits, ids, k).where((F.col("rank") == k) & F.col("score").isNotNull())
    return last.select("_q", F.col("score").alias("_bar"))


def collected_bars(hits: DataFrame, ids: list[str], k: int, queries: int) -> np.ndarray:
    """The same as an array; one number per query of a bounded block."""
    bars = np.full(queries, EXCLUDED)
    table = reached(hits, ids, k).toArrow()
    bars[table.column("_q").to_numpy()] = table.column("_bar").to_numpy()
    return bars


def query_block(table: pa.Table, query_id: str) -> tuple[np.ndarray, pa.Array]:
    return matrix(table.column("_query_vector")), table.column(query_id).combine_chunks()


def few_queries(asked: DataFrame, query_id: str, most: int) -> pa.Table | None:
    """The query table, or None when it has more than ``most`` rows.

    The limit bounds what reaches the driver; one row more tells "too many".
    """
    if not most:
        return None
    rows = asked.limit(most + 1).toArrow()
    return rows if rows.num_rows <= most else None


def nearest(
    corpus: DataFrame,
    vector: list[float],
    k: int,
    ids: list[str],
    column: str = "chunk_text_vector",
    metric: str = "cosine",
    columns: list[str] | None = None,
) -> DataFrame:
    """The ``k`` rows nearest to one vector: ids, score, columns, rank."""
    corpus, tie = tied(corpus, list(columns or []))
    search = Search(k, metric, ids + tie, column, list(columns or []), False)
    block = np.array([vector], dtype=np.float64), pa.array([0], pa.int32())
    one = [T.StructField("_q", T.LongType()), T.StructField("_one", T.IntegerType())]
    bars, share = None, pilot_share(corpus, ids)
    if share is not None:
        bare = replace(search, ids=ids, carried=[]).asking(*block)
        bars = collected_bars(scan_search(share, bare, T.StructType(one + result_fields(corpus, ids, []))), ids, k, 1)
    hits = scan_search(corpus, search.asking(*block, bars=bars), T.StructType(one + result_fields(corpus, search.ids, search.carried)))
    order = [F.desc_nulls_last("score"), *[F.asc_nulls_last(c) for c in search.ids]]
    return finished(ranked(hits.orderBy(*order).limit(k), search.ids, k), "_one", ids, search.carried).drop("_one")


def nearest_expr(
    corpus: DataFrame,
    vector: list[float],
    k: int,
    ids: list[str],
    column: str = "chunk_text_vector",
    metric: str = "cosine",
    columns: list[str] | None = None,
) -> DataFrame:
    """``nearest`` in Spark expressions alone: slower per row, no Python."""
    query = F.lit([float(x) for x in vector])
    scored = corpus.where(F.col(column).isNotNull()).select(
        *ids, vectors.score(F.col(column), query, metric).alias("score"), *(columns or [])
    )
    return scored.orderBy(F.desc_nulls_last("score"), *[F.asc_nulls_last(c) for c in ids]).limit(k)
