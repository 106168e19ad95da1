"""Near-duplicate embeddings by a robust-pruned flat graph over overlapping shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, stored
from papyra.llm.components import components
from papyra.session import ship

THRESHOLD = 0.93
CAP = 1024
PROBES = 3
LEVELS = 8
LEADERS = 64
LEADER_SAMPLE = 256
LEADER_APART = 0.75
DEGREE = 24
CANDIDATES = 64
ALPHA = 1.2
BEAM = 24
AUDIT_ROWS = 256
RECALL = 0.98
FLOOR = 0.9
#: Sampled nodes that must have lost links before low recall is an error.
EVIDENCE = 8
#: Single precision may differ from double by this much.
SLACK = 1e-4
PAIRS = 1 << 17


def unit_bytes(values: list | None) -> bytes | None:
    """The vector scaled to length one; none if it can link with nothing."""
    if values is None or None in values:
        return None
    v = np.array(values, float)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        v = v / (np.abs(v).max() or np.nan) if v.size else v
        v = v / np.sqrt((v * v).sum())
    return v.tobytes() if v.size and np.isfinite(v).all() else None


def placed(vectors: DataFrame) -> DataFrame:
    """``(vec_id, space, node, vec)``: equal vectors of a label share a node.

    ``space`` stands for label and dimension. Rows that link with nothing have
    a null node.
    """

    def run(batches):
        for batch in batches:
            units = [unit_bytes(v) for v in batch.column("embedding").to_pylist()]
            spaces, nodes, vecs = [], [], []
            for unit, label in zip(units, batch.column("label").to_pylist()):
                if unit is None or label is None:
                    spaces.append(None), nodes.append(None), vecs.append(None)
                    continue
                space = xxhash.xxh64_intdigest(f"{len(unit)}/{label}")
                spaces.append(space - (1 << 63))
                nodes.append(xxhash.xxh3_64_intdigest(unit, space) - (1 << 63))
                vecs.append(unit)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(spaces, pa.int64()), pa.array(nodes, pa.int64()), pa.array(vecs, pa.binary())],
                                             names=["vec_id", "space", "node", "vec"])

    columns = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    return arrow_map(columns, run, "vec_id long, space long, node long, vec binary")


def matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(len(column), -1)


def leaders(rows: pa.Table) -> pa.Table:
    """Up to as many sampled vectors as wanted, all pairwise apart."""
    rows = rows.sort_by([("turn", "ascending"), ("node", "ascending")])
    vectors, wanted = matrix(rows.column("vec")), rows.column("wanted")[0].as_py()
    chosen = [0]
    nearest = vectors @ vectors[0]
    for i in range(1, len(vectors)):
        if len(chosen) >= wanted:
            break
        if nearest[i] < LEADER_APART:
            chosen.append(i)
            nearest = np.maximum(nearest, vectors @ vectors[i])
    picked = rows.take(pa.array(chosen))
    return pa.table({"cell": picked.column("cell"), "vec": picked.column("vec"), "n": picked.column("n")})


def assigned(probes: int):
    def run(rows: pa.Table) -> pa.Table:
        lead = rows.column("node").is_null().to_numpy()
        centres = rows.filter(pa.array(lead)).sort_by("vec")
        members = rows.filter(pa.array(~lead))
        empty = {"cell": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "vec": pa.array([], pa.binary()), "home": pa.array([], pa.bool_())}
        if not len(members) or not len(centres):
            return pa.table(empty)
        sims = matrix(members.column("vec")) @ matrix(centres.column("vec")).T
        order = np.argsort(-sims, axis=1, kind="stable")[:, :probes]
        home = members.column("home").to_numpy()
        at, rank = np.nonzero(home[:, None] & (np.arange(order.shape[1]) > 0)[None, :] | (np.arange(order.shape[1]) == 0)[None, :])
        cell = rows.column("cell")[0].as_py()
        children = np.array([xxhash.xxh64_intdigest(f"{cell}/{i}") - (1 << 63) for i in range(len(centres))])
        taken = members.take(pa.array(at))
        return pa.table({"cell": pa.array(children[order[at, rank]]), "node": taken.column("node"), "vec": taken.column("vec"),
                         "home": pa.array(home[at] & (rank == 0))})

    return run


def overlapping_cells(nodes: DataFrame, cap: int, probes: int) -> DataFrame:
    """``(cell, node, vec)``: clusters of about ``cap`` nodes, each node in several.

    Starting from one cell per space, cells over ``cap`` are split around
    leaders: members of a bounded sample of the cell that lie apart, so a group
    of near copies has one leader and is not torn. A node goes to its nearest
    leader, and from its home also to the next ones. A cell whose sample has
    only one leader stays whole; tiles bound the work on it.
    """
    open_ = nodes.select(F.col("space").alias("cell"), "node", "vec", F.lit(True).alias("home"))
    done = None
    for level in range(LEVELS):
        open_ = stored(open_, "cells")
        sizes = open_.groupBy("cell").agg(F.count("*").alias("n"))
        large = stored(sizes.filter(F.col("n") > cap), "large")
        small = open_.join(large, "cell", "left_anti").select("cell", "node", "vec")
        done = small if done is None else done.union(small)
        if large.isEmpty():
            return done.distinct()
        rows = open_.join(large, "cell")
        turn = F.xxhash64("node", F.lit(level))
        first = F.row_number().over(Window.partitionBy("cell").orderBy("turn", "node"))
        sample = rows.withColumn("turn", turn).withColumn("at", first).filter(F.col("at") <= LEADER_SAMPLE)
        wanted = F.least(F.lit(LEADERS), F.ceil(1.5 * probes * F.col("n") / cap)).cast("int")
        sample = sample.select("cell", "node", "vec", "turn", "n", wanted.alias("wanted"))
        heads = stored(sample.groupBy("cell").applyInArrow(leaders, "cell long, vec binary, n long"), "leaders")
        single = heads.groupBy("cell").agg(F.count("*").alias("k")).filter("k = 1").select("cell")
        done = done.union(open_.join(single, "cell").select("cell", "node", "vec"))
        salts = F.ceil(F.col("n") / (4 * cap))
        split = rows.join(single, "cell", "left_anti")
        members = split.select("cell", F.pmod(F.xxhash64("node"), salts).alias("salt"), "node", "vec", "home")
        centres = heads.join(single, "cell", "left_anti").select("cell", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"),
                                                               F.lit(None).cast("long").alias("node"), "vec", F.lit(False).alias("home"))
        open_ = members.union(centres).groupBy("cell", "salt").applyInArrow(assigned(probes), "cell long, node long, vec binary, home boolean")
    return done.union(stored(open_, "cells").select("cell", "node", "vec")).distinct()


def robust_prune(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """Adjacency lists of one shard (padded with -1) and its medoid.

    Candidates of a node are its nearest; the nearest one left becomes a
    neighbour and drops the candidates that are clearly nearer to it than to
    the node. Then every neighbour gets the link back while it has room.
    """
    m = len(vectors)
    v = vectors.astype(np.float32)
    centre = v.mean(axis=0)
    medoid = int((v @ centre).argmax())
    k = min(CANDIDATES, m - 1)
    lists = np.full((m, DEGREE), -1, np.int32)
    if k < 1:
        return lists, medoid
    for low in range(0, m, 256):
        own = np.arange(low, min(low + 256, m))
        sims = v[own] @ v.T
        sims[np.arange(own.size), own] = -np.inf
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        # A few far nodes keep the graph in one piece where copies crowd together.
        far = (own[:, None] * 7919 + np.arange(1, 9) * 104729) % m
        near = np.concatenate((near, far), axis=1)
        near_sims = np.take_along_axis(sims, near, axis=1)
        order = np.argsort(-near_sims, axis=1)
        near, dist = np.take_along_axis(near, order, axis=1), 1 - np.take_along_axis(near_sims, order, axis=1)
        live = np.isfinite(dist)
        rows = np.arange(own.size)
        for slot in range(DEGREE):
            any_ = live.any(axis=1)
            if not any_.any():
                break
            pick = live.argmax(axis=1)
            chosen = near[rows, pick]
            lists[own[any_], slot] = chosen[any_]
            between = 1 - np.einsum("qd,qcd->qc", v[chosen], v[near])
            live &= (ALPHA * between > dist) | ~any_[:, None]
            live[rows, pick] = False
    return with_back_links(lists), medoid


def with_back_links(lists: np.ndarray) -> np.ndarray:
    m = len(lists)
    source, slot = np.nonzero(lists >= 0)
    target = lists[source, slot]
    edges = np.unique(np.concatenate((source * m + target, target.astype(np.int64) * m + source)))
    a, b = edges // m, edges % m
    first = np.searchsorted(a, np.arange(m))
    place = np.arange(a.size) - first[a]
    own = np.zeros(m * m if m <= 4096 else 0, bool)
    if own.size:
        own[source * m + target] = True
        order = np.lexsort((~own[edges], a))  # a node's own choices come before links back
        a, b = a[order], b[order]
    width = 2 * DEGREE
    out = np.full((m, width), -1, np.int32)
    keep = place < width
    out[a[keep], place[keep]] = b[keep]
    return out


def build(rows: pa.Table) -> pa.Table:
    """A shard's adjacency lists, by node."""
    rows = rows.sort_by("node")
    nodes = rows.column("node").to_numpy()
    lists, medoid = robust_prune(matrix(rows.column("vec")))
    neighbours = [nodes[line[line >= 0]] for line in lists]
    return pa.table({"cell": rows.column("cell"), "tile": rows.column("tile"), "node": rows.column("node"),
                     "neighbours": pa.array(neighbours, pa.list_(pa.int64())), "medoid": pa.array(np.arange(len(nodes)) == medoid)})


def range_search(v: np.ndarray, lists: np.ndarray, entries: np.ndarray, low: float) -> np.ndarray:
    """``hit[q, n]``: nodes within range that the search for each node as query meets.

    All queries move together. First a greedy search from the medoids keeps a
    beam of the best nodes met and opens the best one not yet opened. Then the
    range expands: every node within range is opened, until no opened node has
    a neighbour within range that is new.
    """
    m = len(v)
    seen, hit, opened = (np.zeros((m, m), bool) for _ in range(3))
    beam = np.full((m, BEAM), -1, np.int32)
    value = np.full((m, BEAM), -np.inf, np.float32)
    entries = entries[:BEAM]
    start = v @ v[entries].T
    beam[:, : entries.size], value[:, : entries.size] = entries, start
    seen[:, entries] = True
    hit[:, entries] = start >= low
    active = np.arange(m)
    while active.size:
        ids, val = beam[active], value[active]
        closed = (ids < 0) | opened[active[:, None], np.maximum(ids, 0)]
        score = np.where(closed, -np.inf, val)
        best = score.argmax(axis=1)
        going = np.isfinite(score[np.arange(active.size), best])
        active, ids, val, best = active[going], ids[going], val[going], best[going]
        if not active.size:
            break
        node = ids[np.arange(active.size), best]
        opened[active, node] = True
        near = lists[node]
        fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
        q, slot = np.nonzero(fresh)
        found = near[q, slot]
        seen[active[q], found] = True
        sims = np.full(near.shape, -np.inf, np.float32)
        sims[q, slot] = np.einsum("pd,pd->p", v[active[q]], v[found])
        inside = sims[q, slot] >= low
        hit[active[q[inside]], found[inside]] = True
        ids, val = np.concatenate((ids, near), axis=1), np.concatenate((val, sims), axis=1)
        top = np.argpartition(-val, BEAM - 1, axis=1)[:, :BEAM]
        beam[active], value[active] = np.take_along_axis(ids, top, axis=1), np.take_along_axis(val, top, axis=1)
    while True:
        q, node = np.nonzero(hit & ~opened)
        if not q.size:
            return hit
        opened[q, node] = True
        step = max(1, PAIRS // lists.shape[1])
        for at in range(0, q.size, step):
            part = slice(at, at + step)
            near = lists[node[part]]
            flat = (q[part][:, None] * np.int64(m) + near)[near >= 0]
            flat = np.unique(flat[~seen.ravel()[flat]])
            seen.ravel()[flat] = True
            sims = np.einsum("pd,pd->p", v[flat // m], v[flat % m])
            hit.ravel()[flat[sims >= low]] = True


def spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links (a symmetric matrix) connect."""
    left, right = [], []
    rest = linked.any(axis=1)
    while rest.any():
        front = [int(rest.argmax())]
        rest[front] = False
        while front:
            at = front.pop()
            found = np.flatnonzero(linked[at] & rest)
            rest[found] = False
            left += [at] * found.size
            right += found.tolist()
            front += found.tolist()
    return np.array(left, np.int64), np.array(right, np.int64)


def search(threshold: float):
    """Links of one pair of tiles of a cell, as edges that span them."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        nodes = rows.column("node").to_numpy()
        exact = matrix(rows.column("vec"))
        v = exact.astype(np.float32)
        m = len(nodes)
        own = rows.column("neighbours").to_pylist()
        sizes = np.array([len(x) for x in own])
        flat = np.fromiter((n for x in own for n in x), np.int64, int(sizes.sum()))
        at = np.minimum(np.searchsorted(nodes, flat), m - 1)
        here = nodes[at] == flat
        owner = np.repeat(np.arange(m), sizes)[here]
        place = np.arange(owner.size) - np.searchsorted(owner, owner)
        lists = np.full((m, int(place.max()) + 1 if place.size else 1), -1, np.int32)
        lists[owner, place] = at[here]
        hit = range_search(v, lists, np.flatnonzero(rows.column("medoid").to_numpy()), threshold - SLACK)
        i, j = np.nonzero(np.triu(hit | hit.T, 1))
        true = np.concatenate([np.einsum("pd,pd->p", exact[i[s : s + PAIRS]], exact[j[s : s + PAIRS]]) for s in range(0, i.size, PAIRS)] or [np.zeros(0)])
        i, j = i[true >= threshold], j[true >= threshold]
        linked = np.zeros((m, m), bool)
        linked[i, j] = linked[j, i] = True
        a, b = spanning(linked)
        return pa.table({"a": pa.array(nodes[a]), "b": pa.array(nodes[b])})

    return run


def in_tiles(shards: DataFrame) -> DataFrame:
    """Each row of ``shards`` once for every pair ``(lo, hi)`` of tiles that its tile is in."""
    rows = shards.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    return rows.withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")}).drop("other", "tiles")


def found_links(nodes: DataFrame, threshold: float, cap: int, probes: int) -> tuple[DataFrame, DataFrame]:
    """``(a, b)`` edges that span the links found, and the shards they were found in."""
    ship(nodes.sparkSession)
    cells = stored(overlapping_cells(nodes.select("space", "node", "vec"), cap, probes), "overlapping")
    sizes = cells.groupBy("cell").agg(F.count("*").alias("size"))
    tiles = F.ceil(F.col("size") / cap)
    tiled = cells.join(sizes, "cell").withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    shards = stored(tiled.select("cell", "tile", "tiles", "node", "vec"), "shards")
    built = shards.select("cell", "tile", "node", "vec").groupBy("cell", "tile").applyInArrow(
        build, "cell long, tile long, node long, neighbours array<long>, medoid boolean")
    built = stored(built, "lists")
    united = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    starts = built.filter("medoid").select("cell", "tile", "node", "medoid")
    rows = in_tiles(shards.join(united, "node").join(starts, ["cell", "tile", "node"], "left").withColumn("medoid", F.coalesce("medoid", F.lit(False))))
    return stored(rows.groupBy("cell", "lo", "hi").applyInArrow(search(threshold), "a long, b long"), "links"), shards


def counted(threshold: float):
    """``(node, links)`` of one pair of tiles of a cell: rows linked within one component.

    A pair held by several cells counts in the first of them.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("root", "ascending"), ("node", "ascending")])
        cell, lo, hi = (rows.column(c)[0].as_py() for c in ("cell", "lo", "hi"))
        exact = matrix(rows.column("vec"))
        v = exact.astype(np.float32)
        m, copies, tile, root = len(v), *(rows.column(c).to_numpy() for c in ("n", "tile", "root"))
        cells = rows.column("cells").to_pylist()
        none = np.iinfo(np.int64).max
        held = np.full((m, max(len(c) for c in cells)), none, np.int64)
        for k, c in enumerate(cells):
            held[k, : len(c)] = c
        links = np.zeros(m)
        starts = np.flatnonzero(np.concatenate(([True], root[1:] != root[:-1])))
        for low, high in zip(starts, np.append(starts[1:], m)):
            group = np.arange(low, high)
            left, right = group[tile[group] == lo], group[tile[group] == hi]
            for at in range(0, left.size, 128):
                part = left[at : at + 128]
                sims = v[part] @ v[right].T
                i, j = np.nonzero(sims >= threshold - SLACK)
                near = sims[i, j]
                i, j = part[i], right[j]
                if lo == hi:
                    near, i, j = near[i < j], i[i < j], j[i < j]
                close = np.flatnonzero(near < threshold + SLACK)
                sure = np.ones(i.size, bool)
                sure[close] = np.einsum("pd,pd->p", exact[i[close]], exact[j[close]]) >= threshold
                i, j = i[sure], j[sure]
                x, y = held[i], held[j]
                first = np.full(i.size, none)
                for k in range(y.shape[1]):
                    common = (x == y[:, k : k + 1]).any(axis=1)
                    first = np.minimum(first, np.where(common, y[:, k], none))
                i, j = i[first == cell], j[first == cell]
                links += np.bincount(i, copies[j], m) + np.bincount(j, copies[i], m)
        some = np.flatnonzero(links)
        return pa.table({"node": rows.column("node").take(pa.array(some)), "links": pa.array(links[some].astype(np.int64))})

    return run


def link_counts(nodes: DataFrame, shards: DataFrame, rooted: DataFrame, threshold: float) -> DataFrame:
    """``(node, links)``: rows of other nodes linked with each node.

    Every pair of a component that some cell holds is verified, so a link counts
    whichever cell's search met it.
    """
    homes = shards.groupBy("node").agg(F.sort_array(F.collect_set("cell")).alias("cells"))
    known = stored(nodes.select("node", "n").join(rooted, "node").join(homes, "node"), "known")
    rows = in_tiles(shards.join(known, "node"))
    parts = rows.groupBy("cell", "lo", "hi").applyInArrow(counted(threshold), "node long, links long")
    return stored(parts.groupBy("node").agg(F.sum("links").alias("links")), "counts")


def true_links(nodes: DataFrame, queries: pa.Table, threshold: float) -> dict[int, int]:
    """Links of the ``queries (space, node, vec)`` by brute force over all nodes."""
    spaces, ids = queries.column("space").to_numpy(), queries.column("node").to_numpy()
    shared = nodes.sparkSession.sparkContext.broadcast({int(s): (ids[spaces == s], matrix(queries.filter(pa.array(spaces == s)).column("vec"))) for s in set(spaces)})

    def run(batches):
        for batch in batches:
            found: dict[int, int] = {}
            space, node, n = (batch.column(c).to_numpy() for c in ("space", "node", "n"))
            for s, (own, vectors) in shared.value.items():
                rows = np.flatnonzero(space == s)
                for at in range(0, rows.size, 4096):
                    part = rows[at : at + 4096]
                    near = vectors @ matrix(batch.column("vec").take(pa.array(part))).T >= threshold
                    near &= own[:, None] != node[part][None, :]
                    for q, total in zip(own.tolist(), (near @ n[part]).tolist()):
                        found[q] = found.get(q, 0) + total
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["node", "true"])

    rows = arrow_map(nodes.select("space", "node", "vec", "n"), run, "node long, true long").groupBy("node").agg(F.sum("true").alias("true")).collect()
    shared.unpersist()
    return {r.node: r.true for r in rows}


def audit(nodes: DataFrame, counts: DataFrame, rooted: DataFrame, threshold: float, cap: int, rows: int = AUDIT_ROWS) -> tuple[float, float, int]:
    """Recall of small and of large components, and the sampled nodes that lost links.

    Recall is the mean, over nodes that have links, of the share of their links
    that was found. ``rows`` nodes are sampled from components of more than
    ``cap`` nodes, as many from smaller ones, and four times as many from the
    nodes without a link; those of them that have links by brute force count as
    nodes of small components of which nothing was found.
    """
    sizes = rooted.groupBy("root").agg(F.count("*").alias("size"))
    kinds = rooted.join(sizes, "root").select("node", F.when(F.col("size") > cap, "large").otherwise("small").alias("kind"))
    marked = nodes.select("space", "node", "vec").join(kinds, "node", "left").join(counts, "node", "left").withColumns(
        {"kind": F.coalesce("kind", F.lit("none")), "links": F.coalesce("links", F.lit(0))})
    marked = stored(marked, "audited")
    totals = {r.kind: r["count"] for r in marked.groupBy("kind").count().collect()}
    wanted = {"large": rows, "small": rows, "none": 4 * rows}
    drawn = [marked.filter(F.col("kind") == k).orderBy(F.xxhash64("node", F.lit("audit")), "node").limit(wanted[k]).toArrow() for k in totals]
    if not drawn:
        return 1.0, 1.0, 0
    queries = pa.concat_tables(drawn)
    true = true_links(nodes, queries.select(["space", "node", "vec"]), threshold)
    shares: dict[str, list[float]] = {k: [] for k in wanted}
    tried = dict.fromkeys(wanted, 0)
    for node, kind, links in zip(*(queries.column(c).to_pylist() for c in ("node", "kind", "links"))):
        tried[kind] += 1
        if true[node]:
            shares[kind].append(links / true[node])
    linked = {k: totals.get(k, 0) * len(shares[k]) / max(tried[k], 1) for k in wanted}
    mean = {k: sum(shares[k]) / max(len(shares[k]), 1) for k in wanted}
    few = linked["small"] + linked["none"]
    small = linked["small"] * mean["small"] / few if few else 1.0
    large = mean["large"] if shares["large"] else 1.0
    return small, large, sum(x < 1 for k in wanted for x in shares[k])


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, cap: int = CAP, probes: int = PROBES, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept, recall_small, recall_large)`` per row of ``vectors``.

    Vectors ``(vec_id, embedding, label)`` of one label and dimension link when
    their cosine in double precision is at least ``threshold``. Null labels and
    vectors that are null, empty, zero or not finite link with nothing.
    ``n_links`` counts other rows, repeated rows too; ``component_id`` is the
    smallest id reachable (a null id never is).

    Equal vectors are one node with a count. Nodes lie in overlapping clusters;
    each shard of at most ``cap`` nodes gets robust-pruned adjacency lists, a
    node's lists are united over its shards, and a range-expanding greedy
    search from the shards' medoids finds the links, which are then verified.
    Within the components they make, every pair that a cluster holds is
    verified and counted. Samples of small and of large components are audited
    against brute force over all nodes; below ``recall`` in either the clusters
    overlap more and the search is repeated, three times at most. Recall below
    ``FLOOR`` after that, shown by ``EVIDENCE`` sampled nodes, is an error.
    """
    rows = stored(placed(vectors), "vectors")
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("space").alias("space"), F.first("vec").alias("vec"), F.count("*").alias("n"), F.min("vec_id").alias("first"))
    nodes = stored(nodes, "nodes")
    for attempt in range(3):
        edges, shards = found_links(nodes, threshold, cap, probes << attempt)
        rooted = components(edges)
        counts = link_counts(nodes, shards, rooted, threshold)
        small, large, lost = audit(nodes, counts, rooted, threshold, cap)
        if min(small, large) >= recall:
            break
    if min(small, large) < FLOOR and lost >= EVIDENCE:
        raise RuntimeError(f"links found of small and of large components: {small:.3f}, {large:.3f}; set more probes")
    own = nodes.join(counts, "node", "left").join(rooted, "node", "left").select(
        "node", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    own = stored(own, "rooted")
    smallest = own.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stored(own.join(smallest, "root").select("node", "n_links", "component_id"), "classes")
    linked = rows.filter("node IS NOT NULL").join(classes, "node").select("vec_id", "n_links", "component_id")
    alone = rows.filter("node IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return linked.union(alone).select("*", kept, F.lit(small).alias("recall_small"), F.lit(large).alias("recall_large"))
