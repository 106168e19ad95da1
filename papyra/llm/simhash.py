"""Near-duplicates by SimHash fingerprints and pigeonhole blocks."""

from __future__ import annotations

from itertools import accumulate, combinations
from math import log2

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, free_name, longs, record_batch, stored, utf8
from papyra.llm.components import components

HASH_SEED = 42
TILE = 2048
SMALL = 8


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of a text; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    n = len(words) - size + 1
    for low in range(0, n, 1 << 16):
        high = min(n, low + (1 << 16))
        hashes = [digest(joined[a : b - 1], HASH_SEED) for a, b in zip(starts[low:high], ends[low + size - 1 : high + size - 1])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``(doc_id, text_hash, fp)``, one row per document; ``fp`` is the signed long."""

    def run(batches):
        for batch in batches:
            made = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in batch.column("text")]
            yield record_batch(doc_id=batch.column("doc_id"), text_hash=batch.column("text_hash"),
                               fp=np.array(made, np.uint64).view(np.int64))

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), utf8(F.col("text")).alias("text"))
    return arrow_map(columns, run, "doc_id long, text_hash long, fp long")


def masks(blocks: int, bits: int) -> list[int]:
    """Signed masks of all choices of ``blocks - bits`` out of ``blocks`` blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    chosen = [sum(c) for c in combinations(block, blocks - bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def block_count(distinct: int, bits: int) -> int:
    """Fewest blocks whose keys take at least as many values as there are fingerprints."""
    blocks = bits + 2
    while 64 * (blocks - bits) / blocks < log2(max(distinct, 2)) and blocks < 2 * bits + 4:
        blocks += 1
    return blocks


def spanning_links(values: np.ndarray, bits: int) -> tuple[list, list]:
    """Links (at most ``bits`` apart) that connect what all links would connect."""
    left, right, rest = [], [], values
    while rest.size:
        front, rest = [rest[0]], rest[1:]
        while front and rest.size:
            at = front.pop()
            near = np.bitwise_count(rest ^ at) <= bits
            found = rest[near]
            if found.size:
                rest = rest[~near]
                left.append(np.full(found.size, at))
                right.append(found)
                front.extend(found)
    return left, right


def group_links(cell: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``cell``: all of small runs, spanning ones of large."""
    edges = np.flatnonzero(np.diff(cell)) + 1
    starts = np.concatenate(([0], edges))
    sizes = np.diff(np.concatenate((starts, [cell.size])))
    small = np.repeat(sizes <= SMALL, sizes)
    left, right = [], []
    for d in range(1, SMALL):
        hit = small[d:] & (cell[d:] == cell[:-d]) & (np.bitwise_count(fp[d:] ^ fp[:-d]) <= bits)
        left.append(fp[:-d][hit])
        right.append(fp[d:][hit])
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        a, b = spanning_links(np.unique(fp[start : start + size]), bits)
        left += a
        right += b
    return np.concatenate(left), np.concatenate(right)


def links(values: DataFrame, bits: int = 4, tile: int = TILE) -> DataFrame:
    """``(a, b)`` links that connect all of ``values (fp)`` at most ``bits`` apart.

    Two such fingerprints agree in at least ``blocks - bits`` of ``blocks``
    blocks, so they share the key of one choice of that many blocks. Keys of
    one fingerprint go no further. A key of more than ``tile`` fingerprints is
    cut into tiles, and each pair of tiles is a group of its own: exact, and
    of bounded size whatever the key holds. A group gives the links that
    connect it, fewer than it has members, not all its pairs.
    """
    values = values.distinct()
    blocks = block_count(values.count(), bits)
    keys = F.array(*[F.struct(F.lit(i).cast("short").alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(masks(blocks, bits))])
    placed = values.select("fp", F.explode(keys).alias("k")).select("fp", "k.choice", "k.key")
    shared = placed.groupBy("choice", "key").agg(F.count("*").alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / tile)
    own = F.pmod(F.xxhash64("fp"), tiles)
    other = F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))
    grouped = (
        placed.join(shared, ["choice", "key"])
        .select("fp", "choice", "key", own.alias("t"), other.alias("u"))
        .select(F.xxhash64("choice", "key", F.least("t", "u"), F.greatest("t", "u")).alias("cell"), "fp")
    )

    def run(batches):
        held = None
        for batch in batches:
            cell, fp = longs(batch.column("cell")), longs(batch.column("fp")).view(np.uint64)
            if held is not None:
                cell, fp = np.concatenate((held[0], cell)), np.concatenate((held[1], fp))
            if not cell.size:
                continue
            cut = np.searchsorted(cell, cell[-1])
            held = cell[cut:], fp[cut:]
            if cut:
                a, b = group_links(cell[:cut], fp[:cut], bits)
                yield record_batch(a=a.view(np.int64), b=b.view(np.int64))
        if held is not None:
            a, b = group_links(*held, bits)
            yield record_batch(a=a.view(np.int64), b=b.view(np.int64))

    return arrow_map(grouped.repartition("cell").sortWithinPartitions("cell"), run, "a long, b long")


def classes(prints: DataFrame, bits: int = 4) -> DataFrame:
    """``(fp, root, first, component)`` per distinct fingerprint of ``prints``.

    ``root`` names the component, ``component`` is its smallest ``doc_id`` and
    ``first`` the ``(doc_id, text_hash)`` of the row to keep: smallest id, then
    smallest hash, null ids last.
    """
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")
    own = prints.groupBy("fp").agg(F.min(order).alias("first"))
    rooted = components(links(prints.select("fp"), bits)).withColumnRenamed("node", "fp")
    own = stored(own.join(rooted, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "classes")
    whole = own.groupBy("root").agg(F.min("first").alias("first"))
    return own.drop("first").join(whole, "root").select("fp", "root", "first", F.col("first.doc_id").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs (doc_id, text)``.

    Null and empty texts have fingerprint zero and are linked like others.
    Repeated rows stay, each with its class. A null ``doc_id`` is never the
    smallest; where a component has no other, ``component_id`` is null.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    joined = prints.join(stored(classes(prints, bits).select("fp", "component"), "components"), "fp")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """``docs`` without near-duplicates: one row of each component stays.

    The row with the smallest id stays (then the smallest text hash); of rows
    equal in id and text one stays.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    keep = classes(prints, bits).select("first.doc_id", "first.text_hash").distinct()
    row, digest, keep_row, keep_digest = (free_name(docs.columns, n) for n in ("_row", "_digest", "_keep_row", "_keep_digest"))
    keep = stored(keep, "keep").select(F.col("doc_id").alias(keep_row), F.col("text_hash").alias(keep_digest))
    rows = docs.withColumns({row: F.col("doc_id").cast("long"), digest: F.xxhash64("text")})
    same = F.col(row).eqNullSafe(F.col(keep_row)) & (F.col(digest) == F.col(keep_digest))
    return rows.dropDuplicates([row, digest]).join(keep, same, "left_semi").select(*docs.columns)
