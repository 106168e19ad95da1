"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into a fixed number of slots. A small map says which shard
holds a slot; it follows the slots' bytes, and rebalancing edits it instead of
hashing the records anew. A slot that repeated rows make too heavy is dealt
into pieces, each with an entry of its own.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyra.llm.common import stored, utf8
from papyra.session import scratch_dir

SLOTS = 8192
SHARDS = 8
#: A slot with more than this part of a shard's share is dealt into pieces.
HEAVY = 64
MAP = "slot int, piece int, pieces int, shard int, bytes long, records long"


@dataclass(frozen=True)
class Entry:
    """Where one slot, or one piece of a heavy slot, lies and what it holds."""

    slot: int
    piece: int
    pieces: int
    shard: int
    bytes: int
    records: int


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` reduced to ``(doc_id, size, text_crc32, vslot, part)``, written once.

    ``part`` is the task that wrote the row. It only tells repeated rows apart.
    """
    text = utf8(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("digest"))
    slot = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(slots)).cast("int")
    return stored(rows.select("doc_id", "size", "text_crc32", slot.alias("vslot"), F.spark_partition_id().alias("part")), "slotted")


def slot_loads(rows: DataFrame) -> list[tuple[int, int, int]]:
    """``(slot, bytes, records)``, in slot order; one row per slot."""
    loads = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))
    return sorted((r.vslot, r.bytes, r.records) for r in loads.collect())


def pieces_of(loads: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """Number of pieces of each slot too heavy to be moved as one.

    At most ``2 * HEAVY * shards`` slots are, and they have at most twice as
    many pieces in all, whatever the corpus.
    """
    total, records = sum(b for _, b, _ in loads), sum(n for *_, n in loads)
    made = {}
    for slot, size, n in loads:
        wanted = max(size * HEAVY * shards // max(1, total), n * HEAVY * shards // max(1, records))
        if n > 1 and wanted >= 1:
            made[slot] = min(n, wanted + 1)
    return made


def in_pieces(rows: DataFrame, pieces: dict[int, int]) -> DataFrame:
    """``rows`` with ``piece``: 0, or in a heavy slot one of its pieces.

    A second hash of the record decides. A slot that holds a row more than
    once has its rows dealt round instead, numbered within the task that wrote
    them, so that no group outgrows a task.
    """
    if not pieces:
        return rows.withColumn("piece", F.lit(0))
    record = ["doc_id", "size", "text_crc32"]
    copies = rows.filter(F.col("vslot").isin(sorted(pieces))).groupBy("vslot", *record).count().groupBy("vslot").agg(F.max("count").alias("most"))
    repeated = {r.vslot for r in copies.filter("most > 1").collect()}
    heavy = F.broadcast(rows.sparkSession.createDataFrame([(s, n, s in repeated) for s, n in sorted(pieces.items())], "vslot int, pieces int, dealt boolean"))
    found = rows.join(heavy, "vslot")
    by_task = Window.partitionBy("vslot", "part").orderBy(*record)
    dealt = found.filter("dealt").withColumn("piece", F.pmod(F.row_number().over(by_task) + F.col("part"), F.col("pieces")).cast("int"))
    hashed = found.filter("NOT dealt").withColumn("piece", F.pmod(F.xxhash64(F.lit("piece"), *record), F.col("pieces")).cast("int"))
    rest = rows.join(heavy, "vslot", "left_anti").withColumn("piece", F.lit(0))
    return stored(rest.unionByName(dealt.unionByName(hashed).drop("pieces", "dealt")), "pieces")


def balanced(entries: list[Entry], shards: int) -> list[Entry]:
    """A first map: heaviest entries first, each to the shard with the fewest bytes."""
    fill = [(0, 0, s) for s in range(shards)]
    made = []
    for e in sorted(entries, key=lambda e: (-e.bytes, e.slot, e.piece)):
        size, records, shard = heapq.heappop(fill)
        made.append(replace(e, shard=shard))
        heapq.heappush(fill, (size + e.bytes, records + e.records, shard))
    return sorted(made, key=lambda e: (e.slot, e.piece))


def rebalanced(entries: list[Entry], shards: int, tolerance: float = 0.01) -> list[Entry]:
    """``entries`` edited for ``shards`` shards: as few moves as evenness allows.

    An entry leaves a shard only if that shard is above its share by more than
    ``tolerance``, or is no longer there. Adding shards moves entries only
    into shards below their share, the new ones first of all.
    """
    share = sum(e.bytes for e in entries) / shards
    load = dict.fromkeys(range(shards), 0)
    homeless, by_shard = [], {s: [] for s in range(shards)}
    for e in entries:
        if e.shard in load:
            load[e.shard] += e.bytes
            by_shard[e.shard].append(e)
        else:
            homeless.append(e)
    for shard, held in by_shard.items():
        if load[shard] <= share * (1 + tolerance):
            continue
        # The largest entries that still fit into the excess: few moves, none too many.
        for e in sorted(held, key=lambda e: (-e.bytes, e.slot, e.piece)):
            if load[shard] - e.bytes >= share:
                load[shard] -= e.bytes
                held.remove(e)
                homeless.append(e)
    fill = [(size, s) for s, size in load.items()]
    heapq.heapify(fill)
    for e in sorted(homeless, key=lambda e: (-e.bytes, e.slot, e.piece)):
        size, shard = heapq.heappop(fill)
        by_shard[shard].append(replace(e, shard=shard))
        heapq.heappush(fill, (size + e.bytes, shard))
    return sorted((e for held in by_shard.values() for e in held), key=lambda e: (e.slot, e.piece))


def save_map(spark: SparkSession, folder: str, version: int, entries: list[Entry]) -> None:
    """Write one version of the map; a version is never changed afterwards."""
    rows = [(e.slot, e.piece, e.pieces, e.shard, e.bytes, e.records) for e in entries]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> tuple[int, list[Entry]]:
    """A version of the map, by default the newest."""
    versions = spark.read.schema(f"{MAP}, version int").parquet(folder)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return version, sorted((Entry(r.slot, r.piece, r.pieces, r.shard, r.bytes, r.records)
                            for r in versions.filter(F.col("version") == version).collect()), key=lambda e: (e.slot, e.piece))


def measured(rows: DataFrame, loads: list[tuple[int, int, int]], pieces: dict[int, int]) -> list[Entry]:
    """Entries without a shard yet. Only heavy slots are looked at again."""
    made = [Entry(s, 0, 1, -1, b, n) for s, b, n in loads if s not in pieces]
    if pieces:
        heavy = rows.filter(F.col("vslot").isin(sorted(pieces))).groupBy("vslot", "piece")
        found = heavy.agg(F.sum("size").alias("bytes"), F.count("*").alias("records")).collect()
        made += [Entry(r.vslot, r.piece, pieces[r.vslot], -1, r.bytes, r.records) for r in found]
    return sorted(made, key=lambda e: (e.slot, e.piece))


def placed(rows: DataFrame, entries: list[Entry]) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, their place in it, gapless from 0.

    A shard holds its entries one after the other, so a row's place is the
    rows of the entries before its own plus its rank within its own. No window
    spans more than one entry.
    """
    spark = rows.sparkSession
    before = {}
    starts = []
    for e in entries:
        starts.append((e.slot, e.piece, e.shard, before.get(e.shard, 0)))
        before[e.shard] = before.get(e.shard, 0) + e.records
    # Its size is bounded by the number of slots and pieces.
    table = F.broadcast(spark.createDataFrame(starts, "vslot int, piece int, shard int, start long"))
    order = Window.partitionBy("vslot", "piece").orderBy(F.asc_nulls_last("doc_id"), "text_crc32", "size")
    return rows.withColumn("_rank", F.row_number().over(order)).join(table, ["vslot", "piece"]).withColumn("slot", F.col("start") + F.col("_rank") - 1)


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """All rows of ``docs (doc_id, text)`` in ``shards`` shards of nearly equal bytes.

    Returns ``(doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot,
    piece, map_version)``. A row's size is its text's UTF-8 bytes plus 1; a
    null text has none of its own and the checksum of the empty one. The slot
    is a hash of id and text, null ids too; rows equal in both share it, and
    which of them goes where is left open. Which shard a slot has follows
    from all rows' bytes (law ``bytes``), so ``grown_shard`` is null: to grow,
    ``rebalanced`` edits the map, whose versions lie in ``folder``. Other
    columns are not looked at.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "slotmap")
    rows = slotted(docs, slots)
    loads = slot_loads(rows)
    pieces = pieces_of(loads, shards)
    rows = in_pieces(rows, pieces)
    save_map(spark, folder, 1, balanced(measured(rows, loads, pieces), shards))
    version, entries = load_map(spark, folder)
    return placed(rows, entries).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "vslot", "piece", F.lit(version).alias("map_version"))
