"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.session import scratch_dir, ship


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def utf8(text: Column) -> Column:
    """The text's bytes; null is empty."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write below the shared folder and read back: cuts lineage, fixes the rows."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, prefixed until it clashes with none of the ``taken`` names."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def arrow_map(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def with_columns(df: DataFrame, inputs: list[str], added: T.StructType,
                 function: Callable[[Iterator[list[pa.Array]]], Iterator[list[pa.Array]]]) -> DataFrame:
    """``df`` with columns computed by ``function`` from the columns ``inputs``.

    All other columns pass through untouched, without a join; ``inputs`` are
    dropped afterwards, so callers make them under free names.
    """
    ship(df.sparkSession)
    kept = [c for c in df.columns if c not in inputs]
    schema = T.StructType([df.schema[c] for c in kept] + list(added.fields))
    places = [df.columns.index(c) for c in inputs]
    rest = [df.columns.index(c) for c in kept]

    def run(batches):
        seen = []

        def columns():
            for batch in batches:
                seen.append(batch)
                yield [batch.column(i) for i in places]

        for made in function(columns()):
            batch = seen.pop()
            names = kept + [f.name for f in added.fields]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in rest] + made, names=names)

    return df.mapInArrow(run, schema)


def record_batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def longs(column: pa.Array) -> np.ndarray:
    """A null-free long column as numpy."""
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def in_parts(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """A column in slices of at most ``size`` bytes, one text at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(texts):
        before = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + size, side="right")))
        yield texts.slice(low, high - low)
        low = high


_HELD: dict[str, object] = {}


def remembered(key: str, make: Callable[[], object]):
    """What this Python worker keeps between tasks: one memory, that of the last key.

    Stages that run in one worker do not pile up their memories.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]
