"""Document text to chunk rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from papyra.functions.text import non_empty
from papyra.session import ship

# Chunk length, overlap and separators in order of preference.
SIZE = 1000
OVERLAP = 100
SEPARATORS = ("\n\n", "\n", ".", " ", "")


def chunk_fixed(
    df: DataFrame, keys: list[str], text: str = "text", size: int = SIZE, overlap: int = OVERLAP
) -> DataFrame:
    """Windows of ``size`` characters, each sharing ``overlap`` with the last.

    The text is cut once into pieces of ``size - overlap`` characters and each
    window is put together from neighbouring pieces, so the cost stays linear
    in the length of a document.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap
    reach = -(-size // step)
    # Blank texts get null pieces and so no row; a filter would be pushed below
    # the projection that makes the text and compute it a second time.
    cut_up = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    pieces = df.select(*keys, F.when(non_empty(text), cut_up).alias("_pieces"))
    last = F.element_at("_pieces", -1)
    n = F.size("_pieces")
    # A last piece of at most `overlap` characters already ends the window before it.
    windows = F.when((n > 1) & (F.length(last) <= overlap), n - 1).otherwise(n)
    if overlap > step:
        total = (n - 1) * step + F.length(last)
        windows = F.greatest(F.lit(1), F.ceil((total - overlap) / step)).cast("int")
    window = lambda i: F.substring(F.array_join(F.slice("_pieces", i, reach), ""), 1, size)
    cut = F.transform(F.when(n > 0, F.sequence(F.lit(1), windows)), window)
    return pieces.select(*keys, F.posexplode(cut).alias("chunk_no", "chunk_text"))


def split_spans(
    text: str, size: int = SIZE, overlap: int = OVERLAP, separators: tuple[str, ...] = SEPARATORS
) -> list[tuple[int, int]]:
    """Start and end of the chunks of one text, blanks trimmed.

    The first separator that occurs cuts the text into pieces that keep the
    separator at their head. Runs of pieces shorter than ``size`` are packed;
    any other piece is cut again with the separators that remain.
    """
    spans: list[tuple[int, int]] = []

    def emit(start: int, end: int) -> None:
        body = text[start:end]
        kept = body.strip()
        if kept:
            head = start + len(body) - len(body.lstrip())
            spans.append((head, head + len(kept)))

    def pack(cuts: list[int]) -> None:
        first = 0
        for i in range(1, len(cuts)):
            if cuts[i] - cuts[first] > size and i - 1 > first:
                emit(cuts[first], cuts[i - 1])
                while first < i - 1 and (
                    cuts[i - 1] - cuts[first] > overlap or cuts[i] - cuts[first] > size
                ):
                    first += 1
        if len(cuts) > 1:
            emit(cuts[first], cuts[-1])

    def cut(start: int, end: int, level: int) -> None:
        while level < len(separators) and separators[level] and text.find(separators[level], start, end) < 0:
            level += 1
        if level == len(separators):
            emit(start, end)
            return
        mark = separators[level]
        if not mark:
            for lo in range(start, max(end - overlap, start + 1), size - overlap):
                emit(lo, min(lo + size, end))
            return
        run = [start]
        here = start
        while here < end:
            following = text.find(mark, here + (len(mark) if here > start or text.startswith(mark, here) else 0), end)
            stop = following if following >= 0 else end
            if stop - here >= size:
                pack(run)
                cut(here, stop, level + 1)
                run = [stop]
            elif stop > here:
                run.append(stop)
            here = stop
        pack(run)

    cut(0, len(text), 0)
    return spans


def chunk_recursive(
    df: DataFrame,
    keys: list[str],
    text: str = "text",
    size: int = SIZE,
    overlap: int = OVERLAP,
    separators: tuple[str, ...] = SEPARATORS,
    rows_per_batch: int = 2_000,
) -> DataFrame:
    """Chunks cut at the coarsest separator that keeps them within ``size``.

    Adds ``chunk_no, chunk_text, start_at, end_at`` (character offsets). Runs
    inside the scan's own partitions: Arrow batches in, Arrow batches out.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    ship(df.sparkSession)
    source = df.select(*keys, F.col(text).alias("_text"))
    schema = T.StructType(
        [source.schema[k] for k in keys]
        + [
            T.StructField("chunk_no", T.IntegerType()),
            T.StructField("chunk_text", T.StringType()),
            T.StructField("start_at", T.IntegerType()),
            T.StructField("end_at", T.IntegerType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner: list[int] = []
            number: list[int] = []
            chunk: list[str] = []
            start: list[int] = []
            end: list[int] = []

            def flush() -> pa.RecordBatch:
                ids = [batch.column(k).take(pa.array(owner, pa.int32())) for k in keys]
                made = [
                    pa.array(number, pa.int32()),
                    pa.array(chunk, pa.string()),
                    pa.array(start, pa.int32()),
                    pa.array(end, pa.int32()),
                ]
                for part in (owner, number, chunk, start, end):
                    part.clear()
                return pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(ids + made, arrow)], schema=arrow
                )

            for row, value in enumerate(batch.column("_text")):
                body = value.as_py() or ""
                for no, (a, b) in enumerate(split_spans(body, size, overlap, separators)):
                    owner.append(row)
                    number.append(no)
                    chunk.append(body[a:b])
                    start.append(a)
                    end.append(b)
                if len(owner) >= rows_per_batch:
                    yield flush()
            if owner:
                yield flush()

    return source.mapInArrow(cut, schema)
