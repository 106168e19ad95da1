"""Vectors for texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.functions.vectors import bucket_counts, term_buckets, unit_dense
from papyra.session import ship

# Fixed value: length of a chunk vector.
DIM = 384


def embed_terms(
    df: DataFrame, text: str = "chunk_text", out: str = "chunk_text_vector", dim: int = DIM
) -> DataFrame:
    """Add a hashed bag-of-words vector of unit length.

    A deterministic stand-in, not a semantic encoder: lower-cased ASCII words
    (accented letters separate words) counted in ``dim`` md5 buckets. A text
    without ASCII words gets the zero vector. Works row by row: no shuffle.
    """
    return df.withColumn(out, unit_dense(bucket_counts(term_buckets(F.col(text), dim)), dim))


def embed_with(
    df: DataFrame,
    load_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    text: str = "chunk_text",
    out: str = "chunk_text_vector",
) -> DataFrame:
    """Add the vectors of a model. ``load_encoder`` runs once per partition."""
    ship(df.sparkSession)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        for frame in frames:
            if frame.empty:
                continue
            encoder = encoder or load_encoder()
            vectors = np.asarray(encoder(frame[text].fillna("").tolist()), dtype=np.float32)
            yield frame.assign(**{out: list(vectors)})

    return df.mapInPandas(encode, schema)
