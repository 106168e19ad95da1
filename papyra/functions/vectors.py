"""Vector expressions over array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "dot", "l2")
SCORE_DIGITS = 6


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def norm(a: Column) -> Column:
    squares = lambda acc, x: acc + x.cast("double") * x.cast("double")
    return F.sqrt(F.aggregate(a, F.lit(0.0), squares))


def score(a: Column, b: Column, metric: str = "cosine") -> Column:
    """Similarity, higher is nearer, rounded so that ties are settled by id.

    Cosine with a zero vector is null. ``l2`` is the negated distance.
    """
    if metric == "dot":
        value = dot(a, b)
    elif metric == "l2":
        gaps = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
        value = -F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g))
    elif metric == "cosine":
        value = F.try_divide(dot(a, b), norm(a) * norm(b))
    else:
        raise ValueError(f"metric must be one of {METRICS}")
    return F.round(value, SCORE_DIGITS)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain reference inside a lambda would be inlined by the optimizer and
    evaluated again for every array element.
    """
    return F.transform(F.array(value), body)[0]


def term_buckets(text: Column, dim: int) -> Column:
    """Bucket numbers of the ASCII words of a text, with repeats."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    bucket = lambda w: (F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("int") % dim).cast("int")
    return F.transform(words, bucket)


def bucket_counts(buckets: Column) -> Column:
    """``map<bucket, count>`` of a bucket array."""

    def count(ordered: Column) -> Column:
        # In sorted order equal buckets form runs; a count is the distance
        # from one run's start to the next.
        first = lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2))
        last = F.size(ordered) + 1
        places = F.when(last > 1, F.sequence(F.lit(1), last - 1)).otherwise(F.array().cast("array<int>"))

        def to_map(starts: Column) -> Column:
            ends = F.slice(F.concat(starts, F.array(last)), 2, F.size(starts))
            return F.map_from_arrays(
                F.transform(starts, lambda i: F.get(ordered, i - 1)),
                F.zip_with(starts, ends, lambda s, e: e - s),
            )

        return let(F.filter(places, first), to_map)

    return let(F.sort_array(buckets), count)


def unit_dense(counts: Column, dim: int) -> Column:
    """Dense ``array<float>`` of length ``dim`` scaled to unit length."""

    def scaled(parts: Column) -> Column:
        at = lambda i: F.coalesce(
            F.try_divide(F.element_at(parts["c"], i).cast("double"), parts["n"]), F.lit(0.0)
        )
        return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: at(i).cast("float"))

    def with_norm(c: Column) -> Column:
        square = lambda acc, x: acc + x.cast("double") * x.cast("double")
        length = F.sqrt(F.aggregate(F.map_values(c), F.lit(0.0), square))
        return let(F.struct(c.alias("c"), length.alias("n")), scaled)

    return let(counts, with_norm)
