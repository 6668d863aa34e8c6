"""Dot products, norms and bit hashes of array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def sign_hash(vector: Column, bits: int = 64) -> Column:
    """A 64-bit hash: bit i is set where component i is positive."""
    return F.aggregate(F.slice(vector, 1, bits), F.lit(0).cast("long"), lambda h, x: F.shiftleft(h, 1).bitwiseOR(F.when(x > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def md5_key(*parts: Column) -> Column:
    """A 60-bit number drawn from an md5, the same in every SQL engine; stands in for seeded random numbers."""
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) drawn from an md5."""
    return (md5_key(*parts) + 0.5) / float(1 << 60)
