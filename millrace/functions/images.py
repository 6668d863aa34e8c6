"""Numeric grids (rows of grey values) as images: perceptual hashes by name, made of array functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import bound

HASHES = ("average_hash", "dhash", "phash")


def pixel(grid: Column, row: Column | int, column: Column | int) -> Column:
    return F.get(F.get(grid, F.lit(row) if isinstance(row, int) else row), F.lit(column) if isinstance(column, int) else column).cast("double")


def resized(grid: Column, height: int, width: int) -> Column:
    """Means of height x width boxes of a grid, as one array by rows; box i has the rows [i h // height, (i + 1) h // height), at least one."""
    rows, columns = F.size(grid), F.size(F.get(grid, F.lit(0)))

    def mean(part: Column) -> Column:
        return F.aggregate(part, F.lit(0.0), lambda s, v: s + v.cast("double")) / F.size(part)

    def cut(values: Column, size: Column, i: Column, n: int) -> Column:
        first = F.floor(i * size / n).cast("int")
        return F.slice(values, first + 1, F.greatest(F.lit(1), F.floor((i + 1) * size / n).cast("int") - first))

    spots = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    narrow = F.transform(grid, lambda r: F.transform(spots(width), lambda j: mean(cut(r, columns, j, width))))
    box_row = lambda part: F.transform(spots(width), lambda j: mean(F.transform(part, lambda r: F.get(r, j))))
    return F.flatten(bound(narrow, lambda t: F.transform(spots(height), lambda i: bound(cut(t, rows, i, height), box_row))))


def _bits(flags: Column) -> Column:
    """A long of flags, the first in the highest place."""
    return F.aggregate(flags, F.lit(0).cast("long"), lambda h, f: F.shiftleft(h, 1).bitwiseOR(f.cast("long")))


def _cosines(n: int, kept: int) -> list[list[float]]:
    return [[2 * math.cos(math.pi * k * (2 * i + 1) / (2 * n)) for i in range(n)] for k in range(kept)]


def _product(left: Column, right: Column, inner: int, rows: int, columns: int) -> Column:
    """left (rows x inner) times right (inner x columns), both as arrays by rows; so is the product."""
    cell = lambda i, j: F.aggregate(F.sequence(F.lit(0), F.lit(inner - 1)), F.lit(0.0), lambda s, k: s + F.get(left, i * inner + k) * F.get(right, k * columns + j))
    return F.transform(F.sequence(F.lit(0), F.lit(rows * columns - 1)), lambda at: cell(F.floor(at / columns).cast("int"), (at % columns).cast("int")))


def low_frequencies(values: Column, size: int, kept: int) -> Column:
    """The kept x kept lowest terms of the two-dimensional cosine transform of size x size values, by two products with fixed matrices."""
    cosines = _cosines(size, kept)
    across = F.array(*(F.lit(v) for row in zip(*cosines, strict=True) for v in row))
    down = F.array(*(F.lit(v) for row in cosines for v in row))
    return bound(_product(values, across, size, size, kept), lambda half: _product(down, half, size, kept, kept))


def perceptual_hash(grid: Column, name: str = "phash", size: int = 8) -> Column:
    """size x size bits of a grid (at most 64), the first pixel's in the highest place; null for a null or empty grid.

    average_hash: boxes above their mean. dhash: boxes greater than the one before them in their row. phash: low frequencies of
    4 size x 4 size boxes above their median.
    """
    if size > 8:
        raise ValueError("hashes have at most 64 bits")
    if name == "average_hash":
        above = lambda v: bound(F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / (size * size), lambda mean: F.transform(v, lambda x: x > mean))
        bits = bound(resized(grid, size, size), above)
    elif name == "dhash":
        at = lambda v, i, step: F.get(v, (i + F.floor(i / size) + step).cast("int"))
        bits = bound(resized(grid, size, size + 1), lambda v: F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda i: at(v, i, 1) > at(v, i, 0)))
    elif name == "phash":
        middle = lambda o: (F.get(o, F.lit((size * size - 1) // 2)) + F.get(o, F.lit(size * size // 2))) / 2
        low = bound(resized(grid, 4 * size, 4 * size), lambda v: low_frequencies(v, 4 * size, size))
        bits = bound(low, lambda v: bound(middle(F.array_sort(v)), lambda median: F.transform(v, lambda x: x > median)))
    else:
        raise ValueError(f"unknown hash {name}; known are {', '.join(HASHES)}")
    return F.when(F.size(grid) > 0, _bits(bits))
