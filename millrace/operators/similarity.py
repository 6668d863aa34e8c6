"""Structural similarity of images given as grids of grey values: exact leader groups without comparing all pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.neighbours import deal_cells, matrix, meet_cells, near_pairs, searches
from millrace.operators.rounds import settle_first_wins, written

# The constants of structural similarity for grey values of 0 to 255, and its window.
C1, C2, WINDOW = (0.01 * 255) ** 2, (0.03 * 255) ** 2, 7


def box_sums(x: np.ndarray, window: int) -> np.ndarray:
    """Sums of all windows of images (n x h x w), by summed-area tables."""
    table = np.pad(x.cumsum(axis=1).cumsum(axis=2), ((0, 0), (1, 0), (1, 0)))
    return table[:, window:, window:] - table[:, :-window, window:] - table[:, window:, :-window] + table[:, :-window, :-window]


def moments(x: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and sample variances of all windows."""
    n = window * window
    mean = box_sums(x, window) / n
    return mean, np.maximum(box_sums(x * x, window) / n - mean * mean, 0) * n / (n - 1)


def ssim(a: np.ndarray, b: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Mean structural similarity of pairs of images (n x h x w), over all whole windows, each weighing the same."""
    n = window * window
    (ma, va), (mb, vb) = moments(a, window), moments(b, window)
    vab = (box_sums(a * b, window) / n - ma * mb) * n / (n - 1)
    return (((2 * ma * mb + C1) * (2 * vab + C2)) / ((ma * ma + mb * mb + C1) * (va + vb + C2))).mean(axis=(1, 2))


def rough_ssim(a: np.ndarray, b: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """ssim of every image of a (n x h x w) with every one of b, but for rounding: a window's products of all pairs are one matrix product."""
    n, total = window * window, np.zeros((len(a), len(b)))
    (ma, va), (mb, vb) = moments(a, window), moments(b, window)
    for i in range(ma.shape[1]):
        for j in range(ma.shape[2]):
            x, y = (np.ascontiguousarray(v[:, i : i + window, j : j + window].reshape(len(v), n) - m[:, i, j, None]) for v, m in ((a, ma), (b, mb)))
            light = (2 * np.outer(ma[:, i, j], mb[:, i, j]) + C1) / (ma[:, i, j, None] ** 2 + mb[:, i, j] ** 2 + C1)
            total += light * (x @ y.T * (2 / (n - 1)) + C2) / (va[:, i, j, None] + vb[:, i, j] + C2)
    return total / ma[0].size


def image_keys(x: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Light and contrast of images: the means over windows of log(m^2 + C1 / 2) and log(v + C2 / 2)."""
    mean, variance = moments(x, window)
    return np.stack([np.log(mean * mean + C1 / 2).mean(axis=(1, 2)), np.log(variance + C2 / 2).mean(axis=(1, 2))], axis=1)


def key_reach(threshold: float, widest: float) -> float:
    """How far apart one key of two similar images may be.

    A window's similarity is at most 1 / cosh(t / 2), t being the difference of the logarithms of its means or variances (by the
    inequality of Cauchy and Schwarz), and |t| is at most `widest`. The mean of a function is at most its concave hull at the mean, so
    the mean of |t| is at most where the hull falls to the threshold: the function itself up to a point, from there a line to its end.
    """
    f = lambda t: 1 / math.cosh(t / 2)
    line = lambda t: f(t) - 0.5 * f(t) * math.tanh(t / 2) * (widest - t) - f(widest)
    low, high = 0.0, min(2 * math.asinh(1.0), widest)
    for _ in range(80):  # where the tangent meets the end
        low, high = ((low + high) / 2, high) if line((low + high) / 2) > 0 else (low, (low + high) / 2)
    bend = high
    if threshold >= f(bend):
        return 2 * math.acosh(1 / threshold)
    return bend + (f(bend) - threshold) * (widest - bend) / (f(bend) - f(widest))


def image_points(x: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A unit vector an image: two images' product is at least their similarity, but for windows whose product is below 0.

    A window's similarity is (2 m m' + C1) (2 c + C2) over sums of two squares, which are at least twice the root of their product (by the
    inequality of means). With that for the sums it is the product of unit vectors: (m, root of C1 / 2) for the light, the differences
    from the mean and the root of C2 / 2 for the contrast, and all products of an entry of either for both.
    """
    n, parts = window * window, []
    for i in range(x.shape[1] - window + 1):
        for j in range(x.shape[2] - window + 1):
            patch = x[:, i : i + window, j : j + window].reshape(len(x), n)
            mean = patch.mean(axis=1, keepdims=True)
            light = np.hstack([mean, np.full_like(mean, math.sqrt(C1 / 2))])
            shape = np.hstack([(patch - mean) / math.sqrt(n - 1), np.full_like(mean, math.sqrt(C2 / 2))])
            both = light[:, :, None] * shape[:, None]
            parts.append(both.reshape(len(x), -1) / np.sqrt((light**2).sum(axis=1) * (shape**2).sum(axis=1))[:, None])
    return np.hstack(parts) / math.sqrt(len(parts))


def shortened(points: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors along orthonormal axes (a column each), and the length of what is left: products of these are at least those of the vectors."""
    kept = points @ axes
    return np.hstack([kept, np.sqrt(np.maximum(1 - (kept**2).sum(axis=1, keepdims=True), 0.0))])


def point_reach(threshold: float, windows: int) -> float:
    """How far apart the points of two similar images may be: no more windows than are missing to the threshold may have a product below 0."""
    product = threshold - math.floor(windows * (1 - threshold) + 1e-9) / windows
    return math.sqrt(2 * (1 - product)) * (1 + 1e-9) + 1e-6


def similar_images(df: DataFrame, key: str, grid: str, height: int, width: int, threshold: float = 0.92, window: int = WINDOW, axes: int = 64) -> DataFrame:
    """a, b, similarity of all pairs of different images with at least this similarity, a < b; equal ones are one, under their least key.

    Images meet as points on `axes` principal axes of a sample, and only pairs whose points, light and contrast are near enough are
    measured. Grids of another size, or with nulls, NaN or infinite values, are left out.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be over 0 and at most 1")
    flat = F.flatten(F.transform(grid, lambda r: F.transform(r, lambda v: v.cast("double"))))
    sound = (F.size(grid) == height) & F.forall(grid, lambda r: F.size(r) == width) & F.forall(flat, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    images = df.filter(F.coalesce(sound, F.lit(False))).select(F.col(key).cast("long").alias("k"), flat.alias("image")).groupBy("image").agg(F.min("k").alias("k"))
    images = written(images.select("k", "image"), "images")
    windows = (height - window + 1) * (width - window + 1)
    entries = 2 * windows * (window * window + 1)
    drawn = images.orderBy(F.xxhash64(F.lit(7), "k"), "k").limit(max(1, min(1024, (1 << 24) // entries))).collect()  # a bounded sample
    if not drawn:
        return df.sparkSession.createDataFrame([], "a long, b long, similarity double")
    sample = image_points(np.array([r["image"] for r in drawn]).reshape(-1, height, width), window)
    sent = df.sparkSession.sparkContext.broadcast(np.linalg.svd(sample, full_matrices=False)[2][:axes].T)

    def pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, (1 << 20) // entries)
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                x = matrix(part.column(1)).reshape(-1, height, width)
                keys = image_keys(x, window)
                points = pa.array(list(shortened(image_points(x, window), sent.value)))
                yield pa.RecordBatch.from_arrays([part.column(0), points, pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy())], ["k", "x", "light", "contrast"])

    cells = deal_cells(images.mapInArrow(pointed, "k long, x array<double>, light double, contrast double"))
    far = [key_reach(threshold, math.log((255.0**2 + c / 2) / (c / 2))) * (1 + 1e-9) + 1e-9 for c in (C1, C2)]
    reach = point_reach(threshold, windows)

    def found(s: dict[str, np.ndarray], t: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j, _ in near_pairs(s, t, reach):
            good = s["k"][i] < t["k"][j]
            for c, d in zip(("light", "contrast"), far, strict=True):
                good &= np.abs(s[c][i] - t[c][j]) <= d
            a.append(s["k"][i[good]])
            b.append(t["k"][j[good]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (a, b)], ["a", "b"])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                a, b, x, y = batch.slice(lo, 512).columns
                score = ssim(matrix(x).reshape(-1, height, width), matrix(y).reshape(-1, height, width), window)
                good = pa.array(score >= threshold)
                yield pa.RecordBatch.from_arrays([a.filter(good), b.filter(good), pa.array(score).filter(good)], ["a", "b", "similarity"])

    columns = ["k", "x", "light", "contrast"]
    pairs = meet_cells(cells, searches(cells, cells.points, F.lit(reach)), cells.points, columns, columns, found, "a long, b long", "near-images")
    sides = pairs.join(images.toDF("a", "left"), "a").join(images.toDF("b", "right"), "b").select("a", "b", "left", "right")
    return written(sides.mapInArrow(measured, "a long, b long, similarity double"), "similar")


def ssim_leaders(df: DataFrame, key: str, grid: str, height: int, width: int, threshold: float = 0.92) -> DataFrame:
    """df with leader: in key order each free image leads itself and takes every later free one that is similar to it.

    Images without a sound grid lead themselves. Keys are unique.
    """
    pairs = similar_images(df, key, grid, height, width, threshold).select("a", "b")
    copies = df.select(F.col(key).cast("long").alias("k"), F.to_json(grid).alias("g"))
    firsts = written(copies.join(copies.filter("g is not null").groupBy("g").agg(F.min("k").alias("first")), "g", "left").select("k", F.coalesce("first", "k").alias("first")), "copies")
    led = settle_first_wins(firsts.filter("k = first").select("k"), pairs).withColumnRenamed("k", "first")
    return df.join(firsts.join(led, "first").select(F.col("k").alias("_k"), "leader"), F.col(key) == F.col("_k"), "left").select(*df.columns, F.coalesce("leader", F.col(key)).alias("leader"))
