"""Embedding whitening by QDWH spectral divide and conquer of the covariance, then a broadcast projection.

The covariance is split by polar decompositions: the unitary factor U of A - s I has the eigenvalues 1 and -1, so (U + I) / 2
projects on the components whose eigenvalue is above the shift s. Orthonormal bases of both invariant subspaces give two smaller
matrices, and these are split again until each is one component or has only one eigenvalue. The polar factor comes from dynamically
weighted Halley steps by QR (at most six, and a few more where the shift is next to an eigenvalue).

Entries are taken as whole numbers, floor(scale * c) + shift. Sums and centred products of whole numbers are exact, so the covariance
is the same for any order and partitioning of the rows. Per partition it makes d (d + 1) / 2 sums, combined before the shuffle; only
matrices of d x d come to the driver, and only d x k numbers are sent to the tasks.

Defined results: a vector that is null, or has null or non-finite entries, is dropped; so is one whose length is not that of most
vectors (the greater of two equally frequent ones), which lacks entries or has too many, and one with an entry beyond 2^43 / scale,
which whole numbers can't hold exactly. Null and repeated ids are kept as they are; equal rows give equal results. Components without
variance (a share of at most d * 2.2e-16 of the greatest) can't be whitened and are left out, so a table of equal vectors, of one
vector, or of none gives no rows. Of equal eigenvalues any orthonormal vectors are components. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = float(np.finfo(np.float64).eps)


class Whitening(NamedTuple):
    """n fitted vectors with sums per dimension; components (d x k) by falling variance; trace of the covariance."""

    dimensions: int
    n: int
    sums: list[int]
    covariance: np.ndarray
    variances: np.ndarray
    components: np.ndarray
    trace: float


def polar_unitary(a: np.ndarray) -> np.ndarray:
    """The unitary factor of a symmetric matrix's polar decomposition, by QDWH steps; singular values of zero may end anywhere in [0, 1]."""
    n = len(a)
    size = np.linalg.norm(a, 2 if n <= 3 else "fro")
    if size == 0:
        return np.eye(n)
    x = a / size
    low = max(1.0 / (np.linalg.norm(np.linalg.inv(x + EPS * np.eye(n)), 1) * np.sqrt(n)), EPS)  # at most the least singular value
    for _ in range(12):
        d = np.cbrt(4.0 * (1.0 - low * low) / low**4)
        root = np.sqrt(1.0 + d)
        p = root + 0.5 * np.sqrt(8.0 - 4.0 * d + 8.0 * (2.0 - low * low) / (low * low * root))
        q = (p - 1.0) ** 2 / 4.0
        r = p + q - 1.0
        both = np.linalg.qr(np.concatenate([np.sqrt(r) * x, np.eye(n)]))[0]
        after = (q / r) * x + (p - q / r) / np.sqrt(r) * (both[:n] @ both[n:].T)
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x, low = after, min(low * (p + q * low * low) / (1.0 + r * low * low), 1.0)
        if moved <= 1e-10 or abs(1.0 - low) <= 4 * EPS and moved <= 1e-5:
            break
    return x @ (1.5 * np.eye(n) - 0.5 * (x.T @ x))  # one Newton-Schulz step: all digits


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, int, float] | None:
    """An orthonormal basis whose first columns span the components above the shift, how many they are, and what couples the two parts."""
    n = len(a)
    projector = (polar_unitary(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = round(float(np.trace(projector)))
    if not 0 < rank < n:
        return None
    order = np.argsort(-np.einsum("ij,ij->j", projector, projector), kind="stable")
    basis = np.linalg.qr(projector[:, order])[0]
    basis = np.linalg.qr(np.concatenate([projector @ basis[:, :rank], basis[:, rank:]], axis=1))[0]  # one step of subspace iteration
    turned = basis.T @ a @ basis
    return basis, rank, float(np.linalg.norm(turned[rank:, :rank]))


def spectral_components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of a symmetric matrix by recursive spectral projectors."""
    whole = float(np.linalg.norm(a)) or 1.0
    values, vectors = [], []
    open_ = [(a, np.eye(len(a)))] if len(a) else []
    while open_:
        part, basis = open_.pop()
        part, n = (part + part.T) / 2, len(part)
        off = part - np.diag(np.diag(part))
        if n == 1 or np.linalg.norm(off) <= 4 * EPS * whole:  # one component, or a part that is diagonal already
            values += np.diag(part).tolist()
            vectors += list(basis.T)
            continue
        mean, spread = float(np.trace(part)) / n, float(np.linalg.norm(part - np.trace(part) / n * np.eye(n))) / np.sqrt(n)
        best = None
        for step in (0.0, 0.1, -0.1, 0.27, -0.27, 0.53, -0.53, 0.9, -0.9):  # the mean lies between the least and the greatest eigenvalue
            found = _split(part, mean + step * spread)
            if found and (best is None or found[2] < best[2]):
                best = found
            if best and best[2] <= 16 * EPS * whole:
                break
        if best is None:  # eigenvalues that differ by rounding only
            values += np.diag(part).tolist()
            vectors += list(basis.T)
            continue
        turn, rank, _ = best
        for columns in (turn[:, :rank], turn[:, rank:]):
            open_.append((columns.T @ part @ columns, basis @ columns))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors).reshape(len(values), len(a))[order].T


def _usable(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    x = F.col(vector)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) <= float((1 << 43) // scale)))
    return df.select(F.col(key).alias("key"), x.cast("array<double>").alias("vector")).filter(x.isNotNull() & (F.size(x) > 0) & sound)


def _numbers(batch: pa.RecordBatch, d: int, scale: int, shift: int) -> np.ndarray:
    """The vectors of a batch as whole numbers."""
    column = batch.column(batch.schema.get_field_index("vector"))
    entries = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(scale * entries).astype(np.int64) + shift


def _exact_products(y: np.ndarray, weight: int = 1 << 53) -> list[list[int]]:
    """The sums of products y'y of whole numbers: in doubles by blocks whose sums they hold exactly, else in integers of any size."""
    most = int(np.abs(y).max()) if y.size else 0
    if most * most >= weight:
        wide = y.astype(object)
        return (wide.T @ wide).tolist()
    block = max(1, weight // max(1, most * most)) if most else len(y)
    total = np.zeros((y.shape[1],) * 2, object)
    for lo in range(0, len(y), block):
        part = y[lo : lo + block].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total.tolist()


def fit_whitening(df: DataFrame, vector: str = "embedding", scale: int = 1024, shift: int = 100_000) -> Whitening | None:
    """Fit on all usable vectors of df: lengths, sums, and centred products are three passes over the vectors. None without any."""
    rows = _usable(df, vector, vector, scale).select("vector")
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return None
    d = lengths[0]["d"]
    rows = rows.filter(F.size("vector") == d)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            n += batch.num_rows
            total += _numbers(batch, d, scale, shift).sum(axis=0)
        if n:
            values = [Decimal(int(v)) for v in total]
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(values, pa.decimal128(38, 0)), pa.array([n] * d, pa.int64())], ["i", "s", "n"])

    found = rows.mapInArrow(sums, "i int, s decimal(38,0), n long").groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("n").alias("n")).collect()  # d rows
    n, total = found[0]["n"], [int(r["s"]) for r in sorted(found, key=lambda r: r["i"])]
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)  # whole numbers within half a unit of the means
    upper = np.triu_indices(d)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((d, d), object)
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                sums += np.array(_exact_products(_numbers(batch, d, scale, shift) - centre), object)
        if seen:
            values = [Decimal(int(v)) for v in sums[upper]]
            yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["i", "j", "v"])

    cells = rows.mapInArrow(products, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()  # d (d + 1) / 2 rows
    covariance = np.zeros((d, d))
    left = [s - n * int(c) for s, c in zip(total, centre, strict=True)]
    for r in cells:
        # n^2 V, exactly: the centre is a whole number, so what it is off the mean is taken back
        covariance[r["i"], r["j"]] = covariance[r["j"], r["i"]] = (n * int(r["v"]) - left[r["i"]] * left[r["j"]]) / (n * n)
    values, vectors = spectral_components(covariance)
    real = values > d * EPS * max(float(values[0]), 0.0) if len(values) else np.zeros(0, bool)
    values, vectors = values[real], vectors[:, real]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(len(values))] < 0, -1.0, 1.0)
    return Whitening(d, n, total, covariance, values, vectors, float(np.trace(covariance)))


def whiten(df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding", components: int | None = None, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """key, deviation decimal (null where it has more than 38 digits), whitened array: the projections of each usable vector, by a broadcast of d x k numbers."""
    k = min(components or model.dimensions, len(model.variances))
    d, n, total = model.dimensions, model.n, np.array(model.sums, object)
    whole, part = np.array([s // n for s in model.sums], np.int64), np.array([(s % n) / n for s in model.sums])
    shipped = df.sparkSession.sparkContext.broadcast((model.components[:, :k] / np.sqrt(model.variances[:k]), whole, part))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, low, part = shipped.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _numbers(batch, d, scale, shift)
            near, bound = x - low, (int(np.abs(x - low).max()) + 1) * n
            rest = total - n * low.astype(object)
            if bound * bound * d < 1 << 63:
                away = near * n - rest.astype(np.int64)
                deviation = (away * away).sum(axis=1).tolist()
            else:
                deviation = [sum(v * v for v in r) for r in near.astype(object) * n - rest]
            white = (x - low - part) @ matrix
            with localcontext() as context:
                context.prec = 60
                exact = pa.array([Decimal(v) if v < 10**38 else None for v in deviation], pa.decimal128(38, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), exact, lists], ["key", "deviation", "whitened"])

    rows = _usable(df, key, vector, scale).filter(F.size("vector") == d)
    return rows.mapInArrow(run, f"key {kind}, deviation decimal(38,0), whitened array<double>").withColumnRenamed("key", key)


def identity_error(white: DataFrame, k: int) -> float:
    """The largest entry, without sign, of the covariance of whitened vectors less the identity; their means are taken off as well."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                own = w.mean(axis=0)
                centred, step = w - own, own - mean
                both = n + len(w)  # centred within the batch, then put together
                products += centred.T @ centred + np.outer(step, step) * (n * len(w) / both)
                mean, n = mean + step * len(w) / both, both
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tolist()]), pa.array([products.ravel().tolist()])], ["n", "mean", "products"])

    parts = white.select("whitened").mapInArrow(moments, "n long, mean array<double>, products array<double>")
    rows = parts.select("n", F.posexplode("mean").alias("i", "m")).groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("m")).alias("s")).collect()  # k rows
    if not rows:
        return 0.0
    n, means = rows[0]["n"], [r["s"] / r["n"] for r in sorted(rows, key=lambda r: r["i"])]
    centre = F.array(*(F.lit(float(m)) for m in means))
    step = F.zip_with("mean", centre, lambda a, b: a - b)
    outer = F.flatten(F.transform(step, lambda a: F.transform(step, lambda b: a * b)))
    sums = parts.select(F.posexplode(F.zip_with("products", F.transform(outer, lambda x: x * F.col("n")), lambda a, b: a + b)).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    diagonal = F.when(F.col("at") % (k + 1) == 0, 1.0).otherwise(0.0)
    return float(sums.agg(F.max(F.abs(F.col("v") / n - diagonal))).first()[0])


def whitened_components(df: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    deviation is null where it is beyond a long."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit_whitening(df, vector)
    k = min(components, len(model.variances)) if model else 0
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    white = whiten(df, model, key, vector, k)
    off = identity_error(white, k)
    explained = F.get(F.array(*(F.lit(float(v) / model.trace) for v in model.variances[:k])), F.col("at"))
    fits = F.when(F.col("deviation") <= F.lit((1 << 63) - 1).cast("decimal(38,0)"), F.col("deviation")).cast("long")
    rows = white.select(key, fits.alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        key, (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(off).alias("identity_error"),
    )
