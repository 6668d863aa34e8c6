"""Quality classifier: regularised quadratic discriminant over transformed statistics of whole documents.

Each text gives ten statistics, transformed to be closer to normal. Each class (labels.quality 0 and 1) has a mean and
a covariance that is shrunk towards the pooled one and towards its own diagonal; the score is the logistic of the
difference of the Mahalanobis log densities plus the log prior odds, by Cholesky factors made once on the driver.
What comes to the driver from the training rows is a count, sums and products a class, 132 numbers for any input.

Defined results: a null text counts as empty; null doc_ids and repeated rows keep their rows; where a class has no
labelled rows the score is the share of class 1 (0.5 without any labels); repeated labels of a document count once
for each row, rows with a null label never; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._hashing import words
from millrace.llm._shared import slices, written

FEATURES = ["log_words", "word_length", "symbols", "capitals", "digits", "punctuation", "distinct_words", "distinct_lines", "top_word", "lone_marks"]
_KIND = np.zeros(256, np.uint8)  # 1 symbol, 2 capital, 3 digit, 4 punctuation, 5 line end, 6 first byte of other characters, 7 white space
_KIND[[ord(c) for c in "#$%&*|!@^~<>=+\\{}[]_`"]] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[ord(c) for c in ".,;:?'\"()-/"]] = 4
_KIND[10] = 5
_KIND[[9, 11, 12, 13, 32]] = 7


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Transformed statistics, one row a text."""
    n = len(offsets) - 1
    chars = np.diff(offsets) + 40.0  # so that one capital or mark in a few characters weighs little
    kinds = np.concatenate([[0], _KIND[data]])
    at = offsets[1:]
    share = lambda k: (np.cumsum(kinds == k)[at] - np.cumsum(kinds == k)[offsets[:-1]]) / chars
    word, first, last, bounds = words(data, offsets)
    count = np.diff(bounds)
    lines_hash, line_doc = _lines(data, offsets)
    distinct, top = np.ones(n), np.zeros(n)
    line_ratio = np.ones(n)
    line_bounds = np.searchsorted(line_doc, np.arange(n + 1))
    for i in np.flatnonzero(count):
        times = np.unique(word[bounds[i] : bounds[i + 1]], return_counts=True)[1]
        distinct[i], top[i] = len(times) / count[i], times.max() / (count[i] + 10)
        own = lines_hash[line_bounds[i] : line_bounds[i + 1]]
        line_ratio[i] = 1 - (len(own) - len(np.unique(own))) / (len(own) + 6)
    length = last - first
    total = np.concatenate([[0], np.cumsum(length)])
    mean_length = (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(count, 1)
    lone = np.concatenate([[0], np.cumsum((length == 1) & (_KIND[data[first]] == 1))]) if len(first) else np.zeros(1)
    lone_share = (lone[bounds[1:]] - lone[bounds[:-1]]) / np.maximum(count, 1)
    root = np.sqrt
    return np.column_stack([
        np.log1p(count), np.log1p(mean_length), root(share(1)), root(share(2)), root(share(3)), root(share(4)),
        distinct + 0.12 * np.log1p(count), root(1 - line_ratio), root(top), root(lone_share),
    ])


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each line that is not empty: a line is a word when only line ends separate words."""
    joined = np.where(np.isin(data, [9, 11, 12, 32]), np.uint8(95), data)
    h, _, _, bounds = words(joined, offsets)
    return h, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of the two classes; constant where a class is missing."""

    mean: np.ndarray
    factor: np.ndarray
    offset: np.ndarray
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = [-0.5 * (((x - self.mean[c]) @ self.factor[c].T) ** 2).sum(axis=1) + self.offset[c] for c in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -60, 60)))


def fit(count: np.ndarray, total: np.ndarray, product: np.ndarray, pooled: float = 0.1, diagonal: float = 0.1, floor: float = 1e-4) -> Discriminant:
    """From each class's count, sum of x and sum of x xᵀ."""
    if count.min() < 2:
        rest = count.sum()
        return Discriminant(total, product, count, float(count[1] / rest) if rest else 0.5)
    mean = total / count[:, None]
    own = product / count[:, None, None] - mean[:, :, None] * mean[:, None, :]
    shared = (own * count[:, None, None]).sum(axis=0) / count.sum()
    factor, offset = [], []
    for c in (0, 1):
        cov = (1 - pooled) * own[c] + pooled * shared
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + floor * np.eye(len(cov))
        lower = np.linalg.cholesky(cov)
        factor.append(np.linalg.inv(lower))
        offset.append(np.log(count[c] / count.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(mean, np.array(factor), np.array(offset))


def featured(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, x (array of the statistics)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, "text"):
            x = statistics(data, offsets)
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "x"])

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, x array<double>")


def train(features: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """Fit on the rows of features that have a label, but for the held-out third."""
    d = len(FEATURES)
    rows = labels.filter(~_held_out("doc_id")).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y")).filter("y in (0, 1)")
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)] + [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)]
    count, total, product = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for r in features.join(rows, "doc_id").groupBy("y").agg(F.count("*").alias("n"), *sums).collect():
        c = r["y"]
        count[c], total[c] = r["n"], [r[f"s{i}"] for i in range(d)]
        for i in range(d):
            for j in range(i + 1):
                product[c, i, j] = product[c, j, i] = r[f"p{i}_{j}"]
    return fit(count, total, product)


def _held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(df: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of df."""
    features = written(featured(df, text, doc_id), "quality-features")
    model = train(features, labels)
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shipped.value.score(x))], ["doc_id", "score"])

    scored = features.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", _held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_quality(df: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.5, labelled: int = 200_000) -> DataFrame:
    """The rows of df that score at least threshold, with their columns.

    The classifier is fitted on a bounded sample: the `labelled` rows of labels whose doc_id has the least hashes. So their
    ids can be sent to all tasks, and texts neither leave their rows nor are read twice but for the labelled ones.
    """
    sample = written(labels.select("doc_id", "quality").orderBy(F.xxhash64("doc_id")).limit(labelled), "quality-labels")
    own = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    some = own.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    model = df.sparkSession.sparkContext.broadcast(train(featured(some), sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, text):
            yield batch.filter(pa.array(model.value.score(statistics(data, offsets)) >= threshold))

    return df.mapInArrow(run, df.schema)
