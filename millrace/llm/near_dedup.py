"""MinHash near-duplicate classes: BagMinHash signatures of word-shingle multisets, banding, multiset verification.

A document is the multiset of its runs of five words (white space separates words, case counts); a text of one to four
words is one run, a text without words has no run. Two documents are linked when their weighted Jaccard similarity
sum(min)/sum(max) is at least 0.8, or when their texts are equal. Classes are the connected components of the links.

BagMinHash draws, for every shingle, one Poisson process over time, weight and signature component. Weights are
discretised at the integers, and the axis is cut at 1, 2, 4, 8, ...; a process for the stretch [2^k, 2^(k+1)) makes its
points in the order of time; the bits of a point choose one half of the stretch after another down to its level, and
points whose level is not below the shingle's weight don't count. The signature holds the earliest time of each
component, so a process ends as soon as it is later than the latest component.

A multiset is kept as the 32-bit hashes of its shingles with their occurrence numbers; two sets of n items have
n^2 / 2^32 false common items on average (0.002 for n = 3000).

Defined results: a null text counts as empty; texts without words form a class by exact equality only; rows with a null
doc_id stay and take part, their class_id is the least doc_id of the class (null if it has none); repeated rows are in
one class; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._components import components
from millrace.llm._hashing import mix, shingles, words
from millrace.llm._shared import slices, texts_of, written

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def bag_min_hash(element: np.ndarray, weight: np.ndarray, doc: np.ndarray, docs: int, components_: int) -> np.ndarray:
    """Signatures (docs x components) of weighted sets given as flat arrays; documents without elements get infinity.

    Elements are mixed before they seed a process, so that numbers with a pattern don't give related processes.
    """
    m = components_
    out = np.full(docs * m, np.inf)
    if not len(element):
        return out.reshape(docs, m)
    # one process for each element and each stretch [low, low + width) of the weight axis that it reaches into
    seeds, lows, widths, tops, owners = [mix(element)], [np.zeros(len(element))], [np.ones(len(element))], [weight], [doc]
    low = 1
    while (reach := weight > low).any():
        n = int(reach.sum())
        seeds.append(mix(element[reach] ^ mix(np.array([low], _U) * _GOLDEN)))
        lows.append(np.full(n, float(low)))
        widths.append(np.full(n, float(low)))
        tops.append(weight[reach])
        owners.append(doc[reach])
        low *= 2
    seed, low_, width, top, owner = (np.concatenate(x) for x in (seeds, lows, widths, tops, owners))
    time, drawn = np.zeros(len(seed)), np.ones(len(seed), _U)
    while len(seed):
        block = int(max(1, min(256, 4096 // len(seed))))
        bits = mix(seed[:, None] + (drawn[:, None] + np.arange(block, dtype=_U)) * _GOLDEN)
        gap = -np.log(((bits >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * width)[:, None]
        gap[:, 0] += time
        at = np.cumsum(gap, axis=1)
        where = mix(bits)
        part = ((where >> _U(32)) * _U(m)) >> _U(32)
        level = low_[:, None] + np.floor((where & _U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * width[:, None])
        kept = level < top[:, None]
        np.minimum.at(out, (owner[:, None] * m + part.astype(np.int64))[kept], at[kept])
        time = at[:, -1]
        drawn = drawn + _U(block)
        go = time < out.reshape(docs, m).max(axis=1)[owner]
        seed, low_, width, top, owner, time, drawn = (x[go] for x in (seed, low_, width, top, owner, time, drawn))
    return out.reshape(docs, m)


def multisets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, in order of text and hash: hash, multiplicity, text. At most 1024 texts."""
    word, _, _, bounds = words(data, offsets)
    run, doc = shingles(word, bounds, k)
    key = np.sort((doc.astype(_U) << _U(54)) | (run >> _U(10)))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([new, [len(key)]]))
    key = key[new]
    return key & _U((1 << 54) - 1), count, (key >> _U(54)).astype(np.int64)


def items_of(element: np.ndarray, count: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 32-bit items (shingle and occurrence number) of all texts in order, and the first one of each text with the total last."""
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    item = mix(np.repeat(element, count) + nth.astype(_U) * _GOLDEN) >> _U(32)
    key = np.unique((np.repeat(doc, count).astype(_U) << _U(32)) | item)
    return key.astype(np.uint32), np.searchsorted(key >> _U(32), np.arange(docs + 1, dtype=_U))


def sketch(df: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, bands: int = 36, rows: int = 7) -> DataFrame:
    """doc_id, node (md5 of the text), bands (array of band hashes; empty for texts without words), items and n (their number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, "text", max_rows=1000):
            element, weight, doc = multisets(data, offsets, k)
            signature = bag_min_hash(element, weight, doc, batch.num_rows, bands * rows)
            bits = signature.view(_U).reshape(batch.num_rows, bands, rows)
            salt = mix(np.arange(1, rows + 1, dtype=_U))
            band = mix((mix(bits) * (salt | _U(1))).sum(axis=2) + np.arange(bands, dtype=_U) * _GOLDEN).view(np.int64)
            full = np.bincount(doc, minlength=batch.num_rows) > 0
            node = [hashlib.md5(x).digest() for x in texts_of(data, offsets)]
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32), pa.array(band[full].ravel()))
            item, bound = items_of(element, weight, doc, batch.num_rows)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((bound * 4).astype(np.int32)), pa.py_buffer(item)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node, pa.binary()), lists, packed, pa.array(np.diff(bound).astype(np.int64))], ["doc_id", "node", "bands", "items", "n"])

    rows_ = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows_.mapInArrow(run, "doc_id long, node binary, bands array<long>, items binary, n long")


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (a, b), those whose multisets overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3)), strict=True)):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                shared = overlap(x, y)
                keep[i] = shared >= threshold * (len(x) + len(y) - shared) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], ["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("items").alias("left"), F.col("n").alias("left_n"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("right"), F.col("n").alias("right_n"))
    close = pairs.join(right, "b").join(left, "a").filter(F.least("left_n", "right_n") >= threshold * F.greatest("left_n", "right_n"))
    return close.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def near(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the left sets are similar to which of the right ones: by a product of incidence matrices unless there are few."""
    a, b = (np.array([len(x) for x in side], np.float64) for side in (left, right))
    fits = np.minimum(a[:, None], b[None, :]) >= threshold * np.maximum(a[:, None], b[None, :])
    shared = np.zeros(fits.shape)
    if fits.sum() <= 64:
        for i, j in zip(*np.nonzero(fits), strict=True):
            shared[i, j] = overlap(left[i], right[j])
    else:
        value, times = np.unique(np.concatenate(left + right), return_counts=True)
        value = value[times > 1]
        places = []
        for side in (left, right):
            owner, item = np.repeat(np.arange(len(side)), [len(x) for x in side]), np.concatenate(side)
            at = np.minimum(np.searchsorted(value, item), max(len(value) - 1, 0))
            hit = value[at] == item if len(value) else np.zeros(len(item), bool)
            order = np.argsort(at[hit], kind="stable")
            places.append((owner[hit][order], at[hit][order]))
        for low in range(0, len(value), 4096):
            ones = []
            for (owner, at), side in zip(places, (left, right), strict=True):
                part = slice(*np.searchsorted(at, [low, low + 4096]))
                ones.append(np.zeros((len(side), 4096), np.float32))
                ones[-1][owner[part], at[part] - low] = 1
            shared += ones[0] @ ones[1].T
    return fits & (shared >= threshold * (a[:, None] + b[None, :] - shared) - 1e-9)


def _part_links(open_: DataFrame, sets: DataFrame, threshold: float, block: int = 256) -> DataFrame:
    """Links (a, b) between the parts of buckets that hold several, given as band, id, part, main, size, away (from main).

    Strays (documents outside a bucket's main part) are compared with every document of the bucket in another part. A
    bucket's strays and its documents are dealt to blocks of about `block`, and each task has one block of either kind
    at a time, so a bucket of any size is spread over many tasks. Only links of parts come out, never what was compared.
    """

    def links_of(band: list[tuple]) -> Iterator[tuple[int, int]]:
        stray = [r for r in band if r[0]]
        other = [r for r in band if not r[0]]
        if not stray or not other:
            return
        key, part, main = (np.array([r[i] for r in other]) for i in (1, 2, 3))
        met = near([r[4] for r in stray], [r[4] for r in other], threshold)
        for i, (_, id_, own, _, _) in enumerate(stray):
            hits = met[i] & (part != own) & ((part == main) | (key > id_))  # two strays meet twice; one way is enough
            for p in np.unique(part[hits]).tolist():
                yield (own, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at, out = None, set()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(8)]
            for band, i, j, stray, id_, part, main, items in zip(*columns, strict=True):
                if (band, i, j) != at:
                    out.update(links_of(held))
                    at, held = (band, i, j), []
                held.append((stray, id_, part, main, np.frombuffer(items, np.uint32)))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])
                out = set()
        out.update(links_of(held))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    rows = open_.withColumns({"others": F.ceil(F.col("size") / block), "strays": F.ceil(F.col("away") / block)})
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    stray = rows.filter("part <> main").select("band", own("strays").alias("i"), every("others").alias("j"), F.lit(True).alias("stray"), "id", "part", "main")
    other = rows.select("band", every("strays").alias("i"), own("others").alias("j"), F.lit(False).alias("stray"), "id", "part", "main")
    dealt = stray.unionByName(other).join(sets.select("id", "items"), "id").select("band", "i", "j", "stray", "id", "part", "main", "items")
    return dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(run, "a long, b long")


def near_duplicate_classes(df: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, threshold: float = 0.8, bands: int = 36, rows: int = 7) -> DataFrame:
    """doc_id, class_id, class_size, is_kept, node: one row for each row of df.

    36 bands of 7 components meet two documents of similarity 0.8 with probability 0.9998. Equal texts are one from the
    start. In a bucket, every text is checked against the bucket's most central one (the one with most company in all its
    buckets), which joins most of them; then, in buckets that still hold several components, all texts outside the main
    component are checked against those of other components. No candidate pair between components is left out, and
    which way a pair was compared doesn't depend on the bucket's size.
    """
    docs = written(sketch(df, text, doc_id, k, bands, rows).withColumn("row", F.monotonically_increasing_id()), "near-sketch")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("lead")
    nodes = docs.groupBy("node").agg(F.min(F.struct("row", "bands")).alias("first"), lead, F.count("*").alias("copies"))
    nodes = written(nodes.select("node", F.col("first.row").alias("id"), F.col("first.bands").alias("bands"), "lead", "copies"), "near-texts")
    every = nodes.select(F.explode("bands").alias("band"), "id")
    buckets = every.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    entries = written(every.join(buckets, "band"), "near-buckets")
    listed = entries.select("id").distinct().hint("merge")  # the same plan at every size
    sets = written(docs.select(F.col("row").alias("id"), "items", "n").join(listed, "id"), "near-sets")

    company = entries.groupBy("id").agg(F.sum("size").alias("company"))
    central = entries.join(company, "id").groupBy("band").agg(F.max(F.struct("company", "id")).alias("c")).select("band", F.col("c.id").alias("a"))
    tries = entries.join(central, "band").filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    parts = written(components(_similar(tries, sets, threshold)), "near-parts")
    named = entries.join(parts.withColumnRenamed("node", "id"), "id", "left").select("band", "id", F.coalesce("component", "id").alias("part"))
    counts = named.groupBy("band", "part").agg(F.count("*").alias("n")).groupBy("band").agg(F.sum("n").alias("size"), F.max(F.struct("n", "part")).alias("m"))
    mixed = counts.filter("size > m.n").select("band", F.col("m.part").alias("main"), "size", (F.col("size") - F.col("m.n")).alias("away"))
    open_ = written(named.join(mixed, "band"), "near-open")
    merged = components(_part_links(open_, sets, threshold)).select(F.col("node").alias("part"), F.col("component").alias("whole"))

    labels = nodes.select("node", "id", "lead", "copies").join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id"))
    labels = labels.join(merged, "part", "left").select("node", "lead", "copies", F.coalesce("whole", "part").alias("class"))
    classes = labels.groupBy("class").agg(F.min("lead").alias("first"), F.sum("copies").alias("class_size"))
    member = labels.select("node", "class").join(classes, "class").select("node", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("kept_row"), "class_size")
    return docs.select("doc_id", "node", "row").join(member, "node").select("doc_id", "class_id", "class_size", (F.col("row") == F.col("kept_row")).alias("is_kept"), "node")
