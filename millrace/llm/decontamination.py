"""Benchmark decontamination by the q-gram lemma: counts in overlapping diagonal bands, then banded alignment.

Texts are compared as UTF-8 bytes with A-Z in lower case and any ASCII white space as a space. A benchmark item is cut
into windows of at most 192 bytes. A window of m bytes found with at most k = m // 20 edits shares at least
m - q + 1 - kq of its q-grams (q = 12) with the document, all on diagonals (position in the document less position in
the window) within a band of k + 1. Bands are 2k + 2 wide and start every k + 1, so every such band lies in one of
them. Bands with enough shared q-grams are aligned, within the band only, and kept if the distance is at most k.

The benchmark is the stated query set: it is taken in blocks of at most 4 MB, each sent to all tasks, and every block
meets every document; a block's size is fixed, the number of passes grows with the benchmark.

Defined results: null texts and items are empty; a null item_id is kept; an item shorter than q must occur as it is; an empty item matches
nothing; repeated rows give repeated results; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._shared import slices

Q, WINDOW, EDIT_SHARE, TABLE_BITS = 12, 192, 20, 23
_U = np.uint64
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A") : ord("Z") + 1] += 32
_PLAIN[[9, 10, 11, 12, 13]] = 32


def _grams(plain: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the q bytes from each position on; plain must have q - 1 bytes at least."""
    n = len(plain) - Q + 1
    padded = np.concatenate([plain, np.zeros(8, np.uint8)])
    word = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(plain), 8), (1, 1)).copy().view("<u8").ravel() if len(plain) else np.zeros(0, _U)
    with np.errstate(over="ignore"):
        x = word[:n] * _U(0x9E3779B97F4A7C15) + word[Q - 8 : Q - 8 + n] * _U(0xC2B2AE3D27D4EB4F)
        return (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)


def _four_grams(rows: np.ndarray) -> np.ndarray:
    """A 16-bit hash of the 4 bytes from each place on, of each row."""
    x = sum((rows[:, i : rows.shape[1] - 3 + i].astype(np.uint32) << np.uint32(8 * i) for i in range(4)), np.uint32(0))
    return ((x * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _join(regions: list[list[int]], a: int, b: int, e: int) -> None:
    """Add a region; one that begins within the last is joined with it."""
    if regions and regions[-1][0] <= a <= regions[-1][1]:
        regions[-1][1], regions[-1][2] = max(regions[-1][1], b), max(regions[-1][2], e)
    else:
        regions.append([a, b, e])


class _Postings:
    """Which owners (windows, or templates) have a gram, and where. count_bands finds the owners' bands with enough shared grams."""

    def __init__(self, gram: np.ndarray, owner: np.ndarray, place: np.ndarray, length: np.ndarray, edits: np.ndarray, need: np.ndarray) -> None:
        order = np.argsort(gram, kind="stable")
        self.owner, self.place, self.length, self.need = owner[order].astype(np.int64), place[order].astype(np.int64), length, need
        self.step = edits + 1
        self.gram, self.first = np.unique(gram[order], return_index=True)
        self.count = np.diff(np.concatenate([self.first, [len(gram)]]))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.gram >> _U(64 - TABLE_BITS)).astype(np.int64)] = True

    def count_bands(self, grams: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Document, owner and least diagonal of each band with at least `need` hits.

        Hits are made by at most `most` at a time (or one position's), in the order of the text; a band that no later position
        can reach is settled at once, so only counts of bands that are still open are held.
        """
        if not len(grams) or not len(self.gram):
            return
        ends = offsets[1:]
        at = np.flatnonzero(self.table[(grams >> _U(64 - TABLE_BITS)).astype(np.int64)])
        known = np.minimum(np.searchsorted(self.gram, grams[at]), len(self.gram) - 1)
        same = self.gram[known] == grams[at]
        known, at = known[same], at[same]
        doc = np.searchsorted(ends, at, side="right")
        inside = at + Q <= ends[doc]
        known, at, doc = known[inside], at[inside], doc[inside]
        times = self.count[known]
        upto = np.cumsum(times)
        owners, many = len(self.length), int((np.diff(offsets).max() + 2 * self.length.max()) // self.step.min()) + 3
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, side="right")))
            n = times[lo:hi]
            entry = np.repeat(self.first[known[lo:hi]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            owner, where, of = self.owner[entry], np.repeat(at[lo:hi], n), np.repeat(doc[lo:hi], n)
            band = (where - self.place[entry] - offsets[of] + self.length[owner]) // self.step[owner]  # not negative
            key = (of * owners + owner) * many + band
            key, n = np.unique(np.concatenate([key, key[band > 0] - 1]), return_counts=True)
            keys, back = np.unique(np.concatenate([keys, key]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), len(keys)).astype(np.int64)
            owner, of, band = keys // many % owners, keys // many // owners, keys % many
            after = int(at[hi]) if hi < len(at) else 1 << 62
            closed = (offsets[of] + (band + 2) * self.step[owner] < after) | (ends[of] <= after)
            enough = closed & (counts >= self.need[owner])
            if enough.any():
                yield of[enough], owner[enough], band[enough] * self.step[owner[enough]] - self.length[owner[enough]]
            keys, counts = keys[~closed], counts[~closed]
            lo = hi


def _longest_run(flags: np.ndarray) -> tuple[int, int]:
    """First and end of the longest run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    if not len(edges):
        return 0, 0
    i = int((edges[1::2] - edges[::2]).argmax())
    return int(edges[2 * i]), int(edges[2 * i + 1])


class BenchmarkIndex:
    """The q-grams of the windows of one block of items; equal windows are one.

    A gram that more than `hot` windows have is a template's. Of each window the longest run of such grams is left out of the first
    count, as the lemma holds for any of its grams: of the g others at least g - kq must be met. Where g is at most kq, the window may
    also lie where none of the others is met; then its run alone must have all the hits that are needed. Runs are counted once for
    all windows that have them, and these windows are then told apart by their grams of 4 bytes, of which m - 3 - 4k must occur.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], hot: int = 64, most: int = 1 << 18) -> None:
        self.ids = [item for item, _ in items]  # any, also null or repeated; inside, an item is known by its number
        self.most = most
        self.short: list[tuple[int, bytes]] = []
        owners: dict[bytes, list[int]] = {}
        for item, (_, text) in enumerate(items):
            plain = _PLAIN[np.frombuffer((text or "").strip().encode(), np.uint8)]
            if len(plain) < Q:
                self.short += [(item, plain.tobytes())] if len(plain) else []
                continue
            for start in sorted({*range(0, max(1, len(plain) - WINDOW + 1), WINDOW // 2), max(0, len(plain) - WINDOW)}):
                of = owners.setdefault(plain[start : start + WINDOW].tobytes(), [])
                if not of or of[-1] != item:
                    of.append(item)
        self.windows = [np.frombuffer(w, np.uint8) for w in owners]
        self.items = list(owners.values())
        self.length = np.array([len(w) for w in self.windows], np.int64)
        self.edits = np.minimum(self.length // EDIT_SHARE, np.maximum((self.length - Q) // Q, 0))
        self.bound = np.maximum(self.length - Q + 1 - self.edits * Q, 1)
        sizes = self.length - Q + 1
        every = np.concatenate([_grams(w) for w in self.windows]) if self.windows else np.zeros(0, _U)
        window = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes) if len(every) else np.zeros(0, np.int64)
        _, back, times = np.unique(every, return_inverse=True, return_counts=True)
        is_hot, counted, need = times[back] > hot, np.ones(len(every), bool), self.bound.copy()
        runs: dict[tuple[bytes, int], list[tuple[int, int]]] = {}
        begins = np.cumsum(sizes) - sizes
        for w in np.unique(window[is_hot]).tolist():
            begin = int(begins[w])
            first, end = _longest_run(is_hot[begin : begin + sizes[w]])
            counted[begin + first : begin + end] = False
            left = int(sizes[w]) - (end - first) - int(self.edits[w]) * Q
            need[w] = max(1, left)
            if left <= 0 and end - first >= self.bound[w]:
                runs.setdefault((self.windows[w][first : end + Q - 1].tobytes(), int(self.length[w])), []).append((w, first))
        self.grams = _Postings(every[counted], window[counted], place[counted], self.length, self.edits, need)
        self.members = list(runs.values())  # windows of each template, and where it begins in them
        found = [_grams(np.frombuffer(run, np.uint8)) for run, _ in runs]
        one = np.array([m[0][0] for m in self.members], np.int64)
        self.templates = _Postings(
            np.concatenate(found) if found else np.zeros(0, _U), np.repeat(np.arange(len(found)), [len(g) for g in found]), np.concatenate([np.arange(len(g)) for g in found]) if found else np.zeros(0, np.int64),
            self.length[one], self.edits[one], self.bound[one],
        )
        self.fours: dict[int, np.ndarray] = {}

    def _told_apart(self, template: int, text: np.ndarray) -> np.ndarray:
        """The template's windows that may lie in the text by their grams of 4 bytes."""
        members, size = self.members[template], int(self.length[self.members[template][0][0]])
        if template not in self.fours:
            if len(self.fours) >= 64:
                self.fours.clear()
            self.fours[template] = _four_grams(np.stack([self.windows[w] for w, _ in members]))
        there = np.zeros(1 << 16, bool)
        there[_four_grams(text[None, :])[0]] = True
        enough = size - 3 - 4 * int(self.edits[members[0][0]])
        grams = self.fours[template]
        return np.concatenate([np.flatnonzero(there[grams[lo : lo + 1024]].sum(axis=1) >= enough) + lo for lo in range(0, len(grams), 1024)])

    def _candidates(self, plain: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Document, window and least diagonal of all bands in which a window may lie."""
        grams = _grams(plain) if len(plain) >= Q else np.zeros(0, _U)
        yield from self.grams.count_bands(grams, offsets, self.most)
        for docs, templates, lows in self.templates.count_bands(grams, offsets, self.most) if self.members else ():
            for d, t, low in zip(docs.tolist(), templates.tolist(), lows.tolist(), strict=True):
                w, first = self.members[t][0]
                size, reach = int(self.length[w]), 2 * int(self.edits[w]) + 3
                shifts = np.array([f for _, f in self.members[t]], np.int64)
                begin = max(0, low - int(shifts.max()))
                text = plain[offsets[d] + begin : min(offsets[d + 1], offsets[d] + max(0, low + size + reach))]
                if len(text) < 4:
                    continue
                left = self._told_apart(t, text)
                if len(left):
                    yield np.full(len(left), d), np.array([self.members[t][i][0] for i in left], np.int64), low - shifts[left]

    def regions(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first byte, end byte, edits) of all verified regions, those of an item merged where they overlap."""
        plain = _PLAIN[data]
        found: dict[tuple[int, int], list[list[int]]] = {}  # of each text and window
        if self.windows:
            for doc, window, low in self._candidates(plain, offsets):
                for lo in range(0, len(doc), 512):
                    part = slice(lo, lo + 512)
                    distance, first, last = self._align(plain, offsets, doc[part], window[part], low[part])
                    good = np.flatnonzero(distance <= self.edits[window[part]])
                    for d, w, a, b, e in zip(doc[part][good].tolist(), window[part][good].tolist(), first[good].tolist(), last[good].tolist(), distance[good].tolist(), strict=True):
                        _join(found.setdefault((d, w), []), a, b, e)
        shorts: dict[int, list[tuple[int, int, int]]] = {}
        for d, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)) if self.short else ():
            text = plain[a:b].tobytes()
            for item, pattern in self.short:
                spot = text.find(pattern)
                while spot >= 0:
                    shorts.setdefault(d, []).append((item, spot, spot + len(pattern)))
                    spot = text.find(pattern, spot + len(pattern))
        texts: dict[int, list[int]] = {}
        for d, w in found:
            texts.setdefault(d, []).append(w)
        for d in sorted(texts.keys() | shorts.keys()):
            of: dict[int, list[tuple[int, int, int]]] = {}
            for w in texts.get(d, []):
                for item in self.items[w]:
                    of.setdefault(item, []).extend(map(tuple, found[d, w]))
            for item, spot, end in shorts.get(d, []):
                of.setdefault(item, []).append((spot, end, 0))
            for item in sorted(of):
                merged: list[list[int]] = []
                for a, b, e in sorted(of[item]):
                    _join(merged, a, b, e)
                for a, b, e in merged:
                    yield d, self.ids[item], a, b, e

    def _align(self, plain: np.ndarray, offsets: np.ndarray, doc: np.ndarray, window: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least edits of each window against its document within diagonals low to low + 2k + 2, and where that begins and ends."""
        n, width = len(doc), int(2 * self.edits[window].max() + 3)
        size = self.length[window]
        pattern = np.full((n, int(size.max())), 1, np.uint8)
        for i, w in enumerate(window):
            pattern[i, : size[i]] = self.windows[w]
        start, length = offsets[doc], offsets[doc + 1] - offsets[doc]
        lane, big = np.arange(width), 10_000
        outside = lane[None, :] >= (2 * self.edits[window] + 3)[:, None]
        place = low[:, None] + lane  # place in the document before the next byte, on each diagonal
        cost = np.where(outside | (place < 0) | (place > length[:, None]), big, 0)
        origin = place.copy()
        best, first, last = np.full(n, big), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(pattern.shape[1]):
            there = place + i
            valid = (there >= 0) & (there < length[:, None])
            byte = plain[np.clip(start[:, None] + there, 0, len(plain) - 1)]
            step = np.where(valid, cost + (byte != pattern[:, i][:, None]), big)
            skip = np.concatenate([cost[:, 1:] + 1, np.full((n, 1), big)], axis=1)
            use = skip < step
            step = np.where(use, skip, step)
            source = np.where(use, np.concatenate([origin[:, 1:], origin[:, -1:]], axis=1), origin)
            # bytes of the document that the window lacks: a running minimum along the diagonals
            shifted = np.minimum.accumulate((step - lane) * 1024 + lane, axis=1)
            source = np.take_along_axis(source, shifted % 1024, axis=1)
            cost = np.where(outside, big, shifted // 1024 + lane)
            origin = source
            done = np.flatnonzero(size == i + 1)
            if len(done):
                lanes = cost[done].argmin(axis=1)
                best[done] = cost[done, lanes]
                first[done] = origin[done, lanes]
                last[done] = place[done, lanes] + i + 1
        return best, np.maximum(first, 0), np.minimum(last, length)


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_bytes: int = 4 << 20) -> Iterator[BenchmarkIndex]:
    """Indexes of blocks of the benchmark, made one after another on the driver; each is one pass over the documents."""
    block: list[tuple[int, str]] = []
    held = 0
    for row in benchmark.select(F.col(item_id).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).toLocalIterator():
        block.append((row["i"], row["t"]))
        held += len(row["t"].encode())
        if held >= block_bytes:
            yield BenchmarkIndex(block)
            block, held = [], 0
    if block:
        yield BenchmarkIndex(block)


def contaminated_regions(df: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, item_id, start, end (code points), edits: one row for each region of a document that holds an item."""
    schema = "doc_id long, item_id long, start long, end long, edits int"
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    result = df.sparkSession.createDataFrame([], schema)
    for index in benchmark_blocks(benchmark):
        shipped = df.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            for batch, data, offsets in slices(batches, "text"):
                found, of, points = shipped.value.regions(data, offsets), -1, np.zeros(0, np.int64)
                while out := list(islice(found, 10_000)):
                    rows = []
                    for d, item, a, b, edits in out:
                        if d != of:
                            of, points = d, np.cumsum((data[offsets[d] : offsets[d + 1]] & 0xC0) != 0x80)  # code points begun up to each byte
                        rows.append((batch.column(0)[d].as_py(), item, int(points[a - 1]) if a else 0, int(points[b - 1]) if b else 0, edits))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "item_id", "start", "end", "edits"])

        result = result.unionByName(rows.mapInArrow(run, schema))
    return result


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of df that hold no benchmark item, with their columns."""
    for index in benchmark_blocks(benchmark):
        shipped = df.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for batch, data, offsets in slices(batches, text):
                clean = np.ones(batch.num_rows, bool)
                clean[[r[0] for r in shipped.value.regions(data, offsets)]] = False
                yield batch.filter(pa.array(clean))

        df = df.mapInArrow(run, df.schema)
    return df
