"""Best-fit packing of documents into sequences of at most 1024 tokens.

A document is its byte-level BPE ids and an end id. A longer one is cut into pieces of 1024 from its end, so only its
first piece may be shorter. Pieces are packed best-fit decreasing: they come in order of falling length, and a segment
tree over the remaining capacities finds the tightest open sequence in logarithmic time. Full pieces need no search.

Pieces are dealt by a hash of their row number to groups of about 50,000, so a group's size does not grow with the
input; each group leaves a few sequences less than full, some per mille of its sequences.

Defined results: a null text is empty and has the end id alone; null doc_ids and repeated rows are packed as they are;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._shared import slices, texts_of, written

#: White space on both sides of a space: here a piece between spaces can't be encoded by itself.
_RUN = re.compile(r"\s \s")
#: A line end with neither white space nor a border beside it.
_LINE_END = re.compile(r"(?<=\S)\n(?=\S)")
_SPECIAL = "<|endoftext|>"
_ENCODERS: dict[str, "PieceEncoder"] = {}


class PieceEncoder:
    """Ids of the byte-level BPE as little-endian 32-bit bytes, remembered for each piece between two spaces.

    The pattern of this tokenizer never joins a space to what precedes it unless white space does, so the pieces of a
    text encode independently; texts with longer runs of white space or a special token's string go to the tokenizer.
    """

    def __init__(self, tokenizer: str, ranks: str, limit: int = 600_000) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pieces = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.merge = self.pieces._core_bpe.encode_single_piece
        self.whole = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        self.known: dict[str, bytes] = {}
        self.begun: dict[str, bytes] = {}  # pieces at the start of a line
        self.limit = limit
        self.marks = {mark: self._ids(mark) for mark in ".,\n"}

    def _ids(self, text: str) -> bytes:
        return array("I", self.pieces.encode_ordinary(text)).tobytes()

    def _line(self, line: str, lead: str) -> bytes:
        """Ids of lead and a part without a line end that could be cut. Letters with one mark after them are put together from two parts."""
        kept = self.known if lead else self.begun
        ids = kept.get(line)
        if ids is not None:
            return ids
        if line.isalpha():
            ids = array("I", self.merge((lead + line).encode())).tobytes()
        elif line[-1:] in (".", ",") and line[:-1].isalpha():
            word = kept.get(line[:-1])
            ids = (array("I", self.merge((lead + line[:-1]).encode())).tobytes() if word is None else word) + self.marks[line[-1]]
        else:
            ids = self._ids(lead + line)
        if len(line) < 64:
            if len(kept) >= self.limit:
                kept.clear()
            kept[line] = ids
        return ids

    def _learn(self, piece: str) -> bytes:
        """Ids of a space and a piece that has not been met. A line end between two marks or letters is encoded alone, so lines are, too."""
        parts: list[bytes] = []
        lead = " "
        for line in _LINE_END.split(piece) if "\n" in piece else [piece]:
            if parts:
                parts.append(self.marks["\n"])
            parts.append(self._line(line, lead))
            lead = ""
        ids = b"".join(parts)
        if len(piece) < 64:
            if len(self.known) >= self.limit:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if _SPECIAL in text:
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if _RUN.search(text):
            return self._ids(text)
        first, *rest = text.split(" ")
        found = self.known.get
        parts = [self._ids(first)]
        parts += [found(x) or self._learn(x) for x in rest]
        return b"".join(parts)


def encoder(tokenizer: str, ranks: str) -> PieceEncoder:
    """One encoder for each Python worker, as loading it takes longer than a small task."""
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = PieceEncoder(tokenizer, ranks)
    return _ENCODERS[tokenizer]


def tokenized_pieces(df: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 1024, end: int = 2, tokenizer: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken", ids: bool = False) -> DataFrame:
    """row, doc_id, piece, start, length, ids_crc32 and, with ids, the piece's ids as little-endian 32-bit bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = encoder(tokenizer, ranks), TaskContext.get().partitionId() << 33
        stop = np.asarray([end], dtype="<u4").tobytes()
        for batch, data, offsets in slices(batches, "text"):
            out: list[tuple] = []
            for key, raw in zip(batch.column(0).to_pylist(), texts_of(data, offsets), strict=True):
                all_ids = encode(raw.decode("utf-8", "replace")) + stop
                total = len(all_ids) // 4
                cut = total % length or length
                bounds = [0, *range(cut, total + 1, length)] if total > length else [0, total]
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    part = all_ids[4 * a : 4 * b]
                    out.append((row, key, i, a, b - a, zlib.crc32(part), part if ids else None))
                    row += 1
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["row", "doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    pieces = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "row long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return pieces if ids else pieces.drop("ids")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item. The tree has a leaf for each remaining capacity and counts the open bins under it."""
    leaves = 1 << capacity.bit_length()
    tree = [0] * (2 * leaves)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = 0

    def add(room: int, by: int) -> None:
        at = room + leaves
        while at:
            tree[at] += by
            at >>= 1

    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        if size > capacity:
            raise ValueError(f"an item of {size} does not fit into {capacity}")
        at = size + leaves  # least room >= size that some bin has: up until a right sibling has bins, then down its left side
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            at = at + 1 if at > 1 else 0
            while at and at < leaves:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        if at:
            room = at - leaves
            chosen = open_[room].pop()
            add(room, -1)
        else:
            room, chosen = capacity, count
            count += 1
        bins[item], offsets[item] = chosen, capacity - room
        if room > size:
            open_[room - size].append(chosen)
            add(room - size, 1)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 1024, group_rows: int = 50_000) -> DataFrame:
    """Add sequence_id and offset to written pieces (row, length, ...)."""
    groups = max(1, round(pieces.count() / group_rows))
    fields = [f for f in pieces.schema.fields if f.name != "row"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row", ignore_index=True)
        bins, offsets = best_fit_decreasing(frame["length"].to_numpy(), capacity)
        return frame.drop(columns=["row", "group"]).assign(sequence_id=bins * groups + frame["group"].iloc[0], offset=offsets)

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(run, schema)


def pack_documents(df: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 1024, end: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece."""
    return pack(written(tokenized_pieces(df, text, doc_id, length, end), "pieces"), length)
