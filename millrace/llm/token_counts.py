"""Token counts by greedy longest match over a vocabulary, with a linear automaton that builds no pieces.

The vocabulary's trie gets, for each node, a failure link and the number of tokens popped on following it: when no child
matches, the longest token that begins the node's string is taken off (and further ones, until what is left is again a
node), and the link leads to the node of the rest. A word costs one step for each byte and link, whatever its pieces.

Words are separated by white space and matched with one leading space, as in the byte-level vocabulary. A word in which
some position starts no token counts as one unknown token.

Defined results: a null or empty text has no words and no tokens; null doc_ids and repeated rows keep their rows; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._shared import slices, texts_of

_AUTOMATA: dict[str, "LongestMatch"] = {}


class LongestMatch:
    """Greedy longest-match lengths of byte strings."""

    def __init__(self, tokens: Iterable[bytes], limit: int = 300_000) -> None:
        self.child: list[dict[int, int]] = [{}]
        final = [False]
        for token in tokens:
            at = 0
            for byte in token:
                nxt = self.child[at].get(byte)
                if nxt is None:
                    nxt = self.child[at][byte] = len(self.child)
                    self.child.append({})
                    final.append(False)
                at = nxt
            final[at] = at > 0
        # link[v]: node left after the pops, -1 where the string can't be matched; pops[v]: their number
        self.link, self.pops = [-1] * len(self.child), [0] * len(self.child)
        order = [(0, 0)]
        for parent, _ in order:  # breadth first, the list grows
            for byte, at in self.child[parent].items():
                order.append((at, byte))
                if final[at]:
                    self.link[at], self.pops[at] = 0, 1
                    continue
                back, pops = self.link[parent], self.pops[parent]
                while back >= 0 and byte not in self.child[back]:
                    pops += self.pops[back]
                    back = self.link[back]
                if back >= 0:
                    self.link[at], self.pops[at] = self.child[back][byte], pops
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def length(self, word: bytes) -> int:
        """Number of tokens; -1 if some position starts none."""
        at, count, child, link, pops = 0, 0, self.child, self.link, self.pops
        for byte in word:
            while (nxt := child[at].get(byte)) is None:
                count += pops[at]
                at = link[at]
                if at < 0:
                    return -1
            at = nxt
        while at:
            count += pops[at]
            at = link[at]
            if at < 0:
                return -1
        return count

    def remembered(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self.length(b" " + word)
            if len(word) < 64:
                self.known[word] = found
        return found


def automaton(vocabulary: str) -> LongestMatch:
    """One automaton for each Python worker."""
    if vocabulary not in _AUTOMATA:
        import public_tokenizers

        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            _AUTOMATA[vocabulary] = LongestMatch(base64.b64decode(line.split()[0]) for line in lines)
    return _AUTOMATA[vocabulary]


def token_counts(df: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown: one row for each row of df."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = automaton(vocabulary)
        for batch, data, offsets in slices(batches, "text"):
            words, tokens, unknown = [], [], []
            for raw in texts_of(data, offsets):
                parts = raw.split()
                lengths = list(map(match.remembered, parts))
                missing = lengths.count(-1)
                words.append(len(parts))
                unknown.append(missing)
                tokens.append(sum(lengths) + 2 * missing)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array(unknown, pa.int64())], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
