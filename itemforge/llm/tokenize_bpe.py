"""Problem 8: encoding of a corpus with a public byte-level vocabulary.

Method: contiguous rank array.  A short word is an array of part boundaries beside an array with the rank of each
adjacent pair; the smallest rank is looked up again and again, its boundary deleted and the two neighbouring ranks
refreshed.  Words repeat, so each task keeps the ids of the words it has met; the cache is emptied when full, which
changes no result.

Null and empty texts give an empty list; strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The vocabulary's own word pattern.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
NO_RANK = 1 << 30
CACHE_WORDS = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: one base-64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word by repeated scans of its contiguous rank array."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 200:
        return _merge_long(word, ranks)
    n = len(word)
    bounds = list(range(n + 1))
    pair = [ranks.get(word[i : i + 2], NO_RANK) for i in range(n - 1)]
    while pair:
        low = min(pair)
        if low == NO_RANK:
            break
        i = pair.index(low)
        del bounds[i + 1]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(word[bounds[i] : bounds[i + 2]], NO_RANK)
        if i:
            pair[i - 1] = ranks.get(word[bounds[i - 1] : bounds[i + 1]], NO_RANK)
    return [ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for very long words: a heap finds the minimum, links replace deletion."""
    import heapq

    n = len(word)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1" * n)
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or after[after[i]] != end:
            continue
        alive[after[i]] = 0
        after[i] = end
        if end < n:
            before[end] = i
            if (r := ranks.get(word[i : after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:end])) is not None:
            heapq.heappush(heap, (r, p, end))
    return [ranks[word[i : after[i]]] for i in range(n) if alive[i]]


class Encoder:
    """Encodes texts; holds the vocabulary and the cache of one task."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex

        self.ranks, self.find, self.words = ranks, regex.compile(PATTERN).findall, {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        words, out = self.words, []
        for w in self.find(text):
            ids = words.get(w)
            if ids is None:
                if len(words) >= CACHE_WORDS:
                    words.clear()
                ids = words[w] = merge_word(w.encode("utf-8", "surrogatepass"), self.ranks)
            out += ids
        return out


def encode_corpus(df: DataFrame, id_col: str, text_col: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row of ``df`` to one row (id, ids array<int>); no shuffle.

    The vocabulary (about 0.8 MB, a fixed file) is read once on the driver and broadcast.  Other columns of ``df`` are
    ignored, whatever they are called; repeated rows give repeated results; an empty table gives an empty table.
    """
    held = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(held.value)
        for batch in batches:
            lists = [coder.encode(t) for t in batch.column(1).to_pylist()]
            ends = np.zeros(len(lists) + 1, np.int32)
            np.cumsum([len(x) for x in lists], out=ends[1:])
            flat = np.fromiter((i for x in lists for i in x), np.int32, int(ends[-1]))
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(_named(df, id_col), _named(df, text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def _named(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`")
