"""Problem 9: passages of held-out items inside a corpus.

Method: rare n-gram seeds join documents to items, Smith-Waterman alignment over words scores each candidate pair and
decides.  One way serves any number of items: a bitmap of fixed size holds the n-grams of all items, the documents that
meet it give their n-grams, the rarity of every item n-gram is counted over them, and of each stretch of ``STRETCH`` item
words the rarest n-gram becomes a seed, so that no shared stretch of that length can lack one.  Seeds and documents join
on the n-gram; only the texts of candidates are read again, each different text once.

A pair is kept from ``POINTS`` on, what a verbatim passage of ``RUN`` words scores; edited copies lose a point for each
word changed, added or left out.  Where a verbatim run is asked for, an exact check follows (the longest run of equal
words on a diagonal of the alignment).

Words are the longest runs of letters and digits without case and accents; marks and invisible characters inside a word
do not end it.  Null and empty texts and items shorter than the run give no pair.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from itemforge.llm.arrow import Bitmap, map_rows
from itemforge.session import checkpoint_dir

SEED, STRETCH, RUN = 6, 9, 12
MATCH, MISMATCH, GAP = 2, -1, -1
#: Score from which a pair is kept, and from which one without a verbatim run counts as an edited copy.
POINTS, EDITED = RUN * MATCH, 40
#: Bits of the tables of item n-grams and of candidate texts.
BITS = 24
_WORD = re.compile(r"[^\W_]+")
_INSIDE = re.compile("[̀-ͯ\u00ad\u200b-\u200f\u2060\ufeff]")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Word codes of texts: equal words without case and accents have equal 64-bit codes in every task."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _code(self, word: str) -> int:
        import xxhash

        if len(self.known) > 500_000:
            self.known.clear()
        plain = word if word.isascii() else "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))
        code = self.known[word] = xxhash.xxh64_intdigest(plain)
        return code

    def codes(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint64)
        if not text.isascii() and _INSIDE.search(text):
            text = _INSIDE.sub("", unicodedata.normalize("NFC", text))
        known, code = self.known, self._code
        return np.array([known.get(w) or code(w) for w in _WORD.findall(text.lower())], dtype=np.uint64)


def grams(codes: np.ndarray, n: int = SEED) -> np.ndarray:
    """Rolling hash of every run of ``n`` codes."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ codes[k : k + m]) * _MULTIPLIER
            h ^= h >> np.uint64(29)
    return h


def align(doc: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """(Smith-Waterman score, longest run of equal words) of two code sequences."""
    m = len(doc)
    row, run = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    slope = GAP * np.arange(m + 1)
    best = longest = 0
    for w in item:
        same = doc == w
        fresh = np.zeros(m + 1, np.int64)
        fresh[1:] = np.maximum(row[:-1] + np.where(same, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(fresh, 0, out=fresh)
        fresh = np.maximum.accumulate(fresh - slope) + slope  # gaps along the document
        row = fresh
        stretch = np.zeros(m + 1, np.int64)
        stretch[1:] = (run[:-1] + 1) * same
        run = stretch
        best, longest = max(best, int(row.max())), max(longest, int(run.max()))
    return best, longest


def item_seeds(items: DataFrame, matched: DataFrame) -> DataFrame:
    """(g, item): of every window of n-grams that a stretch of ``STRETCH`` words holds, the one that fewest documents have."""
    seen = matched.select(F.explode("gs").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    ranked = items.select("item", F.posexplode("gs").alias("pos", "g")).join(seen, "g", "left").select("item", "pos", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g").alias("r"))
    width = STRETCH - SEED + 1
    w = W.partitionBy("item").orderBy("pos")  # an item's words, bounded by its text
    least = ranked.select("item", F.min("r").over(w.rowsBetween(0, width - 1)).alias("r"), F.count(F.lit(1)).over(w.rowsBetween(0, width - 1)).alias("m"))
    return least.where(F.col("m") == width).select(F.col("r.g").alias("g"), "item").distinct()


def leaked_passages(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(doc_id, item_id, pontos, palavras_seguidas) of every document and item that align to at least ``POINTS``.

    Null and empty texts, null item keys and items of fewer than ``RUN`` words give no row; repeated documents repeat,
    repeated items count once.  Other columns are ignored, whatever their names; an empty table gives an empty table.
    Texts are told apart by two hashes of 96 bits together; only texts of candidates are shuffled.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    source = docs.select(F.col(f"`{doc_id}`").alias("i"), F.col(f"`{text}`").alias("t")).where("length(t) > 0")
    source = source.select("i", "t", F.xxhash64("t").alias("h"), F.crc32("t").alias("c"))
    queries = items.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{item_text}`").alias("t")).where("item is not null and length(t) > 0").distinct()

    def item_grams():
        words = Words()

        def work(ids: list, ts: list) -> Iterator[tuple]:
            for i, t in zip(ids, ts):
                codes = words.codes(t)
                if len(codes) >= RUN:
                    yield i, t, grams(codes).view(np.int64).tolist()

        return work

    known = map_rows(queries, item_grams, "item bigint, t string, gs array<bigint>").checkpoint()
    held = Bitmap(known.select(F.explode("gs").alias("g")), "g", BITS)

    def document_grams():
        words, bits = Words(), held.value

        def work(ids: list, hs: list, cs: list, ts: list) -> Iterator[tuple]:
            for i, h, c, t in zip(ids, hs, cs, ts):
                g = grams(words.codes(t)).view(np.int64)
                if len(g) and (hit := bits.holds(g)).any():
                    yield i, h, c, np.unique(g[hit]).tolist()

        return work

    matched = map_rows(source.select("i", "h", "c", "t"), document_grams, "i bigint, h bigint, c bigint, gs array<bigint>").checkpoint()
    texts = matched.select("h", "c", "gs").groupBy("h", "c").agg(F.first("gs").alias("gs"))
    met = texts.select("h", "c", F.explode("gs").alias("g")).join(item_seeds(known, matched), "g").select("h", "c", "item").distinct().checkpoint()
    wanted = Bitmap(met.select("h"), "h", BITS)
    chosen = wanted.keep(source.select("h", "c", "t"), "h").groupBy("h", "c").agg(F.first("t").alias("t"))

    def scored():
        words = Words()

        def work(hs: list, cs: list, its: list, ds: list, qs: list) -> Iterator[tuple]:
            for h, c, item, d, q in zip(hs, cs, its, ds, qs):
                points, run = align(words.codes(d), words.codes(q))
                if points >= POINTS:
                    yield h, c, item, points, run

        return work

    pairs = met.join(chosen, ["h", "c"]).join(known.select("item", F.col("t").alias("q")), "item").select("h", "c", "item", "t", "q")
    hits = map_rows(pairs, scored, "h bigint, c bigint, item_id bigint, pontos int, palavras_seguidas int")
    return matched.select(F.col("i").alias("doc_id"), "h", "c").join(hits, ["h", "c"]).select("doc_id", "item_id", "pontos", "palavras_seguidas")
