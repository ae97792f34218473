"""Problem 7: near-duplicate records with small edits.

Method: prefix-tree join, exact at any length and threshold.  A text is its set of distinct runs of three words; two texts
belong together if their sets have a Jaccard likeness of at least the threshold.

1. Equal texts form a class (hash of the text; texts of equal hash are told apart by a second hash); everything below
   works on classes.  Texts that differ only in case or punctuation are classes of their own and meet as near-duplicates.
2. The runs of a text stand under one global order, rarer first, and fall into ``BLOCKS`` parts by their hash.  An overlap
   that reaches the threshold over whole sets reaches it in one part at least, so each part is joined by itself.
3. The first level of the tree is spread over the cluster: two sets alike in a part have a first common run within the
   first ``n - ceil(threshold * n) + 1`` runs of each, so these lead to the groups in which candidates meet.  Every two
   classes of a group meet; a frequent run has its group cut into cells that pair each two of its shares.
4. A meeting counts as that of the first common run: the runs before it differ, a parity bitmap of the runs behind it
   tells how many more do at least, and what lengths and positions leave is the most that can still be common.  Meetings
   that cannot reach the threshold are dropped; no alike pair is.
5. What remains is decided in a prefix tree of the whole ordered sets of one leader's candidates, walked once: overlaps of
   a shared path count once, and a subtree is left as soon as the runs that remain cannot reach the overlap asked for.
6. Pairs of classes are widened to pairs of records.  Classes up to ``EXPAND`` records are widened in full; a larger
   class is linked through its first record, and ``record_classes`` gives the membership.

The order comes from counts of a bounded sample in a table of fixed size; any order gives the same pairs, a good one only
fewer meetings.  Null texts, empty texts and texts of fewer than three words have no pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemforge.llm.arrow import map_rows
from itemforge.session import checkpoint_dir

RUN = 3
#: Parts of the runs (a power of two), classes a bucket of groups is meant for, and rows from which a run's group is cut.
BLOCKS, BUCKET_CLASSES, HOT_ROWS = 8, 6_000, 20_000
BLOCK = 512
PARTNERS = 256
EXPAND = 1000
ORDER_ROWS, ORDER_BITS, NEED_BITS = 20_000, 18, 22
_WORD = re.compile(r"[^\W_]+")
_M, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Coder:
    """Word codes of a text; equal words have equal codes in every task."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def codes(self, text: str | None) -> np.ndarray:
        import xxhash

        if not text:
            return np.zeros(0, np.uint64)
        known, out = self.known, []
        for w in _WORD.findall(text.lower()):
            c = known.get(w)
            if c is None:
                if len(known) > 500_000:
                    known.clear()
                c = known[w] = xxhash.xxh64_intdigest(w)
            out.append(c)
        return np.array(out, dtype=np.uint64)


def runs(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ codes[k : k + m]) * _M
            h ^= h >> np.uint64(29)
    return h


_THREE_WORDS = r"[\p{L}\p{N}]+[^\p{L}\p{N}]+[\p{L}\p{N}]+[^\p{L}\p{N}]+[\p{L}\p{N}]"


def named(df: DataFrame, id_col: str, text_col: str, clashes: list[int] = ()) -> DataFrame:
    """(i, t, g): records with at least three words and the name of their text; names in ``clashes`` give way to a second hash."""
    base = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"))
    name = F.xxhash64("t")
    if clashes:
        name = F.when(name.isin(list(clashes)), _second_hash()).otherwise(name)
    return base.where(F.col("t").rlike(_THREE_WORDS)).select("i", "t", name.alias("g"))


def _second_hash():
    return F.conv(F.substring(F.md5("t"), 1, 15), 16, 10).cast("bigint")


def name_clashes(df: DataFrame, text_col: str) -> list[int]:
    """Names that two different texts share; among n texts n * n / 2 ** 65 are to be expected, so next to none."""
    both = df.select(F.col(f"`{text_col}`").alias("t")).where(F.col("t").rlike(_THREE_WORDS)).select(F.xxhash64("t").alias("g"), _second_hash().alias("s"))
    return [r.g for r in both.groupBy("g").agg(F.min("s").alias("a"), F.max("s").alias("b")).where("a < b").select("g").collect()]


def ordered(h: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Hashes under the global order: rarer first, then by value."""
    return (order[(h & np.uint64((1 << ORDER_BITS) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(58)) | (h >> np.uint64(6))


def seeds(sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, ...]:
    """(text * BLOCKS + part, runs in that part, position, bitmap behind it, run) of the prefixes of ordered run sets."""
    key = np.concatenate(sets)
    with np.errstate(over="ignore"):
        mix = key * _M
    mix ^= mix >> np.uint64(29)
    part = np.repeat(np.arange(len(sets)) * BLOCKS, [len(s) for s in sets]) + (mix & np.uint64(BLOCKS - 1)).astype(np.int64)
    o = np.argsort(part, kind="stable")  # runs stay in order within a part
    key, mix, part = key[o], mix[o], part[o]
    n = np.bincount(part, minlength=len(sets) * BLOCKS)
    start = np.cumsum(n) - n
    pos = np.arange(len(key)) - start[part]
    keep = pos < (n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1)[part]
    parity = np.bitwise_xor.accumulate(np.uint64(1) << ((mix >> np.uint64(32)) & np.uint64(63)))
    behind = parity ^ parity[(start + n - 1)[part]]
    part = part[keep]
    return part, n[part], pos[keep], behind[keep], key[keep]


def _order(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Logarithmic frequency class of each bucket of run hashes over a bounded sample (``1 << ORDER_BITS`` bytes), the number of
    cells for each class, and the number of texts."""
    total = texts.count()
    rate = max(1, total // ORDER_ROWS)
    sample = texts.where(F.pmod(F.xxhash64("i"), F.lit(rate)) == 0).select("t")

    def make():
        coder = Coder()

        def work(ts: list) -> Iterator[tuple]:
            counts = np.zeros(1 << ORDER_BITS, np.int64)
            for t in ts:
                c = coder.codes(t)
                np.add.at(counts, (np.unique(runs(c, RUN)) & np.uint64((1 << ORDER_BITS) - 1)).astype(np.int64), 1)
            hit = np.flatnonzero(counts)
            yield from zip(hit.tolist(), counts[hit].tolist())

        return work

    counted = map_rows(sample, make, "b int, n bigint").groupBy("b").agg(F.sum("n").alias("n"))
    packed = _to_pandas(counted.select("b", F.floor(F.log2("n")).cast("int").alias("c")).where("c > 0"))
    out = np.zeros(1 << ORDER_BITS, np.uint8)
    out[packed["b"].to_numpy(dtype=np.int64)] = np.minimum(packed["c"].to_numpy(dtype=np.int64) + 1, 31)
    cells = np.maximum(1, rate * 2.0 ** (np.arange(64) - 1) // HOT_ROWS).astype(np.int64)
    return out, cells, total


def _to_pandas(df: DataFrame):
    """A small bounded frame as columns (``1 << ORDER_BITS`` or ``1 << (NEED_BITS - 5)`` rows at most), by Arrow."""
    return df.toArrow().to_pandas()


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns as bytes, each with its length and item size; whole numbers below 256 take one byte."""
    out = []
    for c in columns:
        if c.dtype == np.int64:
            c = c.astype(np.uint8 if not len(c) or c.max() < 256 else np.uint32)
        out += [np.array([len(c), c.itemsize], np.uint32).tobytes(), c.tobytes()]
    return b"".join(out)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        m, size = np.frombuffer(blob, np.uint32, 2, at).tolist()
        out.append(np.frombuffer(blob, {1: np.uint8, 4: np.uint32, 8: np.uint64}[size], m, at + 8))
        at += 8 + m * size
    return out


def _celled(key: np.ndarray, own: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell hash, side): each row once, or once for each cell of its frequent run.

    Cell (i, j) has the classes of shares i and j; sides 1 and 2 meet each other only, side 0 (the cell of one share) itself.
    """
    many = cells[(key >> np.uint64(58)).astype(np.int64)]
    row = np.repeat(np.arange(len(key)), many)
    other = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    mine = (own[row] % many[row].astype(np.uint64)).astype(np.int64)
    side = np.where(mine == other, 0, np.where(mine < other, 1, 2))
    low, high = np.minimum(mine, other), np.maximum(mine, other)
    with np.errstate(over="ignore"):
        cell = (key[row] ^ (low.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)) ^ (high.astype(np.uint64) << np.uint64(40))) * _M2
    return row, cell ^ (cell >> np.uint64(31)), side


def _seed_rows(texts: DataFrame, order: np.ndarray, cells: np.ndarray, subs: int, threshold: float) -> DataFrame:
    """(p, b): packed prefixes for each bucket ``p`` of groups; a class comes once in each task.

    A bucket holds one part of the runs, so that a class stands once in a packet with the number of its rows there.
    """
    held = texts.sparkSession.sparkContext.broadcast((order, cells))

    def rows(sets: list[np.ndarray], names: list[int]) -> Iterator[tuple[int, bytes]]:
        part, size, pos, behind, key = seeds(sets, threshold)
        g = np.array(names, dtype=np.int64).view(np.uint64)
        row, cell, side = _celled(key, g[part // BLOCKS] >> np.uint64(7), held.value[1])
        bucket = (part[row] % BLOCKS) * subs + ((cell >> np.uint64(32)) % np.uint64(subs)).astype(np.int64)
        o = np.argsort(bucket, kind="stable")
        row, cell, side, bucket = row[o], cell[o], side[o], bucket[o]
        for at, m in zip(*_groups(bucket)):
            mine = slice(at, at + m)
            r = row[mine]
            first, count = _groups(part[r])
            entry = part[r[first]]
            yield int(bucket[at]), _packed([g[entry // BLOCKS], size[r[first]], count, cell[mine].astype(np.uint32), pos[r], behind[r], side[mine] if side[mine].any() else side[:0]])

    def batch_of(found: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
        p, b = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(b, pa.binary())], names=["p", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, met = Coder(), set()
        sets, names, size = [], [], 0
        for batch in batches:
            for t, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if g in met:
                    continue
                if len(met) < 1_000_000:
                    met.add(g)
                own = _ordered_set(coder, t, held.value[0])
                if len(own):
                    sets.append(own)
                    names.append(g)
                    size += len(own)
                if size > 500_000:
                    yield batch_of(rows(sets, names))
                    sets, names, size = [], [], 0
        if size:
            yield batch_of(rows(sets, names))

    return texts.select("t", "g").mapInArrow(run, "p int, b binary")


def _ordered_set(coder: Coder, text: str, order: np.ndarray) -> np.ndarray:
    own = ordered(runs(coder.codes(text), RUN), order)
    own.sort()
    return own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def _index_pairs(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of every two members of each group, groups of equal length together, a large one block by block."""
    for size in np.unique(lengths).tolist():
        at = starts[lengths == size]
        if size > BLOCK:
            for first in at.tolist():
                for p in range(first, first + size, BLOCK):
                    left = np.arange(p, min(p + BLOCK, first + size))
                    for q in range(p, first + size, BLOCK):
                        right = np.arange(q, min(q + BLOCK, first + size))
                        i, j = np.repeat(left, len(right)), np.tile(right, len(left))
                        yield (i[i < j], j[i < j]) if p == q else (i, j)
        elif size > 1:
            i, j = np.triu_indices(size, 1)
            step = max(1, 500_000 // len(i))
            for k in range(0, len(at), step):
                yield (at[k : k + step, None] + i).ravel(), (at[k : k + step, None] + j).ravel()


def _pairs_of(starts: np.ndarray, lengths: np.ndarray, columns: list[np.ndarray], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs inside groups given by start and length that sizes, positions and bitmaps leave possible."""
    h, n, pos, behind, side = columns
    n = n.astype(np.float32)
    need, after = n * np.float32(threshold / (1 + threshold)) - np.float32(1e-3), n - pos
    slack = n * np.float32((1 - threshold) / (1 + threshold)) + np.float32(1e-3) - pos
    sided = side.any()
    for i, j in _index_pairs(starts, lengths):
        room = slack[i] + slack[j]
        keep = np.flatnonzero(room >= 0)
        i, j, room = i[keep], j[keep], room[keep]
        keep = np.bitwise_count(behind[i] ^ behind[j]) <= room
        i, j = i[keep], j[keep]
        both = need[i] + need[j]
        keep = (after[i] >= both) & (after[j] >= both) & (np.minimum(n[i], n[j]) >= both)
        if sided:
            keep &= (side[i] != side[j]) | (side[i] == 0)
        a, b = h[i[keep]], h[j[keep]]
        yield np.minimum(a, b), np.maximum(a, b)


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of equal values."""
    m = len(columns[0])
    change = np.zeros(m, bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(change)
    return starts, np.diff(np.append(starts, m))


def _candidate_rows(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b): candidate pairs of each bucket of groups."""

    def packed(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate(c) for c in zip(*found))
        o = np.lexsort((b, a))
        a, b = a[o], b[o]
        first, _ = _groups(a, b)
        return pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first])], names=["a", "b"])

    def pairs(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        for blob in blobs:
            g, size, count, cell, pos, behind, side = _unpacked(blob)
            side = side if len(side) else np.zeros(len(cell), np.uint8)
            for into, c in zip(columns, (cell, np.repeat(g, count).view(np.int64), np.repeat(size, count), pos, behind, side)):
                into.append(c)
        cell, h, *rest = (np.concatenate(c) for c in columns)
        o = np.lexsort((h, cell))
        cell, h, rest = cell[o], h[o], [c[o] for c in rest]
        first, _ = _groups(cell, h)  # a class that several tasks met counts once
        cell, columns = cell[first], [h[first], *[c[first] for c in rest]]
        yield from _pairs_of(*_groups(cell), columns, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for blobs in _buckets(batches):
            for a, b in pairs(blobs):
                found.append((a, b))
                n += len(a)
                if n > 2_000_000:
                    yield packed(found)
                    found, n = [], 0
        if n:
            yield packed(found)

    return rows.sortWithinPartitions("p").mapInArrow(run, "a bigint, b bigint")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    at, blobs = None, []
    for batch in batches:
        for p, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p != at and blobs:
                yield blobs
                blobs = []
            at = p
            blobs.append(b)
    if blobs:
        yield blobs


class _Node:
    """A stretch of runs that the sets below it have in common."""

    __slots__ = ("stretch", "below", "ends", "least", "rest")

    def __init__(self, stretch: np.ndarray, least: int, rest: int):
        self.stretch, self.least, self.rest = stretch, least, rest  # smallest set and most runs behind the stretch, below here
        self.below: dict[int, _Node] = {}
        self.ends: list[tuple[int, int]] = []


class PrefixTree:
    """Ordered sets as paths of a tree; common beginnings are one path, and a stretch without a fork is one node."""

    #: Runs of a stretch that are compared before the bound is looked at again.
    STEP = 48

    def __init__(self) -> None:
        self.root = _Node(np.zeros(0, np.uint64), 1 << 60, 0)

    def add(self, path: np.ndarray, member: int) -> None:
        size = len(path)
        node, at = self.root, 0
        node.least, node.rest = min(node.least, size), max(node.rest, size)
        while at < size:
            child = node.below.get(int(path[at]))
            if child is None:
                child = node.below[int(path[at])] = _Node(path[at:], size, 0)
                at = size
            else:
                m = min(len(child.stretch), size - at)
                differ = np.flatnonzero(child.stretch[:m] != path[at : at + m])
                m = int(differ[0]) if len(differ) else m
                if m < len(child.stretch):  # the stretch forks here
                    upper = _Node(child.stretch[:m], child.least, child.rest + len(child.stretch) - m)
                    child.stretch = child.stretch[m:]
                    upper.below[int(child.stretch[0])] = child
                    node.below[int(upper.stretch[0])] = child = upper
                at += m
                child.least, child.rest = min(child.least, size), max(child.rest, size - at)
            node = child
        node.ends.append((size, member))

    def join(self, own: np.ndarray, threshold: float) -> Iterator[tuple[int, int, int]]:
        """(member, size, overlap) of the sets alike to the ordered set ``own``."""
        share = threshold / (1 + threshold)
        stack = [(self.root, 0, 0)]
        while stack:
            node, overlap, passed = stack.pop()
            need, alive = share * (len(own) + node.least) - 1e-9, True
            for k in range(0, len(node.stretch), self.STEP):
                piece = node.stretch[k : k + self.STEP]
                at = np.searchsorted(own, piece)
                overlap += int((own[np.minimum(at, len(own) - 1)] == piece).sum())
                passed = int(at[-1])
                left = len(node.stretch) - k - len(piece) + node.rest
                if overlap + min(len(own) - passed, left) < need:
                    alive = False
                    break
            if alive:
                for size, member in node.ends:
                    if overlap >= threshold * (len(own) + size - overlap) - 1e-9:
                        yield member, size, overlap
                stack += [(child, overlap, passed) for child in node.below.values()]


def _likeness_rows(sides: DataFrame, order: np.ndarray, threshold: float) -> DataFrame:
    """Verified pairs (a, b, likeness): sides hold (leader, part, h, t), the leader's own text in every part."""
    held = sides.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()

        def verify(leader: int, members: list[tuple[int, str]]) -> list[tuple[int, int, float]]:
            own, tree = None, PrefixTree()
            for h, t in members:
                path = _ordered_set(coder, t, held.value)
                if h == leader:
                    own = path
                else:
                    tree.add(path, h)
            return [] if own is None else [(min(leader, h), max(leader, h), o / (len(own) + n - o)) for h, n, o in tree.join(own, threshold)]

        out, at, members = [], None, []
        for batch in batches:
            for leader, part, h, t in zip(*[c.to_pylist() for c in batch.columns]):
                if (leader, part) != at:
                    if at is not None:
                        out += verify(at[0], members)
                    at, members = (leader, part), []
                members.append((h, t))
            if len(out) > 5000:
                yield _pair_batch(out)
                out = []
        if at is not None:
            out += verify(at[0], members)
        if out:
            yield _pair_batch(out)

    return sides.repartition("leader", "part").sortWithinPartitions("leader", "part", "h").mapInArrow(run, "a bigint, b bigint, likeness double")


def _pair_batch(rows: list[tuple[int, int, float]]) -> pa.RecordBatch:
    a, b, j = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(j, pa.float64())], names=["a", "b", "likeness"])


def record_classes(df: DataFrame, id_col: str, text_col: str, clashes: list[int] | None = None) -> DataFrame:
    """(id, h): the class of every record with at least three words."""
    clashes = name_clashes(df, text_col) if clashes is None else clashes
    return named(df, id_col, text_col, clashes).select(F.col("i").alias("id"), F.col("g").alias("h"))


def class_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, clashes: list[int] | None = None) -> DataFrame:
    """(a, b, likeness): pairs of classes of different texts alike to at least ``threshold``, a < b, each once."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    texts = named(df, id_col, text_col, name_clashes(df, text_col) if clashes is None else clashes)
    order, cells, total = _order(texts)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    subs = max(1, -(-max(total // BUCKET_CLASSES, tasks) // BLOCKS))
    rows = _seed_rows(texts, order, cells, subs, threshold).repartitionById(min(tasks, BLOCKS * subs), F.col("p"))
    candidates = _candidate_rows(rows, threshold).distinct().checkpoint()
    buckets = candidates.select(F.explode(F.array("a", "b")).alias("h")).select(F.pmod("h", F.lit(1 << NEED_BITS)).alias("k"))
    masks = _to_pandas(buckets.groupBy(F.shiftright("k", 5).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(k & 31 as int))")).alias("m")))
    need = np.zeros(1 << (NEED_BITS - 5), np.int64)
    need[masks["w"].to_numpy(dtype=np.int64)] = masks["m"].to_numpy(dtype=np.int64)
    held = spark.sparkContext.broadcast(need.astype(np.uint32))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows whose class may be wanted, each class once in a task; a table of fixed size decides, without the texts."""
        met: set[int] = set()
        for batch in batches:
            g = batch.column(1).to_numpy(zero_copy_only=False)
            k = g % (1 << NEED_BITS)
            keep = (held.value[k >> 5] >> (k & 31).astype(np.uint32)) & np.uint32(1) == 1
            at = []
            for i in np.flatnonzero(keep).tolist():
                if g[i] not in met:
                    at.append(i)
                    if len(met) < 1_000_000:
                        met.add(int(g[i]))
            if at:
                yield batch.take(pa.array(at))

    chosen = texts.select("t", "g").mapInArrow(pick, "t string, g bigint").groupBy("g").agg(F.first("t").alias("t"))
    degree = candidates.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    parted = candidates.join(degree, "a").select(F.col("a").alias("leader"), F.pmod(F.xxhash64("b"), F.floor(F.col("d") / PARTNERS) + 1).cast("int").alias("part"), "b")
    sides = parted.select("leader", "part", F.col("b").alias("g")).unionByName(parted.select("leader", "part", F.col("leader").alias("g")).distinct())
    return _likeness_rows(sides.join(chosen, "g").select("leader", "part", F.col("g").alias("h"), "t"), order, threshold).distinct()


def alike_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8) -> DataFrame:
    """(id_a, id_b): pairs of records alike to at least ``threshold``, id_a < id_b, each once.

    Records of classes above ``EXPAND`` members are linked through the class's first record only.  Null, empty and shorter
    texts and null keys give no pair; a key that comes twice with one text counts once.  Other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    checkpoint_dir(df.sparkSession)
    clashes = name_clashes(df, text_col)
    flat = record_classes(df, id_col, text_col, clashes).distinct().checkpoint()
    size = flat.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("first"))
    known = flat.join(size, "h")
    open_ = known.where((F.col("m") <= EXPAND) | (F.col("id") == F.col("first"))).select("h", "id")
    left, right = open_.select(F.col("h").alias("a"), F.col("id").alias("ia")), open_.select(F.col("h").alias("b"), F.col("id").alias("ib"))
    alike = class_pairs(df, id_col, text_col, threshold, clashes).select("a", "b")
    between = alike.join(left, "a").join(right, "b")
    several = known.where("m > 1")
    small = several.where(F.col("m") <= EXPAND).select("h", "id")
    within = small.select("h", F.col("id").alias("ia")).join(small.select("h", F.col("id").alias("ib")), "h").where("ia < ib")
    star = several.where((F.col("m") > EXPAND) & (F.col("id") != F.col("first"))).select(F.col("first").alias("ia"), F.col("id").alias("ib"))
    pairs = between.select("ia", "ib").unionByName(within.select("ia", "ib")).unionByName(star)
    return pairs.select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")).where("id_a < id_b")


def record_groups(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8) -> DataFrame:
    """(id, grupo, n_ligacoes): every record with at least three words, the smallest id of its group and its links.

    A group is what links connect; links run between classes, so copies cost nothing.  Labels spread by their minimum
    and jump to their label's label; each round is checkpointed, and rounds end when no label changes.
    """
    checkpoint_dir(df.sparkSession)
    clashes = name_clashes(df, text_col)
    flat = record_classes(df, id_col, text_col, clashes).distinct().checkpoint()
    pairs = class_pairs(df, id_col, text_col, threshold, clashes).select("a", "b").checkpoint()
    edges = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    classes = flat.groupBy("h").agg(F.min("id").alias("label"), F.count(F.lit(1)).alias("m")).checkpoint()
    labels = classes.select("h", "label").join(edges.select(F.col("a").alias("h")).distinct(), "h", "left_semi").checkpoint()
    while True:
        near = edges.join(labels.select(F.col("h").alias("b"), F.col("label").alias("other")), "b").groupBy(F.col("a").alias("h")).agg(F.min("other").alias("other"))
        fresh = labels.join(near, "h").select("h", "label", F.least("label", "other").alias("now"))
        fresh = fresh.join(fresh.groupBy(F.col("label").alias("now")).agg(F.min("now").alias("jump")), "now", "left").select("h", "label", F.least("now", F.coalesce("jump", "now")).alias("now")).checkpoint()
        moved = fresh.where("now < label").limit(1).count()
        labels = fresh.select("h", F.col("now").alias("label"))
        if not moved:
            break
    degree = edges.join(classes.select(F.col("h").alias("b"), "m"), "b").groupBy(F.col("a").alias("h")).agg(F.sum("m").alias("links"))
    out = flat.join(classes, "h").join(labels.select("h", F.col("label").alias("g")), "h", "left").join(degree, "h", "left")
    return out.select("id", F.coalesce("g", "label").alias("grupo"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_ligacoes"))
