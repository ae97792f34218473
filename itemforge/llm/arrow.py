"""Arrow plumbing of the text operators: one worker function for whole partitions, state kept per worker."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemforge.session import ship


class Shared:
    """A broadcast value of bounded size under a name of its own, by which workers tell it from others."""

    def __init__(self, spark: SparkSession, value):
        self.name, self.box = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self.box.value


_BUILT: dict[tuple, object] = {}


def once(held: Shared, build: Callable):
    """``build(held.value)`` kept for all tasks of a Python worker; a new value replaces what an older one left."""
    key = (build, held.name)
    if key not in _BUILT:
        for old in [k for k in _BUILT if k[0] is build]:
            del _BUILT[old]
        _BUILT[key] = build(held.value)
    return _BUILT[key]


def map_rows(df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], schema: str | T.StructType) -> DataFrame:
    """Apply a row function to the columns of ``df``, batch by batch.

    ``make`` runs once in each task and returns the function; it may build tables there.  The function gets one
    Python list for each column and yields result tuples.  No shuffle happens.
    """
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)

    target = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            rows = list(work(*[c.to_pylist() for c in batch.columns]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*rows), target)], schema=target)

    return df.mapInArrow(run, struct)


class Bits:
    """A table of bits by the low part of a hash."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Whether a hash may be in the table; never no for one that is."""
        k = hashes & (32 * len(self.words) - 1)
        return (self.words[k >> 5] >> (k & 31).astype(np.uint32)) & np.uint32(1) == 1


class Bitmap:
    """A broadcast table of ``1 << bits`` bits that the values of a hash column set; its size does not grow with the data."""

    def __init__(self, df: DataFrame, column: str, bits: int):
        low = F.col(column).bitwiseAND((1 << bits) - 1)
        mask = F.bit_or(F.expr("shiftleft(1L, cast(k & 31 as int))")).alias("m")
        rows = df.select(low.alias("k")).groupBy(F.shiftright("k", 5).cast("int").alias("w")).agg(mask).toArrow()
        words = np.zeros(1 << (bits - 5), np.int64)
        words[rows.column("w").to_numpy()] = rows.column("m").to_numpy()
        self.box = df.sparkSession.sparkContext.broadcast(Bits(words.astype(np.uint32)))

    @property
    def value(self) -> Bits:
        return self.box.value

    def keep(self, df: DataFrame, column: str) -> DataFrame:
        """Rows whose hash may be in the table, each hash once in a task; no shuffle."""
        at, box = df.columns.index(column), self.box

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met: set[int] = set()
            for batch in batches:
                h = batch.column(at).to_numpy(zero_copy_only=False)
                fresh = []
                for i in np.flatnonzero(box.value.holds(h)).tolist():
                    if h[i] not in met:
                        fresh.append(i)
                        if len(met) < 1_000_000:
                            met.add(int(h[i]))
                if fresh:
                    yield batch.take(pa.array(fresh))

        return df.mapInArrow(run, df.schema)


def hashed_sample(df: DataFrame, key: str, rows: int, group: str | None = None) -> list:
    """About ``rows`` rows (of each group) by hash of the key, at most that many: the rows under a threshold that counts set.

    What reaches the driver does not grow with partitions or data.
    """
    h = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    counts = {r.g: r.n for r in df.groupBy((F.col(group) if group else F.lit(0)).alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()}
    most = F.lit(0)
    for g, n in counts.items():
        here = F.lit(min(1 << 30, int((1 << 30) * (1.2 * rows + 60) / max(n, 1))))
        most = F.when(F.col(group).eqNullSafe(F.lit(g)), here).otherwise(most) if group else here
    found = sorted(df.withColumn("_h", h).where(F.col("_h") < most).collect(), key=lambda r: (r["_h"], str(r[key])))
    taken: dict = {}
    out = []
    for r in found:
        g = r[group] if group else 0
        taken[g] = taken.get(g, 0) + 1
        if taken[g] <= rows:
            out.append(r)
    return out
