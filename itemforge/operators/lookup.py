"""Lookups: fallbacks, offsets, reconciliation, range joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shifts tried, in order, for a position that a booklet does not hold.
OFFSETS = (135, 90, 45)
LAST_SHIFTED = 45
#: Width of the cells by which objects and regions meet.
CELL = 64.0


def small(df: DataFrame, most_rows: int = 200_000) -> DataFrame:
    """A broadcast hint only if the side is checked to be small; otherwise the plan decides."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def membership(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the codes; null keys are not."""
    return df.join(codes.select(F.col(f"`{key}`")), key, "left_semi")


def absent(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys that the codes do not hold."""
    return df.select(F.col(f"`{key}`")).where(F.col(key).isNotNull()).distinct().join(codes.select(F.col(f"`{key}`")).distinct(), key, "left_anti")


def resolve_position(items: DataFrame, present: DataFrame, booklet: str, position: str) -> DataFrame:
    """``items`` with ``posicao_efetiva``: the position itself, or for one up to 45 that its booklet lacks the first
    present shift of +135, +90, +45; unchanged if none is present.

    The booklet's positions travel as one array a booklet (at most a few hundred numbers), so the items are joined once
    and never multiplied.
    """
    held = present.where(F.col(position).isNotNull()).groupBy(F.col(f"`{booklet}`").alias("_b")).agg(F.collect_set(F.col(position)).alias("_has"))
    joined = items.join(small(held), items[booklet] == F.col("_b"), "left")
    p = F.col(position)
    here = F.coalesce(F.array_contains("_has", p), F.lit(False))
    shifted = F.coalesce(*[F.when(F.array_contains("_has", p + o), p + o) for o in OFFSETS], p)
    return joined.withColumn("posicao_efetiva", F.when((p <= LAST_SHIFTED) & ~here, shifted).otherwise(p)).drop("_b", "_has")


def language_fallback(items: DataFrame, questions: DataFrame, booklet: str, position: str, language: str, values: list[str]) -> DataFrame:
    """Left join to questions by booklet, position and language with the fallback of the bank.

    An exact language wins; an item with a language falls back to the question without one, an item without a language
    to the first language.  Questions are unique by key.  One shuffle joins: the candidates of a position (three at
    most) come as columns of one row.
    """
    q = questions.groupBy(F.col(f"`{booklet}`").alias("_b"), F.col(f"`{position}`").alias("_p")).agg(
        *[F.first(F.when(cond, F.struct(*[F.col(f"`{v}`") for v in values])), ignorenulls=True).alias(n)
          for n, cond in (("_none", F.col(language).isNull()), ("_zero", F.col(language) == 0), ("_one", F.col(language) == 1))]
    )
    joined = items.join(q, (items[booklet] == F.col("_b")) & (items[position] == F.col("_p")), "left")
    lang = F.col(language)
    hit = F.when(lang.isNull(), F.coalesce("_none", "_zero")).when(lang == 0, F.coalesce("_zero", "_none")).when(lang == 1, F.coalesce("_one", "_none")).otherwise(F.col("_none"))
    out = joined.withColumn("_hit", hit)
    for v in values:
        out = out.withColumn(v, F.col(f"_hit.`{v}`"))
    return out.withColumn("encontrado", F.col("_hit").isNotNull().cast("int")).drop("_b", "_p", "_none", "_zero", "_one", "_hit")


def first_interval(objects: DataFrame, regions: DataFrame, keys: list[str], at: str, low: str, high: str, order: str, slack: float, object_id: str) -> DataFrame:
    """Each object with the first region, by order, whose widened interval holds it; objects outside every region drop.

    The join has its equality keys (page, column) first; the rank is a map-side minimum, not a sort.
    """
    hits = _within(objects, regions, keys, at, low, high, slack, slack)
    rest = F.struct(*[F.col("_region")[c].alias(c) for c in regions.columns if c not in keys])
    grouped = hits.groupBy(*[F.col("_object")[k].alias(k) for k in keys], F.col("_object")[object_id].alias(object_id))
    return grouped.agg(F.min_by(rest, F.col("_region")[order]).alias("_r")).select(*keys, object_id, "_r.*")


def all_intervals(objects: DataFrame, regions: DataFrame, keys: list[str], at: str, low: str, high: str, below: float = 0.0) -> DataFrame:
    """Every region whose interval, widened at its end by ``below``, holds the object."""
    hits = _within(objects, regions, keys, at, low, high, 0.0, below)
    return hits.select("_object.*", *[F.col("_region")[c].alias(c) for c in regions.columns if c not in keys])


def _within(objects: DataFrame, regions: DataFrame, keys: list[str], at: str, low: str, high: str, above: float, below: float, cell: float = CELL) -> DataFrame:
    """Objects with the regions that hold them.

    Regions come once for each cell they reach into, an object has one cell, so that only what is near meets and each
    pair meets once; a region has as many rows as cells, a dozen on a page.
    """
    begin, end = (F.col("_region")[low] - above), (F.col("_region")[high] + below)
    cells = F.sequence(F.floor(begin / cell), F.floor(end / cell))
    spread = regions.select(F.struct("*").alias("_region")).where(begin <= end).select("_region", F.explode(cells).alias("_cell"))
    placed = objects.select(F.struct("*").alias("_object"), F.floor(F.col(at) / cell).alias("_cell"))
    on = [F.col("_object")[k] == F.col("_region")[k] for k in keys]
    near = [placed["_cell"] == spread["_cell"], F.col("_object")[at] >= begin, F.col("_object")[at] <= end]
    return placed.join(spread, [*on, *near]).select("_object", "_region")


def supported_extents(df: DataFrame, keys: list[str], low: str, high: str, tolerance: float = 3.0, least: int = 2) -> DataFrame:
    """Extents that at least ``least`` extents of the group, themselves included, match at both ends within the tolerance.

    Extents are bucketed by their begin so that only neighbouring buckets meet; no group is compared in full.
    """
    base = df.where(F.col(low).isNotNull() & F.col(high).isNotNull()).withColumn("_id", F.monotonically_increasing_id())
    cell = F.floor(F.col(low) / tolerance)
    left = base.select(*keys, "_id", F.col(low).alias("_l"), F.col(high).alias("_h"), cell.alias("_c"))
    right = base.select(*keys, F.col(low).alias("_l2"), F.col(high).alias("_h2"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("_c"))
    right = right.groupBy(*keys, "_c", "_l2", "_h2").agg(F.count(F.lit(1)).alias("_m"))
    near = left.join(right, [*keys, "_c"]).where((F.abs(F.col("_l") - F.col("_l2")) <= tolerance) & (F.abs(F.col("_h") - F.col("_h2")) <= tolerance))
    kept = near.groupBy(*keys, "_id", "_l", "_h").agg(F.sum("_m").alias("apoio")).where(F.col("apoio") >= least)
    return kept.select(*keys, F.col("_l").alias(low), F.col("_h").alias(high), "apoio")


def overlap_share(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Share of box ``a`` that box ``b`` covers; boxes are (x0, y0, x1, y1), an empty box has share 0."""
    zero = F.lit(0.0)
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), zero)
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), zero)
    area = (a[2] - a[0]) * (a[3] - a[1])
    return F.when(area > 0, w * h / area).otherwise(zero)
