"""Ordered operators: counters, carry-forward, clustering, interval union, medians.

Every operator takes its partition and order columns from the caller; ties are broken by all order columns given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _cols(names: list[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _by_blocks(df: DataFrame, part: list[str], order: str, block: int, last: Column, name: str, add: bool) -> DataFrame:
    """``df`` with ``_blk`` and ``name``: what ``last``, an aggregate of each block of ``block`` order values, comes to over all blocks before.

    A hot partition is cut by its order values, so that no task sorts it whole; blocks are few, and their windows small.
    """
    cut = df.withColumn("_blk", F.floor(F.col(f"`{order}`") / block))
    each = cut.groupBy(*_cols(part), "_blk").agg(last.alias("_v"))
    before = W.partitionBy(*_cols(part)).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    carried = each.withColumn(name, F.sum("_v").over(before) if add else F.last("_v", ignorenulls=True).over(before))
    side = carried.select(*[F.col(f"`{p}`").alias(f"_p{i}") for i, p in enumerate(part)], F.col("_blk").alias("_b"), name)
    on = [cut[p].eqNullSafe(side[f"_p{i}"]) for i, p in enumerate(part)] + [cut["_blk"].eqNullSafe(side["_b"])]
    return cut.join(side, on, "left").drop("_b", *[f"_p{i}" for i in range(len(part))])


def running_count(df: DataFrame, part: list[str], order: list[str], when: Column, name: str, block: int | None = None) -> DataFrame:
    """Number of rows so far, this one included, for which ``when`` holds; null conditions do not count.

    With ``block``, for one whole-number order column, partitions are counted by blocks of so many order values first.
    """
    hit = F.when(when, 1).otherwise(0)
    if block is None:
        return df.withColumn(name, F.sum(hit).over(W.partitionBy(*_cols(part)).orderBy(*_cols(order)).rowsBetween(W.unboundedPreceding, 0)))
    offset = _by_blocks(df.withColumn("_hit", hit), part, order[0], block, F.sum("_hit"), "_off", True)
    w = W.partitionBy(*_cols(part), "_blk").orderBy(*_cols(order)).rowsBetween(W.unboundedPreceding, 0)
    return offset.withColumn(name, F.coalesce("_off", F.lit(0)) + F.sum("_hit").over(w)).drop("_hit", "_off", "_blk")


def language_variant(df: DataFrame, doc: str, order: str, number: str, doubled: str, block: int | None = None) -> DataFrame:
    """Language of a numbered question in a document that holds both: 0 up to the first repeat of question 1, then 1.

    Only numbers up to 5 have a language; before any question 1 the later language holds, as the counter is still 0.
    """
    counted = running_count(df, [doc], [order], F.col(number) == 1, "_ones", block)
    lang = F.when(F.col(doubled) & (F.col(number) <= 5), F.when(F.col("_ones") == 1, 0.0).otherwise(1.0))
    return counted.withColumn("tp_lingua", lang).drop("_ones")


def carry_forward(df: DataFrame, part: list[str], order: list[str], value: str, name: str, block: int | None = None) -> DataFrame:
    """Last non-null value up to this row; null before the first.  ``block`` as in ``running_count``."""
    if block is None:
        w = W.partitionBy(*_cols(part)).orderBy(*_cols(order)).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumn(name, F.last(F.col(value), ignorenulls=True).over(w))
    last = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(f"`{order[0]}`")))
    joined = _by_blocks(df, part, order[0], block, last, "_off", False)
    w = W.partitionBy(*_cols(part), "_blk").orderBy(*_cols(order)).rowsBetween(W.unboundedPreceding, 0)
    return joined.withColumn(name, F.coalesce(F.last(F.col(value), ignorenulls=True).over(w), "_off")).drop("_off", "_blk")


def next_boundary(df: DataFrame, part: list[str], order: list[str], start: str, end: str, name: str) -> DataFrame:
    """Start of the next row of the partition, or the largest end of the partition for the last row."""
    w = W.partitionBy(*_cols(part)).orderBy(*_cols(order))
    return df.withColumn(name, F.coalesce(F.lead(F.col(start)).over(w), F.max(F.col(end)).over(W.partitionBy(*_cols(part)))))


def last_writer(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; null keys are keys of their own.  Uses map-side aggregation, no sort of whole groups."""
    top = F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*_cols(order))).alias("_row")
    return df.groupBy(*_cols(key)).agg(top).select("_row.*")


def preferred_row(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under an order."""
    w = W.partitionBy(*_cols(key)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def gap_clusters(df: DataFrame, part: list[str], value: str, tolerance: float) -> DataFrame:
    """(part..., cluster, centre, n): values sorted, a new cluster where the gap to the previous value exceeds the tolerance.

    The centre is the mean of the cluster's values, repeated values included; null values belong to no cluster.
    """
    w = W.partitionBy(*_cols(part)).orderBy(F.col(value))
    marked = df.where(F.col(value).isNotNull()).withColumn("_new", F.when(F.col(value) - F.lag(F.col(value)).over(w) > tolerance, 1).otherwise(0))
    grouped = marked.withColumn("cluster", F.sum("_new").over(w.rangeBetween(W.unboundedPreceding, W.currentRow)))
    return grouped.groupBy(*_cols(part), "cluster").agg(F.avg(F.col(value)).alias("centre"), F.count(F.lit(1)).alias("n"))


def interval_islands(df: DataFrame, part: list[str], begin: str, end: str, gap: float) -> DataFrame:
    """(part..., island, x0, x1): intervals merged while the next begins at most ``gap`` after the furthest end so far."""
    order = W.partitionBy(*_cols(part)).orderBy(F.col(begin), F.col(end))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    clean = df.where(F.col(begin).isNotNull() & F.col(end).isNotNull())
    marked = clean.withColumn("_new", F.when(F.col(begin) > F.max(F.col(end)).over(before) + gap, 1).otherwise(0))
    runs = marked.withColumn("island", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy(*_cols(part), "island").agg(F.min(F.col(begin)).alias("x0"), F.max(F.col(end)).alias("x1"))


def covered_length(df: DataFrame, part: list[str], begin: str, end: str, gap: float) -> DataFrame:
    """(part..., covered, n_islands): total length of the merged intervals."""
    return interval_islands(df, part, begin, end, gap).groupBy(*_cols(part)).agg(F.sum(F.col("x1") - F.col("x0")).alias("covered"), F.count(F.lit(1)).alias("n_islands"))


def projection_boundaries(words: DataFrame, part: list[str], begin: str, end: str, rules: DataFrame, rule_x: str, least: float = 5.0) -> DataFrame:
    """(part..., g0, g1, x): gaps of at least ``least`` between merged words that hold no rule; x is the middle."""
    w = W.partitionBy(*_cols(part)).orderBy("x0")
    gaps = interval_islands(words, part, begin, end, 0.0).withColumn("g1", F.lead("x0").over(w)).where(F.col("g1") - F.col("x1") >= least)
    gaps = gaps.select(*_cols(part), F.col("x1").alias("g0"), "g1")
    on = [gaps[p].eqNullSafe(rules[p]) for p in part]
    free = gaps.join(rules, [*on, rules[rule_x].between(gaps["g0"], gaps["g1"])], "left_anti")
    return free.withColumn("x", (F.col("g0") + F.col("g1")) / 2)


def upper_median(df: DataFrame, part: list[str], value: str, weight: str | None = None) -> DataFrame:
    """(part..., median, total): the element at half of the (weighted) count, not interpolated.

    Values are pre-aggregated with their weights, so that a group is as long as its distinct values; weights below one
    and null values do not count.
    """
    wt = F.col(weight) if weight else F.lit(1)
    counted = df.where(F.col(value).isNotNull() & (wt >= 1)).groupBy(*_cols(part), F.col(value).alias("_v")).agg(F.sum(wt).alias("_n"))
    w = W.partitionBy(*_cols(part))
    cum = counted.withColumn("_cum", F.sum("_n").over(w.orderBy("_v"))).withColumn("total", F.sum("_n").over(w))
    return cum.where(F.col("_cum") > F.floor(F.col("total") / 2)).groupBy(*_cols(part)).agg(F.min("_v").alias("median"), F.first("total").alias("total"))


def anchored_lines(df: DataFrame, part: list[str], centre: str, height: str, text: str, share: float = 0.6) -> DataFrame:
    """(part..., line, y, texts): words sorted by centre join the open line while centre - first centre <= share * tallest so far.

    One native ordered fold for each group; groups are single pages, whose word count is bounded by the page.
    """
    item = F.struct(F.col(centre).cast("double").alias("c"), F.col(height).cast("double").alias("h"), F.col(text).cast("string").alias("t"))
    grouped = df.where(F.col(centre).isNotNull() & F.col(height).isNotNull()).groupBy(*_cols(part)).agg(F.array_sort(F.collect_list(item)).alias("_w"))
    start = F.expr("named_struct('done', array(), 'first', cast(null as double), 'tall', cast(null as double), 'open', array())").cast(
        "struct<done:array<struct<y:double,ts:array<string>>>,first:double,tall:double,open:array<string>>"
    )

    def step(acc: Column, w: Column) -> Column:
        tall = F.greatest(acc["tall"], w["h"])
        joins = acc["first"].isNotNull() & (w["c"] - acc["first"] <= share * tall)
        closed = F.when(acc["first"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["first"].alias("y"), acc["open"].alias("ts")))))
        return F.struct(
            F.when(joins, acc["done"]).otherwise(closed).alias("done"),
            F.when(joins, acc["first"]).otherwise(w["c"]).alias("first"),
            F.when(joins, tall).otherwise(w["h"]).alias("tall"),
            F.when(joins, F.concat(acc["open"], F.array(w["t"]))).otherwise(F.array(w["t"])).alias("open"),
        )

    folded = grouped.withColumn("_l", F.aggregate("_w", start, step, lambda a: F.concat(a["done"], F.array(F.struct(a["first"].alias("y"), a["open"].alias("ts"))))))
    return folded.select(*_cols(part), F.posexplode("_l").alias("line", "_x")).select(*_cols(part), "line", F.col("_x.y").alias("y"), F.col("_x.ts").alias("texts"))


def ordered_text(df: DataFrame, part: list[str], order: list[str], text: str, glue: str, name: str = "text") -> DataFrame:
    """Texts of a group joined in order; null texts are left out, a group of nulls gives an empty text."""
    pair = F.struct(*_cols(order), F.col(text).alias("_t"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["_t"]), glue)
    return df.groupBy(*_cols(part)).agg(joined.alias(name))
