"""Page layout: columns, regions of questions, decoration, pictures.

Everything is keyed by document and page first, so that joins hash on those keys and compare coordinates only inside a
page; no page's content leaves its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from itemforge.functions import geometry as G
from itemforge.operators.lookup import first_interval
from itemforge.operators.windows import carry_forward, language_variant, upper_median

PAGE = ["doc_id", "page_no"]
BOTTOM = 737.0
FOOT = r"(?iu)P[ÁA]GINA\s*\d+|CADERNO\s*\d+|\b(?:CH|CN|LC|MT|RED)\s*[-–—|•]\s*[12]\s*[ºo°]?\s*DIA|[12]\s*[ºo°]\s*DIA\s*•"
QUESTION = r"(?iu)QUEST[ÃA]O\s*(\d+)"


def page_bottom(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, page_no, bottom): just above the page's foot line, at least the usual bottom.  ``lines``: y0, text."""
    foot = lines.join(pages.select(*PAGE, "height"), PAGE).where((F.col("y0") >= 0.85 * F.col("height")) & F.col("text").rlike(FOOT)).groupBy(*PAGE).agg(F.min("y0").alias("_f"))
    return pages.join(foot, PAGE, "left").select(*PAGE, F.greatest(F.lit(BOTTOM), F.coalesce(F.col("_f") - 1.0, F.lit(BOTTOM))).alias("bottom"))


def page_columns(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(doc_id, page_no, mid, single): one column if at least two wide blocks cross the middle."""
    mid = F.col("width") / 2
    wide = (F.col("x0") < mid - 40) & (F.col("x1") > mid + 40) & (F.col("y0") > 50) & (F.col("y1") < 740) & (F.col("x1") - F.col("x0") > 280)
    crossing = blocks.join(pages.select(*PAGE, "width"), PAGE).groupBy(*PAGE).agg(F.count(F.when(wide, 1)).alias("_n"))
    return pages.join(crossing, PAGE, "left").select(*PAGE, mid.alias("mid"), (F.coalesce("_n", F.lit(0)) >= 2).alias("single"))


def column_of(single: Column, x: Column, mid: Column) -> Column:
    """Column 0 or 1 of a coordinate; a page with one column has column 0 only."""
    return F.when(single | (x < mid), 0).otherwise(1)


def position_key(grid: float = 2.0) -> Column:
    """A box on a grid, halves to even."""
    return F.struct(*[F.bround(F.col(c) / grid).cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")])


def decoration(boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, k): places occupied on at least max(3, 30 % of the pages after the cover) pages."""
    n = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    seen = boxes.select(*PAGE, position_key().alias("k")).distinct().groupBy("doc_id", "k").agg(F.count(F.lit(1)).alias("n"))
    return seen.join(n, "doc_id").where(F.col("n") >= F.greatest(F.lit(3.0), 0.3 * (F.col("_n") - 1))).select("doc_id", "k")


def question_regions(blocks: DataFrame, columns: DataFrame, bottoms: DataFrame) -> DataFrame:
    """(doc_id, page_no, col, single, ord, num, tp_lingua, y0, header_y1, y1): the page areas of every question.

    Content before the first header of a column belongs to the question before it, in reading order.
    """
    placed = blocks.join(columns, PAGE).join(bottoms, PAGE).where((F.col("page_no") >= 1) & (F.col("y0") > 40) & (F.col("y0") < F.greatest(F.lit(745.0), F.col("bottom"))))
    placed = placed.withColumn("col", column_of(F.col("single"), F.col("x0"), F.col("mid"))).withColumn("num", F.regexp_extract("text", QUESTION, 1).try_cast("bigint"))
    reading = ["page_no", "col", "y0", "x0"]
    w = W.partitionBy("doc_id").orderBy(*reading)
    placed = placed.withColumn("ord", F.row_number().over(w))
    here = W.partitionBy(*PAGE, "col").orderBy("ord")
    part = placed.withColumn("seg", F.count("num").over(here.rowsBetween(W.unboundedPreceding, 0)))
    head = F.max(F.when(F.col("num").isNotNull(), F.col("y1"))).alias("_h")
    # The end of a column without a further header is the end of its last block, whatever block reaches lowest.
    segs = part.groupBy(*PAGE, "col", "single", "seg").agg(F.min("ord").alias("ord"), F.max("num").alias("num"), F.min_by("y0", "ord").alias("y0"), head, F.max_by("y1", "ord").alias("_last"))
    segs = segs.withColumn("y1", F.coalesce(F.lead("y0").over(W.partitionBy(*PAGE, "col").orderBy("seg")), "_last"))
    twice = segs.groupBy("doc_id").agg(((F.count(F.when(F.col("num") == 1, 1)) >= 2) & (F.count(F.when(F.col("num") == 2, 1)) >= 2)).alias("_double"))
    flagged = language_variant(segs.join(twice, "doc_id"), "doc_id", "ord", "num", "_double")
    carried = carry_forward(flagged.withColumn("_q", F.when(F.col("num").isNotNull(), F.struct("num", "tp_lingua"))), ["doc_id"], ["ord"], "_q", "_now").where("_now is not null")
    return carried.select(*PAGE, "col", "single", "ord", F.col("_now.num").alias("num"), F.col("_now.tp_lingua").alias("tp_lingua"), "y0", F.coalesce("_h", "y0").alias("header_y1"), "y1")


def _located(boxes: DataFrame, columns: DataFrame) -> DataFrame:
    mid_x = (F.col("x0") + F.col("x1")) / 2
    return boxes.join(columns, PAGE).withColumn("col", column_of(F.col("single"), mid_x, F.col("mid"))).withColumn("ym", (F.col("y0") + F.col("y1")) / 2).withColumn("oid", F.monotonically_increasing_id())


def _first_region(boxes: DataFrame, regions: DataFrame, slack: float) -> DataFrame:
    """Questions of the boxes by the first region that holds their middle."""
    keys = [*PAGE, "col"]
    return first_interval(boxes.select(*keys, "ym", "oid"), regions.select(*keys, "ord", "num", "tp_lingua", F.col("y0").alias("ry0"), "y1"), keys, "ym", "ry0", "y1", "ord", slack, "oid").select("doc_id", F.col("num").alias("co_posicao"), "tp_lingua")


def question_images(pages: DataFrame, blocks: DataFrame, lines: DataFrame, drawings: DataFrame, images: DataFrame, tables: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, co_posicao, tp_lingua): questions with a picture: raster images, tables that could not be structured,
    figures, clusters of drawings, outlined words and display type.

    ``tables``: boxes with ``status``; ``spans``: horizontal text with size.  Decoration, answer rings and drawings inside
    structured tables do not count.
    """
    columns, bottoms = page_columns(pages, blocks), page_bottom(pages, lines)
    regions = question_regions(blocks, columns, bottoms)
    deep = bottoms.withColumn("bottom", F.greatest(F.lit(745.0), F.col("bottom")))
    raster = images.where("page_no >= 1").withColumn("k", position_key()).join(decoration(images.where("page_no >= 1"), pages), ["doc_id", "k"], "left_anti").join(deep, PAGE)
    raster = raster.where("x1 - x0 >= 25 and y1 - y0 >= 25 and x0 <= 550 and y0 >= 35 and y1 <= bottom")
    rejected = tables.where("status <> 'OK'")
    kept = drawings.where("page_no >= 1").withColumn("k", position_key()).join(decoration(drawings.where("page_no >= 1"), pages), ["doc_id", "k"], "left_anti").join(deep, PAGE).where(~G.answer_ring())
    ok = tables.where("status = 'OK'").select(F.col("doc_id").alias("_d"), F.col("page_no").alias("_p"), *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    inside = (kept.doc_id == ok._d) & (kept.page_no == ok._p) & (kept.x0 >= ok._x0 - 2) & (kept.y0 >= ok._y0 - 2) & (kept.x1 <= ok._x1 + 2) & (kept.y1 <= ok._y1 + 2)
    kept = kept.join(ok, inside, "left_anti")
    figures = kept.where(G.vector_figure(F.col("bottom")))
    out = _first_region(_located(raster, columns), regions, 20.0).unionByName(_first_region(_located(rejected, columns), regions, 15.0)).unionByName(_first_region(_located(figures, columns), regions, 20.0))
    held = _all_regions(_located(kept.where(~G.cluster_noise(F.col("bottom"))), columns), regions, 10.0)
    for found in (clusters(held), outlined_words(held), display_type(_all_regions(_located(spans, columns), regions, 0.0))):
        out = out.unionByName(found)
    return out.distinct()


def _all_regions(boxes: DataFrame, regions: DataFrame, below: float) -> DataFrame:
    r = regions.select(*PAGE, F.col("col").alias("_c"), "ord", F.col("num").alias("co_posicao"), "tp_lingua", "header_y1", F.col("y1").alias("_end"))
    joined = boxes.join(r, PAGE)
    return joined.where((F.col("col") == F.col("_c")) & (F.col("ym") >= F.col("header_y1") + 2) & (F.col("ym") <= F.col("_end") + below))


def clusters(held: DataFrame) -> DataFrame:
    """Regions whose drawings form a figure together: six curved ones over 25 x 10 points, or twenty over 50 x 50."""
    curved = F.exists("items", lambda i: i["cmd"] == "c")
    g = held.groupBy("doc_id", "ord", "co_posicao", "tp_lingua").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(curved, 1)).alias("c"), (F.max("x1") - F.min("x0")).alias("w"), (F.max("y1") - F.min("y0")).alias("h"))
    return g.where("(c >= 6 and w >= 25 and h >= 10) or (n >= 20 and w >= 50 and h >= 50)").select("doc_id", "co_posicao", "tp_lingua")


def outlined_words(held: DataFrame, least: int = 3) -> DataFrame:
    """Regions with at least three outlined glyphs on one base line, nearly touching: a chain from some first glyph."""
    glyph = F.struct(F.bround("y1").alias("b"), "x0", "x1", "y1")
    g = held.where(G.outlined_glyph()).groupBy("doc_id", "ord", "co_posicao", "tp_lingua").agg(F.array_sort(F.collect_list(glyph)).alias("g"))

    def chain(start: Column) -> Column:
        zero = F.struct(F.lit(1).alias("n"), start["x0"].alias("x0"), start["x1"].alias("x1"))

        def step(a: Column, r: Column) -> Column:
            joins = (r["x0"] > a["x0"]) & (F.abs(r["y1"] - start["y1"]) <= 1.2) & (r["x0"] - a["x1"]).between(0, 3)
            return F.when(joins, F.struct((a["n"] + 1).alias("n"), r["x0"].alias("x0"), r["x1"].alias("x1"))).otherwise(a)

        return F.aggregate("g", zero, step, lambda a: a["n"])

    return g.where(F.exists("g", lambda s: chain(s) >= least)).select("doc_id", "co_posicao", "tp_lingua")


def display_type(held: DataFrame, ratio: float = 2.2) -> DataFrame:
    """Regions with a word set at least ``ratio`` times as large as their text: the median size, weighted by characters."""
    real = held.where("size >= 5").withColumn("_n", F.length(F.trim("text"))).withColumn("_word", F.col("text").rlike("[A-Za-zÀ-ÿ]{2,}"))
    keys = ["doc_id", "ord", "co_posicao", "tp_lingua"]
    body = upper_median(real, keys, "size", "_n").select(*keys, "median")
    largest = real.where("_word").groupBy(*keys).agg(F.max("size").alias("_top"))
    on = [body[k].eqNullSafe(largest[k]) for k in keys]
    return body.join(largest, on).where(F.col("_top") >= ratio * F.col("median")).select(*[body[k] for k in ("doc_id", "co_posicao", "tp_lingua")])


def circle_alternatives(drawings: DataFrame, headers: DataFrame, lines: DataFrame, columns: DataFrame) -> DataFrame:
    """(doc_id, co_posicao, alternativas): texts beside the five circles of each question of a page.

    ``headers``: page, co_posicao, x0, y0.  A page counts only if it has exactly five circles a header.  Circles in a
    left column of three and a right one of two are read column by column, others downwards.
    """
    cols = columns.select(*PAGE, "mid")
    dots = drawings.where(G.answer_circle()).join(cols, PAGE).withColumn("col", F.when(F.col("x0") < F.col("mid"), 0).otherwise(1))
    heads = headers.join(cols, PAGE).withColumn("col", F.when(F.col("x0") < F.col("mid"), 0).otherwise(1)).withColumn("q", F.row_number().over(W.partitionBy(*PAGE).orderBy("col", "y0")) - 1)
    fit = dots.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("nd")).join(heads.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("nh")), PAGE).where("nd = 5 * nh").select(*PAGE)
    ranked = dots.join(fit, PAGE).withColumn("q", F.floor((F.row_number().over(W.partitionBy(*PAGE).orderBy("col", "y0", "x0")) - 1) / 5).cast("int"))
    five = W.partitionBy(*PAGE, "q")
    side = ranked.withColumn("right", F.col("x0") >= F.min("x0").over(five) + 50)
    two = side.withColumn("_r", F.sum(F.col("right").cast("int")).over(five))
    order = F.when(F.col("_r") == 2, F.col("right").cast("int")).otherwise(0)
    placed = two.withColumn("letter", F.row_number().over(five.orderBy(order, "y0", "x0"))).select(*PAGE, "q", "letter", F.col("x1").alias("cx1"), F.col("y0").alias("cy0"))
    ln = lines.select(*PAGE, F.col("x0").alias("lx0"), F.col("y0").alias("ly0"), "text", F.monotonically_increasing_id().alias("lo"))
    near = (F.abs(F.col("ly0") - F.col("cy0")) < 8) & (F.col("lx0") > F.col("cx1") - 5) & (F.col("lx0") < F.col("cx1") + 250)
    hit = placed.join(ln, PAGE, "left").groupBy(*PAGE, "q", "letter").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(near, F.struct("lo", "text")))), lambda s: s["text"]), " ").alias("t"))
    shown = F.when((F.trim("t") == "") | F.col("t").startswith("xxxx"), "[Figura / Imagem]").otherwise(F.trim("t"))
    alts = hit.groupBy(*PAGE, "q").agg(F.transform(F.array_sort(F.collect_list(F.struct("letter", shown.alias("t")))), lambda s: s["t"]).alias("alternativas"))
    return alts.join(heads, [*PAGE, "q"]).select("doc_id", "co_posicao", "alternativas")
