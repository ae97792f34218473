"""Booklet files to questions: primitives, lines, tables, page texts, questions, in one plan of DataFrames.

Every step is keyed by document and page; a page's content stays in its group, and files are read in parallel, one task a
file and kind of primitive.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from itemforge.functions import question as Q
from itemforge.operators import layout, pagefold, segment, tablegrid
from itemforge.sources.pdf import PdfSource

#: Base lines that are one line, and the greatest gap inside one, in sizes.
SAME_LINE, LINE_GAP = 2.0, 2.5
COVER = 80


def primitives(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """Pages, spans, drawings or images of files; ``doc_id`` is the file's name, unreadable files give none."""
    spark.dataSource.register(PdfSource)
    found = spark.read.format("itemforge_pdf").option("kind", kind).load(",".join(paths))
    return found.where("error is null").withColumnRenamed("name", "doc_id").drop("error", "path", "ord")


def unreadable(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(name, error) of the files that could not be read."""
    spark.dataSource.register(PdfSource)
    return spark.read.format("itemforge_pdf").option("kind", "page").load(",".join(paths)).where("error is not null").select("name", "error")


def text_lines(spans: DataFrame) -> DataFrame:
    """(doc_id, page_no, x0, y0, x1, y1, text): spans on one base line without a wide gap between them."""
    reading = W.partitionBy("doc_id", "page_no").orderBy(F.bround(F.col("base") / SAME_LINE), "x0")
    before = F.lag(F.struct("base", "x1", "size")).over(reading)
    apart = before.isNull() | (F.abs(F.col("base") - before["base"]) > SAME_LINE) | (F.col("x0") - before["x1"] > LINE_GAP * F.col("size"))
    numbered = spans.withColumn("_b", apart.cast("int")).withColumn("_n", F.sum("_b").over(reading))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda s: s["text"]), " ")
    return numbered.groupBy("doc_id", "page_no", "_n").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), text.alias("text")).drop("_n")


def covers(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """(name, page_count, cover_text): text of the first page, of the first two where the first has little."""
    first = lines.where("page_no < 2").groupBy("doc_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "text"))), lambda s: s["text"]), "\n").alias("t"))
    both = first.groupBy("doc_id").agg(F.max(F.when(F.col("page_no") == 0, F.col("t"))).alias("a"), F.max(F.when(F.col("page_no") == 1, F.col("t"))).alias("b"))
    counted = pages.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("page_count")).join(both, "doc_id", "left")
    a = F.coalesce("a", F.lit(""))
    text = F.when((F.length(F.trim(a)) >= COVER) | F.col("b").isNull(), a).otherwise(F.concat_ws("\n", a, F.col("b")))
    return counted.select(F.col("doc_id").alias("name"), "page_count", text.alias("cover_text"))


def _markdown(rows: str, caption: str) -> Column:
    @F.pandas_udf("string")
    def show(r: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else Q.markdown([list(y) for y in x], t) for x, t in zip(r, c)])

    return show(rows, caption)


def extract(spark: SparkSession, paths: list[str], brand: str = Q.BRAND) -> tuple[DataFrame, DataFrame]:
    """(questions by ``REF_ARQUIVO_PDF``, booklets with covers) of booklet files.

    Tables that pass the gate stand in the texts as Markdown; other tables, pictures and drawings set the picture flag.
    """
    pages = primitives(spark, paths, "page").select("doc_id", "page_no", F.col("x1").alias("width"), F.col("y1").alias("height"))
    spans = primitives(spark, paths, "span").where("abs(dir_y) < 1e-6").select("doc_id", "page_no", "x0", "y0", "x1", "y1", "text", "size", "base", "font", "xs")
    drawings, images = primitives(spark, paths, "drawing"), primitives(spark, paths, "image")
    lines = text_lines(spans)
    words = tablegrid.page_words(spans)
    tables = tablegrid.structured_tables(tablegrid.detect_tables(words, drawings), words, drawings)
    accepted = tables.where(F.col("status") == tablegrid.OK)
    texts = pagefold.page_texts(pages, lines, lines, spans, drawings, accepted, brand)
    kept = segment.keep_pages(texts)
    docs = kept.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda s: s["text"]), "\n").alias("text"))
    pictures = layout.question_images(pages, lines, lines, drawings, images, tables, spans)
    heads = lines.withColumn("co_posicao", F.regexp_extract("text", layout.QUESTION, 1).try_cast("bigint")).where("co_posicao is not null and page_no >= 1")
    circles = layout.circle_alternatives(drawings, heads.select("doc_id", "page_no", "co_posicao", "x0", "y0"), lines, layout.page_columns(pages, lines)).dropDuplicates(["doc_id", "co_posicao"])
    shown = accepted.select("doc_id", "page_no", "tbl_no", _markdown("rows", "caption").alias("markdown"))
    found = segment.questions(docs, pictures, circles, shown, brand)
    return found.withColumnRenamed("doc_id", "REF_ARQUIVO_PDF"), covers(pages, lines)
