"""Question segmentation: documents -> numbered questions -> statements, alternatives and flags."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemforge.functions import question as Q
from itemforge.functions.scalar import PICTURE
from itemforge.operators.windows import language_variant

HEADER = r"(?iu)(?:^|\n)\s*QUEST[ÃA]O\s*(\d+)\s*"
_BODY = T.StructType([T.StructField("enunciado", T.StringType()), T.StructField("alternativas", T.ArrayType(T.StringType())), T.StructField("modo", T.StringType())])
#: A structured table inside a text, until it is written out: private-use signs around page and index.
MARKER = "\ue010{}:{}\ue011"
MARKER_PATTERN = r"\ue010(\d+):(\d+)\ue011"


def clean_page(text: Column, brand: str = Q.BRAND) -> Column:
    """Page text without what the page adds."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: Q.clean_page(t, brand), na_action="ignore")

    return run(text)


def sanitize(text: Column, brand: str = Q.BRAND) -> Column:
    """Statement text without residue, formulas marked."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: Q.sanitize(t, brand), na_action="ignore")

    return run(text)


def parse_body(text: Column, brand: str = Q.BRAND) -> Column:
    """Struct (enunciado, alternativas, modo) of a question's raw text; alternatives are null where none is found."""

    @F.pandas_udf(_BODY)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([Q.parse_body(None if pd.isna(t) else t, brand) for t in s], columns=_BODY.names)

    return run(text)


def keep_pages(pages: DataFrame) -> DataFrame:
    """Pages that can hold questions: no cover (page 0), no essay draft, and of pages without a question header not the last."""
    up = F.upper("text")
    has = F.coalesce(F.col("text").rlike(HEADER), F.lit(False))
    draft = up.contains("RASCUNHO") & (up.contains("REDAÇÃO") | up.contains("REDACAO") | up.contains("TRANSCREVA"))
    last = pages.groupBy("doc_id").agg(F.max("page_no").alias("_last"))
    return pages.join(last, "doc_id").where((F.col("page_no") >= 1) & (has | ~(F.coalesce(draft, F.lit(False)) | (F.col("page_no") == F.col("_last"))))).drop("_last")


def split_questions(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, split_no, co_posicao, corpo): text split at question headers; what precedes the first header drops.

    Stays in the JVM: bodies and captured numbers are two arrays of one length, exploded together.
    """
    cut = F.expr(f"slice(split(`{text}`, '{HEADER}'), 2, greatest(size(split(`{text}`, '{HEADER}')) - 1, 0))".replace("\\", "\\\\"))
    numbers = F.expr(f"regexp_extract_all(`{text}`, '{HEADER}', 1)".replace("\\", "\\\\"))
    zipped = F.arrays_zip(numbers.alias("n"), cut.alias("b"))
    return docs.where(F.col(text).isNotNull()).select(F.col(f"`{doc}`").alias("doc_id"), F.posexplode(zipped).alias("split_no", "z")).select(
        "doc_id", "split_no", F.col("z.n").try_cast("bigint").alias("co_posicao"), F.col("z.b").alias("corpo")
    )


def with_language(questions: DataFrame, block: int | None = None) -> DataFrame:
    """Adds ``tp_lingua``: a document holds two languages if questions 1 and 2 both come at least twice.

    ``block`` cuts documents too large for one task (see ``running_count``); booklets need none.
    """
    twice = questions.groupBy("doc_id").agg((F.count(F.when(F.col("co_posicao") == 1, 1)) >= 2).alias("_a"), (F.count(F.when(F.col("co_posicao") == 2, 1)) >= 2).alias("_b"))
    flagged = questions.join(twice.select("doc_id", (F.col("_a") & F.col("_b")).alias("_double")), "doc_id")
    return language_variant(flagged, "doc_id", "split_no", "co_posicao", "_double", block).drop("_double")


def mentions_image(text: Column) -> Column:
    """Whether a text points to a picture in so many words."""
    return F.coalesce(text.rlike(Q.IMAGE_PHRASES), F.lit(False))


def mentions_table(text: Column) -> Column:
    """Whether a text points to a table in so many words."""
    return F.coalesce(text.rlike(Q.TABLE_PHRASES), F.lit(False))


def flags(statement: Column, alternatives: Column, spatial: Column) -> tuple[Column, Column]:
    """(image flag, table flag): a table reference means a picture only if no table of the question was structured."""
    table = F.coalesce(statement.rlike(MARKER_PATTERN), F.lit(False)) | F.coalesce(F.exists(alternatives, lambda a: a.rlike(MARKER_PATTERN)), F.lit(False))
    image = F.coalesce(F.exists(alternatives, lambda a: a == PICTURE), F.lit(False)) | F.coalesce(spatial, F.lit(False)) | mentions_image(statement) | (mentions_table(statement) & ~table)
    return image.cast("int"), table.cast("int")


def questions(docs: DataFrame, images: DataFrame | None = None, circles: DataFrame | None = None, tables: DataFrame | None = None, brand: str = Q.BRAND) -> DataFrame:
    """Questions of whole documents (doc_id, text), unique by document, position and language (the last split wins).

    ``images``: doc_id, co_posicao, tp_lingua of questions with a picture on the page.  ``circles``: doc_id, co_posicao,
    alternativas drawn as circles, used where the text has none.  ``tables``: doc_id, page_no, tbl_no, markdown.
    """
    parsed = with_language(split_questions(docs)).withColumn("q", parse_body(F.col("corpo"), brand)).select("doc_id", "split_no", "co_posicao", "tp_lingua", "q.*")
    if circles is not None:
        c = circles.select("doc_id", "co_posicao", F.col("alternativas").alias("_c"))
        parsed = parsed.join(c, ["doc_id", "co_posicao"], "left")
        cutter = _with_circles(brand)
        parsed = parsed.withColumn("_x", F.when(F.col("alternativas").isNull() & F.col("_c").isNotNull(), cutter("enunciado", "_c")))
        parsed = parsed.withColumn("enunciado", F.coalesce("_x.enunciado", "enunciado")).withColumn("alternativas", F.coalesce("_x.alternativas", "alternativas")).drop("_c", "_x")
    if images is not None:
        m = images.select(F.col("doc_id").alias("_d"), F.col("co_posicao").alias("_p"), F.col("tp_lingua").alias("_l")).distinct().withColumn("_img", F.lit(True))
        on = (parsed.doc_id == m._d) & (parsed.co_posicao == m._p) & parsed.tp_lingua.eqNullSafe(m._l)
        parsed = parsed.join(m, on, "left").drop("_d", "_p", "_l")
    else:
        parsed = parsed.withColumn("_img", F.lit(False))

    @F.pandas_udf("string")
    def bare(s: pd.Series) -> pd.Series:
        return s.map(lambda t: Q.without_alternatives(t, brand), na_action="ignore")

    none = F.col("alternativas").isNull()
    whole = parsed.withColumn("enunciado", F.when(none, bare("enunciado")).otherwise(F.col("enunciado"))).withColumn("alternativas", F.coalesce("alternativas", F.array(*[F.lit(PICTURE)] * 5)))
    image, table = flags(F.col("enunciado"), F.col("alternativas"), F.col("_img"))
    last = F.max_by(F.struct("enunciado", "alternativas", image.alias("IN_ITEM_IMAGEM"), table.alias("IN_ITEM_TABELA"), "modo"), F.col("split_no"))
    out = whole.groupBy("doc_id", "co_posicao", "tp_lingua").agg(last.alias("r")).select("doc_id", "co_posicao", "tp_lingua", "r.*")
    out = out.select("doc_id", F.col("co_posicao").alias("CO_POSICAO"), F.col("tp_lingua").alias("TP_LINGUA"), F.col("enunciado").alias("DESC_ENUNCIADO"),
                     *[F.element_at("alternativas", k + 1).alias(f"DESC_ALTER_{x}") for k, x in enumerate(Q.LETTERS)], "IN_ITEM_IMAGEM", "IN_ITEM_TABELA", "modo")
    texts = ["DESC_ENUNCIADO", *[f"DESC_ALTER_{x}" for x in Q.LETTERS]]
    out = insert_tables(out, tables, texts) if tables is not None else out
    return out.select(*[F.replace(c, F.lit(Q.DOLLAR), F.lit("\\$")).alias(c) if c in texts else c for c in out.columns])


def _with_circles(brand: str):
    @F.pandas_udf(T.StructType(_BODY.fields[:2]))
    def run(statement: pd.Series, circles: pd.Series) -> pd.DataFrame:
        rows = []
        for s, c in zip(statement, circles):
            if c is None:
                rows.append((s, None))
                continue
            alts = list(c)
            if alts[0] and alts[0] != PICTURE:
                if found := Q.locate_formatted(s, alts):
                    s, alts = Q.sanitize(s[: found[0]], brand), [Q.format_alternative(x) for x in found[1]]
                elif (at := s.find(alts[0])) > 0:
                    s = Q.sanitize(s[:at], brand)
            rows.append((s, alts))
        return pd.DataFrame(rows, columns=["enunciado", "alternativas"])

    return run


def insert_tables(df: DataFrame, tables: DataFrame, columns: list[str]) -> DataFrame:
    """Markers of structured tables replaced by their Markdown, each on lines of its own; other texts stay."""
    key = F.concat_ws(":", F.col("page_no").cast("string"), F.col("tbl_no").cast("string"))
    maps = tables.groupBy(F.col("doc_id").alias("_d")).agg(F.map_from_entries(F.collect_list(F.struct(key.alias("k"), F.col("markdown").alias("v")))).alias("_m"))
    joined = df.join(maps, df.doc_id == maps._d, "left")
    for c in columns:
        parts = F.split(F.col(c), r"(?=\ue010)|(?<=\ue011)")
        shown = F.transform(parts, lambda p: F.when(p.startswith("\ue010"), F.concat(F.lit("\n"), F.coalesce(F.try_element_at(F.col("_m"), F.regexp_replace(p, "[\ue010\ue011]", "")), F.lit("")), F.lit("\n"))).otherwise(F.trim(p)))
        joined = joined.withColumn(c, F.when(F.col(c).contains("\ue010"), F.trim(F.regexp_replace(F.array_join(shown, ""), r"^\s+|\s+$", ""))).otherwise(F.col(c)))
    return joined.drop("_d", "_m")
