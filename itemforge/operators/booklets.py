"""Booklets: classification by name and cover, selection of one booklet a call, area and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemforge.functions import scalar as S

#: Words in names and covers.
NOT_EXAM = ("EDITAL", "MANUAL", "MATRIZ", "QUESTIONARIO", "QUESTIONÁRIO", "RELATORIO", "RELATÓRIO", "PROCEDIMENTOS", "ENTENDA", "GUIA", "RASCUNHO", "INSTRUCOES", "INSTRUÇÕES")
ADAPTED_NAMES = ("BRAILE", "LIBRAS", "AMPLIADA", "SUPERAMPLIADA", "DOSVOX", "NVDA", "DIGITAL")
ADAPTED_COVERS = ("SUPERAMPLIADA", "AMPLIADA", "LIBRAS", "BRAILE")
DAY_2_NAMES = ("DIA_2", "DIA2", "DOM", "D2", "CAD_05", "CAD_06", "CAD_07", "CAD_08", "CADERNO5", "CADERNO6", "CADERNO7", "CADERNO8")
DAY_1_NAMES = ("DIA_1", "DIA1", "SAB", "D1", "CAD_01", "CAD_02", "CAD_03", "CAD_04", "CADERNO1", "CADERNO2", "CADERNO3", "CADERNO4")
SECOND_CALL_PARENTS = ("SEGUNDA APLICAÇÃO", "SEGUNDA APLICACAO", "P2")
SECOND_CALL_NAMES = ("_P2_", "_2.PDF", "_2.PDF.PDF", "PPL", "2_APLICAÇÃO", "2_APLICACAO", "_P2.PDF", "_P2_CAD")
COLOUR_ORDER = ("AMARELO", "AMARELA", "AZUL", "CINZA", "ROSA", "BRANCO", "BRANCA", "VERDE")
COVER_PHRASES = ("CADERNO {}", "CADERNO DE QUESTÕES É {}", "CADERNO DE QUESTOES E {}", "CAPA DO SEU CADERNO DE QUESTÕES É {}", "CAPA DO SEU CADERNO DE QUESTOES E {}", "– {}", "- {}")
LEAST_PAGES = 10
_DAY = r"{}\s*[º°ªoO]?\s*DIA"
_SECOND = r"2\s*[ªº°aA]?\s*APLICA[ÇC][ÃA]O"


def booklet_class(name: Column, parent: Column, pages: Column, cover: Column) -> Column:
    """Struct (app, color, day, cover_day, pages) of a valid booklet, null of anything else; null covers are empty."""
    n, p, c = F.upper(name), F.upper(F.coalesce(parent, F.lit(""))), F.upper(F.coalesce(cover, F.lit("")))
    reader = n.contains("LEDOR") & ~(n.contains("2011") & n.contains("CAD_06"))
    valid = ~S.contains_any(n, NOT_EXAM) & ~S.contains_any(n, ADAPTED_NAMES) & ~reader & (pages >= LEAST_PAGES) & ~S.contains_any(c, ADAPTED_COVERS)
    on1, on2 = c.rlike(_DAY.format(1)), c.rlike(_DAY.format(2))
    day = S.first_rule(
        (S.contains_any(n, DAY_2_NAMES), 2), (S.contains_any(n, DAY_1_NAMES), 1), (on2 | c.contains("DOMINGO"), 2),
        (on1 | S.contains_any(c, ("SÁBADO", "SABADO")), 1), (c.contains("MATEMÁTICA"), 2), (S.contains_any(c, ("CIÊNCIAS HUMANAS", "LINGUAGENS")), 1),
    )
    second = S.contains_any(p, SECOND_CALL_PARENTS) | S.contains_any(n, SECOND_CALL_NAMES) | c.rlike(_SECOND) | S.contains_any(c, ("REAPLICAÇÃO", "REAPLICACAO", "PPL"))
    color = F.coalesce(
        S.first_rule(*[(n.contains(x), S.COLOURS[x]) for x in COLOUR_ORDER]),
        S.first_rule(*[(S.contains_any(c, [f.format(x) for f in COVER_PHRASES]), S.COLOURS[x]) for x in COLOUR_ORDER]),
    )
    cover_day = F.when(on1 & ~on2, 1).when(on2 & ~on1, 2)
    app = F.when(second, "P2").otherwise("P1")
    whole = F.struct(app.alias("app"), color.alias("color"), day.alias("day"), cover_day.alias("cover_day"), pages.alias("pages"))
    return F.when(valid & day.isNotNull() & color.isNotNull(), whole)


def fingerprint(booklets: DataFrame) -> DataFrame:
    """(name, parent_name, app, color, day, cover_day, pages) of the valid booklets."""
    k = booklet_class(F.col("name"), F.col("parent_name"), F.col("page_count"), F.col("cover_text"))
    return booklets.select("name", "parent_name", k.alias("k")).where("k is not null").select("name", "parent_name", "k.*")


def file_key(name: Column) -> Column:
    """Key under which a file is looked up: lower case, one ``.pdf``."""
    return F.lower(F.regexp_replace(name, r"(?i)(\.pdf)+$", ".pdf"))


def select_booklets(codes: DataFrame, prints: DataFrame, catalogue: DataFrame, listing: DataFrame) -> DataFrame:
    """One code and booklet for each year, area and call (at most two a year and area).

    ``codes``: ANO_APLICACAO, SG_AREA, CO_PROVA, TX_COR, TP_APLICACAO, row_no.  ``prints``: ano, name, app, color, day.
    ``catalogue``: ano, app, day, color, filename.  ``listing``: ano, name (all files).  A booklet comes from the prints
    of the same day, call and colour, the one named by the catalogue first, then by name; else from the catalogue if the
    file is listed.  Among codes with a booklet the colour's rank decides, then the row order; colours without a rank
    come last.  Codes without a booklet drop, which is no error.
    """
    wanted = codes.withColumn("day", S.exam_day(F.col("SG_AREA"), F.col("ANO_APLICACAO")))
    cat = catalogue.select(F.col("ano").alias("_ca"), F.col("app").alias("_cp"), F.col("day").alias("_cd"), F.col("color").alias("_cc"), "filename")
    wanted = wanted.join(cat, (wanted.ANO_APLICACAO == cat._ca) & (wanted.TP_APLICACAO == cat._cp) & (wanted.day == cat._cd) & (wanted.TX_COR == cat._cc), "left").drop("_ca", "_cp", "_cd", "_cc")
    pr = prints.select(F.col("ano").alias("_pa"), F.col("app").alias("_pp"), F.col("day").alias("_pd"), F.col("color").alias("_pc"), F.col("name").alias("_pn"))
    hits = wanted.join(pr, (wanted.ANO_APLICACAO == pr._pa) & (wanted.TP_APLICACAO == pr._pp) & (wanted.day == pr._pd) & (wanted.TX_COR == pr._pc), "left")
    best = F.min_by("_pn", F.struct((F.lower("_pn") != F.lower("filename")).alias("a"), F.col("_pn").alias("b")))
    keys = ["ANO_APLICACAO", "SG_AREA", "CO_PROVA", "TX_COR", "TP_APLICACAO", "row_no", "day", "filename"]
    chosen = hits.groupBy(*keys).agg(F.coalesce(best, F.min("_pn")).alias("_print"))
    files = listing.select(F.col("ano").alias("_fa"), file_key(F.col("name")).alias("_fk"), "name").groupBy("_fa", "_fk").agg(F.min("name").alias("_listed"))
    found = chosen.join(files, (chosen.ANO_APLICACAO == files._fa) & (file_key(F.col("filename")) == files._fk), "left")
    found = found.withColumn("REF_ARQUIVO_PDF", F.coalesce("_print", "_listed")).where("REF_ARQUIVO_PDF is not null")
    rank = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in S.PREFERRED_COLOURS]), F.col("TX_COR")), F.lit(0))
    rank = F.when(rank == 0, 99).otherwise(rank)
    order = F.struct(rank.alias("a"), F.col("row_no").alias("b"), F.col("CO_PROVA").alias("c"))
    row = F.struct("CO_PROVA", "TX_COR", "day", "REF_ARQUIVO_PDF")
    return found.groupBy("ANO_APLICACAO", "SG_AREA", "TP_APLICACAO").agg(F.min_by(row, order).alias("r")).select("ANO_APLICACAO", "SG_AREA", "TP_APLICACAO", "r.*")


def direct_map(items: DataFrame, catalogue: DataFrame, listing: DataFrame, year: int) -> DataFrame:
    """(CO_PROVA, name): booklet of every code that is not adapted, straight from its colour, first call only."""
    base = items.select(S.safe_long(F.col("CO_PROVA")).alias("CO_PROVA"), "SG_AREA", "TX_COR", *(["IN_ITEM_ADAPTADO"] if "IN_ITEM_ADAPTADO" in items.columns else []))
    groups = base.select("CO_PROVA", "SG_AREA", "TX_COR").dropna().distinct()
    if "IN_ITEM_ADAPTADO" in base.columns:
        groups = groups.join(base.where("IN_ITEM_ADAPTADO = 1").select("CO_PROVA").distinct(), "CO_PROVA", "left_anti")
    keyed = groups.select("CO_PROVA", S.exam_day(F.col("SG_AREA"), F.lit(year)).alias("day"), S.colour(F.col("TX_COR")).alias("color"))
    named = keyed.join(catalogue.where((F.col("ano") == year) & (F.col("app") == "P1")).select("day", "color", "filename"), ["day", "color"])
    files = listing.where(F.col("ano") == year).select(file_key(F.col("name")).alias("k"), "name").groupBy("k").agg(F.min("name").alias("name"))
    return named.join(files, file_key(F.col("filename")) == F.col("k")).select("CO_PROVA", "name").distinct()
