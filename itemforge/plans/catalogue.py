"""Registered core queries and their SQL twins: each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.functions import question as Q
from itemforge.functions import scalar as S
from itemforge.operators import booklets, dictionary, lookup, publish, segment, summaries
from itemforge.operators import windows as O
from itemforge.session import table, texts

#: Order values of a block of a hot partition.
BLOCK = 1 << 16
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL twin if SQL can say the same."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- filters, casts, unions, summaries --------------------------------------------------------------------------------


@query("""SELECT SG_AREA, count(*) AS n_rows, count(nullif(DESC_ENUNCIADO, '')) AS n_matched,
               round(100.0 * count(nullif(DESC_ENUNCIADO, '')) / count(*), 4) AS pct FROM pipeline GROUP BY SG_AREA""")
def match_rate(spark, sf):
    """Items, items with a statement and the rate, by area."""
    return summaries.match_rate(table(spark, sf, "pipeline", "SG_AREA", "DESC_ENUNCIADO"), ["SG_AREA"], F.col("DESC_ENUNCIADO"))


@query("""SELECT count(*) AS n_rows, count(nullif(DESC_ENUNCIADO, '')) AS n_matched,
               round(100.0 * count(nullif(DESC_ENUNCIADO, '')) / count(*), 4) AS pct FROM pipeline""")
def overall_rate(spark, sf):
    """The match rate over all items."""
    df = table(spark, sf, "pipeline", "DESC_ENUNCIADO").withColumn("k", F.lit(1))
    return summaries.match_rate(df, ["k"], F.col("DESC_ENUNCIADO")).drop("k")


@query("""SELECT CO_ITEM, CO_POSICAO, CO_HABILIDADE, CAST(NULL AS BIGINT) AS fracao,
               CASE WHEN NU_PARAM_A = floor(NU_PARAM_A) THEN CAST(NU_PARAM_A AS BIGINT) END AS param_inteiro, NU_PARAM_B FROM itens_prova""")
def typed_scan(spark, sf):
    """Texts to numbers: whole numbers with a decimal point convert, fractions and words become null."""
    df = table(spark, sf, "itens_prova", "CO_ITEM", "CO_POSICAO", "CO_HABILIDADE", "NU_PARAM_A", "NU_PARAM_B")
    dotted = F.concat(F.col("CO_HABILIDADE").cast("string"), F.lit(".0"))
    return df.select("CO_ITEM", "CO_POSICAO", S.safe_long(dotted).alias("CO_HABILIDADE"), S.safe_long(F.lit("2.5")).alias("fracao"),
                     S.safe_long(F.col("NU_PARAM_A").cast("string")).alias("param_inteiro"), S.safe_double(F.col("NU_PARAM_B").cast("string")).alias("NU_PARAM_B"))


@query("SELECT SG_AREA, CO_PROVA, count(*) AS n FROM itens_prova WHERE SG_AREA IN ('CN', 'MT') GROUP BY ALL")
def area_filter(spark, sf):
    """Items of two areas by code; the filter reaches the scan."""
    return table(spark, sf, "itens_prova", "SG_AREA", "CO_PROVA").where(F.col("SG_AREA").isin("CN", "MT")).groupBy("SG_AREA", "CO_PROVA").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CO_PROVA, CO_ITEM, CO_POSICAO, NU_LOTE FROM itens_prova WHERE CO_PROVA IN (SELECT CO_PROVA FROM exam_codes WHERE TP_APLICACAO = 'P2')")
def code_membership(spark, sf):
    """Item rows of second-call codes."""
    codes = table(spark, sf, "exam_codes", "CO_PROVA", "TP_APLICACAO").where("TP_APLICACAO = 'P2'")
    return lookup.membership(table(spark, sf, "itens_prova", "CO_PROVA", "CO_ITEM", "CO_POSICAO", "NU_LOTE"), lookup.small(codes), "CO_PROVA")


@query("SELECT ID_LINHA, CO_PROVA, CO_HABILIDADE FROM pipeline WHERE CO_HABILIDADE IS NOT NULL AND IN_ITEM_ABAN = 0 AND IN_ITEM_IMAGEM = 0")
def text_subset(spark, sf):
    """Usable items without a picture."""
    df = table(spark, sf, "pipeline", "ID_LINHA", "CO_PROVA", "CO_HABILIDADE", "IN_ITEM_ABAN", "IN_ITEM_IMAGEM")
    return publish.text_subset(df).select("ID_LINHA", "CO_PROVA", "CO_HABILIDADE")


@query("""SELECT count(*) AS n_itens, count(*) FILTER (TP_APLICACAO = 'REGULAR') AS n_regular, count(*) FILTER (TP_APLICACAO = 'REAPLICACAO_PPL') AS n_reaplicacao,
               count(*) FILTER (IN_ITEM_IMAGEM = 1) AS n_imagem, count(*) FILTER (IN_ITEM_TABELA = 1) AS n_tabela FROM pipeline""")
def consolidated_counts(spark, sf):
    """Totals of the bank."""
    return publish.consolidated_counts(table(spark, sf, "pipeline", "TP_APLICACAO", "IN_ITEM_IMAGEM", "IN_ITEM_TABELA"))


@query("""SELECT ANO_APLICACAO, count(*) AS n_itens, count(nullif(DESC_ENUNCIADO, '')) AS n_com_texto, round(100.0 * count(nullif(DESC_ENUNCIADO, '')) / count(*), 4) AS pct,
               CAST(coalesce(sum(IN_ITEM_IMAGEM), 0) AS BIGINT) AS n_imagem, coalesce(string_agg(DISTINCT SG_AREA, ',' ORDER BY SG_AREA), '') AS areas FROM pipeline GROUP BY ANO_APLICACAO""")
def year_summary(spark, sf):
    """One line a year."""
    return publish.year_summary(table(spark, sf, "pipeline", "ANO_APLICACAO", "DESC_ENUNCIADO", "IN_ITEM_IMAGEM", "SG_AREA"))


@query("""SELECT CAST(NULL AS BIGINT) AS ANO_APLICACAO, CO_POSICAO, SG_AREA, CO_ITEM, CO_PROVA, NU_LOTE FROM itens_prova
          UNION ALL SELECT ANO_APLICACAO, CO_POSICAO, SG_AREA, CO_ITEM, CO_PROVA, NU_LOTE FROM pipeline""")
def union_with_missing_columns(spark, sf):
    """Two frames united by name, columns in canonical order."""
    a = table(spark, sf, "itens_prova", "NU_LOTE", "CO_PROVA", "CO_ITEM", "SG_AREA", "CO_POSICAO")
    b = table(spark, sf, "pipeline", "CO_ITEM", "NU_LOTE", "ANO_APLICACAO", "CO_PROVA", "CO_POSICAO", "SG_AREA")
    return publish.canonical_order(publish.union_all([a, b]))


@query("""WITH k AS (SELECT upper(trim(TX_COR)) AS c FROM itens_prova)
          SELECT CASE WHEN c IN ('AZUL', 'ROSA', 'CINZA', 'VERDE', 'AMARELO', 'BRANCO') THEN c WHEN c = 'AMARELA' THEN 'AMARELO' WHEN c = 'BRANCA' THEN 'BRANCO' END AS cor,
                 count(*) AS n FROM k GROUP BY ALL""")
def colour_normalise(spark, sf):
    """Unified colours and their frequency."""
    return table(spark, sf, "itens_prova", "TX_COR").groupBy(S.colour(F.col("TX_COR")).alias("cor")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CO_PROVA, CASE WHEN SG_AREA = 'CH' THEN 1 WHEN SG_AREA = 'MT' THEN 2 WHEN (SG_AREA = 'CN') = (ANO_APLICACAO <= 2016) THEN 1 ELSE 2 END AS dia,
               CASE WHEN TP_APLICACAO = 'P2' THEN 'P2' ELSE 'P1' END AS chamada FROM exam_codes""")
def day_rule(spark, sf):
    """Day and call of every exam code."""
    df = table(spark, sf, "exam_codes", "CO_PROVA", "SG_AREA", "ANO_APLICACAO", "TP_APLICACAO")
    return df.select("CO_PROVA", S.exam_day(F.col("SG_AREA"), F.col("ANO_APLICACAO")).alias("dia"), S.application_key(F.col("TP_APLICACAO")).alias("chamada"))


# --- lookups ----------------------------------------------------------------------------------------------------------

_QUESTIONS = """q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CO_PROVA, CO_POSICAO, TP_LINGUA ORDER BY DT_CARGA DESC NULLS LAST, ID_LINHA DESC) AS r
                 FROM pipeline) WHERE r = 1 AND CO_PROVA IS NOT NULL AND CO_POSICAO IS NOT NULL)"""


def _questions(spark, sf):
    df = table(spark, sf, "pipeline", "CO_PROVA", "CO_POSICAO", "TP_LINGUA", "DT_CARGA", "ID_LINHA").where("CO_PROVA is not null and CO_POSICAO is not null")
    return O.last_writer(df, ["CO_PROVA", "CO_POSICAO", "TP_LINGUA"], ["DT_CARGA", "ID_LINHA"])


@query(f"""WITH {_QUESTIONS}
    SELECT i.CO_PROVA, i.CO_POSICAO, i.TP_LINGUA, i.CO_ITEM, i.NU_LOTE,
           CASE WHEN i.TP_LINGUA IS NULL THEN coalesce(n.ID_LINHA, z.ID_LINHA) ELSE coalesce(e.ID_LINHA, n.ID_LINHA) END AS ID_LINHA,
           CAST(CASE WHEN i.TP_LINGUA IS NULL THEN coalesce(n.ID_LINHA, z.ID_LINHA) ELSE coalesce(e.ID_LINHA, n.ID_LINHA) END IS NOT NULL AS INTEGER) AS encontrado
    FROM itens_prova i LEFT JOIN q e ON e.CO_PROVA = i.CO_PROVA AND e.CO_POSICAO = i.CO_POSICAO AND e.TP_LINGUA = i.TP_LINGUA
    LEFT JOIN q n ON n.CO_PROVA = i.CO_PROVA AND n.CO_POSICAO = i.CO_POSICAO AND n.TP_LINGUA IS NULL
    LEFT JOIN q z ON z.CO_PROVA = i.CO_PROVA AND z.CO_POSICAO = i.CO_POSICAO AND z.TP_LINGUA = 0""")
def lookup_with_fallback(spark, sf):
    """Items with the question of their position and language, with the language fallback."""
    items = table(spark, sf, "itens_prova", "CO_PROVA", "CO_POSICAO", "TP_LINGUA", "CO_ITEM", "NU_LOTE")
    return lookup.language_fallback(items, _questions(spark, sf).select("CO_PROVA", "CO_POSICAO", "TP_LINGUA", "ID_LINHA"), "CO_PROVA", "CO_POSICAO", "TP_LINGUA", ["ID_LINHA"])


@query("""WITH has AS (SELECT DISTINCT CO_PROVA, CO_POSICAO FROM pipeline WHERE CO_POSICAO IS NOT NULL)
    SELECT i.CO_PROVA, i.CO_ITEM, i.CO_POSICAO, i.NU_LOTE, CASE WHEN i.CO_POSICAO <= 45 AND h.CO_POSICAO IS NULL THEN coalesce(a.CO_POSICAO, b.CO_POSICAO, c.CO_POSICAO, i.CO_POSICAO) ELSE i.CO_POSICAO END AS posicao_efetiva
    FROM itens_prova i LEFT JOIN has h ON h.CO_PROVA = i.CO_PROVA AND h.CO_POSICAO = i.CO_POSICAO LEFT JOIN has a ON a.CO_PROVA = i.CO_PROVA AND a.CO_POSICAO = i.CO_POSICAO + 135
    LEFT JOIN has b ON b.CO_PROVA = i.CO_PROVA AND b.CO_POSICAO = i.CO_POSICAO + 90 LEFT JOIN has c ON c.CO_PROVA = i.CO_PROVA AND c.CO_POSICAO = i.CO_POSICAO + 45""")
def offset_resolution(spark, sf):
    """Positions of items shifted to what their booklet holds."""
    items = table(spark, sf, "itens_prova", "CO_PROVA", "CO_ITEM", "CO_POSICAO", "NU_LOTE")
    return lookup.resolve_position(items, table(spark, sf, "pipeline", "CO_PROVA", "CO_POSICAO"), "CO_PROVA", "CO_POSICAO")


@query("""SELECT DISTINCT CO_PROVA FROM itens_prova WHERE CO_PROVA IS NOT NULL AND CO_PROVA NOT IN (SELECT CO_PROVA FROM exam_codes WHERE CO_PROVA IS NOT NULL AND TP_APLICACAO = 'P1')""")
def code_reconcile_anti(spark, sf):
    """Codes that items use and the first call's list lacks."""
    return lookup.absent(table(spark, sf, "itens_prova", "CO_PROVA"), table(spark, sf, "exam_codes", "CO_PROVA", "TP_APLICACAO").where("TP_APLICACAO = 'P1'"), "CO_PROVA")


@query("SELECT DISTINCT CO_PROVA, SG_AREA, TX_COR FROM itens_prova WHERE CO_PROVA IS NOT NULL AND SG_AREA IS NOT NULL AND TX_COR IS NOT NULL")
def distinct_triples(spark, sf):
    """Distinct codes with area and colour."""
    return table(spark, sf, "itens_prova", "CO_PROVA", "SG_AREA", "TX_COR").dropna().distinct()


@query("""SELECT * EXCLUDE r FROM (SELECT ANO_APLICACAO, SG_AREA, TP_APLICACAO, CO_PROVA, TX_COR, row_number() OVER (PARTITION BY ANO_APLICACAO, SG_AREA, TP_APLICACAO
          ORDER BY CASE TX_COR WHEN 'AMARELO' THEN 1 WHEN 'AZUL' THEN 2 WHEN 'CINZA' THEN 3 WHEN 'ROSA' THEN 4 WHEN 'VERDE' THEN 5 WHEN 'BRANCO' THEN 6 ELSE 9 END, CO_PROVA) AS r FROM exam_codes) WHERE r = 1""")
def preferred_pick(spark, sf):
    """One code for each year, area and call by colour preference; a colour without a rank only if no other is there."""
    rank = F.array_position(F.array(*[F.lit(c) for c in S.PREFERRED_COLOURS]), F.col("TX_COR"))
    df = table(spark, sf, "exam_codes", "ANO_APLICACAO", "SG_AREA", "TP_APLICACAO", "CO_PROVA", "TX_COR")
    return O.preferred_row(df, ["ANO_APLICACAO", "SG_AREA", "TP_APLICACAO"], [F.when(rank > 0, rank).otherwise(99), F.col("CO_PROVA")])


@query("SELECT ANO_APLICACAO, SG_AREA, CO_PROVA, TX_COR, TP_APLICACAO, trim(DESC_ORIGINAL) AS DESC_ORIGINAL FROM exam_codes")
def dictionary_block(spark, sf):
    """Exam codes read from the raw cells of the dictionaries."""
    return dictionary.exam_codes(table(spark, sf, "dict_cells")).drop("sheet_no", "row_no")


@query("""WITH b AS (SELECT name, parent_name, page_count, upper(name) AS n, upper(coalesce(parent_name, '')) AS p, upper(coalesce(cover_text, '')) AS c FROM booklets),
    d AS (SELECT *, CASE WHEN regexp_matches(n, 'DIA_2|DIA2|DOM|D2|CAD_05|CAD_06|CAD_07|CAD_08|CADERNO5|CADERNO6|CADERNO7|CADERNO8') THEN 2
                         WHEN regexp_matches(n, 'DIA_1|DIA1|SAB|D1|CAD_01|CAD_02|CAD_03|CAD_04|CADERNO1|CADERNO2|CADERNO3|CADERNO4') THEN 1
                         WHEN regexp_matches(c, '2\\s*[º°ªoO]?\\s*DIA') OR contains(c, 'DOMINGO') THEN 2 WHEN regexp_matches(c, '1\\s*[º°ªoO]?\\s*DIA|SÁBADO|SABADO') THEN 1
                         WHEN contains(c, 'MATEMÁTICA') THEN 2 WHEN regexp_matches(c, 'CIÊNCIAS HUMANAS|LINGUAGENS') THEN 1 END AS day,
          CASE WHEN regexp_matches(p, 'SEGUNDA APLICAÇÃO|SEGUNDA APLICACAO|P2') OR regexp_matches(n, '_P2_|_2\\.PDF|PPL|2_APLICAÇÃO|2_APLICACAO|_P2\\.PDF|_P2_CAD')
                 OR regexp_matches(c, '2\\s*[ªº°aA]?\\s*APLICA[ÇC][ÃA]O|REAPLICAÇÃO|REAPLICACAO|PPL') THEN 'P2' ELSE 'P1' END AS app,
          regexp_matches(c, '1\\s*[º°ªoO]?\\s*DIA') AS one, regexp_matches(c, '2\\s*[º°ªoO]?\\s*DIA') AS two,
          coalesce(CASE WHEN contains(n, 'AMARELO') OR contains(n, 'AMARELA') THEN 'AMARELO' WHEN contains(n, 'AZUL') THEN 'AZUL' WHEN contains(n, 'CINZA') THEN 'CINZA' WHEN contains(n, 'ROSA') THEN 'ROSA'
                        WHEN contains(n, 'BRANCO') OR contains(n, 'BRANCA') THEN 'BRANCO' WHEN contains(n, 'VERDE') THEN 'VERDE' END,
                   CASE WHEN regexp_matches(c, '(CADERNO|QUESTÕES É|QUESTOES E|–|-) (AMARELO|AMARELA)') THEN 'AMARELO' WHEN regexp_matches(c, '(CADERNO|QUESTÕES É|QUESTOES E|–|-) AZUL') THEN 'AZUL'
                        WHEN regexp_matches(c, '(CADERNO|QUESTÕES É|QUESTOES E|–|-) CINZA') THEN 'CINZA' WHEN regexp_matches(c, '(CADERNO|QUESTÕES É|QUESTOES E|–|-) ROSA') THEN 'ROSA'
                        WHEN regexp_matches(c, '(CADERNO|QUESTÕES É|QUESTOES E|–|-) (BRANCO|BRANCA)') THEN 'BRANCO' WHEN regexp_matches(c, '(CADERNO|QUESTÕES É|QUESTOES E|–|-) VERDE') THEN 'VERDE' END) AS color FROM b)
    SELECT name, parent_name, app, color, day, CASE WHEN one AND NOT two THEN 1 WHEN two AND NOT one THEN 2 END AS cover_day, page_count AS pages FROM d
    WHERE NOT regexp_matches(n, 'EDITAL|MANUAL|MATRIZ|QUESTIONARIO|QUESTIONÁRIO|RELATORIO|RELATÓRIO|PROCEDIMENTOS|ENTENDA|GUIA|RASCUNHO|INSTRUCOES|INSTRUÇÕES|BRAILE|LIBRAS|AMPLIADA|DOSVOX|NVDA|DIGITAL')
      AND NOT (contains(n, 'LEDOR') AND NOT (contains(n, '2011') AND contains(n, 'CAD_06'))) AND page_count >= 10 AND NOT regexp_matches(c, 'AMPLIADA|LIBRAS|BRAILE') AND day IS NOT NULL AND color IS NOT NULL""")
def priority_case_classify(spark, sf):
    """Booklets classified by name, folder and cover."""
    return booklets.fingerprint(table(spark, sf, "booklets"))


@query()
def selected_booklets(spark, sf):
    """One booklet for each year, area and call; the test bank has no file catalogue, so prints alone decide."""
    listed = table(spark, sf, "booklets").withColumn("ano", F.regexp_extract("name", r"(20\d{2})", 1).try_cast("bigint"))
    prints = booklets.fingerprint(listed).withColumn("ano", F.regexp_extract("name", r"(20\d{2})", 1).try_cast("bigint"))
    none = spark.createDataFrame([], "ano bigint, app string, day int, color string, filename string")
    codes = dictionary.exam_codes(table(spark, sf, "dict_cells"))
    return booklets.select_booklets(codes, prints, none, listed)


# --- ordered operators ------------------------------------------------------------------------------------------------


@query("""WITH n AS (SELECT ID_LINHA, CO_PROVA, CO_POSICAO % 7 AS num FROM pipeline WHERE CO_PROVA IS NOT NULL),
    c AS (SELECT *, sum(CASE WHEN num = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY CO_PROVA ORDER BY ID_LINHA ROWS UNBOUNDED PRECEDING) AS ones,
                 count(*) FILTER (num = 1) OVER (PARTITION BY CO_PROVA) >= 2 AND count(*) FILTER (num = 2) OVER (PARTITION BY CO_PROVA) >= 2 AS twice FROM n)
    SELECT ID_LINHA, CO_PROVA, num, CASE WHEN twice AND num <= 5 THEN CAST(CASE WHEN ones = 1 THEN 0.0 ELSE 1.0 END AS DOUBLE) END AS tp_lingua FROM c""")
def running_variant_flag(spark, sf):
    """Language of repeated question numbers by a running counter."""
    df = table(spark, sf, "pipeline", "ID_LINHA", "CO_PROVA", "CO_POSICAO").where("CO_PROVA is not null")
    n = df.select("ID_LINHA", F.col("CO_PROVA").alias("doc_id"), F.col("ID_LINHA").alias("split_no"), (F.col("CO_POSICAO") % 7).alias("co_posicao"))
    return segment.with_language(n, BLOCK).select("ID_LINHA", F.col("doc_id").alias("CO_PROVA"), F.col("co_posicao").alias("num"), F.col("tp_lingua").cast("double").alias("tp_lingua"))


@query("""SELECT ID_LINHA, NU_LOTE, last_value(CO_HABILIDADE IGNORE NULLS) OVER (PARTITION BY NU_LOTE ORDER BY ID_LINHA ROWS UNBOUNDED PRECEDING) AS atual FROM pipeline""")
def carry_forward(spark, sf):
    """The last known skill of each load."""
    df = table(spark, sf, "pipeline", "ID_LINHA", "NU_LOTE", "CO_HABILIDADE")
    return O.carry_forward(df, ["NU_LOTE"], ["ID_LINHA"], "CO_HABILIDADE", "atual", BLOCK).drop("CO_HABILIDADE")


@query("""SELECT event_id, user_id, coalesce(lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), max(value) OVER (PARTITION BY user_id)) AS fim FROM events""")
def next_boundary(spark, sf):
    """Start of the next row, the group's furthest end for the last."""
    df = table(spark, sf, "events", "event_id", "user_id", "ts", "value")
    return O.next_boundary(df, ["user_id"], ["ts", "event_id"], "value", "value", "fim").select("event_id", "user_id", "fim")


@query("""SELECT CO_PROVA, CO_POSICAO, ID_LINHA FROM (SELECT *, row_number() OVER (PARTITION BY CO_PROVA, CO_POSICAO ORDER BY DT_CARGA DESC NULLS LAST, ID_LINHA DESC) AS r FROM pipeline) WHERE r = 1""")
def last_writer_wins(spark, sf):
    """The last load of each position."""
    df = table(spark, sf, "pipeline", "CO_PROVA", "CO_POSICAO", "ID_LINHA", "DT_CARGA")
    return O.last_writer(df, ["CO_PROVA", "CO_POSICAO"], ["DT_CARGA", "ID_LINHA"]).drop("DT_CARGA")


@query("""WITH m AS (SELECT user_id, value, CASE WHEN value - lag(value) OVER w > 0.5 THEN 1 ELSE 0 END AS k FROM events WHERE value IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY value)),
    g AS (SELECT *, sum(k) OVER (PARTITION BY user_id ORDER BY value RANGE UNBOUNDED PRECEDING) AS cluster FROM m)
    SELECT user_id, CAST(cluster AS BIGINT) AS cluster, round(avg(value), 6) AS centre, count(*) AS n FROM g GROUP BY ALL""")
def gap_cluster(spark, sf):
    """Values clustered by their gaps."""
    return O.gap_clusters(table(spark, sf, "events", "user_id", "value"), ["user_id"], "value", 0.5).withColumn("centre", F.round("centre", 6))


_SPAN = "SELECT user_id, value AS a, value + 0.4 + event_id % 7 AS b FROM events WHERE value IS NOT NULL"


def _spans(spark, sf):
    return table(spark, sf, "events", "user_id", "event_id", "value").where("value is not null").select("user_id", F.col("value").alias("a"), (F.col("value") + 0.4 + F.col("event_id") % 7).alias("b"))


_ISLANDS = f"""s AS ({_SPAN}), m AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM s),
    g AS (SELECT *, sum(CASE WHEN a > far + {{gap}} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS isl FROM m),
    i AS (SELECT user_id, isl, min(a) AS x0, max(b) AS x1 FROM g GROUP BY ALL)"""


@query(f"WITH {_ISLANDS.format(gap=3.0)} SELECT user_id, round(sum(x1 - x0), 6) AS covered, count(*) AS n_islands FROM i GROUP BY user_id")
def interval_union_coverage(spark, sf):
    """Length that merged intervals cover."""
    return O.covered_length(_spans(spark, sf), ["user_id"], "a", "b", 3.0).withColumn("covered", F.round("covered", 6))


@query(f"""WITH {_ISLANDS.format(gap=0.0)}, n AS (SELECT user_id, x1 AS g0, lead(x0) OVER (PARTITION BY user_id ORDER BY x0) AS g1 FROM i)
    SELECT user_id, round(g0, 6) AS g0, round(g1, 6) AS g1, round((g0 + g1) / 2, 6) AS x FROM n WHERE g1 - g0 >= 5
      AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = n.user_id AND e.event_type = 'purchase' AND e.value + 6 BETWEEN n.g0 AND n.g1)""")
def projection_boundaries(spark, sf):
    """Wide gaps without a rule in them."""
    rules = table(spark, sf, "events", "user_id", "event_type", "value").where("event_type = 'purchase'").select("user_id", (F.col("value") + 6).alias("rx"))
    out = O.projection_boundaries(_spans(spark, sf), ["user_id"], "a", "b", rules, "rx")
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in ("g0", "g1", "x")])


_REGIONS = "r AS (SELECT user_id, event_id AS ord, value AS lo, value + 10 AS hi FROM events WHERE event_type = 'signup' AND value IS NOT NULL)"


def _interval_sides(spark, sf):
    e = table(spark, sf, "events", "user_id", "event_id", "event_type", "value").where("value is not null")
    regions = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("ord"), F.col("value").alias("lo"), (F.col("value") + 10).alias("hi"))
    return e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("oid"), F.col("value").alias("at")), regions


@query(f"""WITH {_REGIONS}, o AS (SELECT user_id, event_id AS oid, value AS at FROM events WHERE event_type = 'error' AND value IS NOT NULL)
    SELECT user_id, oid, ord, lo, hi FROM (SELECT o.user_id, o.oid, r.ord, r.lo, r.hi, row_number() OVER (PARTITION BY o.oid ORDER BY r.ord) AS k
      FROM o JOIN r ON o.user_id = r.user_id AND o.at >= r.lo - 2 AND o.at <= r.hi + 2) WHERE k = 1""")
def first_match_interval(spark, sf):
    """Each object with the first region that holds it."""
    objects, regions = _interval_sides(spark, sf)
    return lookup.first_interval(objects, regions, ["user_id"], "at", "lo", "hi", "ord", 2.0, "oid")


@query(f"""WITH {_REGIONS} SELECT e.user_id, e.event_id AS oid, e.value AS at, r.ord, r.lo, r.hi FROM events e JOIN r ON e.user_id = r.user_id AND e.value >= r.lo AND e.value <= r.hi + 1 WHERE e.event_type = 'error'""")
def all_match_interval(spark, sf):
    """Every region that holds an object."""
    objects, regions = _interval_sides(spark, sf)
    return lookup.all_intervals(objects, regions, ["user_id"], "at", "lo", "hi", 1.0)


@query("""WITH e AS (SELECT c_nationkey, c_acctbal AS lo, c_acctbal + (c_custkey % 5) AS hi, c_custkey FROM customer)
    SELECT a.c_nationkey, a.lo, a.hi, count(*) AS apoio FROM e a JOIN e b ON a.c_nationkey = b.c_nationkey AND abs(a.lo - b.lo) <= 3 AND abs(a.hi - b.hi) <= 3 GROUP BY a.c_custkey, a.c_nationkey, a.lo, a.hi HAVING count(*) >= 2""")
def near_equal_pairs(spark, sf):
    """Extents that another extent supports."""
    df = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal").select("c_nationkey", F.col("c_acctbal").alias("lo"), (F.col("c_acctbal") + F.col("c_custkey") % 5).alias("hi"))
    return lookup.supported_extents(df, ["c_nationkey"], "lo", "hi")


@query("SELECT user_id, list_sort(list(value))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median, count(*) AS total FROM events WHERE value IS NOT NULL GROUP BY user_id")
def upper_median(spark, sf):
    """The element at half of the count."""
    return O.upper_median(table(spark, sf, "events", "user_id", "value"), ["user_id"], "value")


@query("""WITH w AS (SELECT lang, ano AS v, sum(n_chars) AS n FROM documents WHERE n_chars >= 1 AND ano IS NOT NULL GROUP BY ALL),
    c AS (SELECT *, sum(n) OVER (PARTITION BY lang ORDER BY v) AS cum, sum(n) OVER (PARTITION BY lang) AS t FROM w)
    SELECT lang, min(v) AS median, CAST(any_value(t) AS BIGINT) AS total FROM c WHERE cum > floor(t / 2) GROUP BY lang""")
def weighted_upper_median(spark, sf):
    """The median weighted by text length."""
    return O.upper_median(table(spark, sf, "documents", "lang", "ano", "n_chars"), ["lang"], "ano", "n_chars")


@query("""SELECT CAST((l_extendedprice > 10000)::INT + (l_extendedprice > 25000)::INT + (l_extendedprice > 60000)::INT AS INTEGER) AS banda, count(*) AS n FROM lineitem GROUP BY ALL""")
def bucket_by_boundaries(spark, sf):
    """Values counted by the boundaries below them."""
    return table(spark, sf, "lineitem", "l_extendedprice").groupBy(S.buckets_above(F.col("l_extendedprice"), [10000, 25000, 60000]).alias("banda")).agg(F.count(F.lit(1)).alias("n"))


@query()
def anchor_line_fold(spark, sf):
    """Events of a user, in pages of 500 keys, grouped into lines around an anchor."""
    df = table(spark, sf, "events", "event_id", "user_id", "value").withColumn("h", F.lit(2.0) + F.col("event_id") % 3).withColumn("pagina", F.floor(F.col("event_id") / 500))
    return O.anchored_lines(df, ["user_id", "pagina"], "value", "h", "event_id").withColumn("texts", F.array_join("texts", " "))


# --- text -------------------------------------------------------------------------------------------------------------

_BOOK = """b AS (SELECT CO_PROVA || '/' || (ID_LINHA // 500) AS doc_id, CO_POSICAO, ID_LINHA FROM pipeline WHERE CO_PROVA IS NOT NULL AND CO_POSICAO IS NOT NULL AND DESC_ENUNCIADO <> '')"""


def _books(spark, sf):
    """Booklets as documents: the records of a code in blocks of 500 keys, so that no document grows with the data."""
    df = table(spark, sf, "pipeline", "CO_PROVA", "CO_POSICAO", "ID_LINHA", "DESC_ENUNCIADO").where("CO_PROVA is not null and CO_POSICAO is not null and DESC_ENUNCIADO <> ''")
    head = F.concat(F.lit("\nQUESTÃO "), F.col("CO_POSICAO").cast("string"), F.lit("\n"), F.regexp_replace("DESC_ENUNCIADO", r"(?U)^\s+", ""))
    doc = F.concat_ws("/", F.col("CO_PROVA").cast("string"), F.floor(F.col("ID_LINHA") / 500).cast("string"))
    return O.ordered_text(df.select(doc.alias("doc_id"), "ID_LINHA", head.alias("q")), ["doc_id"], ["ID_LINHA"], "q", "")


@query(f"""WITH {_BOOK} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ID_LINHA) - 1 AS INTEGER) AS split_no, CO_POSICAO AS co_posicao FROM b""")
def split_by_header(spark, sf):
    """Whole booklets put together and split again at their question headers."""
    return segment.split_questions(_books(spark, sf)).select("doc_id", "split_no", "co_posicao")


@query()
def question_bodies(spark, sf):
    """Statement, alternatives and mode of the test items' raw texts."""
    q = segment.parse_body(F.col("text"))
    return table(spark, sf, "eval_items", "item_id", "text").select("item_id", q.alias("q")).select("item_id", "q.enunciado", F.array_join("q.alternativas", " | ").alias("alternativas"), "q.modo")


@query()
def booklet_questions(spark, sf):
    """Questions of whole booklets with language, alternatives and flags."""
    return segment.questions(_books(spark, sf))


@query()
def page_clean(spark, sf):
    """Documents cleaned as pages are."""
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", segment.clean_page(F.col("text")).alias("text"))


@query()
def statement_sanitise(spark, sf):
    """Statements without residue, formulas marked."""
    return texts(spark, sf, "pipeline", "ID_LINHA", "DESC_ENUNCIADO").select("ID_LINHA", segment.sanitize(F.col("DESC_ENUNCIADO")).alias("texto"))


@query("""SELECT doc_id, trim(regexp_replace(text, '[\\s\\x{0B}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g'), ' ') AS texto FROM documents""")
def whitespace_collapse(spark, sf):
    """White space runs of every kind made one blank."""
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", S.collapse(F.col("text")).alias("texto"))


@query("""SELECT r_name, '| ' || 'nation' || ' | ' || 'key' || ' |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_nationkey) AS markdown
          FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def table_markdown(spark, sf):
    """Nations of each region as a Markdown table."""
    @F.pandas_udf("string")
    def show(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: Q.markdown([["nation", "key"], *[[c["n"], c["k"]] for c in r]]))

    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    cells = F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("o"), F.col("n_name").alias("n"), F.col("n_nationkey").cast("string").alias("k"))))
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).groupBy("r_name").agg(cells.alias("c")).select("r_name", show("c").alias("markdown"))


@query("""WITH v AS (SELECT ano, sheet_no, a FROM dict_cells, (SELECT unnest(['CN', 'CH', 'LC', 'MT']) AS a) WHERE contains(upper(value), 'CO_PROVA_' || a))
          SELECT ano, a AS sg_area, min(sheet_no) AS sheet_no FROM v GROUP BY ALL""")
def first_sheet_wins(spark, sf):
    """The first sheet of each year that holds an area's block of codes."""
    rows = dictionary.code_rows(table(spark, sf, "dict_cells"))
    return rows.groupBy("ano", "sg_area").agg(F.min("sheet_no").alias("sheet_no"))


@query("""WITH w AS (SELECT ID_LINHA, DESC_ALTER_A AS t, regexp_extract_all(regexp_replace(DESC_ALTER_A, '[_^]\\{[^{}]*\\}|\\\\[a-zA-Z]+', ' ', 'g'), '[A-Za-zÀ-ÿ]{3,}') AS w FROM pipeline WHERE DESC_ALTER_A IS NOT NULL AND NOT contains(DESC_ALTER_A, chr(92))),
               k AS (SELECT ID_LINHA, list_filter(w, lambda x: NOT list_contains(['log', 'sen', 'cos', 'tg', 'rad', 'det', 'max', 'min', 'lim', 'mod'], lower(x))) AS w FROM w)
          SELECT ID_LINHA, len(w) > 1 OR len(list_filter(w, lambda x: length(x) > 3)) > 0 AS prosa FROM k""")
def prose_test(spark, sf):
    """Whether an alternative without commands is prose."""

    @F.pandas_udf("boolean")
    def test(s: pd.Series) -> pd.Series:
        return s.map(Q.has_prose)

    df = table(spark, sf, "pipeline", "ID_LINHA", "DESC_ALTER_A").where("DESC_ALTER_A is not null and not contains(DESC_ALTER_A, '\\\\')")
    return df.select("ID_LINHA", test("DESC_ALTER_A").alias("prosa"))
