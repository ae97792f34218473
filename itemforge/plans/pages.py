"""Registered queries of page operators: over primitives derived from whole tables, and over small tables of labelled cases.

A case table states inputs and the results that are right for them; its SQL twin is the table of the results.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from itemforge.functions import formulas, question as Q, residue
from itemforge.functions import geometry as G
from itemforge.functions.scalar import PICTURE
from itemforge.operators import booklets, layout, pagefold, segment, tablegrid
from itemforge.plans.catalogue import query
from itemforge.session import table

DRAWING = "doc_id string, page_no int, x0 double, y0 double, x1 double, y1 double, type string, fill array<double>, color array<double>, width double, dashes string, items " + G.DRAWING_ITEMS


def _value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _values(columns: str, rows: list[tuple]) -> str:
    """The rows as an SQL table."""
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_value, r)) + ')' for r in rows)}) t({columns})"


# --- text -------------------------------------------------------------------------------------------------------------

#: (case, operator, input, result)
TEXT_CASES = (
    ("glued", "split_glued", r"\pih e \left", r"\pi h e \left"), ("glued known", "split_glued", r"\frac{1}{2} \cdotm", r"\frac{1}{2} \cdot m"), ("glued longest", "split_glued", r"\timescos \leqx", r"\times cos \leq x"),
    ("prose", "has_prose", r"O valor de \frac{A}{B} é", "sim"), ("formula", "has_prose", r"IMC = \frac{massa}{altura}", "não"), ("two short words", "has_prose", "cor que", "sim"), ("functions", "has_prose", "log sen cos", "não"),
    ("indexed", "mark_inline", "M_{1} e 10^{3} m^{2}", "$M_{1}$ e $10^{3}$ $m^{2}$"), ("relation", "mark_inline", "p_{1} < p_{2} < p_{3} sempre", "$p_{1} < p_{2} < p_{3}$ sempre"), ("chain", "mark_inline", "A_{1}B_{1}", "$A_{1}B_{1}$"),
    ("argument", "mark_inline", r"\frac{m_{1}}{d^{2}}", r"\frac{m_{1}}{d^{2}}"), ("long base", "mark_inline", "valor^{2} e x^y", "valor^{2} e x^y"),
    ("in prose", "mark_in_prose", r"metade, ou \frac{1}{2}, de k.m^{\frac{2}{3}}", r"metade, ou $\frac{1}{2}$, de $k.m^{\frac{2}{3}}$"), ("outermost", "mark_in_prose", r"vale \frac{\sqrt{3}}{3} metros", r"vale $\frac{\sqrt{3}}{3}$ metros"),
    ("mixed number", "mark_in_prose", r"leva 2 \frac{1}{2} horas", r"leva $2 \frac{1}{2}$ horas"), ("matrix", "mark_in_prose", r"a matriz \begin{pmatrix} 1 & 2 \end{pmatrix} dada", r"a matriz $\begin{pmatrix} 1 & 2 \end{pmatrix}$ dada"),
    ("whole", "format_alternative", r"\frac{1}{2}.", r"$\frac{1}{2}$"), ("dot inside", "format_alternative", "$x.$", "$x$"), ("loose dot", "format_alternative", r"3x \cdot", "3x"), ("plain", "format_alternative", "um metro", "um metro"),
    ("prose with formula", "format_alternative", "tipo I, pois p_{1} < p_{2}.", "tipo I, pois $p_{1} < p_{2}$."), ("ellipsis", "format_alternative", "x^2..", "$x^2..$"), ("picture", "format_alternative", PICTURE, PICTURE),
    ("cell", "format_cell", "π r", r"$\pi r$"), ("cell prose", "format_cell", "área m^{2}", "área $m^{2}$"), ("cell ordinal", "format_cell", "1ª < x", "1ª < x"), ("cell relation", "format_cell", "x < 3", "$x < 3$"),
    ("year alone", "clean_alternative", "2013", "2013"), ("year behind", "clean_alternative", "custo 2013", "custo"), ("nothing", "clean_alternative", "", PICTURE), ("foot", "clean_alternative", "verde claro MT - 2º dia | Caderno 7", "verde claro"),
    ("foot page", "clean_alternative", "um metro • AZUL PÁGINA 25", "um metro"), ("draft", "clean_alternative", "três RASCUNHO DA REDAÇÃO", "três"), ("watermark", "clean_alternative", "quatro SIMULADO2024SIMULADO2024", "quatro"),
    ("next text", "clean_alternative", "cinco Texto comum para as questões 12 e 13", "cinco"),
    ("page", "clean_page", "SIMULADO2024SIMULADO2024\n*020325AZ2*\nQUESTÃO\n14\nTexto de¿nido\n7\nMT - 2º dia\nCADERNO 7 - AZUL - PÁGINA 25", "QUESTÃO 14\nTexto definido"),
    ("heads", "clean_page", "CIÊNCIAS HUMANAS E SUAS TECNOLOGIAS\nQuestões de 1 a 45\n2º DIA\nRASCUN\nNUNHO\nSIMULADO 2014\n^{x} fica\n\nlinha", "fica\nlinha"),
    ("codes", "clean_page", "2010\n*azul25dom23*\na\x0fb\x11c", "a,b.c"), ("sentence stays", "clean_page", "O dia do caderno azul\nMatemática é bela", "O dia do caderno azul\nMatemática é bela"),
    ("statement", "sanitize", "Seja log x ( ) e M_{1}  ^{ } ok *AZ12*", r"Seja \log x e $M_{1}$ ok"), ("statement year", "sanitize", "Quanto vale? SIMULADO 2015", "Quanto vale?"), ("statement draft", "sanitize", "Leia.\nfim Rascunho daqui", "Leia. fim"),
    ("span", "span_text", "\U0001d70b\U0001d70b r", r"\pi r"), ("money", "span_text", "R$ 5 e US$ 6", "R$ 5 e US$ 6"),
    ("letters at the end", "without_alternatives", "Veja o gráfico A B C D E", "Veja o gráfico"),
)
_OPERATORS = {n: getattr(formulas, n, None) or getattr(Q, n, None) or getattr(residue, n) for n in {c[1] for c in TEXT_CASES}}


@query(_values("caso, texto", [(f"{op}: {case}", out) for case, op, _, out in TEXT_CASES]))
def text_cases(spark, sf):
    """Cleaning and formula operators over labelled texts."""

    @F.pandas_udf("string")
    def run(op: pd.Series, text: pd.Series) -> pd.Series:
        show = lambda v: ("sim" if v else "não") if isinstance(v, bool) else v
        return pd.Series([show(_OPERATORS[o](t)) for o, t in zip(op, text)])

    df = spark.createDataFrame([(f"{op}: {case}", op, text) for case, op, text, _ in TEXT_CASES], "caso string, op string, t string")
    return df.select("caso", run("op", "t").alias("texto"))


#: (case, body, mode, statement, alternatives)
BODY_CASES = (
    ("lines", "Enunciado A\nA primeira\nfrase\nA) um\nB) dois\ncontinua\nC) três\nD) quatro\nE) cinco 2019", "linha", "Enunciado A A primeira frase", "um | dois continua | três | quatro | cinco"),
    ("tightest", "A x\nB x\nC x\n\n\nD x\nE x\nA um\nB dois\nC três\nD quatro\nE cinco", "linha", "A x B x C x D x E x", "um | dois | três | quatro | cinco"),
    ("letters", "Veja a figura A D B E C", "letras", "Veja a figura", " | ".join([PICTURE] * 5)), ("letters second call", "Veja a figura A B C D E 2ª aplicação", "letras", "Veja a figura", " | ".join([PICTURE] * 5)),
    ("inline", "Qual é? A um B dois C três D quatro E cinco", "em_linha", "Qual é?", "um | dois | três | quatro | cinco"), ("inline columns", "Qual é? A um D quatro B dois E cinco C três", "em_linha", "Qual é?", "um | dois | três | quatro | cinco"),
    ("inline pictures", "Qual é? A B dois C três D quatro E cinco", "em_linha", "Qual é?", " | ".join([PICTURE] * 5)),
    ("none", "Sem alternativas", "nenhum", "Sem alternativas", None), ("empty", "", "nenhum", "", None), ("null", None, "nenhum", None, None),
)


@query(_values("caso, modo, enunciado, alternativas", [(c, m, s, a) for c, _, m, s, a in BODY_CASES]))
def body_cases(spark, sf):
    """Bodies of questions: led lines, letters alone, markers inside lines, none."""
    q = segment.parse_body(F.col("t"))
    df = spark.createDataFrame([(c, t) for c, t, *_ in BODY_CASES], "caso string, t string")
    return df.select("caso", q.alias("q")).select("caso", "q.modo", "q.enunciado", F.array_join("q.alternativas", " | ").alias("alternativas"))


_PHRASE = """CASE ID_LINHA % 6 WHEN 0 THEN ', conforme a figura' WHEN 1 THEN ', como mostra o gráfico' WHEN 2 THEN ' e no mapa a seguir' WHEN 3 THEN ', na tabela abaixo' WHEN 4 THEN ' com dados do quadro' ELSE '' END"""


@query(f"""WITH t AS (SELECT ID_LINHA, DESC_ENUNCIADO || {_PHRASE} AS t FROM pipeline)
    SELECT ID_LINHA, coalesce(regexp_matches(t, '(?i)\\b(?:indicad[ao]s?\\s+na\\s+figura|conforme\\s+(?:a\\s+)?figura|como\\s+(?:mostra|ilustra|se\\s+v[eê])\\s+a\\s+figura|como\\s+na\\s+figura|ilustrad[ao]\\s+na\\s+figura|apresentad[ao]\\s+na\\s+figura|mostrad[ao]\\s+na\\s+figura|representad[ao]\\s+na\\s+figura|observada?\\s+na\\s+figura|destacad[ao]s?\\s+na\\s+figura|reproduzid[ao]\\s+na\\s+figura|esboçad[ao]\\s+na\\s+figura|v[eê]-se\\s+na\\s+figura|o\\s+gr[aá]fico\\s+(?:a\\s+seguir|abaixo|apresenta|mostra|indica|ilustra|representa)|no\\s+gr[aá]fico\\s+(?:a\\s+seguir|abaixo)|os\\s+gr[aá]ficos\\s+(?:a\\s+seguir|abaixo|apresentam|mostram)|conforme\\s+o\\s+gr[aá]fico|como\\s+(?:mostra|ilustra)\\s+o\\s+gr[aá]fico|no\\s+esquema\\s+(?:a\\s+seguir|abaixo)|conforme\\s+o\\s+esquema|como\\s+mostra\\s+o\\s+esquema|indicad[ao]s?\\s+no\\s+esquema|no\\s+mapa\\s+(?:a\\s+seguir|abaixo)|indicad[ao]s?\\s+no\\s+mapa)\\b'), false) AS imagem,
           coalesce(regexp_matches(t, '(?i)\\b(?:a\\s+tabela\\s+(?:a\\s+seguir|abaixo|apresenta|mostra|indica|ilustra|representa)|na\\s+tabela\\s+(?:a\\s+seguir|abaixo)|as\\s+tabelas\\s+(?:a\\s+seguir|abaixo|apresentam|mostram)|conforme\\s+a\\s+tabela|como\\s+(?:mostra|ilustra)\\s+a\\s+tabela|dados\\s+da\\s+tabela|informad[ao]s?\\s+na\\s+tabela|observad[ao]s?\\s+na\\s+tabela|o\\s+quadro\\s+(?:a\\s+seguir|abaixo|apresenta|mostra|indica|ilustra|representa)|no\\s+quadro\\s+(?:a\\s+seguir|abaixo)|os\\s+quadros\\s+(?:a\\s+seguir|abaixo|apresentam|mostram)|conforme\\s+o\\s+quadro|como\\s+(?:mostra|ilustra)\\s+o\\s+quadro|dados\\s+do\\s+quadro|informad[ao]s?\\s+no\\s+quadro|observad[ao]s?\\s+no\\s+quadro)\\b'), false) AS tabela FROM t""")
def keyword_flags(spark, sf):
    """Statements, some with a reference put behind them, by the phrases that point to pictures and tables."""
    t = table(spark, sf, "pipeline", "ID_LINHA", "DESC_ENUNCIADO").select("ID_LINHA", F.concat("DESC_ENUNCIADO", F.expr(_PHRASE)).alias("t"))
    return t.select("ID_LINHA", segment.mentions_image(F.col("t")).alias("imagem"), segment.mentions_table(F.col("t")).alias("tabela"))


# --- primitives from tables -------------------------------------------------------------------------------------------

_BOX = "CAST(l_suppkey % 10 AS VARCHAR) AS doc_id, CAST(month(l_shipdate) AS INTEGER) AS page_no, 2.0 * (l_partkey % 97) AS x0, 2.0 * (l_orderkey % 89) AS y0, 2.0 * (l_partkey % 97) + 70.0 * l_linenumber AS x1, 2.0 * (l_orderkey % 89) + 9.0 AS y1"


def _boxes(spark, sf):
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
    x0, y0 = 2.0 * (F.col("l_partkey") % 97), 2.0 * (F.col("l_orderkey") % 89)
    return li.select(
        (F.col("l_suppkey") % 10).cast("string").alias("doc_id"), F.month("l_shipdate").alias("page_no"), x0.alias("x0"), y0.alias("y0"), (x0 + 70.0 * F.col("l_linenumber")).alias("x1"), (y0 + 9.0).alias("y1"), *li.columns
    )


def _pages(spark, sf):
    return _boxes(spark, sf).select("doc_id", "page_no").distinct().select("doc_id", "page_no", F.lit(560.0).alias("width"), F.lit(200.0).alias("height"))


@query(f"""WITH l AS (SELECT {_BOX}, l_linenumber, 2.0 * (l_partkey % 41) + 0.5 AS px, 2.0 * (l_orderkey % 11) + 1.0 AS py FROM lineitem),
    b AS (SELECT DISTINCT doc_id, page_no, round_even(px / 2, 0)::INTEGER AS kx0, round_even(py / 2, 0)::INTEGER AS ky0, round_even((px + 9) / 2, 0)::INTEGER AS kx1, round_even((py + 7) / 2, 0)::INTEGER AS ky1 FROM l WHERE l_linenumber = 1),
    p AS (SELECT doc_id, count(DISTINCT page_no) AS n FROM l GROUP BY 1), c AS (SELECT doc_id, kx0, ky0, kx1, ky1, count(*) AS n FROM b GROUP BY ALL)
    SELECT c.doc_id, kx0, ky0, kx1, ky1 FROM c JOIN p USING (doc_id) WHERE c.n >= greatest(3.0, 0.3 * (p.n - 1))""")
def repeated_element(spark, sf):
    """Places that recur on many pages of a document."""
    px, py = 2.0 * (F.col("l_partkey") % 41) + 0.5, 2.0 * (F.col("l_orderkey") % 11) + 1.0
    marks = _boxes(spark, sf).where("l_linenumber = 1").withColumns({"x0": px, "y0": py, "x1": px + 9, "y1": py + 7})
    return layout.decoration(marks, _pages(spark, sf)).select("doc_id", *[F.col(f"k.{c}").alias(f"k{c}") for c in ("x0", "y0", "x1", "y1")])


@query(f"""WITH b AS (SELECT {_BOX}, l_returnflag FROM lineitem), p AS (SELECT DISTINCT doc_id, page_no FROM b),
    w AS (SELECT doc_id, page_no, count(*) AS n FROM b WHERE x0 < 240 AND x1 > 320 AND y0 > 50 AND y1 < 740 AND x1 - x0 > 280 GROUP BY ALL),
    f AS (SELECT doc_id, page_no, min(y0) AS y FROM b WHERE l_returnflag = 'R' AND y0 >= 170 GROUP BY ALL)
    SELECT doc_id, page_no, 280.0 AS mid, coalesce(n, 0) >= 2 AS single, greatest(737.0, coalesce(y - 1, 737.0)) AS bottom FROM p LEFT JOIN w USING (doc_id, page_no) LEFT JOIN f USING (doc_id, page_no)""")
def crossing_layout(spark, sf):
    """Columns of pages by the blocks that cross the middle, and the foot of pages."""
    boxes, pages = _boxes(spark, sf), _pages(spark, sf)
    lines = boxes.select("doc_id", "page_no", "y0", F.when(F.col("l_returnflag") == "R", "MT - 1º DIA | PÁGINA 7").otherwise("texto").alias("text"))
    return layout.page_columns(pages, boxes).join(layout.page_bottom(pages, lines), layout.PAGE)


@query(f"""WITH b AS (SELECT {_BOX}, CAST(l_orderkey % 500 AS BIGINT) AS co, l_returnflag FROM lineitem),
    g AS (SELECT doc_id, co, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS c, max(x1) - min(x0) AS w, max(y1) - min(y0) AS h FROM b GROUP BY ALL)
    SELECT doc_id, co AS co_posicao FROM g WHERE (c >= 6 AND w >= 25 AND h >= 10) OR (n >= 20 AND w >= 50 AND h >= 50)""")
def envelope_having(spark, sf):
    """Regions whose drawings form a figure together."""
    held = _boxes(spark, sf).withColumn("co_posicao", (F.col("l_orderkey") % 500).cast("bigint")).withColumn("ord", F.col("co_posicao")).withColumn("tp_lingua", F.lit(None).cast("double"))
    curve = F.struct(F.when(F.col("l_returnflag") == "R", "c").otherwise("l").alias("cmd"))
    return layout.clusters(held.withColumn("items", F.array(curve))).select("doc_id", "co_posicao")


@query("""SELECT l_orderkey, ltrim(string_agg(CASE WHEN k % 3 = 0 THEN '^{' || l_linenumber || '}' ELSE ' ' || l_linenumber END, '' ORDER BY k)) AS texto
          FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS k FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) GROUP BY l_orderkey""")
def script_tokens(spark, sf):
    """Lines of small and large pieces, small ones above the base line as superscripts."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber").distinct()
    grouped = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("k"))

    @F.pandas_udf("string")
    def line(k: pd.Series) -> pd.Series:
        piece = lambda i, n: pagefold.Piece(20.0 * i, 0.0, 20.0 * i + 12, 10.0, str(n), 6.0 if i % 3 == 0 else 10.0, 4.0 if i % 3 == 0 else 8.0)
        return k.map(lambda ns: pagefold.scripts([piece(i, n) for i, n in enumerate(ns, 1)]))

    return grouped.select("l_orderkey", line("k").alias("texto"))


@query("""WITH t AS (SELECT s_nationkey, -1 AS o, 'fornecedor' AS a, 'chave' AS b FROM supplier UNION ALL SELECT s_nationkey, s_suppkey, s_name, CAST(s_suppkey AS VARCHAR) FROM supplier)
    SELECT CAST(s_nationkey AS VARCHAR) AS doc_id, 'OK' AS status, string_agg(a || ';' || b, '/' ORDER BY o) AS linhas
    FROM (SELECT DISTINCT * FROM t WHERE s_nationkey IS NOT NULL) GROUP BY s_nationkey""")
def structured_rows(spark, sf):
    """Suppliers of each nation set as a ruled page table, found again from its strokes and words."""
    s = table(spark, sf, "supplier", "s_nationkey", "s_suppkey", "s_name").where("s_nationkey is not null").distinct()
    named = s.groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("r"))
    rows = named.select(F.col("s_nationkey").cast("string").alias("doc_id"), F.posexplode(F.concat(F.array(F.struct(F.lit(0).cast("bigint").alias("s_suppkey"), F.lit("fornecedor").alias("s_name"))), F.col("r"))).alias("i", "c"))
    top, cell = 20.0 * F.col("i"), lambda x, t: F.struct(F.lit(x).alias("x0"), t.alias("text"))
    cells = F.array(cell(5.0, F.col("c.s_name")), cell(260.0, F.when(F.col("i") == 0, "chave").otherwise(F.col("c.s_suppkey").cast("string"))))
    words = rows.select("doc_id", F.lit(1).alias("page_no"), (top + 5).alias("y0"), F.explode(cells).alias("w")).select(
        "doc_id", "page_no", F.col("w.x0").alias("x0"), "y0", (F.col("w.x0") + 5.0 * F.length("w.text")).alias("x1"), (F.col("y0") + 10).alias("y1"), F.col("w.text").alias("text"), F.lit(10.0).alias("size"), (F.col("y0") + 8).alias("base"), F.lit("F").alias("font")
    )
    edges = rows.select("doc_id", F.explode(F.array(top, top + 20.0)).alias("y")).distinct()
    point = lambda x: F.struct(F.lit(x).alias("x"), F.col("y").alias("y"))
    item = F.struct(F.lit("l").alias("cmd"), F.array(point(0.0), point(320.0)).alias("pts"))
    strokes = edges.select("doc_id", F.lit(1).alias("page_no"), F.lit(0.0).alias("x0"), F.col("y").alias("y0"), F.lit(320.0).alias("x1"), F.col("y").alias("y1"), F.lit("s").alias("type"), F.lit(None).cast("array<double>").alias("fill"), F.array(item).alias("items"))
    found = tablegrid.structured_tables(tablegrid.detect_tables(words, strokes), words, strokes)
    return found.select("doc_id", "status", F.array_join(F.transform("rows", lambda r: F.array_join(r, ";")), "/").alias("linhas"))


# --- cases of pages ---------------------------------------------------------------------------------------------------


def _seg(cmd: str, *pts) -> tuple:
    return cmd, [(float(x), float(y)) for x, y in pts]


def _draw(x0, y0, x1, y1, items, fill=None, color=(0.0, 0.0, 0.0), width=1.0, dashes="") -> tuple:
    return float(x0), float(y0), float(x1), float(y1), "s", fill, list(color), width, dashes, items


_CURVE = _seg("c", (0, 0), (1, 1), (2, 2), (3, 3))
#: (case, drawing, figure, answer ring, noise, glyph, circle, root sign)
DRAWING_CASES = (
    ("curve", _draw(100, 100, 130, 130, [_CURVE]), True, False, False, False, False, False), ("box", _draw(100, 100, 180, 160, [_seg("re", (100, 100), (180, 160))]), True, False, False, False, False, False),
    ("table rule", _draw(100, 100, 240, 100.5, [_seg("l", (100, 100), (240, 100))]), False, False, True, False, False, False), ("slanted", _draw(100, 100, 140, 140, [_seg("l", (100, 100), (140, 140))]), True, False, False, False, False, False),
    ("dashed", _draw(100, 100, 150, 100.2, [_seg("l", (100, 100), (150, 100))], dashes="[3 3] 0"), True, False, True, False, False, False), ("page frame", _draw(30, 45, 560, 700, [_CURVE]), False, False, False, False, False, False),
    ("foot", _draw(100, 740, 130, 760, [_CURVE]), False, False, True, False, False, False), ("ring", _draw(100, 100, 115, 115, [_CURVE] * 4, None, (0.0, 0.6, 0.2), 2.0), True, True, False, False, False, False),
    ("dot", _draw(100, 100, 104, 104, [_CURVE]), False, False, True, False, False, False), ("glyph", _draw(100, 100, 105, 108, [_CURVE] * 5, [0.0]), False, False, False, True, False, False),
    ("circle", _draw(100, 100, 106.9, 106.9, [_CURVE] * 4, [0.1]), False, False, False, True, True, False),
    ("root", _draw(100, 100, 106, 112, [_seg("l", (100, 108), (102, 112)), _seg("l", (102, 112), (106, 100)), _seg("l", (106, 100), (105, 100))], [0.0]), False, False, False, False, False, True),
    ("quad", _draw(100, 100, 110, 110, [_seg("qu", (100, 100), (110, 105), (110, 110), (100, 105))]), True, False, False, False, False, False), ("no items", _draw(100, 100, 130, 130, []), False, False, False, False, False, False),
)


@query(_values("caso, figura, anel, ruido, glifo, circulo, raiz", [(c, *r) for c, _, *r in DRAWING_CASES]))
def drawing_kinds(spark, sf):
    """What drawings are."""
    df = spark.createDataFrame([(c, 1, *d) for c, d, *_ in DRAWING_CASES], DRAWING)
    low = F.lit(745.0)
    return df.select(F.col("doc_id").alias("caso"), G.vector_figure(low).alias("figura"), G.answer_ring().alias("anel"), G.cluster_noise(low).alias("ruido"), G.outlined_glyph().alias("glifo"), G.answer_circle().alias("circulo"), G.radical_sign().alias("raiz"))


def _p(x0, y0, x1, y1, text, size=10.0, base=None, font="") -> tuple:
    return float(x0), float(y0), float(x1), float(y1), text, float(size), float(base if base is not None else y1 - 2), font


#: (case, spans, bars, text)
FOLD_CASES = (
    ("script and fraction", [_p(100, 100, 106, 110, "x"), _p(112, 100, 118, 110, "="), _p(122, 92, 128, 102, "a"), _p(122, 107, 128, 117, "b"), _p(106, 97, 109, 103, "2", 6, 103)], [(120, 130, 104)], r"$x^{2} = \frac{a}{b}$"),
    ("root", [_p(100, 100, 106, 112, "√", 10, 110), _p(108, 102, 114, 112, "3", 10, 110)], [(106.5, 116, 101)], r"$\sqrt{3}$"),
    ("ordinal", [_p(100, 100, 110, 110, "12"), _p(110, 98, 113, 104, "a", 6, 103)], [(110, 114, 105)], "12ª"),
    ("no fraction of words", [_p(100, 92, 130, 102, "total"), _p(100, 107, 130, 117, "itens")], [(100, 130, 104)], "total\nitens"),
    ("underscore bar", [_p(122, 92, 128, 102, "a"), _p(119, 96, 131, 106, "___", 10, 103), _p(122, 107, 128, 117, "b")], [], r"$\frac{a}{b}$"),
    ("matrix", [_p(100, 100, 104, 140, "(", 30, 138), _p(108, 102, 114, 112, "1"), _p(120, 102, 126, 112, "2"), _p(108, 126, 114, 136, "3"), _p(120, 126, 126, 136, "4"), _p(130, 100, 134, 140, ")", 30, 138)], [], r"$\begin{pmatrix} 1 & 2 \\ 3 & 4 \end{pmatrix}$"),
    ("two lines", [_p(100, 130, 140, 140, "depois"), _p(100, 100, 140, 110, "antes")], [], "antes\ndepois"),
)


@query(_values("caso, texto", [(c, t) for c, _, _, t in FOLD_CASES]))
def page_folds(spark, sf):
    """Columns of spans and bars read as text."""
    schema = "caso string, s array<struct<x0:double,y0:double,x1:double,y1:double,text:string,size:double,base:double,font:string>>, b array<struct<x0:double,x1:double,y:double>>"
    df = spark.createDataFrame([(c, s, [tuple(map(float, b)) for b in bars]) for c, s, bars, _ in FOLD_CASES], schema)

    @F.pandas_udf("string")
    def fold(spans: pd.Series, bars: pd.Series) -> pd.Series:
        piece = lambda p: pagefold.Piece(p["x0"], p["y0"], p["x1"], p["y1"], p["text"], p["size"], p["base"], font=p["font"])
        return pd.Series([pagefold.column_text([piece(p) for p in s], [(x["x0"], x["x1"], x["y"]) for x in b], [], 737.0) for s, b in zip(spans, bars)])

    return df.select("caso", fold("s", "b").alias("texto"))


def _grid(rows: list[list[str]], step: float = 20.0, wide: float = 200.0) -> list[tuple]:
    return [_p(5 + 115 * j, step * i + 5, 5 + 115 * j + 5 * len(t), step * i + 15, t) for i, r in enumerate(rows) for j, t in enumerate(r) if t]


_PLAIN = [["cidade", "total"], ["Alfa", "12"], ["Beta", "15"]]
#: (case, words, lines drawn besides the rules at 0, 20, 40 and 60, status, caption, rows)
TABLE_CASES = (
    ("plain", _grid(_PLAIN), [], "OK", "", "cidade;total/Alfa;12/Beta;15"), ("no words", [], [], "sem texto", "", None), ("curve", _grid(_PLAIN), [("c", (5, 5), (6, 9), (8, 9), (9, 9))], "curvas", "", None),
    ("slanted", _grid(_PLAIN), [("l", (5, 5), (30, 30))], "traços diagonais", "", None), ("fraction", [*_grid(_PLAIN), _p(60, 22, 66, 32, "1"), _p(60, 34, 66, 39, "2")], [("l", (59, 33), (68, 33))], "fração em célula", "", None),
    ("question", [*_grid(_PLAIN), _p(60, 45, 95, 55, "QUESTÃO")], [], "alternativas ou cabeçalho de questão na área", "", None), ("one row", _grid([["cidade", "total"]]), [], "degenerada", "", None),
    ("empty cells", _grid([["cidade", "total"], ["Alfa", ""], ["Beta", "15"]]), [], "células vazias", "", None), ("fused", _grid([["cidade", "total"], ["Alfa", "12"], ["Beta", "1 2 3"]]), [], "linhas fundidas", "", None),
    ("thousands", _grid([["cidade", "total"], ["Alfa", "5 000"], ["Beta", "15"]]), [], "OK", "", "cidade;total/Alfa;5 000/Beta;15"),
    ("caption", [_p(5, 5, 35, 15, "Vendas"), _p(38, 5, 53, 15, "das"), _p(56, 5, 91, 15, "cidades"), _p(94, 5, 129, 15, "maiores"), *_grid([["", ""], ["Alfa", "12"], ["Beta", "15"]])], [], "OK", "Vendas das cidades maiores", "Alfa;12/Beta;15"),
    ("script", [*_grid(_PLAIN), _p(131, 22, 134, 28, "2", 6, 27)], [], "OK", "", "cidade;total/Alfa;12^{2}/Beta;15"),
)


@query(_values("caso, status, legenda, linhas", [(c, s, t, r) for c, _, _, s, t, r in TABLE_CASES]))
def table_gate(spark, sf):
    """Tables of labelled pages behind the gate."""
    words = spark.createDataFrame([(c, 1, *w[:7], w[7] or "F") for c, ws, *_ in TABLE_CASES for w in ws], "doc_id string, page_no int, x0 double, y0 double, x1 double, y1 double, text string, size double, base double, font string")
    drawn = []
    for c, _, more, *_ in TABLE_CASES:
        for cmd, *pts in [*(("l", (0, y), (200, y)) for y in (0, 20, 40, 60)), *more]:
            drawn.append((c, 1, *_draw(min(p[0] for p in pts), min(p[1] for p in pts), max(p[0] for p in pts), max(p[1] for p in pts), [_seg(cmd, *pts)])))
    hits = spark.createDataFrame([(c, 1, 0, 0.0, 0.0, 200.0, 60.0, 3, 2, []) for c, *_ in TABLE_CASES], "doc_id string, page_no int, tbl_no int, x0 double, y0 double, x1 double, y1 double, row_count int, col_count int, row_boxes array<struct<y0:double,y1:double>>")
    found = tablegrid.structured_tables(hits, words, spark.createDataFrame(drawn, DRAWING))
    return found.select(F.col("doc_id").alias("caso"), "status", F.col("caption").alias("legenda"), F.array_join(F.transform("rows", lambda r: F.array_join(r, ";")), "/").alias("linhas"))


#: (page, column, question, begin, end) of the page below
REGIONS = ((1, 0, 1, 60.0, 310.0), (1, 0, 2, 310.0, 700.0), (1, 1, 2, 60.0, 210.0), (1, 1, 3, 210.0, 700.0))


@query(_values("page_no, col, num, y0, y1", list(REGIONS)))
def page_regions(spark, sf):
    """Areas of the questions of a page of two columns; what precedes a column's first header belongs to the question before."""
    pages = spark.createDataFrame([("d", 0, 560.0, 800.0), ("d", 1, 560.0, 800.0)], "doc_id string, page_no int, width double, height double")
    blocks = spark.createDataFrame(
        [("d", 1, 30.0, 60.0, 250.0, 80.0, "QUESTÃO 1"), ("d", 1, 30.0, 90.0, 250.0, 300.0, "texto"), ("d", 1, 30.0, 310.0, 250.0, 330.0, "QUESTÃO 2"), ("d", 1, 30.0, 340.0, 250.0, 700.0, "t"),
         ("d", 1, 300.0, 60.0, 500.0, 200.0, "continua"), ("d", 1, 300.0, 210.0, 500.0, 230.0, "QUESTÃO 3"), ("d", 1, 300.0, 240.0, 500.0, 700.0, "t")],
        "doc_id string, page_no int, x0 double, y0 double, x1 double, y1 double, text string",
    )
    lines = spark.createDataFrame([("d", 1, 50.0, 760.0, "PÁGINA 3")], "doc_id string, page_no int, x0 double, y0 double, text string")
    return layout.question_regions(blocks, layout.page_columns(pages, blocks), layout.page_bottom(pages, lines)).select("page_no", "col", "num", "y0", "y1")


@query(_values("TP_APLICACAO, CO_PROVA, TX_COR, REF_ARQUIVO_PDF", [("P1", 1, "AMARELO", "AMARELO.pdf.pdf"), ("P2", 4, "CINZA", "cinza_p2.pdf")]))
def catalogue_booklets(spark, sf):
    """Booklets of a year with a file catalogue: by catalogue where no print matches, the colour's rank first."""
    codes = spark.createDataFrame([(2009, "CN", 1, "AMARELO", "P1", 1), (2009, "CN", 2, "AZUL", "P1", 2), (2009, "CN", 3, "ROSA", "P1", 3), (2009, "CN", 4, "CINZA", "P2", 4)], "ANO_APLICACAO bigint, SG_AREA string, CO_PROVA bigint, TX_COR string, TP_APLICACAO string, row_no int")
    prints = spark.createDataFrame([(2009, "azul_b.pdf", "P1", "AZUL", 1), (2009, "azul_a.pdf", "P1", "AZUL", 1), (2009, "cinza_p2.pdf", "P2", "CINZA", 1)], "ano bigint, name string, app string, color string, day int")
    files = spark.createDataFrame([(2009, "P1", 1, "AMARELO", "Amarelo.pdf"), (2009, "P1", 1, "AZUL", "AZUL_B.PDF")], "ano bigint, app string, day int, color string, filename string")
    listed = spark.createDataFrame([(2009, "AMARELO.pdf.pdf")], "ano bigint, name string")
    return booklets.select_booklets(codes, prints, files, listed).select("TP_APLICACAO", "CO_PROVA", "TX_COR", "REF_ARQUIVO_PDF")
