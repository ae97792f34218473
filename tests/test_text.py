from itemforge.functions import question as Q
from itemforge.functions.scalar import PICTURE
from itemforge.operators import segment


def test_line_led_alternatives_take_the_tightest_last_run():
    text = "Enunciado A\nA primeira\nfrase\nA) um\nB) dois\ncontinua\nC) três\nD) quatro\nE) cinco 2019"
    statement, alts, mode = Q.parse_body(text)
    assert mode == "linha" and alts == ["um", "dois continua", "três", "quatro", "cinco"]
    assert statement == "Enunciado A A primeira frase"


def test_trailing_letters_and_pictures():
    assert Q.parse_body("Veja a figura A D B E C")[1:] == ([PICTURE] * 5, "letras")
    statement, alts, mode = Q.parse_body("Qual é? A um B dois C três D quatro E cinco")
    assert mode == "em_linha" and alts == ["um", "dois", "três", "quatro", "cinco"] and statement == "Qual é?"
    assert Q.parse_body("Sem alternativas")[1:] == (None, "nenhum")
    assert Q.parse_body(None) == (None, None, "nenhum") and Q.parse_body("")[0] == ""


def test_alternative_that_is_only_a_year_stays():
    assert Q.clean_alternative("2013") == "2013" and Q.clean_alternative("custo 2013") == "custo" and Q.clean_alternative("") == PICTURE


def test_page_cleaning():
    page = "SIMULADO2024SIMULADO2024\n*020325AZ2*\nQUESTÃO\n14\nTexto de¿nido\n7\nMT - 2º dia\nCADERNO 7 - AZUL - PÁGINA 25"
    assert Q.clean_page(page) == "QUESTÃO 14\nTexto definido"
    assert Q.clean_page(None) is None and Q.clean_page("") == ""


def test_formulas():
    assert Q.split_glued(r"\pih e \left") == r"\pi h e \left"
    assert Q.has_prose(r"O valor de \frac{A}{B} é") and not Q.has_prose(r"IMC = \frac{massa}{altura}")
    assert Q.mark_inline("M_{1} e 10^{3} m^{2}") == "$M_{1}$ e $10^{3}$ $m^{2}$"
    assert Q.mark_inline(r"\frac{m_{1}}{d^{2}}") == r"\frac{m_{1}}{d^{2}}"
    assert Q.format_alternative(r"\frac{1}{2}.") == r"$\frac{1}{2}$" and Q.format_alternative("$x.$") == "$x$"
    assert Q.format_cell("π r") == r"$\pi r$"
    assert Q.markdown([["a|b", "c"], ["1", "2"]], "título") == "título\n| a\\|b | c |\n|---|---|\n| 1 | 2 |"


def test_locating_formatted_alternatives():
    s = "Calcule. $10^{-2}$ $10^{-3}$ $1$ $2$ $3$"
    cut, pieces = Q.locate_formatted(s, ["10-2", "10-3", "1", "2", "3"])
    assert s[:cut] == "Calcule. " and pieces[0] == "$10^{-2}$"
    assert Q.locate_formatted(s, ["x", "", "1", "2", "3"]) is None


def test_questions_of_a_document(spark):
    body = "\nA) um\nB) dois\nC) três\nD) quatro\nE) cinco"
    doc = "capa\n" + "".join(f"QUESTÃO {n}\nTexto {t}{body}\n" for n, t in [(1, "a"), (2, "b"), (1, "c"), (2, "d"), (6, "e"), (6, "f")])
    df = spark.createDataFrame([("d", doc), ("vazio", ""), ("nulo", None)], "doc_id string, text string")
    got = {(r.CO_POSICAO, r.TP_LINGUA): r.DESC_ENUNCIADO for r in segment.questions(df).collect()}
    assert got == {(1, 0.0): "Texto a", (2, 0.0): "Texto b", (1, 1.0): "Texto c", (2, 1.0): "Texto d", (6, None): "Texto f"}


def test_flags_and_tables(spark):
    mark = segment.MARKER.format(1, 0)
    body = "\nA) um\nB) dois\nC) três\nD) quatro\nE) cinco"
    df = spark.createDataFrame([("d", f"QUESTÃO 7\nNa tabela a seguir {mark} veja{body}\nQUESTÃO 8\nna tabela a seguir{body}\nQUESTÃO 9\nsó imagem")], "doc_id string, text string")
    tables = spark.createDataFrame([("d", 1, 0, "| a |")], "doc_id string, page_no int, tbl_no int, markdown string")
    got = {r.CO_POSICAO: r for r in segment.questions(df, tables=tables).collect()}
    assert (got[7].IN_ITEM_IMAGEM, got[7].IN_ITEM_TABELA) == (0, 1) and "| a |" in got[7].DESC_ENUNCIADO and "" not in got[7].DESC_ENUNCIADO
    assert (got[8].IN_ITEM_IMAGEM, got[8].IN_ITEM_TABELA) == (1, 0)
    assert got[9].IN_ITEM_IMAGEM == 1 and got[9].DESC_ALTER_E == PICTURE


def test_span_text(spark):
    assert Q.span_text("𝜋𝜋 r") == r"\pi r" and Q.span_text("R$ 5 e US$ 6") == "R$ 5 e US$ 6" and Q.span_text("!, @ e $") == "!, @ e " + Q.DOLLAR
    body = "\nA) um\nB) dois\nC) três\nD) quatro\nE) cinco"
    df = spark.createDataFrame([("d", "QUESTÃO 7\nsinais @ e " + Q.DOLLAR + " aqui" + body)], "doc_id string, text string")
    assert segment.questions(df).first().DESC_ENUNCIADO == "sinais @ e \\$ aqui"
