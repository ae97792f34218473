from hypothesis import given, settings
from hypothesis import strategies as st

from itemforge.operators import layout, pagefold, tablegrid
from itemforge.operators import windows as O

BOX = "doc_id string, page_no int, x0 double, y0 double, x1 double, y1 double"
DRAW = BOX + ", type string, fill array<double>, color array<double>, width double, dashes string, items array<struct<cmd:string,pts:array<struct<x:double,y:double>>>>"


def line(x0, y0, x1, y1):
    x0, y0, x1, y1 = map(float, (x0, y0, x1, y1))
    return ("d", 1, min(x0, x1), min(y0, y1), max(x0, x1), max(y0, y1), "s", None, [0.0, 0.0, 0.0], 1.0, "", [("l", [(x0, y0), (x1, y1)])])


def test_regions_and_images(spark):
    pages = spark.createDataFrame([("d", p, 560.0, 800.0) for p in range(3)], "doc_id string, page_no int, width double, height double")
    blocks = spark.createDataFrame(
        [("d", 1, 30.0, 60.0, 250.0, 80.0, "QUESTÃO 1"), ("d", 1, 30.0, 90.0, 250.0, 300.0, "texto"), ("d", 1, 30.0, 310.0, 250.0, 330.0, "QUESTÃO 2"), ("d", 1, 30.0, 340.0, 250.0, 700.0, "t"), ("d", 1, 300.0, 60.0, 500.0, 200.0, "continua"), ("d", 1, 300.0, 210.0, 500.0, 230.0, "QUESTÃO 3"), ("d", 1, 300.0, 240.0, 500.0, 700.0, "t")],
        BOX + ", text string",
    )
    lines = spark.createDataFrame([("d", 1, 50.0, 760.0, "PÁGINA 3")], "doc_id string, page_no int, x0 double, y0 double, text string")
    empty_draw = spark.createDataFrame([line(320, 100, 360, 140), line(40, 400, 45, 400)], DRAW)
    images = spark.createDataFrame([("d", 1, 40.0, 100.0, 140.0, 200.0)] + [("d", p, 100.0, 10.0, 150.0, 60.0) for p in (1, 2)], BOX)
    tables = spark.createDataFrame([("d", 1, 320.0, 300.0, 480.0, 400.0, "sem texto")], BOX + ", status string")
    spans = spark.createDataFrame([("d", 1, 40.0, 350.0, 60.0, 360.0, "texto", 10.0), ("d", 1, 40.0, 400.0, 160.0, 430.0, "GRANDE", 30.0), ("d", 1, 40.0, 440.0, 60.0, 450.0, "mais texto", 10.0)], BOX + ", text string, size double")
    cols, bottoms = layout.page_columns(pages, blocks), layout.page_bottom(pages, lines)
    assert {(r.page_no, r.bottom) for r in bottoms.collect()} == {(0, 737.0), (1, 759.0), (2, 737.0)}
    got = [(r.col, r.num, r.y0, r.y1) for r in layout.question_regions(blocks, cols, bottoms).orderBy("ord").collect()]
    assert got == [(0, 1, 60.0, 310.0), (0, 2, 310.0, 700.0), (1, 2, 60.0, 210.0), (1, 3, 210.0, 700.0)]
    found = {r.co_posicao for r in layout.question_images(pages, blocks, lines, empty_draw, images, tables, spans).collect()}
    assert found == {1, 2, 3}


def word(x, y, text, size=10.0):
    return tablegrid.Word(float(x), float(y), x + 5.0 * len(text), y + size, text, size, y + size)


def grid():
    ruled = [dict(zip(("x0", "y0", "x1", "y1", "type", "fill", "items"), (0, y, 200, y, "s", None, [{"cmd": "l", "pts": [{"x": 0, "y": y}, {"x": 200, "y": y}]}]))) for y in (0, 20, 40, 60)]
    words = [word(5, 5, "cidade"), word(120, 5, "total"), word(5, 25, "Alfa"), word(120, 25, "12"), word(5, 45, "Beta"), word(120, 45, "15")]
    return ruled, words


def test_table_is_structured():
    ruled, words = grid()
    assert tablegrid.structure((0, 0, 200, 60), ruled, words, [])[1:] == ("OK", "", [["cidade", "total"], ["Alfa", "12"], ["Beta", "15"]])


def test_gate_of_a_table():
    ruled, words = grid()
    why = lambda drawings, ws: tablegrid.structure((0, 0, 200, 60), drawings, ws, [])[1]
    stroke = lambda cmd, *pts: {"x0": 0, "y0": 0, "x1": 200, "y1": 60, "type": "s", "fill": None, "items": [{"cmd": cmd, "pts": [{"x": x, "y": y} for x, y in pts]}]}
    assert why(ruled, []) == "sem texto" and why([], words) == "poucas réguas horizontais"
    assert why([*ruled, stroke("c", (5, 5), (6, 9), (8, 9), (9, 9))], words) == "curvas"
    assert why([*ruled, stroke("l", (5, 5), (30, 30))], words) == "traços diagonais"
    assert why(ruled, [*words, word(60, 45, "Questão")]) == "alternativas ou cabeçalho de questão na área"
    assert why(ruled, words[:3]) == "degenerada" and why(ruled, [*words[:5], word(120, 45, "1 2 3")]) == "linhas fundidas"
    assert [tablegrid.is_fused(c) for c in ("1 2", "5 000", "12", "a 2", "-1 3,5")] == [True, False, False, False, True]
    title = [word(5, 5, "Vendas"), word(40, 5, "das"), word(60, 5, "cidades"), word(100, 5, "maiores")]
    got = tablegrid.structure((0, 0, 200, 60), ruled, [*title, *words[2:]], [])
    assert got[1] == "OK" and got[2] == "Vendas das cidades maiores" and got[3] == [["Alfa", "12"], ["Beta", "15"]]


def test_words_and_tables_of_a_page(spark):
    assert [w[4] for w in tablegrid.words_of("a b\x0fc", [0, 1, 2, 3, 4, 5], 0, 10, 10, 8, "F")] == ["a", "b,c"]
    ruled, words = grid()
    found = tablegrid.detected(ruled, tablegrid.framed(words))
    assert found == [(0.0, 0.0, 200.0, 60.0, 3, 2, [(0.0, 20.0), (20.0, 40.0), (40.0, 60.0)])]
    spans = spark.createDataFrame([("d", 1, 0.0, 0.0, 50.0, 10.0, "dois nomes", 10.0, 8.0, "F"), ("d", 1, 0.0, 0.0, 5.0, 10.0, None, 10.0, 8.0, None)], BOX + ", text string, size double, base double, font string")
    assert [(r.text, r.x0, r.x1) for r in tablegrid.page_words(spans).collect()] == [("dois", 0.0, 20.0), ("nomes", 25.0, 50.0)]
    w = spark.createDataFrame([("d", 1, x.x0, x.y0, x.x1, x.y1, x.text, x.size, x.base, "F") for x in words], BOX + ", text string, size double, base double, font string")
    d = spark.createDataFrame([line(0, y, 200, y) for y in (0, 20, 40, 60)], DRAW)
    hits = tablegrid.detect_tables(w, d)
    assert [(r.row_count, r.col_count) for r in hits.collect()] == [(3, 2)]
    assert [r.rows for r in tablegrid.structured_tables(hits, w, d).collect()] == [[["cidade", "total"], ["Alfa", "12"], ["Beta", "15"]]]


def test_delimiters_bars_and_cut_pieces():
    P = pagefold.Piece
    tall = [P(10, y, 14, y + 10, c, 10, y + 8, font="Symbol") for y, c in ((0, "⎛"), (10, "⎜"), (20, "⎝"))]
    assert [(p.text, p.y0, p.y1) for p in pagefold.stacked(tall)] == [("(", 0, 30)]
    assert pagefold.underscores([P(0, 0, 20, 10, "____", 10, 8), P(0, 0, 5, 9, "x", 10, 8)])[1] == [(0, 20, 9.5)]
    both = P(0, 0, 70, 10, "6!     15!", 10, 8, xs=tuple(range(0, 77, 7)))
    assert [(p.text, p.x0, p.x1) for p in pagefold.cut_at(both, 30)] == [("6!", 0, 14), ("15!", 49, 70)] and pagefold.cut_at(P(0, 0, 9, 9, "ab", 9, 8), 4)[0].text == "ab"
    sides = [P(100, 92, 142, 102, "6! 15!", 10, 100, xs=(100, 105, 110, 125, 130, 135, 142)), P(101, 107, 108, 117, "2", 10, 115), P(128, 107, 138, 117, "3", 10, 115)]
    assert pagefold.column_text(sides, [(99.0, 112.0, 104.0), (124.0, 143.0, 104.0)], [], 737.0) == r"$\frac{6!}{2} \frac{15!}{3}$"


def test_drawn_root(spark):
    from itemforge.functions import geometry as G

    pts = [(0.0, 8.0), (2.0, 12.0), (6.0, 0.0), (5.0, 0.0)]
    shape = ("d", 1, 0.0, 0.0, 6.0, 12.0, "f", [0.0], None, 1.0, "", [("l", [a, b]) for a, b in zip(pts, pts[1:])])
    df = spark.createDataFrame([shape, line(0, 0, 6, 12)], DRAW)
    assert [r.r for r in df.select(G.radical_sign().alias("r")).collect()] == [True, False]


def test_tables_with_gates(spark):
    ruled, words = grid()
    hits = spark.createDataFrame([("d", 1, k, 0.0, y, 200.0, y + 60.0, 3, 2, [(0.0, 20.0)]) for k, y in ((0, 0.0), (1, 300.0))], "doc_id string, page_no int, tbl_no int, x0 double, y0 double, x1 double, y1 double, row_count int, col_count int, row_boxes array<struct<y0:double,y1:double>>")
    w = spark.createDataFrame([("d", 1, x.x0, x.y0, x.x1, x.y1, x.text, x.size, x.base, "F") for x in words], "doc_id string, page_no int, x0 double, y0 double, x1 double, y1 double, text string, size double, base double, font string")
    d = spark.createDataFrame([line(0, y, 200, y) for y in (0, 20, 40, 60)], DRAW)
    got = {r.tbl_no: (r.status, r.rows) for r in tablegrid.structured_tables(hits, w, d).collect()}
    assert got == {0: ("OK", [["cidade", "total"], ["Alfa", "12"], ["Beta", "15"]]), 1: ("sem texto", None)}


def test_cell_scripts():
    small = tablegrid.Word(5.5, 0.0, 8.0, 6.0, "2", 6.0, 6.0)
    assert tablegrid.cell_text([tablegrid.Word(0, 0, 5, 10, "m", 10.0, 10.0), small]) == "m^{2}"


def test_page_fold_reads_fractions_and_scripts():
    P = pagefold.Piece
    pieces = [P(100, 100, 106, 110, "x", 10, 108), P(112, 100, 118, 110, "=", 10, 108), P(122, 92, 128, 102, "a", 10, 100), P(122, 107, 128, 117, "b", 10, 115), P(106, 97, 109, 103, "2", 6, 103)]
    assert pagefold.column_text(pieces, [(120.0, 130.0, 104.0)], [], 737.0) == r"$x^{2} = \frac{a}{b}$"
    root = [P(100, 100, 106, 112, "√", 10, 110), P(108, 102, 114, 112, "3", 10, 110)]
    assert pagefold.column_text(root, [(106.5, 116.0, 101.0)], [], 737.0) == r"$\sqrt{3}$"


def test_page_texts(spark):
    pages = spark.createDataFrame([("d", p, 560.0, 800.0) for p in (0, 1)], "doc_id string, page_no int, width double, height double")
    spans = spark.createDataFrame([("d", 1, 30.0, 100.0, 90.0, 110.0, "esquerda", 10.0, 108.0), ("d", 1, 300.0, 90.0, 350.0, 100.0, "direita", 10.0, 98.0), ("d", 1, 30.0, 120.0, 90.0, 130.0, "depois", 10.0, 128.0)], BOX + ", text string, size double, base double")
    blocks = spark.createDataFrame([], BOX + ", text string")
    lines = spark.createDataFrame([], "doc_id string, page_no int, x0 double, y0 double, text string")
    tables = spark.createDataFrame([], BOX + ", tbl_no int")
    got = pagefold.page_texts(pages, blocks, lines, spans, spark.createDataFrame([], DRAW), tables).collect()
    assert [(r.page_no, r.text) for r in got] == [(1, "esquerda\ndepois\ndireita")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 60)), min_size=1, max_size=25))
def test_gap_clusters_equal_a_fold(spark, values):
    df = spark.createDataFrame([(g, v / 4) for g, v in values], "g int, v double")
    got = sorted((r.g, round(r.centre, 6), r.n) for r in O.gap_clusters(df, ["g"], "v", 1.0).collect())
    want = []
    for g in {g for g, _ in values}:
        groups = []
        for v in sorted(v / 4 for k, v in values if k == g):
            if not groups or v - groups[-1][-1] > 1.0:
                groups.append([])
            groups[-1].append(v)
        want += [(g, round(sum(x) / len(x), 6), len(x)) for x in groups]
    assert got == sorted(want)


def test_anchored_lines(spark):
    df = spark.createDataFrame([(1, 0.0, 2.0, "a"), (1, 1.0, 2.0, "b"), (1, 1.3, 2.0, "c"), (1, None, 2.0, "x")], "g int, c double, h double, t string")
    assert [(r.line, r.texts) for r in O.anchored_lines(df, ["g"], "c", "h", "t").orderBy("line").collect()] == [(0, ["a", "b"]), (1, ["c"])]
