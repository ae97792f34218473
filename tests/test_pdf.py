import zlib

from itemforge.functions import fonts
from itemforge.sources import pdf


def make(path, pages, packed=False):
    """A small file of the format: one font with differences and a code map, one picture."""
    cmap = b"beginbfrange <61> <63> <0061> endbfrange beginbfchar <01> <03B1> <02> <F070> endbfchar"
    objs = {1: b"<</Type/Catalog/Pages 2 0 R>>", 3: b"<</Type/Font/Subtype/Type1/BaseFont/ABCDEF+Symbol/FirstChar 97/Widths[600 600 600]/Encoding<</Differences[1/alpha 233/eacute]>>/ToUnicode 5 0 R>>", 4: b"<</Type/XObject/Subtype/Image/Width 1/Height 1>>"}
    streams = {5: cmap}
    kids = []
    for k, content in enumerate(pages):
        objs[10 + 2 * k] = b"<</Type/Page/Parent 2 0 R/Contents %d 0 R>>" % (11 + 2 * k)
        streams[11 + 2 * k] = content
        kids.append(b"%d 0 R" % (10 + 2 * k))
    objs[2] = b"<</Type/Pages/Count %d/Kids[%s]/MediaBox[0 0 600 800]/Resources<</Font<</F1 3 0 R>>/XObject<</I 4 0 R>>>>>>" % (len(pages), b" ".join(kids))
    out = b"%PDF-1.5\n"
    if packed:
        heads, body = b"", b""
        for n, o in objs.items():
            heads += b"%d %d " % (n, len(body))
            body += o + b" "
        z = zlib.compress(heads + body)
        out += b"90 0 obj\n<</Type/ObjStm/N %d/First %d/Filter/FlateDecode/Length %d>>\nstream\n%s\nendstream\nendobj\n" % (len(objs), len(heads), len(z), z)
        objs = {}
    for n, o in objs.items():
        out += b"%d 0 obj\n%s\nendobj\n" % (n, o)
    for n, s in streams.items():
        z = zlib.compress(s)
        out += b"%d 0 obj\n<</Filter/FlateDecode/Length %d>>\nstream\n%s\nendstream\nendobj\n" % (n, len(z), z)
    path.write_bytes(out + b"trailer<</Root 1 0 R>>")
    return path


CONTENT = b"BT /F1 10 Tf 1 0 0 1 50 700 Tm (abc) Tj 0 -20 Td [(a) -300 (\\351)] TJ ET q 2 w 1 0 0 RG 50 600 m 150 600 l S 10 20 30 40 re f Q q 100 0 0 50 200 300 cm /I Do Q"


def test_primitives(tmp_path, spark):
    for packed in (False, True):
        p = make(tmp_path / f"a{packed}.pdf", [CONTENT, b"BT /F1 12 Tf 10 10 Td (\x01\x02) Tj ET"], packed)
        got = list(pdf.primitives(p.read_bytes()))
        spans = [f for k, f in got if k == "span"]
        assert [s["text"] for s in spans] == ["abc", "a é", "απ"]
        assert (spans[0]["x0"], spans[0]["x1"], spans[0]["base"], spans[0]["font"]) == (50.0, 68.0, 100.0, "Symbol")
        draw = [f for k, f in got if k == "drawing"]
        assert [(d["type"], d["x0"], d["y0"], d["x1"], d["y1"]) for d in draw] == [("s", 50.0, 200.0, 150.0, 200.0), ("f", 10.0, 740.0, 40.0, 780.0)]
        assert draw[0]["color"] == [1.0, 0.0, 0.0] and draw[0]["width"] == 2.0
        assert [(f["x0"], f["y0"], f["x1"], f["y1"]) for k, f in got if k == "image"] == [(200.0, 450.0, 300.0, 500.0)]
        assert pdf.cover_text(p.read_bytes()) == (2, "abc\na é\nαπ")
    (tmp_path / "bad.pdf").write_bytes(b"%PDF /Encrypt")
    spark.dataSource.register(pdf.PdfSource)
    read = lambda k: spark.read.format("itemforge_pdf").option("kind", k).load(f"{tmp_path}/aTrue.pdf,{tmp_path}/bad.pdf")
    assert {(r.page_no, r.x1) for r in read("page").where("error is null").collect()} == {(0, 600.0), (1, 600.0)}
    assert read("span").where("error is not null").count() == 1 and read("image").where("error is null").count() == 1
    assert read("drawing").where("error is null").orderBy("ord").first().items[0].cmd == "l"


def test_fonts():
    assert fonts.style("/ABCDEF+Arial-Bold") == "Arial-Bold"
    assert [fonts.glyph(n) for n in ("/eacute", "ccedilla", "uni00E3", "alpha", "Omega", "a", "one", "nope9")] == ["é", "ç", "ã", "α", "Ω", "a", "1", None]
    assert fonts.differences([65, "Aacute", "B", 200, "atilde"]) == {65: "Á", 66: "B", 200: "ã"}
    assert fonts.private_use("\uf070", "Symbol") == "π" and fonts.private_use("\uf041", "Arial") == "A" and fonts.private_use("x") == "x"
    assert fonts.code_map("beginbfrange <0001> <0003> <0041> <0005> <0006> [<00E3> <00E7>] endbfrange") == {1: "A", 2: "B", 3: "C", 5: "ã", 6: "ç"}


def _page(lines, strokes=b""):
    body = b"".join(b"BT /F1 10 Tf 1 0 0 1 %d %d Tm (%s) Tj ET " % (x, y, t.encode("cp1252").replace(b"(", b"\\(").replace(b")", b"\\)")) for x, y, t in lines)
    return body + strokes


def test_booklet_to_questions(tmp_path, spark):
    from itemforge.plans import extraction

    cover = _page([(50, 700, "CADERNO DE QUESTÕES"), (50, 680, "1º DIA - CADERNO 1 - AZUL")])
    table = [(60, 545, "cidade"), (200, 545, "total"), (60, 525, "Alfa"), (200, 525, "12"), (60, 505, "Beta"), (200, 505, "15")]
    rules = b"".join(b"50 %d m 260 %d l S " % (y, y) for y in (560, 540, 520, 500))
    first = _page([(50, 650, "QUESTÃO 1"), (50, 630, "Qual é o total de"), (50, 615, "todas as cidades da"), (50, 600, "tabela?"), *table, *[(50, 480 - 15 * k, f"{x} resposta {k}") for k, x in enumerate("ABCDE")]], rules)
    second = _page([(50, 650, "QUESTÃO 2"), (50, 630, "Outra pergunta."), *[(50, 610 - 15 * k, f"{x} opção {k}") for k, x in enumerate("ABCDE")], (50, 300, "QUESTÃO 3"), (50, 280, "Conforme a figura, diga.")])
    path = make(tmp_path / "prova_azul.pdf", [cover, first, second, _page([(50, 700, "fim")])])
    (tmp_path / "bad.pdf").write_bytes(b"%PDF /Encrypt")
    questions, booklets = extraction.extract(spark, [str(path), str(tmp_path / "bad.pdf")])
    got = {r.CO_POSICAO: r for r in questions.collect()}
    assert sorted(got) == [1, 2, 3] and {r.REF_ARQUIVO_PDF for r in got.values()} == {"prova_azul.pdf"}
    assert got[1].DESC_ENUNCIADO == "Qual é o total de todas as cidades da tabela?\n| cidade | total |\n|---|---|\n| Alfa | 12 |\n| Beta | 15 |" and got[1].IN_ITEM_TABELA == 1
    assert [got[2][f"DESC_ALTER_{x}"] for x in "ABCDE"] == [f"opção {k}" for k in range(5)] and got[2].IN_ITEM_IMAGEM == 0
    assert got[3].IN_ITEM_IMAGEM == 1 and got[3].DESC_ALTER_A == "[Figura / Imagem]"
    b = booklets.collect()
    assert [(r.name, r.page_count) for r in b] == [("prova_azul.pdf", 4)] and "AZUL" in b[0].cover_text
    assert [r.name for r in extraction.unreadable(spark, [str(path), str(tmp_path / "bad.pdf")]).collect()] == ["bad.pdf"]
