import zipfile

import pytest
from pyspark.sql import functions as F

from itemforge.operators import booklets, dictionary, publish
from itemforge.plans import pipeline
from itemforge.sources import folders, items
from itemforge.sources.workbook import WorkbookSource, workbook_cells

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def write_workbook(path, sheets):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {NS}><sheets>" + "".join(f'<sheet name="s{k}" sheetId="{k}" r:id="r{k}"/>' for k in range(len(sheets))) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>' for k in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}><si><t>CO_PROVA_MT</t></si></sst>")
        for k, cells in enumerate(sheets):
            rows = "".join(f'<row r="{r}">' + "".join(c for c in cs) + "</row>" for r, cs in cells)
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {NS}><sheetData>{rows}</sheetData></worksheet>")


def inline(ref, text):
    return f'<c r="{ref}" t="inlineStr"><is><t>{text}</t></is></c>'


def test_workbook_source(spark, tmp_path):
    good, bad = tmp_path / "d.xlsx", tmp_path / "bad.xlsx"
    first = [(3, ['<c r="A3" t="s"><v>0</v></c>', '<c r="C3"><v>159</v></c>', inline("D3", "Amarelo ")]), (4, ['<c r="C4"><v>160</v></c>', inline("D4", "Azul (Ledor)")]), (6, ['<c r="C6"><v>161</v></c>', inline("D6", "Azul - PPL")]), (7, [inline("A7", "TX_RESPOSTA"), '<c r="C7"><v>170</v></c>', inline("D7", "Rosa")])]
    write_workbook(good, [first, [(1, [inline("A1", "CO_PROVA_MT"), '<c r="B1"><v>999</v></c>', inline("C1", "Rosa")])]])
    bad.write_bytes(b"no workbook")
    assert list(workbook_cells(good.read_bytes()))[:2] == [(1, 3, 1, "CO_PROVA_MT"), (1, 3, 3, "159")]
    spark.dataSource.register(WorkbookSource)
    cells = spark.read.format("itemforge_workbook").load(f"{good},{bad}")
    assert cells.where("error is not null").count() == 1
    codes = dictionary.exam_codes(cells.where("error is null").withColumn("ano", F.lit(2012).cast("bigint")))
    assert {(r.CO_PROVA, r.TX_COR, r.TP_APLICACAO) for r in codes.collect()} == {(159, "AMARELO", "P1"), (161, "AZUL", "P2")}
    more = dictionary.with_known_omissions(codes)
    assert {r.CO_PROVA for r in more.collect()} == {159, 161, 156}


def test_items_round_trip(spark, tmp_path):
    text = 'linha 1\nlinha "2"; \\frac{1}{2}'
    df = spark.createDataFrame([(2019, 1, "MT", text, None, "x"), (2019, 2, "CN", "", 0.5, "y")], "ANO_APLICACAO bigint, CO_POSICAO bigint, SG_AREA string, DESC_ENUNCIADO string, NU_PARAM_A double, EXTRA string")
    items.write_csv(df, str(tmp_path / "csv"))
    back = items.read_enriched(spark, str(tmp_path / "csv"))
    assert back.columns == ["ANO_APLICACAO", "CO_POSICAO", "SG_AREA", "NU_PARAM_A", "DESC_ENUNCIADO", "EXTRA"]
    rows = {r.CO_POSICAO: r for r in back.collect()}
    assert rows[1].DESC_ENUNCIADO == text and rows[2].DESC_ENUNCIADO is None and rows[2].NU_PARAM_A == 0.5
    (tmp_path / "comma.csv").write_text("CO_PROVA,CO_ITEM\n3.0,3.5\n", encoding="latin-1")
    assert [tuple(r) for r in items.read_items(spark, str(tmp_path / "comma.csv")).collect()] == [(3, None)]
    items.write_bank(df.withColumn("CO_PROVA", F.lit(1)), str(tmp_path / "bank"))
    assert items.read_bank(spark, str(tmp_path / "bank"), [2019]).count() == 2


def prints(spark, rows):
    return spark.createDataFrame(rows, "name string, parent_name string, page_count int, cover_text string")


def test_booklet_hazards(spark):
    rows = [("X_2009_DIA_1_AMARELO_2.pdf", "PROVAS", 32, ""), ("X_2011_P1_CAD_06_DIA_2_CINZA_LEDOR.pdf", "P", 32, None), ("X_2011_P1_CAD_03_DIA_1_BRANCO_LEDOR.pdf", "P", 32, None), ("gabarito_azul_dia1.pdf", "P", 2, ""), ("caderno.pdf", "P", 20, "1º DIA e 2º DIA CADERNO ROSA"), ("a.pdf", "P", 20, None), (None, None, None, None)]
    got = {r.name: (r.app, r.color, r.day, r.cover_day) for r in booklets.fingerprint(prints(spark, rows)).collect()}
    assert got == {"X_2009_DIA_1_AMARELO_2.pdf": ("P2", "AMARELO", 1, None), "X_2011_P1_CAD_06_DIA_2_CINZA_LEDOR.pdf": ("P1", "CINZA", 2, None), "caderno.pdf": ("P1", "ROSA", 2, None)}


def test_selection_falls_back_to_the_catalogue(spark):
    codes = spark.createDataFrame([(2009, "CN", 1, "AMARELO", "P1", 1), (2009, "CN", 2, "AZUL", "P1", 2), (2009, "MT", 3, "ROXO", "P1", 1)], "ANO_APLICACAO bigint, SG_AREA string, CO_PROVA bigint, TX_COR string, TP_APLICACAO string, row_no int")
    p = spark.createDataFrame([(2009, "azul_b.pdf", "P1", "AZUL", 1), (2009, "azul_a.pdf", "P1", "AZUL", 1)], "ano bigint, name string, app string, color string, day int")
    cat = spark.createDataFrame([(2009, "P1", 1, "AMARELO", "Amarelo.pdf"), (2009, "P1", 1, "AZUL", "AZUL_B.PDF")], "ano bigint, app string, day int, color string, filename string")
    listed = spark.createDataFrame([(2009, "AMARELO.pdf.pdf")], "ano bigint, name string")
    assert [(r.CO_PROVA, r.REF_ARQUIVO_PDF) for r in booklets.select_booklets(codes, p, cat, listed).collect()] == [(1, "AMARELO.pdf.pdf")]
    got = booklets.select_booklets(codes, p, cat, listed.limit(0)).collect()
    assert [(r.CO_PROVA, r.REF_ARQUIVO_PDF) for r in got] == [(2, "azul_b.pdf")]
    assert booklets.direct_map(spark.createDataFrame([(1, "CN", "Amarela", 0), (2, "CN", "AZUL", 1)], "CO_PROVA int, SG_AREA string, TX_COR string, IN_ITEM_ADAPTADO int"), cat, listed, 2009).collect() == [(1, "AMARELO.pdf.pdf")]


def test_enrichment(spark):
    it = spark.createDataFrame([(1, 5, 7, None), (1, 140, 8, 1), (1, 99, 9, None), (2, 1, 1, None)], "CO_PROVA bigint, CO_POSICAO bigint, CO_ITEM bigint, TP_LINGUA bigint")
    sel = spark.createDataFrame([(2019, "MT", "P1", 1, "a.pdf")], "ANO_APLICACAO bigint, SG_AREA string, TP_APLICACAO string, CO_PROVA bigint, REF_ARQUIVO_PDF string")
    q = spark.createDataFrame([("a.pdf", 140, None, *["t"] * 6, 0, 1)], "REF_ARQUIVO_PDF string, CO_POSICAO bigint, TP_LINGUA double, DESC_ENUNCIADO string, DESC_ALTER_A string, DESC_ALTER_B string, DESC_ALTER_C string, DESC_ALTER_D string, DESC_ALTER_E string, IN_ITEM_IMAGEM int, IN_ITEM_TABELA int")
    got = {r.CO_ITEM: (r.DESC_ENUNCIADO, r.IN_ITEM_TABELA, r.TP_APLICACAO) for r in publish.enrich(it, sel, q).collect()}
    assert got == {7: ("t", 1, "REGULAR"), 8: ("t", 1, "REGULAR"), 9: ("", 0, "REGULAR")}


def test_subset_needs_its_columns(spark):
    with pytest.raises(ValueError):
        publish.text_subset(spark.createDataFrame([(1,)], "CO_HABILIDADE int"))


def test_consolidation_and_arguments(spark):
    a, b = spark.createDataFrame([(1, "x")], "CO_ITEM int, EXTRA string"), spark.createDataFrame([("2.0", 1)], "CO_ITEM string, ANO_APLICACAO int")
    assert {(r.ANO_APLICACAO, r.CO_ITEM, r.EXTRA) for r in pipeline.consolidate({2010: a, 2009: b}).collect()} == {(2010, 1, "x"), (2009, 2, None)}
    with pytest.raises(RuntimeError):
        pipeline.consolidate({})
    assert pipeline.parse_years("2009-2011") == [2009, 2010, 2011] and pipeline.parse_areas("mt, cn") == ["MT", "CN"]
    for bad in (lambda: pipeline.parse_years("2009-2011,2015"), lambda: pipeline.parse_areas("XX")):
        with pytest.raises(ValueError):
            bad()


def test_folder_plan(tmp_path):
    root = tmp_path / "edicao_2009"
    (root / "edicao_2009" / "PROVAS").mkdir(parents=True)
    (root / "edicao_2009" / "PROVAS" / "a.pdf.pdf").write_text("x")
    (root / "edicao_2009" / "ITENS_2009.csv").write_text("x")
    (root / "edicao_2009" / "dic.xlsx").write_text("x")
    report = folders.plan_year(root, 2009)
    assert report["status"] == "ok" and folders.apply_plan(report["actions"]) == 3
    assert folders.apply_plan(folders.plan_extensions(root / "PROVAS")) == 1 and (root / "PROVAS" / "a.pdf").exists()
    found = folders.locate(tmp_path, 2009)
    assert (found.items.name, found.dictionary.name, found.booklets.name) == ("ITENS_2009.csv", "dic.xlsx", "PROVAS")
    assert folders.plan_year(tmp_path / "none", 2010)["status"] == "not_found"
    with pytest.raises(FileNotFoundError):
        folders.locate(tmp_path, 2012)


def test_streaming_loads(spark, tmp_path):
    from itemforge.streaming import arrivals

    rows = spark.read.parquet("/root/testdata/sf0.001/itens_prova.parquet").where("DT_CARGA is not null and CO_ITEM is not null and CO_PROVA is not null")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = arrivals.distinct_loads(stream, ["CO_PROVA", "CO_POSICAO", "CO_ITEM"], "DT_CARGA", "40000 days").writeStream.format("memory").queryName("loads").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("loads").count() == rows.select("CO_PROVA", "CO_POSICAO", "CO_ITEM").distinct().count()
