"""Nulls, empty and very long texts, repeated rows, empty tables and clashing extra columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from itemforge.llm import canonical, catalogue, encoding, language, leaks, near, personal, reading, scan, subjects, tokenize_bpe

LONG = "Para o agricultor, ampliar a variância exige tempo, porque a mediana observa a probabilidade. " * 3000 + "A" * 50_000 + " " + "1" * 20_000
ROWS = [(1, None), (2, ""), (3, "   \n"), (4, "Texto simples com algumas palavras comuns em português."), (4, "Texto simples com algumas palavras comuns em português."), (5, LONG), (None, "sem chave, mas com texto comum e palavras")]
SCHEMA = "i bigint, t string"


def frame(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("campo", "id_linha", "ids", "s", "h", "g", "w", "doc_id", "n"):
        df = df.withColumn(name, F.lit("x"))
    return df


def outputs(df, spark):
    marks = spark.createDataFrame([(4, "basico")], "id_linha bigint, nivel string")
    items = spark.createDataFrame([(9, "texto simples com algumas palavras comuns em português para testar a busca de trechos"), (8, None), (7, "curto")], "item_id bigint, text string")
    labelled = df.withColumn("l", F.lit("pt"))
    model = reading.fit_levels([])
    topics = subjects.fit_topics(spark, [])
    words = language.fit_profile(labelled, "i", "l", "t")
    return {
        "p1": lambda: scan.scan_traces(df, "i", ["t"], scan.fit_lexicon(df, ["t"])),
        "p2": lambda: language.passages(df, "i", ["t"], words),
        "p2b": lambda: language.language_cases(labelled, "i", "l", ["t"], words),
        "p3": lambda: canonical.unstable_fields(df, "i", ["t"]),
        "p4": lambda: reading.reading_levels(df, "i", "t", reading.fit_levels([(reading.Splitter().words(t), g[0]) for t, g in reading.labelled_sample(df, "i", "t", marks, "id_linha", "nivel", 10)])),
        "p4b": lambda: reading.reading_levels(df, "i", "t", model),
        "p5": lambda: subjects.subject_areas(df, "i", "t", topics),
        "p6": lambda: encoding.garbled_fields(df, "i", ["t"]),
        "p6b": lambda: encoding.restore_fields(df, "i", ["t"]),
        "p7": lambda: near.alike_pairs(df, "i", "t", 0.5),
        "p7b": lambda: near.record_groups(df, "i", "t", 0.5),
        "p8": lambda: tokenize_bpe.encode_corpus(df, "i", "t"),
        "p9": lambda: leaks.leaked_passages(df, "i", "t", items, "item_id", "text"),
        "p10": lambda: personal.personal_spans(df, "i", "t", personal.fit_model(df, "i", "t")),
        "p10b": lambda: personal.masked_texts(df, "i", "t", personal.fit_model(df, "i", "t")),
    }


NAMES = ["p1", "p2", "p2b", "p3", "p4", "p4b", "p5", "p6", "p6b", "p7", "p7b", "p8", "p9", "p10", "p10b"]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, name):
    rows = outputs(frame(spark), spark)[name]().collect()
    ids = [r[0] for r in rows]
    if name in ("p6b", "p8", "p10b"):  # one row for each row
        assert len(rows) == len(ROWS)
    if name in ("p4", "p4b"):  # a level for every text that is neither null nor empty
        assert sorted(map(str, ids)) == sorted(map(str, [3, 4, 4, 5, None]))
    if name == "p8":
        got = {r[0]: r[1] for r in rows}
        assert got[1] == [] and got[2] == [] and len(got[5]) > 3000
    if name in ("p6b", "p10b"):
        assert {r[0]: r[1] for r in rows}[1] is None and {r[0]: r[1] for r in rows}[2] == ""
    if name == "p2":
        assert {1, 2, 3}.isdisjoint(ids) and ids.count(4) == 2


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert outputs(frame(spark, []), spark)[name]().collect() == []


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_queries_run(spark, name):
    df = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.count() > 0
    if name.endswith("_found"):
        assert df.count() == df.distinct().count()


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_equals_sql(spark, name):
    from tests import oracle

    sf = "/root/testdata/sf0.01"
    oracle.compare(spark, oracle.connect(sf), sf, catalogue.QUERIES[name], catalogue.SQL[name])
