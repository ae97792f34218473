"""Misread words that are frequent enough to look like words."""

from itemforge.llm import scan


def test_frequent_and_copied_misreadings_are_no_words(spark):
    texts = [f"o porto alto {k}" for k in range(300)] + [f"um porfo {k}" for k in range(12)] + ["o alfo cais"] * 30 + [f"o rio {k}" for k in range(12)] + [f"no mar {k}" for k in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i bigint, t string")
    found = {r.id_linha: r.texto_reparado for r in scan.scan_traces(df, "i", ["t"], scan.fit_lexicon(df, ["t"])).collect()}
    assert found == {k: t.replace("porfo", "porto").replace("alfo", "alto") for k, t in enumerate(texts) if "porfo" in t or "alfo" in t}
