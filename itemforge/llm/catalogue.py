"""Registered queries of the training-data operators, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm import canonical, encoding, language, leaks, near, personal, reading, scan, subjects, tokenize_bpe
from itemforge.session import table, texts

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Fields with a trace of the scanned page."""
    fields = ["DESC_ENUNCIADO", "DESC_ALTER_A"]
    df = texts(spark, sf, "pipeline", "ID_LINHA", *fields)
    return scan.with_traces(scan.scan_traces(df, "ID_LINHA", fields, scan.fit_lexicon(df, fields), texts=False)).select("id_linha", "campo")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Languages of a field that its record's label does not name."""
    fields = ["DESC_ENUNCIADO", "DESC_ALTER_A"]
    df = texts(spark, sf, "pipeline", "ID_LINHA", "TX_IDIOMA", *fields)
    words = language.fit_profile(df, "ID_LINHA", "TX_IDIOMA", "DESC_ENUNCIADO")
    return language.language_cases(df, "ID_LINHA", "TX_IDIOMA", fields, words)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Fields with look-alike, invisible or taken-apart characters."""
    fields = ["DESC_ENUNCIADO", "DESC_ALTER_B"]
    return canonical.unstable_fields(texts(spark, sf, "pipeline", "ID_LINHA", *fields), "ID_LINHA", fields).select("id_linha", "campo")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Reading level of every record with a statement."""
    df = texts(spark, sf, "pipeline", "ID_LINHA", "DESC_ENUNCIADO")
    labels = table(spark, sf, "reading_labels", "id_linha", "nivel")
    sample = reading.labelled_sample(df, "ID_LINHA", "DESC_ENUNCIADO", labels, "id_linha", "nivel", reading.FIT_DOCUMENTS)
    cut = reading.Splitter()
    model = reading.fit_levels([(cut.words(t), g[0]) for t, g in sample if g[0] in reading.LEVELS])
    return reading.reading_levels(df, "ID_LINHA", "DESC_ENUNCIADO", model).select("id_linha", "nivel")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Subjects that at least two sentences of a record treat."""
    df, model = _topics(spark, sf)
    return subjects.subject_areas(df, "ID_LINHA", "DESC_ENUNCIADO", model).select("id_linha", "assunto")


def _topics(spark: SparkSession, sf: str) -> tuple[DataFrame, subjects.TopicModel]:
    df = texts(spark, sf, "pipeline", "ID_LINHA", "DESC_ENUNCIADO", "TX_IDIOMA")
    labels = table(spark, sf, "subject_labels", "id_linha", "assunto")
    sample = subjects.labelled_sample(df, "ID_LINHA", "DESC_ENUNCIADO", labels, "id_linha", "assunto", subjects.FIT_DOCUMENTS, "TX_IDIOMA")
    return df, subjects.fit_topics(spark, sample)


def p5_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Top terms of every topic, the subject it stands for, whether the inspection keeps it, and the records it is found in."""
    df, model = _topics(spark, sf)
    rows = [(j, None if model.map[j] is None else subjects.SUBJECTS[model.map[j]], " ".join(t), model.map[j] is not None) for j, t in model.top_terms().items()]
    found = subjects.subject_areas(df, "ID_LINHA", "DESC_ENUNCIADO", model).groupBy("assunto").agg(F.count(F.lit(1)).alias("n_registros"), F.round(F.avg("proporcao"), 4).alias("proporcao"))
    return spark.createDataFrame(rows, "topico int, assunto string, termos string, aceito boolean").join(found, "assunto", "left").select("topico", "assunto", "termos", "aceito", "n_registros", "proporcao")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Fields decoded, wholly or partly, with a wrong encoding."""
    fields = ["DESC_ENUNCIADO", "DESC_ALTER_C"]
    return encoding.garbled_fields(texts(spark, sf, "pipeline", "ID_LINHA", *fields), "ID_LINHA", fields).select("id_linha", "campo")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of records whose statements are alike to at least one half."""
    return near.alike_pairs(texts(spark, sf, "pipeline", "ID_LINHA", "DESC_ENUNCIADO"), "ID_LINHA", "DESC_ENUNCIADO", 0.5)


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every document."""
    return tokenize_bpe.encode_corpus(texts(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with at least twelve consecutive words of a test item."""
    docs, items = texts(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "eval_items", "item_id", "text")
    return leaks.leaked_passages(docs, "doc_id", "text", items, "item_id", "text").where(F.col("palavras_seguidas") >= leaks.RUN).select("doc_id", "item_id")


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of the documents, by type and position."""
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return personal.personal_spans(docs, "doc_id", "text", personal.fit_model(docs, "doc_id", "text")).select("doc_id", "tipo", "inicio")


def p1_repaired(spark: SparkSession, sf: str) -> DataFrame:
    """Fields whose text changed as continuous paragraphs, with running lines, broken, misread, torn and glued words counted."""
    fields = ["DESC_ENUNCIADO", "DESC_ALTER_A"]
    df = texts(spark, sf, "pipeline", "ID_LINHA", *fields)
    return scan.scan_traces(df, "ID_LINHA", fields, scan.fit_lexicon(df, fields))


def p2_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Every passage of both fields with its language and confidence."""
    fields = ["DESC_ENUNCIADO", "DESC_ALTER_A"]
    df = texts(spark, sf, "pipeline", "ID_LINHA", "TX_IDIOMA", *fields)
    return language.passages(df, "ID_LINHA", fields, language.fit_profile(df, "ID_LINHA", "TX_IDIOMA", "DESC_ENUNCIADO"))


def p3_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """Fields with unstable segments in their canonical form."""
    fields = ["DESC_ENUNCIADO", "DESC_ALTER_B"]
    return canonical.unstable_fields(texts(spark, sf, "pipeline", "ID_LINHA", *fields), "ID_LINHA", fields)


def p6_restored(spark: SparkSession, sf: str) -> DataFrame:
    """Garbled fields with the original text where it can be restored."""
    fields = ["DESC_ENUNCIADO", "DESC_ALTER_C"]
    return encoding.garbled_fields(texts(spark, sf, "pipeline", "ID_LINHA", *fields), "ID_LINHA", fields)


def p7_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Records of one question grouped over the whole bank, with the number of links of each."""
    return near.record_groups(texts(spark, sf, "pipeline", "ID_LINHA", "DESC_ENUNCIADO"), "ID_LINHA", "DESC_ENUNCIADO", 0.5)


def p9_report(spark: SparkSession, sf: str) -> DataFrame:
    """Verbatim leaks and edited copies with their alignment score and longest verbatim run."""
    docs, items = texts(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "eval_items", "item_id", "text")
    found = leaks.leaked_passages(docs, "doc_id", "text", items, "item_id", "text")
    kind = F.when(F.col("palavras_seguidas") >= leaks.RUN, "literal").when(F.col("pontos") >= leaks.EDITED, "editado")
    return found.withColumn("tipo", kind).where("tipo is not null")


def p10_masked(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with personal data replaced by typed placeholders."""
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return personal.masked_texts(docs, "doc_id", "text", personal.fit_model(docs, "doc_id", "text"))


QUERIES: dict[str, Query] = {
    "p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "p7_found": p7_found, "p8_ids": p8_ids, "p9_found": p9_found, "p10_found": p10_found,
    "p1_repaired": p1_repaired, "p2_passages": p2_passages, "p3_canonical": p3_canonical, "p5_topics": p5_topics, "p6_restored": p6_restored, "p7_groups": p7_groups, "p9_report": p9_report, "p10_masked": p10_masked,
}
SQL: dict[str, str] = {
    "p7_found": """WITH w AS (SELECT ID_LINHA AS id, regexp_extract_all(lower(DESC_ENUNCIADO), '[\\pL\\pN]+') AS w FROM pipeline WHERE DESC_ENUNCIADO IS NOT NULL),
        s AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS g FROM w WHERE len(w) >= 3),
        n AS (SELECT id, count(*) AS c FROM s GROUP BY id),
        p AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY ALL)
        SELECT id_a, id_b FROM p JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE i >= 0.5 * (x.c + y.c - i)""",
    "p9_found": """WITH t AS (SELECT doc_id AS id, 0 AS k, text FROM documents UNION ALL SELECT item_id, 1, text FROM eval_items),
        w AS (SELECT id, k, regexp_extract_all(strip_accents(lower(regexp_replace(text, '[\\x{AD}\\x{200B}-\\x{200F}\\x{2060}\\x{FEFF}]', '', 'g'))), '[\\pL\\pN]+') AS w FROM t WHERE text IS NOT NULL),
        s AS (SELECT DISTINCT id, k, unnest(list_transform(range(1, len(w) - 10), lambda j: array_to_string(w[j:j + 11], ' '))) AS g FROM w WHERE len(w) >= 12)
        SELECT DISTINCT a.id AS doc_id, b.id AS item_id FROM s a JOIN s b ON a.g = b.g AND a.k = 0 AND b.k = 1""",
}
