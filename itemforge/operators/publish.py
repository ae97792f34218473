"""Enrichment, consolidation, subsets and summaries of the item bank."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemforge.functions import scalar as S
from itemforge.operators.lookup import language_fallback, resolve_position, small

#: Columns of the published bank in their order, with their kinds.
CANONICAL = (
    "ANO_APLICACAO", "CO_POSICAO", "SG_AREA", "CO_ITEM", "TX_GABARITO", "CO_HABILIDADE", "IN_ITEM_ABAN", "TX_MOTIVO_ABAN", "NU_PARAM_A", "NU_PARAM_B", "NU_PARAM_C",
    "TX_COR", "CO_PROVA", "TP_LINGUA", "IN_ITEM_ADAPTADO", "TP_VERSAO_DIGITAL", "TP_APLICACAO", "REF_ARQUIVO_PDF", "DESC_ENUNCIADO", "DESC_ALTER_A", "DESC_ALTER_B",
    "DESC_ALTER_C", "DESC_ALTER_D", "DESC_ALTER_E", "IN_ITEM_IMAGEM", "IN_ITEM_TABELA",
)
WHOLE = ("ANO_APLICACAO", "CO_POSICAO", "CO_ITEM", "CO_HABILIDADE", "IN_ITEM_ABAN", "CO_PROVA", "TP_LINGUA", "IN_ITEM_ADAPTADO", "TP_VERSAO_DIGITAL", "IN_ITEM_IMAGEM", "IN_ITEM_TABELA")
REAL = ("NU_PARAM_A", "NU_PARAM_B", "NU_PARAM_C")
TEXTS = ("DESC_ENUNCIADO", "DESC_ALTER_A", "DESC_ALTER_B", "DESC_ALTER_C", "DESC_ALTER_D", "DESC_ALTER_E")
CALLS = {"P1": "REGULAR", "P2": "REAPLICACAO_PPL"}


def enforce_types(df: DataFrame) -> DataFrame:
    """Known columns that are present get their kind; values that do not fit become null; other columns stay."""
    kinds = {c: S.safe_long for c in WHOLE} | {c: S.safe_double for c in REAL}
    return df.select(*[kinds[c](F.col(f"`{c}`")).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def canonical_order(df: DataFrame) -> DataFrame:
    """Canonical columns that are present first, then the others in their own order."""
    known = [c for c in CANONICAL if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in [*known, *[c for c in df.columns if c not in CANONICAL]]])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows, columns united; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def enrich(items: DataFrame, selected: DataFrame, questions: DataFrame) -> DataFrame:
    """Items of the selected booklets with the text and flags of their questions; no match gives empty texts and 0.

    ``selected``: ANO_APLICACAO, SG_AREA, TP_APLICACAO, CO_PROVA, REF_ARQUIVO_PDF (a few rows a year); ``questions``:
    REF_ARQUIVO_PDF, CO_POSICAO, TP_LINGUA, texts and flags, unique by these three.
    """
    chosen = selected.select("CO_PROVA", F.element_at(F.create_map(*[F.lit(x) for kv in CALLS.items() for x in kv]), F.col("TP_APLICACAO")).alias("TP_APLICACAO"), "REF_ARQUIVO_PDF", "ANO_APLICACAO")
    own = items.drop("TP_APLICACAO", "REF_ARQUIVO_PDF", "ANO_APLICACAO", *TEXTS, "IN_ITEM_IMAGEM", "IN_ITEM_TABELA")
    if "TP_LINGUA" not in own.columns:
        own = own.withColumn("TP_LINGUA", F.lit(None).cast("bigint"))
    placed = own.join(small(chosen), "CO_PROVA")
    placed = resolve_position(placed, questions.select("REF_ARQUIVO_PDF", "CO_POSICAO"), "REF_ARQUIVO_PDF", "CO_POSICAO")
    q = questions.withColumnRenamed("CO_POSICAO", "posicao_efetiva")
    values = [*TEXTS, "IN_ITEM_IMAGEM", "IN_ITEM_TABELA"]
    found = language_fallback(placed, q, "REF_ARQUIVO_PDF", "posicao_efetiva", "TP_LINGUA", values).drop("posicao_efetiva", "encontrado")
    filled = found.fillna("", list(TEXTS)).fillna(0, ["IN_ITEM_IMAGEM", "IN_ITEM_TABELA"])
    return enforce_types(canonical_order(filled))


def text_subset(df: DataFrame) -> DataFrame:
    """Items with a skill, not abandoned and without a picture; a null flag drops the row; a missing column is an error."""
    missing = [c for c in ("CO_HABILIDADE", "IN_ITEM_ABAN", "IN_ITEM_IMAGEM") if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the text subset: {missing}")
    return df.where(F.col("CO_HABILIDADE").isNotNull() & (F.col("IN_ITEM_ABAN") == 0) & (F.col("IN_ITEM_IMAGEM") == 0))


def consolidated_counts(df: DataFrame) -> DataFrame:
    """One row: items, items of each call, with picture, with table; 0 for a column that is missing."""
    tests = {"n_regular": ("TP_APLICACAO", "REGULAR"), "n_reaplicacao": ("TP_APLICACAO", "REAPLICACAO_PPL"), "n_imagem": ("IN_ITEM_IMAGEM", 1), "n_tabela": ("IN_ITEM_TABELA", 1)}
    counts = [F.count(F.when(F.col(c) == v, 1)).alias(n) if c in df.columns else F.lit(0).cast("bigint").alias(n) for n, (c, v) in tests.items()]
    return df.agg(F.count(F.lit(1)).alias("n_itens"), *counts)


def year_summary(df: DataFrame) -> DataFrame:
    """One row a year: items, items with a statement, rate, pictures, sorted areas."""
    text = F.count(F.when(F.col("DESC_ENUNCIADO") != "", 1))
    return df.groupBy("ANO_APLICACAO").agg(
        F.count(F.lit(1)).alias("n_itens"), text.alias("n_com_texto"), F.round(100.0 * text / F.count(F.lit(1)), 4).alias("pct"),
        F.coalesce(F.sum("IN_ITEM_IMAGEM"), F.lit(0)).alias("n_imagem"), F.array_join(F.array_sort(F.collect_set("SG_AREA")), ",").alias("areas"),
    )
