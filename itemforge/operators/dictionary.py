"""Code dictionaries: cells of a workbook -> exam codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemforge.functions import scalar as S

#: Codes that the published dictionaries leave out (area MT, second call, grey) by year.
KNOWN_OMISSIONS = {2011: 136, 2012: 156, 2013: 186, 2014: 214}
NEXT_VARIABLE = r"^\s*(CO_|TX_|TP_|IN_|NU_|SG_)"


def code_rows(cells: DataFrame, areas: tuple[str, ...] = S.AREAS) -> DataFrame:
    """(ano, sheet_no, row_no, sg_area, code, text): rows of each area's block that hold a code and a text after it.

    A block runs from the first row with the area's variable to the row before the next one whose first cell begins a
    variable.  The code is the first cell that is a whole number from 1 to 99999, the text the next non-empty cell.
    """
    cell = F.struct("col_no", "value")
    filled = cells.where(F.col("value").isNotNull())
    rows = filled.groupBy("ano", "sheet_no", "row_no").agg(F.array_sort(F.collect_list(cell)).alias("c"))
    targets = F.array(*[F.lit(a) for a in areas])
    named = filled.select("ano", "sheet_no", "row_no", F.explode(F.filter(targets, lambda a: F.upper("value").contains(F.concat(F.lit("CO_PROVA_"), a)))).alias("sg_area"))
    starts = named.groupBy("ano", "sheet_no", "sg_area").agg(F.min("row_no").alias("begin"))
    breaks = rows.where(F.upper(F.element_at("c", 1)["value"]).rlike(NEXT_VARIABLE)).select("ano", "sheet_no", F.col("row_no").alias("stop"))
    ends = starts.join(breaks, ["ano", "sheet_no"], "left").groupBy("ano", "sheet_no", "sg_area", "begin").agg(F.min(F.when(F.col("stop") > F.col("begin"), F.col("stop"))).alias("end"))
    inside = rows.join(ends, ["ano", "sheet_no"]).where((F.col("row_no") >= F.col("begin")) & (F.col("end").isNull() | (F.col("row_no") < F.col("end"))))
    number = lambda x: S.safe_long(x["value"])
    codes = F.filter("c", lambda x: number(x).between(1, 99999))
    found = inside.withColumn("_code", F.try_element_at(codes, F.lit(1)))
    texts = F.filter("c", lambda x: (x["col_no"] > F.col("_code.col_no")) & (S.strip(x["value"]) != ""))
    return (
        found.withColumn("_text", F.try_element_at(texts, F.lit(1)))
        .where(F.col("_code").isNotNull() & F.col("_text").isNotNull())
        .select("ano", "sheet_no", "row_no", "sg_area", S.safe_long(F.col("_code.value")).alias("code"), S.strip(F.col("_text.value")).alias("text"))
    )


def exam_codes(cells: DataFrame, areas: tuple[str, ...] = S.AREAS) -> DataFrame:
    """(ANO_APLICACAO, SG_AREA, CO_PROVA, TX_COR, TP_APLICACAO, DESC_ORIGINAL, sheet_no, row_no) of regular exams.

    Adapted exams and rows without a colour drop; of each year and area only the first sheet with a record counts.
    """
    low = F.lower("text")
    rows = code_rows(cells, areas).where(~S.contains_any(low, S.ADAPTED_WORDS)).withColumn("TX_COR", S.described_colour(F.col("text"))).where("TX_COR is not null")
    first = rows.groupBy("ano", "sg_area").agg(F.min("sheet_no").alias("sheet_no"))
    return rows.join(first, ["ano", "sg_area", "sheet_no"], "left_semi").select(
        F.col("ano").alias("ANO_APLICACAO"), F.col("sg_area").alias("SG_AREA"), F.col("code").alias("CO_PROVA"), "TX_COR",
        F.when(S.contains_any(low, S.SECOND_CALL_WORDS), "P2").otherwise("P1").alias("TP_APLICACAO"), F.col("text").alias("DESC_ORIGINAL"), "sheet_no", "row_no",
    )


def with_known_omissions(codes: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Codes with the known omissions of MT that they lack: those of 2011 to 2013 by year, any of them if items use it."""
    spark = codes.sparkSession
    known = spark.createDataFrame(
        [(y, "MT", c, "CINZA", "P2", "omitido do dicionário") for y, c in KNOWN_OMISSIONS.items()],
        "ANO_APLICACAO bigint, SG_AREA string, CO_PROVA bigint, TX_COR string, TP_APLICACAO string, DESC_ORIGINAL string",
    )
    have = codes.where("SG_AREA = 'MT'").select("CO_PROVA")
    years = codes.where("SG_AREA = 'MT'").select("ANO_APLICACAO").distinct()
    by_year = known.where("ANO_APLICACAO <= 2013").join(years, "ANO_APLICACAO", "left_semi")
    wanted = by_year
    if items is not None:
        used = items.where("SG_AREA = 'MT'").select(S.safe_long(F.col("CO_PROVA")).alias("CO_PROVA")).where("CO_PROVA is not null").distinct()
        wanted = by_year.unionByName(known.join(used, "CO_PROVA", "left_semi").select(known.columns)).dropDuplicates(["CO_PROVA"])
    return codes.unionByName(wanted.join(have, "CO_PROVA", "left_anti").select(known.columns), allowMissingColumns=True)
