"""Item files: delimited text in, delimited text and Parquet out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.operators.publish import canonical_order, enforce_types


def sniff_delimiter(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> str:
    """``;`` or ``,``, whichever the first line holds more of."""
    head = spark.read.option("encoding", encoding).text(path).limit(1).collect()
    line = head[0][0] if head else ""
    return "," if line.count(",") > line.count(";") else ";"


def read_items(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", typed: bool = True) -> DataFrame:
    """An item file with any known and unknown columns; texts with line ends, quotes and backslashes survive.

    All columns are read as text and known ones converted, so that one bad value makes a null and not a failure.
    """
    df = spark.read.csv(path, sep=sniff_delimiter(spark, path, encoding), header=True, encoding=encoding, multiLine=True, quote='"', escape='"', nullValue="", emptyValue="")
    df = df.toDF(*[c.lstrip("\ufeff").strip() for c in df.columns])
    return enforce_types(df) if typed else df


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """An enriched file of this engine: UTF-8, a byte order mark is skipped."""
    return read_items(spark, path, encoding="UTF-8")


def write_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """Export as one delimited file in a folder (the system of record is Parquet, written in parallel).

    With ``bom`` the header's first name carries the byte order mark that spreadsheet programs look for.
    """
    ordered = canonical_order(df)
    if bom and ordered.columns:
        ordered = ordered.withColumnRenamed(ordered.columns[0], "\ufeff" + ordered.columns[0])
    ordered.coalesce(1).write.mode("overwrite").csv(path, sep=";", header=True, quote='"', escape='"', emptyValue="", nullValue="", encoding="UTF-8")


def write_bank(df: DataFrame, path: str) -> None:
    """The bank as Parquet, one folder a year and area; only the years and areas in ``df`` are replaced.

    Rows are spread by year, area and booklet before the write, so that a large year is not written by one task.
    """
    spread = canonical_order(df).repartition("ANO_APLICACAO", "SG_AREA", F.pmod(F.xxhash64("CO_PROVA"), F.lit(16)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ANO_APLICACAO", "SG_AREA").parquet(path)


def read_bank(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """The bank, pruned to the folders of the wanted years."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return canonical_order(df.where(F.col("ANO_APLICACAO").isin(years)) if years else df)
