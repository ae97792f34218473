"""Whole runs: one edition, consolidation of editions, text subset, report; and the command line."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.functions import scalar as S
from itemforge.operators import booklets, dictionary, publish
from itemforge.operators.summaries import match_rate
from itemforge.plans import extraction
from itemforge.session import ship

YEARS = tuple(range(2009, 2025))


def parse_years(arg: str) -> list[int]:
    """``all`` or ``*``, one year, ``a-b`` with both ends, or a list; ranges inside lists are refused."""
    arg = arg.strip().lower()
    if arg in ("all", "*"):
        return list(YEARS)
    if "-" in arg and "," in arg:
        raise ValueError(f"a list of years holds no ranges: {arg}")
    if "-" in arg:
        a, b = (int(x) for x in arg.split("-", 1))
        return list(range(a, b + 1))
    return [int(x) for x in arg.split(",") if x.strip()]


def parse_areas(arg: str) -> list[str]:
    """``all`` or ``*``, or a list of area codes in any case."""
    if arg.strip().lower() in ("all", "*"):
        return list(S.AREAS)
    areas = [a.strip().upper() for a in arg.split(",") if a.strip()]
    if bad := [a for a in areas if a not in S.AREAS]:
        raise ValueError(f"unknown areas: {bad}")
    return areas


def run_edition(items: DataFrame, cells: DataFrame, prints: DataFrame, catalogue: DataFrame, listing: DataFrame, questions: DataFrame, year: int, areas: list[str] | None = None) -> DataFrame:
    """Enriched items of one year; areas without codes or booklets give no rows.

    ``cells`` are dictionary cells, ``questions`` the extracted questions by booklet name.  Every booklet is extracted
    once, whatever the number of areas that use it.
    """
    wanted = [a.upper() for a in areas or S.AREAS]
    codes = dictionary.with_known_omissions(dictionary.exam_codes(cells.where(F.col("ano") == year), tuple(wanted)), items)
    codes = codes.where((F.col("ANO_APLICACAO") == year) & F.col("SG_AREA").isin(wanted)).withColumn("row_no", F.coalesce("row_no", F.lit(1_000_000)))
    selected = booklets.select_booklets(codes, prints.where(F.col("ano") == year), catalogue, listing)
    rows = publish.enforce_types(items).where(F.col("SG_AREA").isin(wanted))
    return publish.enrich(rows, selected, questions)


def consolidate(editions: dict[int, DataFrame]) -> DataFrame:
    """All editions in one frame, in year order, the year set from the edition even where a column says otherwise."""
    if not editions:
        raise RuntimeError("no edition to consolidate")
    frames = [publish.enforce_types(df.withColumn("ANO_APLICACAO", F.lit(y).cast("bigint"))) for y, df in sorted(editions.items())]
    return publish.canonical_order(publish.union_all(frames))


def report(df: DataFrame) -> DataFrame:
    """Match rate by year and area, and over all."""
    by = match_rate(df, ["ANO_APLICACAO", "SG_AREA"], F.col("DESC_ENUNCIADO"))
    whole = match_rate(df.withColumn("_all", F.lit(1)), ["_all"], F.col("DESC_ENUNCIADO")).drop("_all")
    return by.unionByName(whole, allowMissingColumns=True)


def read_booklets(spark: SparkSession, folder: Path, read, questions: str | None, prints: str | None, out: str) -> tuple[DataFrame, DataFrame]:
    """(questions, booklets with covers): as given, or read from the booklet files and kept in ``out``."""
    if questions and prints:
        return read(questions), read(prints)
    listing = sorted(p for p in folder.rglob("*") if p.suffix.lower() == ".pdf")
    if not listing:
        raise FileNotFoundError(f"no booklets in {folder}")
    found, covers = extraction.extract(spark, [str(p) for p in listing])
    parents = spark.createDataFrame([(p.name, p.parent.name) for p in listing], "name string, parent_name string").dropDuplicates(["name"])
    if not questions:
        found.write.mode("overwrite").parquet(f"{out}/questions")
    covers.join(parents, "name").write.mode("overwrite").parquet(f"{out}/booklets")
    return read(questions or f"{out}/questions"), read(prints or f"{out}/booklets")


def main(argv: list[str] | None = None) -> int:
    """Command line: put folders in order, write the text subset, or build the bank; one bad year does not stop the rest."""
    from itemforge.sources import folders, items as item_files
    from itemforge.sources.workbook import WorkbookSource

    p = argparse.ArgumentParser(prog="itemforge")
    p.add_argument("--year", default="all")
    p.add_argument("--area", default="all")
    p.add_argument("--organize", action="store_true", help="plan the order of raw folders")
    p.add_argument("--apply", action="store_true", help="carry the plan out")
    p.add_argument("--text-subset", action="store_true", help="write the text subset of the bank")
    p.add_argument("--base-dir", type=Path, default=Path("."))
    p.add_argument("--output-dir", type=Path, default=Path("out"))
    p.add_argument("--questions", help="Parquet folder of extracted questions; without it the booklet files are read")
    p.add_argument("--catalogue", help="Parquet folder of the file catalogue")
    p.add_argument("--booklets", help="Parquet folder of booklets with covers; without it the booklet files are read")
    a = p.parse_args(argv)
    if a.organize:
        for r in folders.plan_all(a.base_dir):
            print(r["year"], r["status"], len(r["actions"]), "applied" if a.apply and folders.apply_plan(r["actions"]) >= 0 else "planned")
        return 0
    spark = SparkSession.builder.appName("itemforge").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    bank = str(a.output_dir / "bank")
    if a.text_subset:
        item_files.write_csv(publish.text_subset(item_files.read_bank(spark, bank)), str(a.output_dir / "text_subset"))
        return 0
    spark.dataSource.register(WorkbookSource)
    years, areas, failed = parse_years(a.year), parse_areas(a.area), 0
    read = lambda p: spark.read.parquet(p)
    for year in years:
        try:
            found = folders.locate(a.base_dir, year)
            cells = spark.read.format("itemforge_workbook").load(str(found.dictionary)).where("error is null").withColumn("ano", F.lit(year).cast("bigint"))
            questions, listed = read_booklets(spark, found.booklets, read, a.questions, a.booklets, str(a.output_dir / "extracted" / str(year)))
            listed = listed.withColumn("ano", F.lit(year).cast("bigint"))
            prints = booklets.fingerprint(listed).withColumn("ano", F.lit(year).cast("bigint"))
            catalogue = read(a.catalogue) if a.catalogue else spark.createDataFrame([], "ano bigint, app string, day int, color string, filename string")
            edition = run_edition(item_files.read_items(spark, str(found.items)), cells, prints, catalogue, listed, questions, year, areas)
            item_files.write_bank(edition, bank)
            report(item_files.read_bank(spark, bank, [year])).show(truncate=False)
        except Exception as e:  # reported; the other years go on
            failed += 1
            print(f"{year}: {type(e).__name__}: {e}", file=sys.stderr)
    return 1 if failed else 0
