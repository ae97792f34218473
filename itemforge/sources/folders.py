"""Folders of an edition: finding its inputs, and a plan for putting raw folders in order.

Nothing is moved by a query: the planner returns actions as rows, ``apply_plan`` carries them out when told to.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.operators.booklets import file_key

#: Folders searched, in order, for the inputs of a year.
ITEM_DIRS, DICTIONARY_DIRS = ("DADOS", "dados", "."), ("DICIONÁRIO", "DICIONARIO", "dicionario", ".")


@dataclass(frozen=True)
class Action:
    """One step of a plan: ``move``, ``rename`` or ``remove_dir``."""

    kind: str
    src: str
    dst: str


@dataclass(frozen=True)
class Inputs:
    items: Path
    dictionary: Path
    booklets: Path


def locate(root: Path, year: int) -> Inputs:
    """Item file, dictionary and booklet folder of a year; the first by folder order, then by name; missing is an error."""
    base = next((p for p in sorted(root.glob(f"*{year}*")) if p.is_dir()), None)
    if base is None:
        raise FileNotFoundError(f"no folder for {year} in {root}")

    def pick(dirs: tuple[str, ...], test, what: str) -> Path:
        places = [base / d for d in dirs] + sorted(p for p in base.iterdir() if p.is_dir())
        for place in dict.fromkeys(p for p in places if p.is_dir()):
            if found := sorted((p for p in place.iterdir() if test(p)), key=lambda p: p.name):
                return found[0]
        raise FileNotFoundError(f"no {what} for {year} in {base}")

    return Inputs(
        pick(ITEM_DIRS, lambda p: p.suffix.lower() == ".csv" and "ITENS" in p.name.upper(), "item file"),
        pick(DICTIONARY_DIRS, lambda p: p.suffix.lower() == ".xlsx" and not p.name.startswith("~$"), "dictionary"),
        pick((".",), lambda p: p.is_dir() and "PROVAS" in p.name.upper(), "booklet folder"),
    )


def list_booklets(spark: SparkSession, root: str) -> DataFrame:
    """(path, name, parent_name, length): all ``.pdf`` files below a folder, any case, each once; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(root).select("path", "length")
    parts = F.split("path", "/")
    return files.dropDuplicates(["path"]).select("path", F.element_at(parts, -1).alias("name"), F.element_at(parts, -2).alias("parent_name"), "length")


def find_files(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    """(name, path): for each wanted name the listed file of that name, whatever its case and doubled ending, nearest the top."""
    depth = F.size(F.split("path", "/"))
    best = listing.groupBy(file_key(F.col("name")).alias("_k")).agg(F.min_by("path", F.struct(depth.alias("d"), F.col("path").alias("p"))).alias("path"))
    return wanted.select("name").distinct().join(best, file_key(F.col("name")) == F.col("_k")).select("name", "path")


def plan_flatten(year_dir: Path, year: int) -> list[Action]:
    """Lift the content of a nested folder of the same year, one level of sub-folders merged; collisions stay in place."""
    nested = [p for p in sorted(year_dir.iterdir()) if p.is_dir() and str(year) in p.name]
    plan: list[Action] = []
    taken = {p.name for p in year_dir.iterdir()}
    for outer in nested[:1] if len(nested) == 1 else []:
        for child in sorted(outer.iterdir()):
            if child.name not in taken:
                plan.append(Action("move", str(child), str(year_dir / child.name)))
                taken.add(child.name)
            elif child.is_dir() and (year_dir / child.name).is_dir():
                there = {p.name for p in (year_dir / child.name).iterdir()}
                plan += [Action("move", str(p), str(year_dir / child.name / p.name)) for p in sorted(child.iterdir()) if p.name not in there]
    return plan


def plan_extensions(folder: Path) -> list[Action]:
    """Drop a doubled ``.pdf`` where the plain name is free."""
    plan = []
    for p in sorted(folder.rglob("*")):
        if p.is_file() and re.search(r"\.pdf\.pdf$", p.name, re.I) and not (dst := p.with_name(p.name[:-4])).exists():
            plan.append(Action("rename", str(p), str(dst)))
    return plan


def plan_names(prints: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(kind, src, dst): canonical names of second-day booklets that the catalogue knows and that bear another name.

    ``prints``: ano, path, name, app, color, day, cover_day.  A cover that contradicts the day, a name equal but for case
    and an occupied target give no action.
    """
    second = prints.where((F.col("day") == 2) & F.coalesce(F.col("cover_day") == 2, F.lit(True)))
    named = second.join(catalogue.select("ano", "app", "day", "color", "filename"), ["ano", "app", "day", "color"]).where(F.lower("name") != F.lower("filename"))
    held = prints.select(F.col("ano"), F.lower("name").alias("_l")).distinct()
    free = named.withColumn("_l", F.lower("filename")).join(held, ["ano", "_l"], "left_anti")
    folder = F.regexp_replace("path", r"[^/]+$", "")
    one = free.groupBy("filename", "ano").agg(F.min_by(F.struct("path", folder.alias("f")), "path").alias("r"))
    return one.select(F.lit("rename").alias("kind"), F.col("r.path").alias("src"), F.concat("r.f", "filename").alias("dst"))


def plan_year(year_dir: Path, year: int) -> dict:
    """Report of a dry run: status ``ok``, ``not_found`` or ``no_provas_dir``, and the actions."""
    if not year_dir.is_dir():
        return {"status": "not_found", "year": year, "actions": []}
    plan = plan_flatten(year_dir, year)
    folders = [p for p in sorted(year_dir.iterdir()) if p.is_dir() and "PROVA" in p.name.upper()]
    if not folders and not any("PROVA" in Path(a.dst).name.upper() for a in plan):
        return {"status": "no_provas_dir", "year": year, "actions": plan}
    return {"status": "ok", "year": year, "actions": plan + [a for f in folders for a in plan_extensions(f)]}


def plan_all(root: Path) -> list[dict]:
    """Reports of all year folders in name order; folders whose name ends in no year are skipped."""
    return [plan_year(p, int(m.group(1))) for p in sorted(root.iterdir()) if p.is_dir() and (m := re.search(r"((?:19|20)\d{2})$", p.name))]


def apply_plan(actions: list[Action]) -> int:
    """Carry out a plan without overwriting anything; returns the number of steps done."""
    done = 0
    for a in actions:
        src, dst = Path(a.src), Path(a.dst)
        if src.exists() and not dst.exists():
            dst.parent.mkdir(parents=True, exist_ok=True)
            src.rename(dst)
            done += 1
    return done
