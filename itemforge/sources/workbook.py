"""Workbooks as a Spark data source: every filled cell of every sheet is a row.

``spark.dataSource.register(WorkbookSource)``, then ``spark.read.format("itemforge_workbook").load(paths)`` with paths
separated by commas.  One workbook is one partition; a workbook that cannot be read gives one row with ``error``.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def column_number(ref: str) -> int:
    """Column of a reference such as ``AB7``, from 1."""
    n = 0
    for c in re.match(r"[A-Z]+", ref).group():
        n = 26 * n + ord(c) - 64
    return n


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_M}t"))


def workbook_cells(raw: bytes) -> Iterator[tuple[int, int, int, str]]:
    """(sheet, row, column, value) of all filled cells, sheets in workbook order, all numbered from 1."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        shared = [_text(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        sheets = ET.fromstring(z.read("xl/workbook.xml")).find(f"{_M}sheets")
        for number, sheet in enumerate(sheets, 1):
            target = targets[sheet.get(f"{_R}id")]
            path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            row_no = 0
            for row in ET.fromstring(z.read(path)).iter(f"{_M}row"):
                row_no = int(row.get("r") or row_no + 1)
                col_no = 0
                for cell in row.iter(f"{_M}c"):
                    col_no = column_number(cell.get("r")) if cell.get("r") else col_no + 1
                    kind, v = cell.get("t"), cell.find(f"{_M}v")
                    if kind == "inlineStr":
                        value = _text(cell)
                    elif v is None or v.text is None:
                        continue
                    else:
                        value = shared[int(v.text)] if kind == "s" else v.text
                    yield number, row_no, col_no, value


class WorkbookSource(DataSource):
    """Cells of workbooks."""

    @classmethod
    def name(cls) -> str:
        return "itemforge_workbook"

    def schema(self) -> str:
        return "path string, sheet_no int, row_no int, col_no int, value string, error string"

    def reader(self, schema) -> DataSourceReader:
        return WorkbookReader([p for p in self.options.get("path", "").split(",") if p])


class WorkbookReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path = partition.value
        try:
            with open(path.removeprefix("file:"), "rb") as f:
                for cell in workbook_cells(f.read()):
                    yield (path, *cell, None)
        except Exception as e:  # one bad workbook is reported, not fatal
            yield path, None, None, None, None, f"{type(e).__name__}: {e}"
