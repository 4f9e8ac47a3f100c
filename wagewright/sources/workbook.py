"""Sheets of workbooks (.xlsx) as rows of cells. A workbook is an archive of XML files; its rows are read one by one."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Namespaces of the parts of a workbook.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
CELLS = "path string, sheet string, row int, cells array<struct<text string, number double>>"
#: Rows that leave a task at once.
BATCH = 5000


def column_number(reference: str) -> int:
    """From 0: of A1 it is 0, of AB7 it is 27."""
    n = 0
    for letter in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(letter) - 64
    return n - 1


def _text(element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{MAIN}t"))


def _cell(c, shared: list[str]) -> tuple[str | None, float | None]:
    kind, value = c.get("t", "n"), c.findtext(f"{MAIN}v")
    if kind == "inlineStr":
        return _text(c), None
    if value is None:
        return None, None
    if kind == "s":
        return shared[int(value)], None
    if kind != "n":
        return value, None
    number = float(value)
    return str(int(number)) if number.is_integer() else value, number


def sheet_rows(content: bytes, wanted: list[str]) -> Iterator[tuple[str, int, list]]:
    """(sheet, number of the row from 1, cells) of the wanted sheets; cells without a value are None, rows end at their last."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = set(archive.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            with archive.open("xl/sharedStrings.xml") as part:
                for _, element in ElementTree.iterparse(part):
                    if element.tag == f"{MAIN}si":
                        shared.append(_text(element))
                        element.clear()
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(archive.read("xl/workbook.xml")).iter(f"{MAIN}sheet"):
            if sheet.get("name") not in wanted:
                continue
            target = targets[sheet.get(f"{LINK}id")]
            with archive.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as part:
                number = 0
                for _, row in ElementTree.iterparse(part):
                    if row.tag != f"{MAIN}row":
                        continue
                    number = int(row.get("r", number + 1))
                    cells: list = []
                    for c in row.iter(f"{MAIN}c"):
                        at = column_number(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (at - len(cells))
                        text, value = _cell(c, shared)
                        cells.append(None if text is None else {"text": text, "number": value})
                    yield sheet.get("name"), number, cells
                    row.clear()


def sheets_of(files: DataFrame, wanted: list[str]) -> DataFrame:
    """path, sheet, row, cells of workbooks given as path and content."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                for sheet, number, cells in sheet_rows(bytes(content), wanted):
                    rows.append((path, sheet, number, cells))
                    if len(rows) == BATCH:
                        yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells"])
                        rows = []
                yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells"])

    return files.select("path", "content").mapInPandas(read, CELLS)


def sheets(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """The same of the workbooks at path; one is read in one task."""
    return sheets_of(spark.read.format("binaryFile").load(path), wanted)


def cell(i: int):
    return F.get("cells", F.lit(i))
