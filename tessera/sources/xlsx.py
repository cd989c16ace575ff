"""Workbook sheets as DataFrames: an .xlsx file is a zip of XML parts."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from pathlib import Path
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

# Namespaces of the file format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def sheet_parts(path: str) -> dict[str, str]:
    """Sheet name -> part of the archive, in workbook order."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    with zipfile.ZipFile(path) as book:
        links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = {link.get("Id"): link.get("Target").removeprefix("/xl/") for link in links}
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")
        return {s.get("name"): f"xl/{target[s.get(f'{REL}id')]}" for s in sheets}


def _texts(element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{MAIN}t"))


def _column(reference: str) -> int:
    number = 0
    for letter in re.match("[A-Z]+", reference)[0]:
        number = number * 26 + ord(letter) - 64
    return number - 1


def sheet_rows(path: str, sheet: str) -> Iterator[list[str | None]]:
    """Rows as lists of text, streamed from the archive."""
    with zipfile.ZipFile(path) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_texts(s) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]
        with book.open(sheet_parts(path)[sheet]) as part:
            for _, row in ElementTree.iterparse(part):
                if row.tag != f"{MAIN}row":
                    continue
                values: list[str | None] = []
                for place, cell in enumerate(row.iter(f"{MAIN}c")):
                    at = _column(cell.get("r")) if cell.get("r") else place
                    values += [None] * (at + 1 - len(values))
                    kind, raw = cell.get("t"), cell.findtext(f"{MAIN}v")
                    if kind == "inlineStr":
                        values[at] = _texts(cell)
                    elif kind == "s" and raw is not None:
                        values[at] = shared[int(raw)]
                    else:
                        values[at] = raw
                yield values
                row.clear()


class SheetReader(DataSourceReader):
    """One task per sheet; the format itself limits a sheet to about a million rows."""

    def __init__(self, path: str, sheet: str, width: int):
        self.path, self.sheet, self.width = path, sheet, width

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        rows = sheet_rows(self.path, self.sheet)
        next(rows, None)
        for values in rows:
            if any(v not in (None, "") for v in values):
                yield tuple((values + [None] * self.width)[: self.width])


class XlsxSource(DataSource):
    """``spark.read.format("xlsx").option("sheet", name).load(path)``; the first row is the header."""

    @classmethod
    def name(cls):
        return "xlsx"

    def _header(self):
        header = next(sheet_rows(self.options["path"], self.options["sheet"]), [])
        return [name or f"column {i}" for i, name in enumerate(header)]

    def schema(self):
        return StructType([StructField(name, StringType()) for name in self._header()])

    def reader(self, schema):
        return SheetReader(self.options["path"], self.options["sheet"], len(schema.fields))


def read_workbook(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All sheets of a workbook by name, as text columns."""
    names = sheet_parts(path)
    spark.dataSource.register(XlsxSource)
    return {name: spark.read.format("xlsx").option("sheet", name).load(path) for name in names}
