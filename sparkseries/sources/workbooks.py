"""Spreadsheet workbooks (.xlsx) as rows."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.project import rename_date
from .files import spreadsheet_frame
from .payloads import payload_kind

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_ROW_SCHEMA = "path STRING, row_number INT, header ARRAY<STRING>, cells ARRAY<STRING>"
_EPOCH = "1899-12-30"


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _sheet_rows(content: bytes, sheet: str | None) -> Iterator[list[str | None]]:
    """Rows of one worksheet as texts, the first sheet when none is named."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in root.findall(f"{_MAIN}si")]
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets")
        chosen = next((s for s in sheets if sheet is None or s.get("name") == sheet), None)
        if chosen is None:
            raise ValueError(f"no sheet {sheet!r}")
        links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = next(r.get("Target") for r in links if r.get("Id") == chosen.get(_REL))
        target = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        with book.open(target) as stream:
            for _event, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list[str | None] = []
                for cell in row.findall(f"{_MAIN}c"):
                    index = _column_index(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (index + 1 - len(cells)))
                    if cell.get("t") == "inlineStr":
                        cells[index] = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                        continue
                    value = cell.findtext(f"{_MAIN}v")
                    cells[index] = shared[int(value)] if cell.get("t") == "s" and value is not None else value
                yield cells
                row.clear()


def workbook_rows(files: DataFrame, sheet: str | None = None, batch_rows: int = 20_000) -> DataFrame:
    """(path, row_number, header, cells) of files given as (path, content); one workbook is one unit of work.

    The format allows about a million rows per sheet, and rows leave the task in batches.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = _sheet_rows(bytes(content), sheet)
                header = [(name or "").strip() for name in next(rows, [])]
                buffered = []
                for number, cells in enumerate(rows, start=1):
                    buffered.append((path, number, header, cells))
                    if len(buffered) >= batch_rows:
                        yield pd.DataFrame(buffered, columns=["path", "row_number", "header", "cells"])
                        buffered = []
                if buffered:
                    yield pd.DataFrame(buffered, columns=["path", "row_number", "header", "cells"])

    return files.select("path", "content").mapInPandas(parse, _ROW_SCHEMA)


def parse_workbooks(files: DataFrame, schema: str, sheet: str | None = None) -> DataFrame:
    """Workbooks as a frame with the fields of `schema`, matched to each file's header by name.

    A date cell may hold text or a day number. Values that do not fit their type become null.
    """
    fields = T.StructType.fromDDL(schema).fields
    rows = workbook_rows(files, sheet)
    columns = []
    for field in fields:
        position = F.array_position("header", F.lit(field.name)).cast("int")
        cell = F.when(position > 0, F.get("cells", position - 1))
        kind = field.dataType.simpleString()
        if kind == "date":
            days = F.floor(cell.try_cast("double")).cast("int")
            value = F.when(days > 9999, F.date_add(F.lit(_EPOCH).cast("date"), days)).otherwise(cell.try_cast("date"))
        else:
            value = cell.try_cast(kind) if kind != "string" else cell
        columns.append(value.alias(field.name))
    return rename_date(rows.select(*columns))


def read_workbooks(spark: SparkSession, path: str, schema: str, sheet: str | None = None) -> DataFrame:
    return parse_workbooks(spark.read.format("binaryFile").load(path).select("path", "content"), schema, sheet)


def payload_workbooks(payloads: DataFrame, schema: str, sheet: str | None = None) -> DataFrame:
    """Rows of the fetched payloads (url, content_type, body) that are workbooks."""
    books = payloads.where(payload_kind(F.col("content_type")) == "excel")
    return parse_workbooks(books.select(F.col("url").alias("path"), F.col("body").alias("content")), schema, sheet)


def read_spreadsheet_export(spark: SparkSession, path: str, schema: str, sheet: str | None = None) -> DataFrame:
    """A landed spreadsheet export as a series; failed reads are repeated by Spark's task retry."""
    return spreadsheet_frame(read_workbooks(spark, path, schema, sheet))
