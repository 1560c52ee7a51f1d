"""CSV and Excel files as numbered rows of text cells, any mix of headers in one plan."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.session import stage
from feedmill.sources import csv_records
from feedmill.sources.listing import relative

# Cell texts that mean "no value".
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
CELLS = "file_name string, row_no bigint, cells array<string>, error string"


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def csv_parts(spark: SparkSession, landing: str, files: list[str]) -> DataFrame:
    """The lines of the CSV files, staged; ``csv_cells`` makes rows of them."""
    return stage(csv_records.split_parts(spark, [f"{landing.rstrip('/')}/{f}" for f in files]), "csv-lines")


def csv_cells(parts: DataFrame, landing: str) -> DataFrame:
    """All rows of the CSV files behind ``parts``, header included as row 1."""
    return csv_records.split_cells(csv_records.records(parts)).select(
        relative(_decoded(F.col("file")), landing).alias("file_name"), "row_no", "cells",
        F.lit(None).cast("string").alias("error"),
    )


# -- Excel ------------------------------------------------------------------------

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Built-in number formats that show dates.
_DATE_FORMATS = set(range(14, 23)) | set(range(45, 48))
_ROWS_PER_BATCH = 5000


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        index = index * 26 + ord(letter) - 64
    return index - 1


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in root.iter(f"{_MAIN}si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId")) for f in root.iter(f"{_MAIN}numFmt")
        if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")), re.I)
    }
    styles = root.find(f"{_MAIN}cellXfs")
    found = set()
    for i, style in enumerate(styles if styles is not None else []):
        if int(style.get("numFmtId", 0)) in _DATE_FORMATS | custom:
            found.add(i)
    return found


def _first_sheet(book: zipfile.ZipFile) -> str:
    workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
    relation = next(workbook.iter(f"{_MAIN}sheet")).get(f"{_REL}id")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(e.get("Target") for e in links if e.get("Id") == relation)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _cell_text(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    value = cell.find(f"{_MAIN}v")
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "True" if value.text == "1" else "False"
    if kind is None and int(cell.get("s", 0)) in dates:
        return str(pd.Timestamp("1899-12-30") + pd.to_timedelta(round(float(value.text) * 86400), unit="s"))
    return value.text


def sheet_rows(content: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells) of the first sheet, streamed from its XML."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared, dates = _shared_strings(book), _date_styles(book)
        with book.open(_first_sheet(book)) as sheet:
            number = 0
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_MAIN}row":
                    continue
                number += 1
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    at = _column_index(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (at + 1 - len(cells)))
                    cells[at] = _cell_text(cell, shared, dates)
                row.clear()
                yield number, cells


def _read_workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for name, content in zip(batch["file_name"], batch["content"]):
            held: list[tuple] = []
            try:
                for number, cells in sheet_rows(content):
                    held.append((name, number, cells, None))
                    if len(held) >= _ROWS_PER_BATCH:
                        yield pd.DataFrame(held, columns=["file_name", "row_no", "cells", "error"])
                        held = []
            except Exception as error:  # one unreadable workbook must not stop the others
                held.append((name, 0, None, f"{type(error).__name__}: {error}"))
            if held:
                yield pd.DataFrame(held, columns=["file_name", "row_no", "cells", "error"])


def excel_cells(spark: SparkSession, landing: str, files: list[str]) -> DataFrame:
    """Rows of the first sheet of each workbook; one task per workbook."""
    paths = [f"{landing.rstrip('/')}/{f}" for f in files]
    books = spark.read.format("binaryFile").load(paths).select(
        relative(F.col("path"), landing).alias("file_name"), "content"
    )
    return workbook_cells(books.repartition(len(files), "file_name"))


def workbook_cells(books: DataFrame) -> DataFrame:
    """Rows of (file_name, content) workbooks."""
    return books.select("file_name", "content").mapInPandas(_read_workbooks, CELLS)


# -- header to object ---------------------------------------------------------------

def column_names(header: Column) -> Column:
    """Header cells as unique field names; blanks and repeats get a suffix."""
    plain = F.transform(
        header,
        lambda h, i: F.when(
            F.coalesce(h, F.lit("")) == "", F.concat(F.lit("Unnamed: "), i.cast("string"))
        ).otherwise(F.regexp_replace(h, "^﻿", "")),
    )
    return F.transform(
        plain,
        lambda name, i: F.concat(
            name,
            F.when(
                F.size(F.filter(F.slice(plain, F.lit(1), i), lambda p: p == name)) > 0,
                F.concat(F.lit("."), F.size(F.filter(F.slice(plain, F.lit(1), i), lambda p: p == name)).cast("string")),
            ).otherwise(""),
        ),
    )


def used_width(cells: Column) -> Column:
    """Position of the last cell holding something."""
    filled = F.transform(cells, lambda c, i: F.when(c.isNotNull() & (c != ""), i + 1).otherwise(0))
    return F.coalesce(F.array_max(filled), F.lit(0))


def row_json(names: Column, cells: Column) -> Column:
    """Object of one row as JSON text: every value text or null."""
    width = F.size(names)
    padded = F.slice(F.concat(cells, F.array_repeat(F.lit(None).cast("string"), width)), F.lit(1), width)
    clean = F.transform(padded, lambda c: F.when(~c.isin(NULL_TOKENS), c))
    return F.to_json(F.map_from_arrays(names, clean))
