"""Dictionaries from XLSX sheets. A sheet is read by one task, row by row; dictionaries are small."""

from __future__ import annotations

import io
import json
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
# fixed values: the sheet's name, and the columns without which an entry is none
SHEET = "KPI_Dictionary"
REQUIRED = ["KPI_Code", "Variable_Name", "Definition"]
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(reference: str) -> int:
    n = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _part_of(book: zipfile.ZipFile, sheet: str) -> str:
    """The part that holds the sheet of that name."""
    sheets = {s.get("name"): s.get(_LINK) for s in ET.fromstring(book.read("xl/workbook.xml")).iter(f"{_NS}sheet")}
    if sheet not in sheets:
        raise ValueError(f"no sheet {sheet!r} (found: {sorted(sheets)})")
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    target = targets[sheets[sheet]]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


_NUMBER = re.compile(r"-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?")


def _literal(kind: str | None, text: str) -> str:
    """The cell's value as JSON: numbers and booleans stay what they are."""
    if kind == "b":
        return "true" if text == "True" else "false"
    return text if kind in (None, "n") and _NUMBER.fullmatch(text) else json.dumps(text)


def sheet_cells(data: bytes, sheet: str = SHEET) -> Iterator[tuple[int, int, str, str]]:
    """(row, column, text, JSON value) of the cells that aren't empty; shared and inline strings are
    resolved. Rows are parsed one by one."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        part = _part_of(book, sheet)
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in item.iter(f"{_NS}t")) for item in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
        rows = (e for _, e in ET.iterparse(book.open(part)) if e.tag == f"{_NS}row")
        for i, row in enumerate(rows):
            for cell in row.iter(f"{_NS}c"):
                kind, value = cell.get("t"), cell.find(f"{_NS}v")
                if kind == "inlineStr":
                    text = "".join(t.text or "" for t in cell.iter(f"{_NS}t"))
                elif value is None or value.text is None:
                    continue
                else:
                    text = shared[int(value.text)] if kind == "s" else value.text
                if kind == "b":
                    text = str(text.strip() == "1")
                if text.strip():
                    yield int(row.get("r", i + 1)), _column(cell.get("r", "A1")), text.strip(), _literal(kind, text.strip())
            row.clear()


def cells(spark: SparkSession, path: str, sheet: str = SHEET) -> DataFrame:
    """``file, row, column, text, value`` (as JSON) of one sheet of each workbook; one without it is an error."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(p, *cell) for p, c in zip(pdf["path"], pdf["content"]) for cell in sheet_cells(bytes(c), sheet)]
            yield pd.DataFrame(rows, columns=["file", "row", "column", "text", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "file string, row long, column long, text string, value string")


def dictionary(spark: SparkSession, path: str, required: list[str] | None = None, sheet: str = SHEET) -> DataFrame:
    """``file, row, entry`` of the rows below the header, entry a map from header to text (headers as
    they are written, stripped), with ``source_row``, a variant of all columns in which numbers and
    booleans stay what they are and empty cells are null, and ``embedding_text``. Fails
    when the sheet, a required header or any row is missing, when a row lacks a required value, or when
    a code occurs twice."""
    required = REQUIRED if required is None else required
    found = cells(spark, path, sheet)
    first = found.groupBy("file").agg(F.min("row").alias("top"))
    placed = found.join(F.broadcast(first), "file")
    headers = placed.where("row = top").select("file", "column", F.col("text").alias("name"))
    named = placed.where("row > top").join(F.broadcast(headers), ["file", "column"])
    given = F.collect_list(F.struct("name", "text"))
    values = F.map_from_entries(F.collect_list(F.struct("name", "value")))
    rows = named.groupBy("file", "row").agg(F.map_from_entries(given).alias("entry"), values.alias("values"))
    columns = headers.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("column", "name"))).alias("columns"))
    field = lambda c: F.concat(F.regexp_extract(F.to_json(F.array(c["name"])), r"^\[(.*)\]$", 1), F.lit(":"), F.coalesce(F.try_element_at("values", c["name"]), F.lit("null")))
    as_json = F.concat(F.lit("{"), F.array_join(F.transform("columns", field), ","), F.lit("}"))
    rows = rows.join(F.broadcast(columns), "file").withColumn("source_row", F.parse_json(as_json)).drop("columns", "values")
    missing = set(required) - {r.name for r in headers.select("name").distinct().collect()}
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    code, absent = F.col("entry")[required[0]], F.lit(False)
    for name in required:
        absent = absent | F.col("entry")[name].isNull()
    total, codes, nameless = rows.agg(F.count(F.lit(1)), F.count_distinct(F.struct("file", code)), F.count_if(absent)).first()
    if not total:
        raise ValueError("no rows")
    if nameless:
        raise ValueError(f"{nameless} rows without a required value")
    if codes < total:
        raise ValueError("a code occurs twice")
    text = F.concat(F.col("entry")["Variable_Name"], F.lit(": "), F.col("entry")["Definition"])
    return rows.withColumn("embedding_text", text)
