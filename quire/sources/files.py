"""Readers and writers of office tables and JSON lines; file bytes come from Spark's binaryFile reader, so any file system works."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


class SourceError(Exception):
    """A file that cannot be read as what it should be."""


def docx_rows(data: bytes) -> Iterator[tuple[int, int, list[str]]]:
    """(table, row, cell texts) of all tables in order, both from 1; a cell's paragraphs are lines."""
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml"))

    def text(paragraph: ElementTree.Element) -> str:
        marks = {f"{_W}t": lambda e: e.text or "", f"{_W}tab": lambda e: "\t", f"{_W}br": lambda e: "\n", f"{_W}cr": lambda e: "\n"}
        return "".join(marks[e.tag](e) for e in paragraph.iter() if e.tag in marks)

    for t, table in enumerate(body.iter(f"{_W}tbl"), 1):
        for r, row in enumerate(table.findall(f"{_W}tr"), 1):
            yield t, r, ["\n".join(text(p) for p in cell.findall(f"{_W}p")) for cell in row.findall(f"{_W}tc")]


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def xlsx_rows(data: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row, cell values as text) of all sheets in order; of formulas the stored result."""
    book = zipfile.ZipFile(io.BytesIO(data))
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in item.iter(f"{_S}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
    targets = {r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_S}sheet"):
        for row in ElementTree.fromstring(book.read("xl/" + targets[sheet.get(f"{_R}id")])).iter(f"{_S}row"):
            cells: dict[int, str | None] = {}
            for at, c in enumerate(row.findall(f"{_S}c")):
                value, kind = c.find(f"{_S}v"), c.get("t")
                if kind == "inlineStr":
                    found = "".join(t.text or "" for t in c.iter(f"{_S}t"))
                else:
                    found = None if value is None else shared[int(value.text)] if kind == "s" else value.text
                cells[_column(c.get("r")) if c.get("r") else at] = found
            yield sheet.get("name"), int(row.get("r")), [cells.get(i) for i in range(max(cells, default=-1) + 1)]


def _read(spark: SparkSession, path: str, parse: Callable[[bytes], Iterator[tuple]], schema: str, kinds: list[pa.DataType]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", *[p.split()[0] for p in schema.split(", ")]]
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = [(file.rsplit("/", 1)[-1], *r) for r in parse(content)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate([pa.string(), *kinds])], names=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, f"file string, {schema}")


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """(file, table_no, row_no, cells) of every row of every table."""
    return _read(spark, path, docx_rows, "table_no int, row_no int, cells array<string>", [pa.int32(), pa.int32(), pa.list_(pa.string())])


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """(file, sheet, excel_row, cells) of every row of every sheet."""
    return _read(spark, path, xlsx_rows, "sheet string, excel_row int, cells array<string>", [pa.string(), pa.int32(), pa.list_(pa.string())])


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line; a byte order mark and blank lines are skipped, anything else fails the read."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("value")).where(F.trim("value") != "")
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    return lines.select(F.when(F.trim("value").startswith("{"), parsed).otherwise(F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("value", 1, 80)))).alias("r")).select("r.*")


def write_jsonl(df: DataFrame, path: str, *, overwrite: bool = False) -> None:
    """One JSON object per line, nulls kept; an existing path is an error unless overwritten."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("ignoreNullFields", "false").json(path)


def read_pdf_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, page_index, block_index, line_index, text, x0, y0, x1, y1, page_width, page_height, font_size, bold, italic) where PyMuPDF is installed."""
    try:
        import pymupdf
    except ImportError as error:
        raise SourceError("reading PDF needs PyMuPDF, which is not installed; load a table of lines instead") from error

    def parse(data: bytes) -> Iterator[tuple]:
        for p, page in enumerate(pymupdf.open(stream=data, filetype="pdf")):
            for b, block in enumerate(page.get_text("dict")["blocks"]):
                for i, line in enumerate(block.get("lines", [])):
                    spans = line["spans"]
                    yield (p, b, i, "".join(s["text"] for s in spans), *map(float, line["bbox"]), page.rect.width, page.rect.height, max(float(s["size"]) for s in spans), any("bold" in s["font"].lower() or s["flags"] & 16 for s in spans), any(s["flags"] & 2 for s in spans))

    kinds = [pa.int32()] * 3 + [pa.string()] + [pa.float64()] * 7 + [pa.bool_()] * 2
    return _read(spark, path, parse, "page_index int, block_index int, line_index int, text string, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double, font_size double, bold boolean, italic boolean", kinds)
