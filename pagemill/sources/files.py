"""Sources: JSON lines of pages, chunks and manifests, plain text, CSV, spreadsheets and word files.

JSON, CSV and text are Spark's own readers. Office files are zip archives of XML and read from ``binaryFile`` rows in
vectorised functions, one file per row, with the standard library alone.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill import schemas
from pagemill.functions.text import collapse_newlines, decode_bytes, strip

_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages from JSON lines: blank and broken lines are left out, page numbers may be strings, a missing text is empty."""
    raw = spark.read.schema("source_id string, page string, text string, parser string, _corrupt_record string").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    good = raw.filter("_corrupt_record is null and page is not null")
    return good.select("source_id", F.expr("try_cast(page as int)").alias("page"), F.coalesce("text", F.lit("")).alias("text"), "parser")


def read_registry(spark: SparkSession, path: str, sheet: str = "source_registry") -> DataFrame:
    """The source registry (source_id, file_path, format) from Parquet, CSV or a sheet of a workbook; other columns are left out, missing ones are null."""
    if path.lower().endswith(".xlsx"):
        cells = read_sheets(spark, path).filter(F.col("sheet") == sheet)
        names = cells.filter("row_idx = 0").select("source_id", F.col("cells").alias("names"))
        rows = cells.filter("row_idx > 0").join(F.broadcast(names), "source_id").select(F.map_from_arrays("names", "cells").alias("m"), "row_idx")
        return rows.select(*(F.try_element_at("m", F.lit(c)).alias(c) for c in ("source_id", "file_path", "format")))
    raw = spark.read.option("header", True).csv(path) if path.lower().endswith(".csv") else spark.read.parquet(path)
    return raw.select(*((F.col(c).cast("string") if c in raw.columns else F.lit(None).cast("string")).alias(c) for c in ("source_id", "file_path", "format")))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks from JSON lines; any broken line fails the read."""
    return spark.read.schema(schemas.CHUNKS).option("mode", "FAILFAST").json(path)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).json(path)


def _source_id(column: str = "path"):
    return F.regexp_extract(column, r"([^/]+?)(?:\.[^./]*)?$", 1)


def read_texts(spark: SparkSession, path: str, detect: bool = False) -> DataFrame:
    """Whole text files as one page each; invalid bytes become U+FFFD (with ``detect``, files that are not UTF-8 are read as old Cyrillic ones), runs of empty lines one."""
    files = spark.read.format("binaryFile").load(path)
    text = collapse_newlines(decode_bytes(F.col("content")) if detect else F.make_valid_utf8(F.col("content")))
    return files.select(_source_id().alias("source_id"), F.lit(1).alias("page"), text.alias("text"), F.lit("api_native_txt").alias("parser"))


def head_names(names: list[str | None]) -> list[str]:
    """Column names of a head row: blanks are ``Unnamed: i``, repeats get ``.1``, ``.2`` and so on."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for i, name in enumerate(names):
        name = name if name and name.strip() else f"Unnamed: {i}"
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}.{n}" if n else name)
    return out


def _cells(rows: list[list[str]]) -> Iterator[tuple[int, list[str]]]:
    if rows:
        width = max(map(len, rows))
        yield 0, head_names([*rows[0], *[""] * (width - len(rows[0]))])
        for i, row in enumerate(rows[1:], 1):
            yield i, row + [""] * (width - len(row))


def _csv_rows(content: bytes) -> list[list[str]]:
    import csv

    return [row for row in csv.reader(io.StringIO(content.decode("utf-8-sig", "replace"))) if row]


def xlsx_sheets(content: bytes) -> Iterator[tuple[str, list[list[str]]]]:
    """Name and rows of every sheet, in tab order."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{_SHEET}t")))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_SHEET}sheet"):
            target = links[sheet.get(_REL)].lstrip("/")
            rows: list[list[str]] = []
            for row in ElementTree.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{_SHEET}row"):
                cells: list[str] = []
                for cell in row.iter(f"{_SHEET}c"):
                    letters = re.match("[A-Z]*", cell.get("r") or "")[0]
                    at = sum((ord(c) - 64) * 26**i for i, c in enumerate(reversed(letters))) - 1 if letters else len(cells)
                    value = cell.findtext(f"{_SHEET}v") or "".join(t.text or "" for t in cell.iter(f"{_SHEET}t"))
                    cells += [""] * (at + 1 - len(cells))
                    cells[at] = shared[int(value)] if cell.get("t") == "s" and value else value
                rows.append(cells)
            yield sheet.get("name"), rows


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    """Cells of CSV and XLSX files: source_id, sheet_idx, sheet, row_idx (0: head), cells. A file that can't be read has none."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for source, path_, content in zip(frame["source_id"], frame["path"], frame["content"]):
                try:
                    sheets = [("Sheet1", _csv_rows(content))] if path_.lower().endswith(".csv") else list(xlsx_sheets(content))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                    continue
                out += [(source, i, name, at, cells) for i, (name, rows) in enumerate(sheets) for at, cells in _cells(rows)]
            yield pd.DataFrame(out, columns=["source_id", "sheet_idx", "sheet", "row_idx", "cells"])

    files = spark.read.format("binaryFile").load(path).filter(F.lower("path").rlike(r"\.(csv|xlsx)$"))
    return files.select(_source_id().alias("source_id"), "path", "content").mapInPandas(run, schemas.CELLS)


def docx_text(content: bytes, with_tables: bool = True) -> str:
    """Paragraphs by blank lines, then tables as pipe rows without blank ones; without tables, paragraphs by line ends."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_WORD}body")

    def text(node) -> str:
        return "".join("\t" if n.tag == f"{_WORD}tab" else "\n" if n.tag == f"{_WORD}br" else n.text or "" for n in node.iter() if n.tag in (f"{_WORD}t", f"{_WORD}tab", f"{_WORD}br"))

    paragraphs = [t for p in body.findall(f"{_WORD}p") if (t := text(p).strip())]
    if not with_tables:
        return "\n".join(paragraphs)
    rows = []
    for row in body.iter(f"{_WORD}tr"):
        cells = [" ".join(text(p) for p in c.findall(f"{_WORD}p")).strip().replace("|", "\\|") for c in row.findall(f"{_WORD}tc")]
        if any(cells):
            rows.append("| " + " | ".join(cells) + " |")
    return "\n\n".join(paragraphs + (["\n".join(rows)] if rows else []))


def rtf_text(content: bytes) -> str:
    """Text of an RTF file: groups of fonts, colours, styles and pictures left out, unicode and code-page escapes decoded."""
    data = content.decode("latin-1")
    page = re.search(r"\\ansicpg(\d+)", data)
    codec = f"cp{page[1]}" if page else "cp1251"
    out: list[str] = []
    stack: list[tuple[bool, int]] = []
    hidden, skip, left = False, 1, 0
    for m in re.finditer(r"\\'([0-9a-fA-F]{2})|\\([a-z]+)(-?\d+)? ?|\\(.)|([{}])|([^\\{}\r\n]+)", data):
        hex_, word, number, sign, brace, plain = m.groups()
        if brace == "{":
            stack.append((hidden, skip))
        elif brace == "}":
            hidden, skip = stack.pop() if stack else (False, 1)
        elif sign == "*" or word in ("fonttbl", "colortbl", "stylesheet", "pict", "info", "header", "footer"):
            hidden = True
        elif word == "uc":
            skip = int(number or 1)
        elif hidden:
            continue
        elif word == "u" and number:
            out.append(chr(int(number) % 0x10000))
            left = skip
        elif hex_:
            if left:
                left -= 1
            else:
                out.append(bytes([int(hex_, 16)]).decode(codec, "ignore"))
        elif word in ("par", "line", "row"):
            out.append("\n")
        elif word in ("tab", "cell"):
            out.append("\t")
        elif sign and sign in "\\{}":
            out.append(sign)
        elif plain:
            out.append(plain[left:])
            left = max(0, left - len(plain))
    return "".join(out)


def read_office(spark: SparkSession, path: str, with_tables: bool = True) -> DataFrame:
    """DOCX and RTF files as one page each: source_id, page, text, parser. Unreadable files have an empty text."""
    @F.pandas_udf("string")
    def extract(paths: pd.Series, contents: pd.Series) -> pd.Series:
        def one(path_: str, content: bytes) -> str:
            try:
                return rtf_text(content) if path_.lower().endswith(".rtf") else docx_text(content, with_tables)
            except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, LookupError):
                return ""
        return pd.Series([one(p, c) for p, c in zip(paths, contents)], dtype=object)

    files = spark.read.format("binaryFile").load(path).filter(F.lower("path").rlike(r"\.(docx|rtf)$"))
    parser = F.when(F.lower("path").endswith(".rtf"), "api_native_rtf").otherwise("api_native_docx")
    return files.select(_source_id().alias("source_id"), F.lit(1).alias("page"), collapse_newlines(strip(extract("path", "content"))).alias("text"), parser.alias("parser"))
