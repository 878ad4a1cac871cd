"""Sales exports as workbooks: zipped XML sheets, read row by row."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree.ElementTree import iterparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from acreage.constants import HEADER_ROW_CANDIDATES
from acreage.operators.joins import lookup_join
from acreage.session import stage

#: Rows sent on at once.
ROWS = 10_000
#: Built-in number formats that show dates or times (fixed values).
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _name(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _elements(archive: zipfile.ZipFile, member: str, *names: str) -> Iterator:
    """Elements of some names as they close; each is emptied after use, so a long part takes little memory."""
    if member not in archive.namelist():
        return
    with archive.open(member) as part:
        for _, element in iterparse(part):
            if _name(element.tag) in names:
                yield element
                element.clear()


def _text(element) -> str:
    """Text of a string, plain or in runs; phonetic hints are no part of it."""
    out = []
    for child in element:
        kind = _name(child.tag)
        if kind == "t":
            out.append(child.text or "")
        elif kind == "r":
            out += [t.text or "" for t in child if _name(t.tag) == "t"]
    return "".join(out)


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Cell styles that show a number as a date."""
    custom, styles = set(), set()
    for element in _elements(archive, "xl/styles.xml", "numFmt", "cellXfs"):
        if _name(element.tag) == "numFmt":
            shown = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", element.get("formatCode", "")).lower()
            if re.search("[ymdhs]", shown):
                custom.add(int(element.get("numFmtId")))
        else:
            kinds = [int(x.get("numFmtId", 0)) for x in element if _name(x.tag) == "xf"]
            styles = {i for i, k in enumerate(kinds) if k in DATE_FORMATS or k in custom}
    return styles


def _date(number: float, base: dt.datetime) -> str:
    moment = base + dt.timedelta(seconds=round(number * 86_400))
    return moment.strftime("%Y-%m-%d" if moment.time() == dt.time() else "%Y-%m-%d %H:%M:%S")


def _column(place: str) -> int:
    """Number from 0 of the letters of a cell's place."""
    n = 0
    for c in place:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def sheets_of(archive: zipfile.ZipFile) -> tuple[list[tuple[str, str]], bool]:
    """Names of the sheets with their parts, in order, and whether dates count from 1904."""
    targets = {e.get("Id"): e.get("Target") for e in _elements(archive, "xl/_rels/workbook.xml.rels", "Relationship")}
    sheets, late = [], False
    for element in _elements(archive, "xl/workbook.xml", "sheet", "workbookPr"):
        if _name(element.tag) == "workbookPr":
            late = element.get("date1904", "0") in ("1", "true")
        else:
            target = targets[element.get(_RELATION)]
            sheets.append((element.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return sheets, late


def sheet_rows(archive: zipfile.ZipFile, part: str, late: bool) -> Iterator[tuple[int, list[str | None]]]:
    """(number from 0, cells) of the rows of a sheet; cells are text as shown, null where there is none."""
    shared = [_text(e) for e in _elements(archive, "xl/sharedStrings.xml", "si")]
    dates, base = _date_styles(archive), dt.datetime(1904, 1, 1) if late else dt.datetime(1899, 12, 30)
    number = -1
    for row in _elements(archive, part, "row"):
        number = int(row.get("r", number + 2)) - 1
        cells: list[str | None] = []
        for cell in row:
            at = _column(cell.get("r")) if cell.get("r") else len(cells)
            cells += [None] * (at + 1 - len(cells))
            kind, inner = cell.get("t", "n"), {_name(x.tag): x for x in cell}
            value = inner["v"].text if "v" in inner else None
            if kind == "inlineStr" and "is" in inner:
                cells[at] = _text(inner["is"])
            elif value is None:
                continue
            elif kind == "s":
                cells[at] = shared[int(value)]
            elif kind == "b":
                cells[at] = "true" if value == "1" else "false"
            elif kind == "n" and int(cell.get("s", 0)) in dates:
                cells[at] = _date(float(value), base)
            elif kind != "e":  # errors are missing values
                cells[at] = value
        yield number, cells


def workbook_rows(files: DataFrame, sheet: int | None = 0) -> DataFrame:
    """`(file, sheet, number, cells)` of workbooks given as rows (file, content); of all sheets with `sheet` null.

    A workbook is read by one task, its rows are streamed; null contents have no rows. What is no
    workbook is an error."""
    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                if not content.is_valid:
                    continue
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                    sheets, late = sheets_of(archive)
                    for name, part in sheets if sheet is None else sheets[sheet:sheet + 1]:
                        held = []
                        for row in sheet_rows(archive, part, late):
                            held.append(row)
                            if len(held) == ROWS:
                                yield _batch(file, name, held)
                                held = []
                        if held:
                            yield _batch(file, name, held)

    return files.select("file", "content").mapInArrow(run, "file string, sheet string, number long, cells array<string>")


def _batch(file: str, name: str, rows: list) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays([
        pa.array([file] * n), pa.array([name] * n), pa.array([r for r, _ in rows], pa.int64()),
        pa.array([c for _, c in rows], pa.list_(pa.string()))], ["file", "sheet", "number", "cells"])


def read_workbooks(
    spark: SparkSession, paths: list[str] | str, column: str = "SALE PRICE", sheet: int | None = 0,
    candidates: tuple[int, ...] = HEADER_ROW_CANDIDATES,
) -> DataFrame:
    """Workbooks under `paths`, read through Spark wherever they lie, as `concatenated` makes them one table."""
    files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), "content")
    return concatenated(workbook_rows(files, sheet), column, candidates)


def concatenated(rows: DataFrame, column: str = "SALE PRICE", candidates: tuple[int, ...] = HEADER_ROW_CANDIDATES) -> DataFrame:
    """The rows below each sheet's header as text under the union of the trimmed header names.

    The header is the first of the `candidates` (rows from 0, in order of preference) that names `column`; a sheet without
    one is an error. Rows without any cell are left out. Of columns of one name in a sheet the first counts.
    """
    rows = stage(rows, "sheets")
    preference = F.array_position(F.array(*[F.lit(c).cast("long") for c in candidates]), F.col("number"))
    named = F.transform("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))))
    fits = F.exists(named, lambda c: F.upper(c) == column.upper())
    first = Window.partitionBy("file", "sheet").orderBy("order")
    # a few rows of each sheet
    near = rows.withColumns({"order": preference, "names": named}).filter((preference > 0) & fits)
    headers = near.withColumn("nth", F.row_number().over(first)).filter("nth = 1").select("file", "sheet", F.col("number").alias("header"), "names")
    headers = stage(headers, "headers")
    # one row per sheet
    missing = rows.select("file", "sheet").distinct().join(headers, ["file", "sheet"], "left_anti").collect()
    if missing:
        raise ValueError(f"no {column!r} header in {sorted(tuple(r) for r in missing)}")
    # distinct headers are the versions of the export, a handful
    known = [list(r["names"]) for r in headers.select("names").distinct().orderBy("names").collect()]
    filled = F.exists("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))) != "")
    body = lookup_join(rows, headers, ["file", "sheet"], "inner").filter((F.col("number") > F.col("header")) & filled)
    union = list(dict.fromkeys(n for names in known for n in names if n))

    def picked(name: str):
        return F.coalesce(*[F.when(F.col("names") == F.array(*map(F.lit, names)), F.get("cells", F.lit(names.index(name))))
                            for names in known if name in names])

    return body.select(*[picked(n).alias(n) for n in union])


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A workbook of the given rows: numbers as numbers, dates as dates, other values as shared strings, null as no cell."""
    shared: dict[str, int] = {}

    def escaped(text: str) -> str:
        return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")

    def letter(i: int) -> str:
        return (letter(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)

    def cell(value, row: int, at: int) -> str:
        place = f"{letter(at)}{row + 1}"
        if value is None:
            return ""
        if isinstance(value, dt.date):
            return f'<c r="{place}" s="1"><v>{(value - dt.date(1899, 12, 30)).days}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{place}"><v>{value}</v></c>'
        return f'<c r="{place}" t="s"><v>{shared.setdefault(str(value), len(shared))}</v></c>'

    main, out = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", io.BytesIO()
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for k, rows in enumerate(sheets.values()):
            lines = [f'<row r="{r + 1}">{"".join(cell(v, r, c) for c, v in enumerate(row))}</row>' for r, row in enumerate(rows) if row]
            archive.writestr(f"xl/worksheets/sheet{k + 1}.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        names = "".join(f'<sheet name="{escaped(n)}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, n in enumerate(sheets))
        archive.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k + 1}" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(sheets)))
        archive.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        archive.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        items = "".join(f'<si><t xml:space="preserve">{escaped(t)}</t></si>' for t in shared)
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
    return out.getvalue()
