"""Workbooks (.xlsx): zipped XML, read by an executor and written without any library."""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.sources.files import parsed, write_bytes

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Numbers of built-in formats that show dates or times (fixed values).
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
MOST_ROWS = 1_048_576
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def column_number(reference: str) -> int:
    """0 for A1, 27 for AB7."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def column_letters(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out


def _text(element: ElementTree.Element) -> str:
    """Text of a string item, without phonetic readings."""
    return "".join(t.text or "" for part in element for t in ([part] if part.tag == f"{MAIN}t" else part.findall(f"{MAIN}t") if part.tag == f"{MAIN}r" else ()))


def _shown(number: str, is_date: bool, since_1904: bool) -> str:
    if not is_date:
        return number
    start = datetime.datetime(1904, 1, 1) if since_1904 else datetime.datetime(1899, 12, 30)
    moment = start + datetime.timedelta(seconds=round(float(number) * 86_400))
    return moment.strftime("%Y-%m-%d" if moment.time() == datetime.time() else "%Y-%m-%d %H:%M:%S")


def sheets(content: bytes) -> Iterator[Iterator[list[str | None]]]:
    """The rows of each sheet, cells as text: numbers as they are written, dates in ISO form, errors
    and empty cells None."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        strings = [_text(x) for x in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        dates: list[bool] = []
        if "xl/styles.xml" in names:
            styles = ElementTree.fromstring(z.read("xl/styles.xml"))
            own = {int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")) for f in styles.iter(f"{MAIN}numFmt")}
            formats = [int(x.get("numFmtId", 0)) for xfs in styles.findall(f"{MAIN}cellXfs") for x in xfs]
            dates = [f in DATE_FORMATS or bool(re.search("[ymdhs]", own.get(f, ""), re.IGNORECASE)) for f in formats]
        properties = book.find(f"{MAIN}workbookPr")
        since_1904 = properties is not None and properties.get("date1904") in ("1", "true")

        def value(cell: ElementTree.Element) -> str | None:
            kind, v = cell.get("t", "n"), cell.find(f"{MAIN}v")
            if kind == "inlineStr":
                inside = cell.find(f"{MAIN}is")
                return _text(inside) if inside is not None else None
            if v is None or v.text is None or kind == "e":
                return None
            if kind == "s":
                return strings[int(v.text)]
            if kind == "b":
                return str(v.text == "1")
            style = int(cell.get("s", 0))
            return v.text if kind in ("str", "d") else _shown(v.text, style < len(dates) and dates[style], since_1904)

        def rows(path: str) -> Iterator[list[str | None]]:
            with z.open(path) as f:
                for _, row in ElementTree.iterparse(f):
                    if row.tag != f"{MAIN}row":
                        continue
                    cells: list[str | None] = []
                    for k, cell in enumerate(row.findall(f"{MAIN}c")):
                        at = column_number(cell.get("r")) if cell.get("r") else k
                        cells += [None] * (at + 1 - len(cells))
                        cells[at] = value(cell)
                    yield cells
                    row.clear()

        for sheet in book.iter(f"{MAIN}sheet"):
            target = targets[sheet.get(LINK)]
            yield rows(target[1:] if target.startswith("/") else f"xl/{target}")


def headers(first: list[str | None]) -> list[str]:
    """Names of a sheet's columns: blank ones are numbered, repeated ones get .1, .2."""
    out: list[str] = []
    for i, name in enumerate(first):
        name = name if name not in (None, "") else f"Unnamed: {i}"
        n, unique = 0, name
        while unique in out:
            n += 1
            unique = f"{name}.{n}"
        out.append(unique)
    return out


def _tables(content: bytes) -> Iterator[tuple[int, list[str], Iterator[list[str | None]]]]:
    for n, rows in enumerate(sheets(content)):
        first = next(rows, None)
        if first is not None:
            yield n, headers(first), rows


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """All sheets of a workbook, one after another, by the names in their first rows; cells are text. A
    column that a sheet lacks is null there. Rows without any cell are left out."""

    def names(files: dict[str, bytes]) -> Iterable[list]:
        yield [list(dict.fromkeys(h for _, own, _ in _tables(files["xlsx"]) for h in own))]

    def rows(files: dict[str, bytes]) -> Iterable[list]:
        for _, own, cells in _tables(files["xlsx"]):
            for row in cells:
                if any(c is not None for c in row):
                    yield [[(h, c) for h, c in zip(own, row, strict=False)]]

    known = parsed(spark, [path], names, "names array<string>").first()["names"]
    table = parsed(spark, [path], rows, "cells map<string,string>")
    return table.select(*[F.element_at("cells", F.lit(n)).alias(n) for n in known])


def _cell(n: int, row: int, value) -> str:
    place = f'r="{column_letters(n)}{row}"'
    if isinstance(value, bool):
        return f'<c {place} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and value == value and abs(value) != float("inf"):
        return f"<c {place}><v>{value!r}</v></c>"
    return f'<c {place} t="inlineStr"><is><t xml:space="preserve">{escape(_BAD.sub("", str(value)))}</t></is></c>'


def write_workbook(df: DataFrame, path: str, sheet: str) -> None:
    """``df`` as the one sheet of a workbook. The format is one file of at most 1,048,576 rows, so more
    is an error; rows are streamed to the driver. Nested and binary columns are written as text."""
    if df.limit(MOST_ROWS).count() >= MOST_ROWS:
        raise ValueError(f"a workbook holds fewer than {MOST_ROWS} rows below its header")
    kinds = dict(df.dtypes)
    plain = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    own = df.select(*[F.col(f"`{c}`") if kinds[c] in plain else F.col(f"`{c}`").cast("string") for c in df.columns])
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    relation = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    name = escape(re.sub(r"[\[\]:*?/\\]", "_", sheet)[:31] or "Sheet1", {'"': "&quot;"})
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{relation}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{MAIN[1:-1]}" xmlns:r="{relation}"><sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{relation}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'{head}<worksheet xmlns="{MAIN[1:-1]}"><sheetData>'.encode())
            f.write(f'<row r="1">{"".join(_cell(k, 1, str(c)) for k, c in enumerate(df.columns))}</row>'.encode())
            for n, row in enumerate(own.toLocalIterator(), 2):
                f.write(f'<row r="{n}">{"".join(_cell(k, n, v) for k, v in enumerate(row) if v is not None)}</row>'.encode())
            f.write(b"</sheetData></worksheet>")
    write_bytes(df.sparkSession, path, out.getvalue())
