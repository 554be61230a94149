"""Excel workbooks (.xlsx) on the standard library: a table read from the first sheet, and one written with thumbnails.

A workbook is one file, of at most 1,048,576 rows by its format, and so one task reads or writes it.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

MOST_ROWS = 1_048_576
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'


def _column(letters: str) -> int:
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - 64
    return n - 1


def _letters(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out


def sheet_rows(data: bytes) -> Iterator[list[str | None]]:
    """The first sheet's rows as text; numbers without a fraction are written as integers."""
    book = zipfile.ZipFile(io.BytesIO(data))
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
    name = min((n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
    for _, row in ElementTree.iterparse(book.open(name)):
        if row.tag != f"{_MAIN}row":
            continue
        out: list[str | None] = []
        for cell in row.iter(f"{_MAIN}c"):
            at = _column(re.match(r"[A-Z]+", cell.get("r") or _letters(len(out)) + "1")[0])
            out += [None] * (at + 1 - len(out))
            value = cell.find(f"{_MAIN}v")
            if cell.get("t") == "inlineStr":
                out[at] = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
            elif value is not None and value.text is not None:
                text = shared[int(value.text)] if cell.get("t") == "s" else value.text
                out[at] = re.sub(r"^(-?\d+)\.0+$", r"\1", text) if cell.get("t") in (None, "n") else text
        yield out
        row.clear()


def read_excel(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet as a table of text columns and row_id (its place); names come from the first row, trimmed."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                rows = [(i, r) for i, r in enumerate(sheet_rows(data))]
                yield pd.DataFrame({"row_id": [i - 1 for i, _ in rows], "cells": [r for _, r in rows]})

    cells = files.mapInPandas(run, "row_id long, cells array<string>")
    head = cells.filter("row_id = -1").first()
    names = [(n or "").strip() for n in head.cells] if head else []
    rows = cells.filter("row_id >= 0")
    return rows.selectExpr("row_id", *[f"get(cells, {i}) as `{n}`" for i, n in enumerate(names) if n])


def png_size(data: bytes) -> tuple[int, int]:
    return struct.unpack(">II", data[16:24])


def write_excel(df: DataFrame, path: str, order: str | None = None, thumbnails: dict | None = None, key: str = "ref", side: int = 120) -> int:
    """Writes df as one sheet, in order, and returns its rows. ``thumbnails`` maps keys to PNG bytes for a last column, miniatura.

    Rows come to the driver partition by partition; a table beyond the format's rows is refused.
    """
    names = [c for c in df.columns if c != order]
    rows = (df.orderBy(order) if order else df).select(*dict.fromkeys([*names, *([order] if order else [])])).toLocalIterator()
    heads = [*names, *(["miniatura"] if thumbnails is not None else [])]
    pictures, n = [], 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        with book.open("xl/worksheets/sheet1.xml", "w") as sheet:

            def put(at: int, values: list) -> None:
                high = f' ht="{side * 0.75}" customHeight="1"' if pictures and pictures[-1][0] == at else ""
                cells = "".join(f'<c r="{_letters(i)}{at + 1}" t="inlineStr"><is><t xml:space="preserve">{escape(_clean(v))}</t></is></c>' for i, v in enumerate(values) if v is not None)
                sheet.write(f'<row r="{at + 1}"{high}>{cells}</row>'.encode())

            sheet.write(f'{_HEAD}<worksheet xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL}"><sheetData>'.encode())
            put(0, heads)
            for row in rows:
                n += 1
                if n >= MOST_ROWS:
                    raise ValueError(f"a sheet has at most {MOST_ROWS} rows")
                picture = thumbnails.get(row[key]) if thumbnails else None
                if picture:
                    pictures.append((n, picture))
                put(n, [row[c] for c in names])
            sheet.write(f'</sheetData>{"<drawing r:id=%s/>" % quoteattr("rId1") if pictures else ""}</worksheet>'.encode())
        _parts(book, pictures, len(names), side)
    return n


def _clean(value) -> str:
    """Text without the characters that XML has no way to write."""
    return re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", "", str(value))


def _parts(book: zipfile.ZipFile, pictures: list, column: int, side: int) -> None:
    """The parts of a workbook around its sheet."""
    kind = "application/vnd.openxmlformats-officedocument."
    types = "".join(f'<Override PartName="/xl/{p}" ContentType="{kind}{t}+xml"/>' for p, t in (("workbook.xml", "spreadsheetml.sheet.main"), ("worksheets/sheet1.xml", "spreadsheetml.worksheet"), *([("drawings/drawing1.xml", "drawing")] if pictures else [])))
    book.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Default Extension="png" ContentType="image/png"/>{types}</Types>')

    def relations(name: str, targets: list[tuple[str, str]]) -> None:
        each = "".join(f'<Relationship Id="rId{i}" Type="{_REL}/{t}" Target="{target}"/>' for i, (t, target) in enumerate(targets, 1))
        book.writestr(name, f'{_HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{each}</Relationships>')

    relations("_rels/.rels", [("officeDocument", "xl/workbook.xml")])
    relations("xl/_rels/workbook.xml.rels", [("worksheet", "worksheets/sheet1.xml")])
    book.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL}"><sheets><sheet name="catalogo" sheetId="1" r:id="rId1"/></sheets></workbook>')
    if not pictures:
        return
    relations("xl/worksheets/_rels/sheet1.xml.rels", [("drawing", "../drawings/drawing1.xml")])
    relations("xl/drawings/_rels/drawing1.xml.rels", [("image", f"../media/image{i}.png") for i in range(1, len(pictures) + 1)])
    draw, art = "http://schemas.openxmlformats.org/drawingml/2006/spreadsheetDrawing", "http://schemas.openxmlformats.org/drawingml/2006/main"
    anchors = []
    for i, (row, data) in enumerate(pictures, 1):
        w, h = png_size(data)
        scale = min(1.0, side / max(w, h, 1)) * 9525  # drawing units of a pixel
        size = f'cx="{int(w * scale)}" cy="{int(h * scale)}"'
        anchors.append(
            f'<xdr:oneCellAnchor><xdr:from><xdr:col>{column}</xdr:col><xdr:colOff>0</xdr:colOff><xdr:row>{row}</xdr:row><xdr:rowOff>0</xdr:rowOff></xdr:from><xdr:ext {size}/>'
            f'<xdr:pic><xdr:nvPicPr><xdr:cNvPr id="{i}" name="image{i}"/><xdr:cNvPicPr/></xdr:nvPicPr><xdr:blipFill><a:blip r:embed="rId{i}"/><a:stretch><a:fillRect/></a:stretch></xdr:blipFill>'
            f'<xdr:spPr><a:xfrm><a:off x="0" y="0"/><a:ext {size}/></a:xfrm><a:prstGeom prst="rect"><a:avLst/></a:prstGeom></xdr:spPr></xdr:pic><xdr:clientData/></xdr:oneCellAnchor>'
        )
        book.writestr(f"xl/media/image{i}.png", data)
    book.writestr("xl/drawings/drawing1.xml", f'{_HEAD}<xdr:wsDr xmlns:xdr="{draw}" xmlns:a="{art}" xmlns:r="{_REL}">{"".join(anchors)}</xdr:wsDr>')
