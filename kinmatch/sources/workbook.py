"""Workbooks (.xlsx) with the standard library: a Spark data source that reads sheets, and a writer for bounded tables."""
from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Rows that a sheet can hold.
MOST_ROWS = 1_048_576


def _parts(book: zipfile.ZipFile) -> dict[str, str]:
    """The file of each sheet, by its name, in order."""
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}sheets")
    return {s.get("name"): "xl/" + links[s.get(RELATION)].removeprefix("/xl/") for s in sheets}


def sheet_names(path: str) -> list[str]:
    with zipfile.ZipFile(path) as book:
        return list(_parts(book))


def _place(reference: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def rows_of(path: str, sheet: str) -> Iterator[list[str | None]]:
    """Rows of cells as strings; a whole number's ".0" is dropped."""
    with zipfile.ZipFile(path) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{MAIN}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        with book.open(_parts(book)[sheet]) as data:
            for _, row in ElementTree.iterparse(data):
                if row.tag != f"{MAIN}row":
                    continue
                cells: list[str | None] = []
                for n, c in enumerate(row.findall(f"{MAIN}c")):
                    at = _place(c.get("r")) if c.get("r") else n
                    cells += [None] * (at + 1 - len(cells))
                    value, kind = c.find(f"{MAIN}v"), c.get("t")
                    text = "".join(t.text or "" for t in c.iter(f"{MAIN}t")) if kind == "inlineStr" else value.text if value is not None else None
                    if kind == "s" and text is not None:
                        text = shared[int(text)]
                    elif kind in (None, "n") and text and re.fullmatch(r"-?\d+\.0+", text):
                        text = text.split(".")[0]
                    cells[at] = text or None
                row.clear()
                yield cells


def _header(path: str, sheet: str) -> list[str]:
    names: list[str] = []
    for i, name in enumerate(next(rows_of(path, sheet), [])):
        name, k = name or f"Unnamed: {i}", 0
        while (f"{name}.{k}" if k else name) in names:
            k += 1
        names.append(f"{name}.{k}" if k else name)
    return names


class WorkbookSource(DataSource):
    """spark.read.format("workbook").option("path", ...).option("sheet", ...): one sheet, all columns strings. The path must be readable where tasks run."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def _sheet(self) -> tuple[str, str]:
        path = self.options["path"]
        return path, self.options.get("sheet") or sheet_names(path)[0]

    def schema(self) -> StructType:
        return StructType([StructField(n, StringType()) for n in _header(*self._sheet())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SheetReader(*self._sheet(), len(schema.fields))


class _SheetReader(DataSourceReader):
    def __init__(self, path: str, sheet: str, width: int):
        self.path, self.sheet, self.width = path, sheet, width

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.sheet)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        rows = rows_of(self.path, self.sheet)
        next(rows, None)
        for cells in rows:
            if any(c is not None for c in cells):
                yield tuple((cells + [None] * self.width)[: self.width])


# Writing


def _cell(value) -> str:
    if value is None or value != value:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float):
        return f"<c><v>{value!r}</v></c>"
    clean = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value))
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(clean)}</t></is></c>'


def write_workbook(path: str, sheets: Iterable[tuple[str, list[str], Iterable[tuple]]]) -> list[str]:
    """Writes sheets (name, header, rows) in order, row by row as they come; what one sheet doesn't hold goes on in a next one. Returns the sheets' names."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    names: list[str] = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for name, header, rows in sheets:
            rows = iter(rows)
            part, row = 1, next(rows, None)
            while part == 1 or row is not None:
                names.append(name[:31] if part == 1 else f"{name[:26]} {part}")
                with book.open(f"xl/worksheets/sheet{len(names)}.xml", "w", force_zip64=True) as raw, io.TextIOWrapper(raw, "utf-8") as out:
                    out.write(f'{head}<worksheet xmlns="{MAIN[1:-1]}"><sheetData><row>' + "".join(map(_cell, header)) + "</row>")
                    for _ in range(MOST_ROWS - 1):
                        if row is None:
                            break
                        out.write("<row>" + "".join(map(_cell, row)) + "</row>")
                        row = next(rows, None)
                    out.write("</sheetData></worksheet>")
                part += 1
        overrides = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="{kinds}.worksheet+xml"/>' for i in range(len(names)))
        book.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/>{overrides}</Types>')
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        relations = "http://schemas.openxmlformats.org/package/2006/relationships"
        book.writestr("_rels/.rels", f'{head}<Relationships xmlns="{relations}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{relations}">' + "".join(f'<Relationship Id="rId{i + 1}" Type="{office}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names))) + "</Relationships>")
        book.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{MAIN[1:-1]}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names)) + "</sheets></workbook>")
    return names
