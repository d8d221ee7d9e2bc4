"""Spreadsheet workbooks (zipped sheet XML) read on executors as a stream of cells.

A workbook is one value of a (path, content) frame, as ``binaryFile`` gives it; its sheets are parsed element by
element, so a sheet's XML is never held as a tree.  Texts that cells share stand in a list of their own and
meet the cells by a join.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Namespaces and part names of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
TARGETS = "{http://schemas.openxmlformats.org/package/2006/relationships}"
BOOK, LINKS, SHARED = "xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml"

CHUNK = 20_000


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, part) of each sheet, in the order of the workbook."""
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read(LINKS)).iter(f"{TARGETS}Relationship")}
    found = [(s.get("name"), links[s.get(RELATION)]) for s in ElementTree.fromstring(book.read(BOOK)).iter(f"{MAIN}sheet")]
    return [(name, target.lstrip("/") if target.startswith("/") else f"xl/{target}") for name, target in found]


def _column(reference: str) -> int:
    """Place of a cell in its row from a reference like AB12, from 0."""
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _texts(element: ElementTree.Element) -> str:
    """All text runs of an element, without phonetic ones; a run is a t element, alone or inside an r."""
    return "".join(t.text or "" for child in element if child.tag != f"{MAIN}rPh" for t in child.iter(f"{MAIN}t"))


def _cells(book: zipfile.ZipFile, part: str) -> Iterator[tuple[int, int, str | None, int | None]]:
    """(row, column, own text, place in the shared list) of each cell that holds something."""
    with book.open(part) as xml:
        row, col = -1, -1
        for event, element in ElementTree.iterparse(xml, ("start", "end")):
            if event == "start" and element.tag == f"{MAIN}row":
                row, col = int(element.get("r") or row + 2) - 1, -1
            elif event == "end" and element.tag == f"{MAIN}c":
                col = _column(element.get("r")) if element.get("r") else col + 1
                kind, value = element.get("t"), element.findtext(f"{MAIN}v")
                if kind == "s" and value is not None:
                    yield row, col, None, int(value)
                elif kind == "inlineStr":
                    yield row, col, _texts(element.find(f"{MAIN}is")), None
                elif value is not None:
                    yield row, col, value, None
            elif event == "end" and element.tag == f"{MAIN}row":
                element.clear()


def cells(files: DataFrame, last_only: bool = False) -> DataFrame:
    """path, sheet, sheet_no, row, col, value of every cell that is not empty, rows and columns from 0.

    ``last_only`` reads the last sheet of each workbook.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    sheets = list(enumerate(_sheets(book)))
                    rows: list[tuple] = []
                    for number, (name, part) in sheets[-1:] if last_only else sheets:
                        for cell in _cells(book, part):
                            rows.append((path, name, number, *cell))
                            if len(rows) == CHUNK:
                                yield pd.DataFrame(rows, columns=names).astype({"shared": "Int32"})
                                rows = []
                    yield pd.DataFrame(rows, columns=names).astype({"shared": "Int32"})

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    if SHARED not in book.namelist():
                        continue
                    rows, place = [], 0
                    with book.open(SHARED) as xml:
                        for _, element in ElementTree.iterparse(xml):
                            if element.tag == f"{MAIN}si":
                                rows.append((path, place, _texts(element)))
                                place += 1
                                element.clear()
                                if len(rows) == CHUNK:
                                    yield pd.DataFrame(rows, columns=["path", "shared", "text"])
                                    rows = []
                    yield pd.DataFrame(rows, columns=["path", "shared", "text"])

    names = ["path", "sheet", "sheet_no", "row", "col", "own", "shared"]
    found = files.select("path", "content").mapInPandas(read, "path string, sheet string, sheet_no int, row int, col int, own string, shared int")
    texts = files.select("path", "content").mapInPandas(listed, "path string, shared int, text string")
    return found.join(texts, ["path", "shared"], "left").select("path", "sheet", "sheet_no", "row", "col", F.coalesce("own", "text").alias("value"))


def last_sheet(files: DataFrame, header_row: int, names: list[str]) -> DataFrame:
    """path, row and ``names``: the rows below row ``header_row`` (from 0) of each workbook's last sheet, columns by position.

    Missing cells are blank; rows without a cell in these columns are left out.
    """
    body = cells(files, last_only=True).where((F.col("row") > header_row) & (F.col("col") < len(names)))
    return body.groupBy("path", "row").agg(*[F.coalesce(F.max(F.when(F.col("col") == i, F.col("value"))), F.lit("")).alias(n) for i, n in enumerate(names)])


def packed(sheets: list[tuple[str, list[list[object]]]]) -> bytes:
    """A workbook of (name, rows): texts shared, numbers plain, None left out; the same rows give the same bytes."""
    shared: dict[str, int] = {}
    parts: dict[str, str] = {}
    for number, (_, rows) in enumerate(sheets, 1):
        lines = []
        for i, row in enumerate(rows, 1):
            held = []
            for j, value in enumerate(row):
                place = f"{_letters(j)}{i}"
                if isinstance(value, str):
                    held.append(f'<c r="{place}" t="s"><v>{shared.setdefault(value, len(shared))}</v></c>')
                elif value is not None:
                    held.append(f'<c r="{place}"><v>{value}</v></c>')
            if held:
                lines.append(f'<row r="{i}">{"".join(held)}</row>')
        parts[f"xl/worksheets/sheet{number}.xml"] = f'<worksheet xmlns="{MAIN[1:-1]}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
    listed = "".join(f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>' for i, (name, _) in enumerate(sheets, 1))
    parts[BOOK] = f'<workbook xmlns="{MAIN[1:-1]}" xmlns:r="{RELATION[1:-3]}"><sheets>{listed}</sheets></workbook>'
    parts[LINKS] = f'<Relationships xmlns="{TARGETS[1:-1]}">' + "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>"
    parts[SHARED] = f'<sst xmlns="{MAIN[1:-1]}">' + "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in shared) + "</sst>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name in sorted(parts):
            book.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), parts[name].encode())
    return out.getvalue()


def _letters(j: int) -> str:
    out = ""
    j += 1
    while j:
        j, rest = divmod(j - 1, 26)
        out = chr(65 + rest) + out
    return out


def grouped(rows: DataFrame, path: Column, names: list[str], lead: int) -> DataFrame:
    """path, content: a workbook for each ``path``, a cover and a last sheet with ``lead`` empty rows, ``names`` and the rows, in order.

    A workbook is one value, so its rows are one group: what a sheet may hold.
    """

    def made(frame: pd.DataFrame) -> pd.DataFrame:
        body = frame[names].sort_values(names).values.tolist()
        content = packed([("cover", [["not this one"]]), ("data", [[]] * lead + [names] + body)])
        return pd.DataFrame({"path": [frame["_path"].iloc[0]], "content": [content]})

    return rows.select(path.alias("_path"), *names).groupBy("_path").applyInPandas(made, "path string, content binary")
