"""S3/S4 — workbooks (XLSX) to the long cell table.

``spark.read.format("binaryFile")`` lists and reads the files; one
``mapInPandas`` task decodes each workbook (an XLSX is a zip of XML parts, not
splittable) with the standard library only and emits its cells in bounded
batches.  Many workbooks decode in parallel; nothing passes through the driver.

Per cell: ``file, sheet, sheet_idx, row_idx, col_idx, ctype, raw`` where
``ctype`` is ``s`` (text: shared, inline or formula string), ``n`` (number),
``d`` (number in a date format; ``raw`` is the day serial; ``d1904`` in a
workbook using the 1904 date system), ``t`` (a duration in days), ``b`` (boolean ``1``/``0``) or ``e``
(error text), and ``raw`` is the cached value as stored.
Formulas contribute their cached value.  Empty cells are not emitted; the
grid builder restores them.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from indicata.functions.text import cell_text_legacy, cell_text_xlsx

CELL_SCHEMA = ("file string, sheet string, sheet_idx int, row_idx int, col_idx int, "
               "ctype string, raw string")
BATCH_CELLS = 50_000

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"

# Built-in number formats that display dates or times.
BUILTIN_DATE_FORMATS = frozenset([*range(14, 23), 45, 47])
# Fixed value: the built-in format of elapsed time.
BUILTIN_DURATION_FORMAT = 46
_ELAPSED = re.compile(r"\[(h+|m+|s+)\]", re.IGNORECASE)
_DATE_TOKEN = re.compile(r"[dmyhs]", re.IGNORECASE)
_REF = re.compile(r"^([A-Z]+)([0-9]+)$")


def _col_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n


def _is_date_code(code: str) -> bool:
    stripped = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.', "", code)
    return bool(_DATE_TOKEN.search(stripped))


def _text_of(elem) -> str:
    """Text of a shared/inline string item: its ``<t>``, or the ``<t>`` of
    each rich-text run ``<r>``; phonetic runs ``<rPh>`` are not text."""
    parts = []
    for child in elem:
        if child.tag == f"{_MAIN}t":
            parts.append(child.text or "")
        elif child.tag == f"{_MAIN}r":
            parts.extend(t.text or "" for t in child.iter(f"{_MAIN}t"))
    return "".join(parts)


def _uses_1904(z: zipfile.ZipFile) -> bool:
    """Workbooks saved with the 1904 date system count days from 1904-01-01."""
    pr = ET.fromstring(z.read("xl/workbook.xml")).find(f"{_MAIN}workbookPr")
    return pr is not None and pr.get("date1904", "0").lower() in ("1", "true")


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """``(sheet name, part path)`` in workbook order."""
    rels = {}
    rel_root = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for r in rel_root.iter(f"{_PKG_REL}Relationship"):
        target = r.get("Target")
        target = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        rels[r.get("Id")] = target
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    return [(s.get("name"), rels[s.get(f"{_REL}id")]) for s in wb.iter(f"{_MAIN}sheet")]


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    root = ET.fromstring(z.read("xl/sharedStrings.xml"))
    return [_text_of(si) for si in root.iter(f"{_MAIN}si")]


def _date_styles(z: zipfile.ZipFile) -> dict[int, str]:
    """Cell styles that show a number as a date (``d``) or a duration (``t``)."""
    if "xl/styles.xml" not in z.namelist():
        return {}
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")): f.get("formatCode") or ""
              for f in root.iter(f"{_MAIN}numFmt")}
    xfs = root.find(f"{_MAIN}cellXfs")
    out = {}
    for i, xf in enumerate(xfs if xfs is not None else []):
        fid = int(xf.get("numFmtId", 0))
        if fid == BUILTIN_DURATION_FORMAT or _ELAPSED.search(custom.get(fid, "")):
            out[i] = "t"
        elif fid in BUILTIN_DATE_FORMATS or (fid in custom and _is_date_code(custom[fid])):
            out[i] = "d"
    return out


def decode_xlsx(content: bytes, file: str, sheet: str | None = None,
                sheet_index: int | None = None) -> Iterator[tuple]:
    """Yield cell tuples of one workbook (all sheets unless one is named or
    indexed).  A named sheet that does not exist is an error."""
    z = zipfile.ZipFile(io.BytesIO(content))
    sheets = _sheets(z)
    if sheet is not None:
        chosen = [(i, n, p) for i, (n, p) in enumerate(sheets) if n == sheet]
        if not chosen:
            raise KeyError(f"Worksheet {sheet} does not exist in {file}")
    elif sheet_index is not None:
        chosen = [(sheet_index, *sheets[sheet_index])]
    else:
        chosen = [(i, n, p) for i, (n, p) in enumerate(sheets)]
    shared = _shared_strings(z)
    dates = _date_styles(z)
    date_type = "d1904" if _uses_1904(z) else "d"
    cell_tag, row_tag = f"{_MAIN}c", f"{_MAIN}row"
    v_tag, is_tag = f"{_MAIN}v", f"{_MAIN}is"
    for idx, name, part in chosen:
        row_no = 0
        pending: list[tuple] = []   # cells of the row being read: (col or None, row or None, ctype, raw)
        with z.open(part) as fh:
            for _, elem in ET.iterparse(fh, events=("end",)):
                tag = elem.tag
                if tag == cell_tag:
                    ref = elem.get("r")
                    m = _REF.match(ref) if ref else None
                    t = elem.get("t", "n")
                    v = elem.find(v_tag)
                    raw = v.text if v is not None else None
                    if t == "inlineStr":
                        is_ = elem.find(is_tag)
                        raw, ctype = (_text_of(is_) if is_ is not None else None), "s"
                    elif t == "s":
                        raw, ctype = (shared[int(raw)] if raw is not None else None), "s"
                    elif t in ("str", "d"):
                        ctype = "s"
                    elif t in ("b", "e"):
                        ctype = t
                    else:
                        kind = dates.get(int(elem.get("s", 0)), "n")
                        ctype = date_type if kind == "d" else kind
                    pending.append((_col_number(m.group(1)) if m else None,
                                    int(m.group(2)) if m else None, ctype, raw))
                    elem.clear()
                elif tag == row_tag:
                    # the row's number is known at its end: its r attribute or the next one
                    r = elem.get("r")
                    row_no = int(r) if r else row_no + 1
                    col_no = 0
                    for col, row, ctype, raw in pending:
                        col_no = col if col is not None else col_no + 1
                        if raw is not None:
                            yield (file, name, idx, row if row is not None else row_no, col_no, ctype, raw)
                    pending = []
                    elem.clear()


def _decoder(sheet: str | None, sheet_index: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["file", "sheet", "sheet_idx", "row_idx", "col_idx", "ctype", "raw"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                name = path.rsplit("/", 1)[-1]
                buf = []
                for cell in decode_xlsx(bytes(content), name, sheet, sheet_index):
                    buf.append(cell)
                    if len(buf) >= BATCH_CELLS:
                        yield pd.DataFrame(buf, columns=cols)
                        buf = []
                if buf:
                    yield pd.DataFrame(buf, columns=cols)
    return run


def read_xlsx_cells(spark: SparkSession, path: str, sheet: str | None = None,
                    sheet_index: int | None = None, glob: str = "*.xlsx") -> DataFrame:
    """Cell table of every workbook under ``path``.

    A workbook is never split (each file is at most one task); small ones are
    packed into a task by the file source's own split planning.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", True).load(path).select("path", "content"))
    return decode_workbooks(files, sheet, sheet_index)


def decode_workbooks(files: DataFrame, sheet: str | None = None, sheet_index: int | None = None) -> DataFrame:
    """Cell table of a ``(path, content)`` frame of workbook bytes."""
    return files.select("path", "content").mapInPandas(_decoder(sheet, sheet_index), CELL_SCHEMA)


def xlsx_text(cells: DataFrame) -> DataFrame:
    """Add ``text``: the cached-value reader's rendering of each cell."""
    return cells.withColumn("text", cell_text_xlsx("raw", "ctype"))


def legacy_text(cells: DataFrame) -> DataFrame:
    """Add ``text``: the legacy reader's rendering (integral numbers lose
    ``.0``; booleans, dates and error codes are numbers)."""
    return cells.withColumn("text", cell_text_legacy("raw", "ctype"))


__all__ = ["CELL_SCHEMA", "decode_xlsx", "decode_workbooks", "read_xlsx_cells", "xlsx_text", "legacy_text"]
