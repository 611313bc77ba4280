"""Landing helpers for checks and benches: driver tables in source formats.

The loaders read what upstream systems land (delimited text, JSON
documents, workbooks).  To check them on the driver tables, those tables are
first landed in the same formats; the workbook encoder here writes the
minimal SpreadsheetML an XLSX reader needs (shared and inline strings,
numbers, date-styled numbers, booleans, errors, formulas with cached values).
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd

_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def _letters(n: int) -> str:
    s = ""
    while n:
        n, r = divmod(n - 1, 26)
        s = chr(65 + r) + s
    return s


def xlsx_bytes(sheets: dict[str, dict[tuple[int, int], tuple]]) -> bytes:
    """Workbook bytes.  Cell spec ``(row, col) -> (kind, value)``: ``s``
    shared string, ``is`` inline string, ``n`` number text, ``d`` date serial
    (date style), ``b`` boolean, ``e`` error, ``f`` ``(formula, cached
    number)``, ``fs`` ``(formula, cached text)``, ``blank`` styled empty."""
    shared: dict[str, int] = {}

    def sst(v: str) -> int:
        return shared.setdefault(v, len(shared))

    def cell(ref: str, kind: str, value) -> str:
        if kind == "s":
            return f'<c r="{ref}" t="s"><v>{sst(value)}</v></c>'
        if kind == "is":
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        if kind == "n":
            return f'<c r="{ref}"><v>{value}</v></c>'
        if kind == "d":
            return f'<c r="{ref}" s="1"><v>{value}</v></c>'
        if kind in ("b", "e"):
            return f'<c r="{ref}" t="{kind}"><v>{escape(str(value))}</v></c>'
        if kind == "f":
            formula, cached = value if isinstance(value, tuple) else (f"VALUE({value})", value)
            return f'<c r="{ref}"><f>{escape(formula)}</f><v>{cached}</v></c>'
        if kind == "fs":
            return f'<c r="{ref}" t="str"><f>{escape(value[0])}</f><v>{escape(value[1])}</v></c>'
        return f'<c r="{ref}" s="0"/>'

    parts = []
    for cells in sheets.values():
        rows: dict[int, list[str]] = {}
        for (r, c), (kind, value) in sorted(cells.items()):
            rows.setdefault(r, []).append(cell(f"{_letters(c)}{r}", kind, value))
        body = "".join(f'<row r="{r}">{"".join(cs)}</row>' for r, cs in sorted(rows.items()))
        parts.append(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS}"><sheetData>{body}'
                     '</sheetData></worksheet>')
    names = list(sheets)
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    workbook = (f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_NS}" xmlns:r="{rel}"><sheets>'
                + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
                + "</sheets></workbook>")
    rels = ('<?xml version="1.0" encoding="UTF-8"?><Relationships '
            'xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            + "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>'
                      for i in range(1, len(names) + 1)) + "</Relationships>")
    styles = (f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{_NS}"><cellXfs count="2">'
              '<xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>')
    strings = (f'<?xml version="1.0" encoding="UTF-8"?><sst xmlns="{_NS}">'
               + "".join(f"<si><t>{escape(v)}</t></si>" for v in shared) + "</sst>")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types/>')
        z.writestr("xl/workbook.xml", workbook)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/styles.xml", styles)
        z.writestr("xl/sharedStrings.xml", strings)
        for i, x in enumerate(parts, 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", x)
    return buf.getvalue()


def workbooks_from_rows(header: list[str], kinds: list[str], sheet: str, prefix: str):
    """``mapInPandas`` function: each input batch becomes one workbook
    (header row + one row per record) emitted as ``(path, content)``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx else 0
        for n, pdf in enumerate(batches):
            cells = {(1, c): ("s", h) for c, h in enumerate(header, 1)}
            for r, rec in enumerate(pdf.itertuples(index=False), 2):
                for c, (kind, value) in enumerate(zip(kinds, rec), 1):
                    if value is None:
                        continue
                    cells[(r, c)] = (kind, value)
            yield pd.DataFrame({"path": [f"{prefix}/part-{part:05d}-{n:04d}.xlsx"],
                                "content": [xlsx_bytes({sheet: cells})]})
    return run
