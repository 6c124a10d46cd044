"""Write small .xlsx files with the standard library (test fixtures only).

Cells: str → shared string (or inline when ``inline=True``), int/float →
number, datetime/date → number with a date style, bool → boolean, None →
absent.
"""

from __future__ import annotations

import datetime as dt
import zipfile
from xml.sax.saxutils import escape

_EPOCH = dt.datetime(1899, 12, 30)


def _col(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def write_xlsx(path: str, sheets: dict[str, list[list]], inline: bool = False) -> None:
    shared: list[str] = []
    index: dict[str, int] = {}
    sheet_xml = []
    for rows in sheets.values():
        out = []
        for r, row in enumerate(rows, start=1):
            cells = []
            for c, v in enumerate(row):
                ref = f"{_col(c)}{r}"
                if v is None:
                    continue
                if isinstance(v, bool):
                    cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, (dt.datetime, dt.date)):
                    d = v if isinstance(v, dt.datetime) else dt.datetime(v.year, v.month, v.day)
                    serial = (d - _EPOCH).total_seconds() / 86400
                    cells.append(f'<c r="{ref}" s="1"><v>{serial}</v></c>')
                elif isinstance(v, (int, float)):
                    cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                elif inline:
                    cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>')
                else:
                    if v not in index:
                        index[v] = len(shared)
                        shared.append(v)
                    cells.append(f'<c r="{ref}" t="s"><v>{index[v]}</v></c>')
            out.append(f'<row r="{r}">{"".join(cells)}</row>')
        sheet_xml.append(
            '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
            f'<sheetData>{"".join(out)}</sheetData></worksheet>'
        )
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    names = list(sheets)
    wb = f'<?xml version="1.0" encoding="UTF-8"?><workbook {ns}><sheets>' + "".join(
        f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names)
    ) + "</sheets></workbook>"
    rels = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(
        f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
        for i in range(len(names))
    ) + "</Relationships>"
    sst = '<?xml version="1.0" encoding="UTF-8"?><sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">' + "".join(
        f"<si><t>{escape(s)}</t></si>" for s in shared
    ) + "</sst>"
    styles = (
        '<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    )
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/workbook.xml", wb)
        zf.writestr("xl/_rels/workbook.xml.rels", rels)
        zf.writestr("xl/sharedStrings.xml", sst)
        zf.writestr("xl/styles.xml", styles)
        for i, x in enumerate(sheet_xml):
            zf.writestr(f"xl/worksheets/sheet{i + 1}.xml", x)
