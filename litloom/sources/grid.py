"""Tables in markup as grids, and grids as text."""

from __future__ import annotations

import xml.etree.ElementTree as ET

from litloom.sources.xmltext import collapsed, spaced


def _span(cell: ET.Element, name: str) -> int:
    value = cell.get(name, "1").strip()
    return max(1, int(value)) if value.isdigit() else 1


def grid(table: ET.Element) -> list[list[str]]:
    """The rows of a table. A cell that spans rows is repeated downwards, one that spans columns is followed by empty cells; pipes are escaped."""
    rows: list[list[str]] = []
    below: dict[int, tuple[int, str]] = {}  # column -> rows still to fill, text
    for tr in table.iter("tr"):
        cells = [c for c in tr if c.tag in ("td", "th")]
        row: list[str] = []

        def carried(row: list[str] = row) -> bool:
            left, text = below.get(len(row), (0, ""))
            if left:
                below[len(row)] = (left - 1, text)
                row.append(text)
            return bool(left)

        for cell in cells:
            while carried():
                pass
            text, down = collapsed(cell).replace("|", "\\|"), _span(cell, "rowspan") - 1
            for j in range(_span(cell, "colspan")):
                own = text if j == 0 else ""
                if down:
                    below[len(row)] = (down, own)
                row.append(own)
        while carried():
            pass
        if row:
            rows.append(row)
    return rows


def markdown(rows: list[list[str]], rule: str = "---", caption: str = "", footnotes: list[str] | None = None) -> str:
    """A pipe table: the first row is the header, short rows are filled up."""
    if not rows:
        return ""
    width = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    body = [lines[0], "| " + " | ".join([rule] * width) + " |", *lines[1:]]
    return "\n".join(([f"**{caption}**", ""] if caption else []) + body + (["", *footnotes] if footnotes else []))


def row_by_row(rows: list[list[str]]) -> str:
    """Each body row as a sentence of header and value; empty cells are left out, columns beyond the headers are numbered."""
    if len(rows) < 2:
        return ""
    head = rows[0]
    name = lambda j: (head[j] if j < len(head) else "") or f"Col{j + 1}"
    return "\n".join(f"Row {i}: " + ", ".join(f"{name(j)}: {c}" for j, c in enumerate(r) if c) for i, r in enumerate(rows[1:], 1) if any(r))


def _notes(wrap: ET.Element) -> str:
    foot = wrap.find(".//table-wrap-foot")
    told = [t for e in (foot.iter() if foot is not None else []) if e.tag in ("p", "fn") and (t := spaced(e))]
    return "\n\nFootnotes: " + "; ".join(told) if told else ""


def table_text(wrap: ET.Element, sentences: bool = False) -> str:
    """A boxed table with caption and footnotes, as a pipe table or as sentences; without cells, what there is of caption and notes."""
    caption, notes, table = spaced(wrap.find(".//caption")), _notes(wrap), wrap.find(".//table")
    rows = grid(table) if table is not None else []
    if not rows or sentences and len(rows) < 2:
        return (f"Table: {caption}{notes}" if sentences else f"**{caption}**{notes}") if caption else ""
    if not sentences:
        return markdown(rows, caption=caption) + notes
    told = row_by_row(rows).split("\n") if row_by_row(rows) else []
    return (f"Table: {caption}. " if caption else "Table: ") + ". ".join(told) + notes


def boxed_tables(root: ET.Element, most: int = 15) -> list[dict]:
    """The first `most` boxed tables of a document in both forms. Among alternatives the one in markup is taken; a picture is told by caption and notes."""
    out = []
    for i, wrap in enumerate(list(root.iter("table-wrap"))[:most], 1):
        other = wrap.find(".//alternatives")
        picture = wrap.find(".//table") is None and wrap.find(".//graphic") is not None
        if other is not None and (table := other.find(".//table")) is not None:
            own = ET.Element("table-wrap")
            own.extend(e for e in (wrap.find(".//caption"), table, wrap.find(".//table-wrap-foot")) if e is not None)
            wrap = own
        caption = spaced(wrap.find(".//caption"))
        told = {"markdown": f"**{caption}** (Image-based table){_notes(wrap)}", "row_by_row": f"Table: {caption} (Image-based table){_notes(wrap)}"} if picture else {"markdown": table_text(wrap), "row_by_row": table_text(wrap, sentences=True)}
        out.append({"id": f"table-{i}", "caption": caption, **told, "is_image_only": picture})
    return out
