"""Drug labels in SPL XML."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.functions import tables
from litloom.sources.grid import grid, markdown
from litloom.sources.xmltext import root_of, spaced

LABEL = """path string, set_id string, drug_name string, title string, active_ingredients array<string>, manufacturer string, label_type_code string, label_type_display string,
sections array<struct<key:string,title:string,text:string,tables:array<struct<index:int,content:string,type:string>>,has_tables:boolean>>, status string"""

HIGHLIGHT_CHARS = 15_000  # a fixed value: longer highlights are cut
_EMPTY: dict = dict.fromkeys(("set_id", "drug_name", "title", "active_ingredients", "manufacturer", "label_type_code", "label_type_display", "sections"))


def _first_words(el: ET.Element | None) -> str:
    """The first piece of an element's own text, outside its children."""
    return "" if el is None else next((t for t in [el.text, *(c.tail for c in el)] if t), "")


def _section(sec: ET.Element) -> tuple[str, list[str]]:
    """A section's own text and that of its direct children, each with its title; the tables in these texts as pipe tables."""
    bodies = [(None, sec.find("text"))] + [(c.find("title"), c.find("text")) for c in sec.findall("./component/section")]
    parts = []
    for title, body in bodies:
        told, head = spaced(body), _first_words(title)
        if told:
            parts.append(f"{head}: {told}" if head else told)
    found = [markdown(grid(t)) for _, body in bodies if body is not None for t in body.iter("table")]
    return "\n\n".join(parts), [t for t in found if t]


def _sections(root: ET.Element) -> list[dict]:
    """Sections of the wanted kinds in document order; one that comes again is added to the first, its tables numbered from 0 again. Highlights from excerpts replace any section of that name."""
    own: dict[str, dict] = {}
    highlights = []
    for sec in root.iter("section"):
        at = sec.find("code")
        named = tables.LABEL_SECTIONS.get(at.get("code", "")) if at is not None else None
        if not named:
            continue
        highlights += [t for e in sec.iter("excerpt") for h in e.iter("highlight") if len(t := spaced(h)) > 50]
        text, found = _section(sec)
        if not (text or found):
            continue
        key, title = named
        numbered = [{"index": i, "content": t, "type": f"table_{i}"} for i, t in enumerate(found)]
        if key in own:
            own[key]["text"] += f"\n\n{text}" if text else ""
            own[key]["tables"] += numbered
        else:
            own[key] = {"key": key, "title": title, "text": text, "tables": numbered}
    if highlights:
        own["highlights"] = {"key": "highlights", "title": tables.LABEL_SECTIONS["34066-3"][1], "text": "\n\n".join(highlights)[:HIGHLIGHT_CHARS], "tables": []}
    return [s | {"has_tables": bool(s["tables"])} for s in own.values()]


def parse(content: bytes, name: str = "") -> dict:
    """One label; status is ok, non_rx (then the rest is empty but for the label's type) or parse_error. name: the file's stem, which stands for a missing set id."""
    try:
        root = root_of(content)
        code = root.find("./code")
        kind, display = (code.get("code", ""), code.get("displayName", "")) if code is not None else ("", "")
        typed = _EMPTY | {"label_type_code": kind, "label_type_display": display}
        if " ".join(kind.split()) != tables.PRESCRIPTION_CODE and tables.PRESCRIPTION_TOKEN not in " ".join(display.split()).lower():
            return typed | {"status": "non_rx"}
        set_id, title = root.find(".//setId"), spaced(root.find(".//title"))
        product = root.find(".//manufacturedProduct/manufacturedProduct/name")
        return typed | {
            "set_id": (set_id.get("root") if set_id is not None else None) or name or None, "drug_name": spaced(product) if product is not None else title, "title": title,
            "active_ingredients": [spaced(n) for i in root.iter("ingredient") if i.get("classCode") == "ACTIB" and (n := i.find(".//ingredientSubstance/name")) is not None],
            "manufacturer": spaced(root.find(".//representedOrganization/name")), "sections": _sections(root), "status": "ok",
        }
    except Exception:  # whatever a broken file raises: one label must not end the run
        return _EMPTY | {"status": "parse_error"}


def read(files: DataFrame, carry: str | None = None) -> DataFrame:
    """Labels of binary files (path, content), or of archive members (archive_id too, which then names the file). carry: a string column of files to keep."""
    named = F.col("archive_id") if "archive_id" in files.columns else F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    own = ["path", *([carry] if carry else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([k | parse(bytes(c), n or "") for k, n, c in zip(batch[own].to_dict("records"), batch["_stem"], batch["content"], strict=True)])

    return files.select(*own, named.alias("_stem"), "content").mapInPandas(run, f"{carry} string, {LABEL}" if carry else LABEL)
