"""Full-text articles in JATS XML."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from litloom.functions import tables
from litloom.sources.grid import grid, markdown
from litloom.sources.xmltext import collapsed, joined, root_of, spaced

ARTICLE = """path string, document_id string, pmid string, pmcid string, doi string, publisher_id string, nihms_id string, title string, abstract string, article_type string,
language string, license string, is_open_access boolean, is_commercial boolean, year int, publication_date string,
journal struct<title:string,abbreviation:string,publisher:string,issn:string,nlm_unique_id:string>, country string, country_name string, keywords array<string>, mesh_terms array<string>,
sections array<struct<type:string,id:string,title:string,content:string>>,
tables array<struct<id:string,location:string,label:string,caption_title:string,caption_text:string,content:string,footnotes:array<string>>>,
full_text string, section_titles array<string>, extraction_metadata struct<schema_version:string,empty_body_detected:boolean,tables_in_floats_group:int>,
has_full_text boolean, skip_reason string"""

_ID_KINDS = {"pmid": "pmid", "doi": "doi", "pmc": "pmcid", "pmcid": "pmcid", "publisher-id": "publisher_id", **dict.fromkeys(("nihms", "nihms-id", "nihmsid", "manuscript-id", "manuscript"), "nihms_id")}
_INDICATORS = ("open-access", "cc-", "cc0"), ("creativecommons", "cc by", "cc-by", "cc0")
# Where a licence is told, and what there means which licence, in order. Fixed values.
_LICENCE_RULES = [
    ("type", "cc0", "cc0"), ("type", "cc-by-nc", "cc-by-nc"), ("type", "cc-by-sa", "cc-by-sa"), ("type", "cc-by-nd", "cc-by-nd"), ("type", "cc-by", "cc-by"), ("type", "open-access", "cc-by"),
    ("link", "cc0", "cc0"), ("link", "by-nc", "cc-by-nc"), ("link", "by-sa", "cc-by-sa"), ("link", "by-nd", "cc-by-nd"), ("link", "by", "cc-by"),
    ("words", "cc0", "cc0"), ("words", "by-nc", "cc-by-nc"), ("words", "by-sa", "cc-by-sa"), ("words", "by-nd", "cc-by-nd"), ("words", "cc by", "cc-by"), ("words", "cc-by", "cc-by"), ("words", "public domain", "cc0"),
]


def _ids(meta: ET.Element) -> dict:
    """Identifiers by their kind; one of no known kind that looks like a manuscript number is one, if none was told before."""
    out = dict.fromkeys(("pmid", "pmcid", "doi", "publisher_id", "nihms_id"))
    for el in meta.iter("article-id"):
        kind, value = el.get("pub-id-type", "").strip().lower().replace("_", "-"), (el.text or "").strip()
        if value and kind in _ID_KINDS:
            out[_ID_KINDS[kind]] = value
        elif value.upper().startswith("NIHMS") and out["nihms_id"] is None:
            out["nihms_id"] = value
    return out


def license_of(meta: ET.Element) -> str:
    """By the first rule that holds, of the first licence for which any does."""
    for el in meta.findall("./permissions/license"):
        told = {"type": el.get("license-type", ""), "link": next((v for k, v in el.attrib.items() if "href" in k.lower()), ""), "words": "".join(el.itertext())}
        name = next((name for where, part, name in _LICENCE_RULES if part in told[where].lower()), None)
        if name:
            return name
    return "unknown"


def is_open(meta: ET.Element) -> bool:
    if meta.find("./permissions/free-to-read") is not None:
        return True
    return any(any(i in el.get("license-type", "").lower() for i in _INDICATORS[0]) or any(i in "".join(el.itertext()).lower() for i in _INDICATORS[1]) for el in meta.findall("./permissions/license"))


def date_of(meta: ET.Element) -> str | None:
    """An ISO date: of the electronic publication, of any, from parts in order of kind, or of any year."""
    dates = meta.findall("pub-date")
    kind = lambda d: d.get("pub-type") or d.get("date-type") or ""
    for d in [x for x in dates if kind(x) == "epub"] + dates:
        if d.get("iso-8601-date"):
            return d.get("iso-8601-date")
    part = lambda d, n: (d.findtext(n) or "").strip()
    for k in ("epub", "collection", "ppub"):
        for d in dates:
            if kind(d) == k and part(d, "year"):
                return "-".join([part(d, "year"), *((part(d, n) or "01").zfill(2) for n in ("month", "day"))])
    return next((part(d, "year") + "-01-01" for d in dates if part(d, "year")), None)


def normal_section(kind: str, title: str) -> str:
    own = tables.SECTION_TYPES.get(kind.lower(), "other")
    return own if own != "other" else next((t for p, t in tables.TITLE_HINTS if p in title.lower()), "other")


def sections(body: ET.Element | None) -> list[dict]:
    """Paragraphs before any section as an introduction, then each top-level section with its own paragraphs."""
    if body is None:
        return []
    out = []
    lead = "\n\n".join(t for t in (spaced(p) for p in body.findall("./p")) if t)
    if lead:
        out.append({"type": "introduction", "id": "intro", "title": "Introduction", "content": lead})
    for i, sec in enumerate(body.findall("./sec")):
        content = "\n\n".join(t for t in (spaced(p) for p in sec.findall("./p")) if t)
        title = spaced(sec.find("title"))
        if content:
            out.append({"type": normal_section(sec.get("sec-type", ""), title), "id": sec.get("id") or f"sec{i + 1}", "title": title, "content": content})
    return out


def table_list(root: ET.Element) -> list[dict]:
    """Tables of the body, then floating ones; a repeated id keeps the first, one without an id is named by its place in the list."""
    out, seen = [], set()
    for where, short, at in (("inline", "inline", root.find("body")), ("floating", "float", root.find("floats-group"))):
        for wrap in at.iter("table-wrap") if at is not None else []:
            key = wrap.get("id", "")
            if key and key in seen:
                continue
            seen.add(key)
            label, caption, table = wrap.find("label"), wrap.find("caption"), wrap.find("table")
            told = [spaced(p) for p in caption.findall("p")] if caption is not None else []
            out.append({
                "id": key or f"table-{short}-{len(out) + 1}", "location": where, "label": (label.text or "") if label is not None else "", "caption_title": spaced(caption.find("title")) if caption is not None else "",
                "caption_text": " ".join(t for t in told if t), "content": markdown(grid(table), ":---") if table is not None else "", "footnotes": footnotes(wrap),
            })
    return out


def footnotes(wrap: ET.Element) -> list[str]:
    """The notes of a table's foot, then its paragraphs that say something else."""
    foot = wrap.find("table-wrap-foot")
    if foot is None:
        return []
    notes = [t for t in map(spaced, foot.findall("fn")) if t]
    for p in foot.findall("p"):
        if (told := spaced(p)) and told not in notes:
            notes.append(told)
    return notes


def country_of(root: ET.Element, meta: ET.Element) -> tuple[str, str]:
    """(code in capitals, name) of the corresponding author, of the first group of authors, or of any affiliation that has a code; a name without a code stays until one with a code is found."""
    group = meta.find("contrib-group")
    first = group.find(".//aff") if group is not None else None
    code, name = "", ""
    for at in (meta.find("./corresp//country"), first.find("country") if first is not None else None):
        if at is not None and not code:
            code, name = (at.get("country") or "").upper(), spaced(at)
    if not code:
        coded = (c for a in root.iter("aff") if (c := a.find("country")) is not None and c.get("country"))
        at = next(coded, None)
        if at is not None:
            code, name = at.get("country").upper(), spaced(at)
    return code, name


def _abstract(meta: ET.Element) -> str:
    at = meta.find("abstract")
    if at is None:
        return ""
    parts = [spaced(p) for p in at.findall("./p")]
    for sec in at.findall("./sec"):
        words = " ".join(spaced(p) for p in sec.findall("./p"))
        title = spaced(sec.find("title"))
        parts.append(f"{title}: {words}" if title else words)
    return "\n\n".join(p for p in parts if p)


def parse(content: bytes, name: str = "", need_pmid: bool = False, need_open: bool = False, need_commercial: bool = True) -> dict:
    """One article; if it is not to be kept, only skip_reason is set."""
    empty = dict.fromkeys(re.findall(r"(?:^|, |,\n)(\w+) ", re.sub(r"<[^<>]*(?:<[^<>]*>[^<>]*)*>", "", ARTICLE)))
    try:
        root = root_of(content)
    except Exception as e:  # whatever a broken file raises
        return empty | {"skip_reason": f"parse error: {type(e).__name__}"}
    # odd wrappers are let pass: what lacks is empty, and the file's name stands for a missing pmcid
    article = root if root.tag == "article" else root.find(".//article")
    article = root if article is None else article
    meta = next((m for m in (article.find("front/article-meta"), article.find(".//article-meta"), root.find(".//article-meta")) if m is not None), ET.Element("article-meta"))
    ids = _ids(meta)
    missing = need_pmid and not ids["pmid"]
    ids["pmcid"] = ids["pmcid"] or name or None
    license_, open_ = license_of(meta), is_open(meta)
    reason = "missing pmid" if missing else "not open access" if need_open and not open_ else "non-commercial license" if need_commercial and "nc" in license_ else None
    if reason is None and not (ids["pmid"] or ids["pmcid"]):
        reason = "no identifier"
    if reason:
        return empty | {"skip_reason": reason}
    journal = root.find(".//journal-meta")
    get = (lambda p: collapsed(journal.find(p)) or None) if journal is not None else lambda p: None
    body = article.find("body")
    date, body = date_of(meta), root.find(".//body") if body is None else body
    own, found, (code, told) = sections(body), table_list(article), country_of(root, meta)
    words = spaced(body)
    full = bool(own) or len(words) > 100
    groups = [(g.get("kwd-group-type", "").lower(), [collapsed(k) for k in g.findall("kwd") if collapsed(k)]) for g in meta.findall("kwd-group")]
    return empty | ids | {
        "document_id": f"pmid_{ids['pmid']}" if ids["pmid"] else f"pmcid_{ids['pmcid']}", "title": collapsed(meta.find("./title-group/article-title")) or f"Untitled {name}", "abstract": _abstract(meta),
        "article_type": article.get("article-type", "").lower() or "other", "language": article.get("{http://www.w3.org/XML/1998/namespace}lang", "").lower() or "en", "license": license_, "is_open_access": open_, "is_commercial": "nc" not in license_,
        "year": int(date[:4]) if date and date[:4].isdigit() else None, "publication_date": date,
        "journal": {"title": get(".//journal-title"), "abbreviation": get("journal-id[@journal-id-type='nlm-ta']"), "publisher": get(".//publisher-name"), "issn": get("issn[@pub-type='epub']"), "nlm_unique_id": get("journal-id[@journal-id-type='nlm-id']")},
        "country": code or told, "country_name": told,
        "keywords": [k for t, ks in groups if t in ("", "author-keywords") for k in ks], "mesh_terms": [k for t, ks in groups if t == "mesh" for k in ks],
        "sections": own, "section_titles": [x["title"] for x in own], "tables": found, "has_full_text": full, "full_text": words if full else "",
        "extraction_metadata": {"schema_version": "1.0", "empty_body_detected": not full, "tables_in_floats_group": sum(t["location"] == "floating" for t in found)},
    }


def read(files: DataFrame, carry: str | None = None, **switches) -> DataFrame:
    """Articles of binary files (path, content), skipped ones included with their reason. carry: a string column of files to keep."""
    own = ["path", *([carry] if carry else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = batch[own].to_dict("records")
            yield pd.DataFrame([parse(bytes(content), re.sub(r"(?i)\.n?xml(\.gz)?$", "", k["path"].rpartition("/")[2]), **switches) | k for k, content in zip(kept, batch["content"], strict=True)])

    return files.select(*own, "content").mapInPandas(run, f"{carry} string, {ARTICLE}" if carry else ARTICLE)
