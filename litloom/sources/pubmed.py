"""Bibliographic records in PubMed XML."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from litloom.sources.xmltext import joined, root_of, text_at

ARTICLE = """pmid string, doi string, pmc string, pii string, other_ids map<string,string>, title string, abstract string,
abstract_structured array<struct<label:string,nlm_category:string,text:string>>, has_structured_abstract boolean, year int, journal string,
journal_full struct<title:string,iso_abbreviation:string,issn:string,issn_type:string,volume:string,issue:string,cited_medium:string,nlm_unique_id:string>,
publication_date struct<year:string,month:string,day:string,medline_date:string,date_str:string>,
mesh_terms array<struct<descriptor:string,descriptor_ui:string,major_topic:boolean,type:string,qualifiers:array<struct<name:string,ui:string,major_topic:boolean>>>>,
mesh_terms_flat array<string>, keywords array<struct<keyword:string,major_topic:boolean,owner:string>>, keywords_flat array<string>,
publication_types array<struct<type:string,ui:string>>, publication_types_flat array<string>, affiliations array<string>, grant_agencies array<string>"""

_KINDS = {"pubmed": "pmid", "doi": "doi", "pmc": "pmc", "pmcid": "pmc", "pii": "pii"}
_yes = lambda el: el is not None and el.get("MajorTopicYN") == "Y"


def _ids(article: ET.Element) -> dict:
    out: dict = {"pmid": text_at(article, "./MedlineCitation/PMID"), "doi": None, "pmc": None, "pii": None, "other_ids": {}}
    for el in article.findall("./PubmedData/ArticleIdList/ArticleId"):
        kind, value = el.get("IdType", ""), (el.text or "").strip()
        if value:
            (out if kind in _KINDS else out["other_ids"])[_KINDS.get(kind, kind)] = value
    for el in article.findall("./MedlineCitation/Article/ELocationID"):
        kind = el.get("EIdType", "")
        if kind in ("doi", "pii") and not out[kind]:
            out[kind] = (el.text or "").strip() or None
    return out


def _abstract(article: ET.Element) -> dict:
    parts, labelled = [], []
    for el in article.findall("./MedlineCitation/Article/Abstract/AbstractText"):
        text, label = joined(el), el.get("Label")
        if text:
            parts.append(f"{label}: {text}" if label else text)
            if label:
                labelled.append({"label": label, "nlm_category": el.get("NlmCategory"), "text": text})
    return {"abstract": " ".join(parts), "abstract_structured": labelled, "has_structured_abstract": bool(labelled)}


def _date(article: ET.Element) -> dict:
    at = article.find("./MedlineCitation/Article/Journal/JournalIssue/PubDate")
    get = (lambda n: text_at(at, n)) if at is not None else lambda n: None
    year, month, day, medline = get("Year"), get("Month"), get("Day"), get("MedlineDate")
    if not year and medline and (m := re.search(r"\d{4}", medline)):
        year_of = m.group()
    else:
        year_of = year
    told = " ".join(x for x in (year, month if year else None, day if year and month else None) if x) or medline
    return {"year": int(year_of) if year_of and year_of.isdigit() else None, "publication_date": {"year": year_of, "month": month, "day": day, "medline_date": medline, "date_str": told}}


def _journal(article: ET.Element) -> dict:
    at = article.find("./MedlineCitation/Article/Journal")
    get = (lambda p: text_at(at, p)) if at is not None else lambda p: None
    issn, issue = (at.find("./ISSN"), at.find("./JournalIssue")) if at is not None else (None, None)
    full = {"title": get("Title"), "iso_abbreviation": get("ISOAbbreviation"), "issn": get("ISSN"), "issn_type": issn.get("IssnType") if issn is not None else None, "volume": get("./JournalIssue/Volume"), "issue": get("./JournalIssue/Issue"), "cited_medium": issue.get("CitedMedium") if issue is not None else None, "nlm_unique_id": text_at(article, "./MedlineCitation/MedlineJournalInfo/NlmUniqueID")}
    return {"journal": full["title"] or full["iso_abbreviation"] or "", "journal_full": full}


def _terms(article: ET.Element) -> dict:
    mesh = []
    for heading in article.findall("./MedlineCitation/MeshHeadingList/MeshHeading"):
        name = heading.find("DescriptorName")
        if name is not None and joined(name):
            mesh.append({"descriptor": joined(name), "descriptor_ui": name.get("UI"), "major_topic": _yes(name), "type": name.get("Type"), "qualifiers": [{"name": joined(q), "ui": q.get("UI"), "major_topic": _yes(q)} for q in heading.findall("QualifierName")]})
    first = article.find("./MedlineCitation/KeywordList")
    keywords = [{"keyword": joined(k), "major_topic": _yes(k), "owner": first.get("Owner")} for k in first.findall("Keyword") if joined(k)] if first is not None else []
    types = [{"type": joined(t), "ui": t.get("UI")} for t in article.findall("./MedlineCitation/Article/PublicationTypeList/PublicationType") if joined(t)]
    return {"mesh_terms": mesh, "mesh_terms_flat": [m["descriptor"] for m in mesh], "keywords": keywords, "keywords_flat": [k["keyword"] for k in keywords], "publication_types": types, "publication_types_flat": [t["type"] for t in types]}


def parse_article(article: ET.Element) -> dict:
    """One record; a title may be empty, nothing is filtered here."""
    title = joined(article.find("./MedlineCitation/Article/ArticleTitle"))
    affiliations = [a.text for a in article.iter("Affiliation") if a.text]
    grants = [a.text for g in article.iter("Grant") for a in g.findall("Agency") if a.text]
    return _ids(article) | {"title": title} | _abstract(article) | _date(article) | _journal(article) | _terms(article) | {"affiliations": affiliations, "grant_agencies": grants}


def articles(content: bytes) -> Iterator[dict]:
    """The records of a file, plain or gzip; those before a syntax error still come out."""
    import gzip
    import io
    import zlib

    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    try:
        for _, el in ET.iterparse(stream):
            if el.tag == "PubmedArticle":
                yield parse_article(el)
                el.clear()
    except (ET.ParseError, EOFError, OSError, zlib.error):
        return


def read(files: DataFrame, column: str = "content") -> DataFrame:
    """Records of binary files (path, content), one row each, parsed file by file with a stream per file; of many small files the records go on together."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[dict] = []
        for batch in batches:
            for content in batch[column]:
                for a in articles(bytes(content)):
                    rows.append(a)
                    if len(rows) == 1000:
                        yield pd.DataFrame(rows)
                        rows = []
        if rows:
            yield pd.DataFrame(rows)

    return files.select(column).mapInPandas(run, ARTICLE)


__all__ = ["ARTICLE", "articles", "parse_article", "read", "root_of"]
