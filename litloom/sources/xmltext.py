"""Small helpers over ElementTree, shared by the parsers."""

from __future__ import annotations

import gzip
import xml.etree.ElementTree as ET


def local(el: ET.Element) -> str:
    return el.tag.rpartition("}")[2] if isinstance(el.tag, str) else ""


def joined(el: ET.Element | None) -> str:
    """All text as it stands, outer white space off."""
    return "" if el is None else "".join(el.itertext()).strip()


def spaced(el: ET.Element | None) -> str:
    """All pieces of text with a blank between them."""
    return "" if el is None else " ".join(el.itertext()).strip()


def collapsed(el: ET.Element | None) -> str:
    return "" if el is None else " ".join("".join(el.itertext()).split())


def text_without(el: ET.Element | None, left_out: set[str]) -> str:
    """An element's text without that of the named elements at any depth (what follows them stays), white space collapsed."""
    parts: list[str] = []

    def walk(at: ET.Element) -> None:
        parts.append(at.text or "")
        for child in at:
            if child.tag not in left_out:
                walk(child)
            parts.append(child.tail or "")

    if el is not None:
        walk(el)
    return " ".join("".join(parts).split())


def text_at(el: ET.Element, path: str) -> str | None:
    found = el.find(path)
    return (found.text or "").strip() or None if found is not None else None


def root_of(content: bytes) -> ET.Element:
    """The parsed document; gzip is recognised by its first bytes, name spaces are dropped from element names."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    root = ET.fromstring(content)
    for el in root.iter():
        if isinstance(el.tag, str) and "}" in el.tag:
            el.tag = local(el)
    return root
