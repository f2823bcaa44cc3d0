"""Metadata records and article sets from XML."""

from __future__ import annotations

import re
from collections.abc import Iterator

from . import fixed
from .inline import line, plain
from .tree import Node, parse_xml, to_xml

def parse_records(data: bytes | str) -> Iterator[dict]:
    """A dictionary with the columns of schemas.PARSED for each record; ValueError for one without an id."""
    return (record(n) for n in parse_xml(data).walk() if n.name == "PubmedArticle")


def _value(node: Node, path: str) -> str | None:
    return plain(node.first(path)) or None


def _values(node: Node, path: str) -> list[str]:
    return [plain(n) for n in node.all(path)]


def record(node: Node) -> dict:
    pmid = _value(node, "MedlineCitation/PMID")
    if pmid is None:
        raise ValueError("a record has no id")
    types = _values(node, "MedlineCitation/Article/PublicationTypeList/PublicationType")
    links = [n.get("RefType") for n in node.all("MedlineCitation/CommentsCorrectionsList/CommentsCorrections")]
    return {
        "pmid": pmid, "title": plain(node.first("MedlineCitation/Article/ArticleTitle")), "authors": list(_authors(node)), "journal": _value(node, "MedlineCitation/Article/Journal/Title"),
        **{column: _value(node, f"MedlineCitation/Article/Journal/JournalIssue/PubDate/{part}") for part, column in fixed.DATE_PARTS}, "languages": _values(node, "MedlineCitation/Article/Language"),
        "mesh_terms": _values(node, "MedlineCitation/MeshHeadingList/MeshHeading/DescriptorName"), "publication_types": types, "doi": _identifier(node, "doi"), "pmcid": _identifier(node, "pmc"),
        "abstract": [{"label": (n.get("Label") or "").strip() or None, "text": text} for n in node.all("MedlineCitation/Article/Abstract/AbstractText") if (text := line(n))],
        "retracted": "RetractionIn" in links or any(t.casefold() in fixed.RETRACTED_TYPES for t in types),
    }


def _identifier(node: Node, kind: str) -> str | None:
    return next((v for n in node.all("PubmedData/ArticleIdList/ArticleId") if n.get("IdType") == kind and (v := plain(n))), None)


def _authors(node: Node) -> Iterator[str]:
    for author in node.all("MedlineCitation/Article/AuthorList/Author"):
        person = " ".join(filter(None, (_value(author, "ForeName") or _value(author, "Initials"), _value(author, "LastName"))))
        if name := _value(author, "CollectiveName") or person:
            yield name


def parse_articles(data: bytes | str) -> Iterator[dict]:
    """pmcid, xml, license_raw and has_body of each article that has an id, in document order, repeats included."""
    root = parse_xml(data)
    for node in [root] if root.name == "article" else (n for n in root.walk() if n.name == "article"):
        if pmcid := article_id(node):
            body = node.first("body")
            yield {"pmcid": pmcid, "xml": to_xml(node), "license_raw": license_of(node), "has_body": body is not None and bool(body.text.strip())}


def article_id(node: Node) -> str | None:
    ids = list(node.all("front/article-meta/article-id"))
    digits = (re.sub(r"\D", "", n.text) for kind in fixed.ARTICLE_ID_KINDS for n in ids if n.get("pub-id-type") == kind)
    return next((f"PMC{d}" for d in digits if d), None)


def license_of(node: Node) -> str | None:
    """Of the first licence that says anything: its reference, its own link, a link in it, its type."""
    for given in node.all("front/article-meta/permissions/license"):
        inside = list(given.walk())
        says = [
            *(n.text for n in inside if n.name == "license_ref"), given.get("href", fixed.XLINK), *(n.get("href", fixed.XLINK) for n in inside if n.name == "ext-link"), given.get("license-type"),
        ]
        if found := next((s.strip() for s in says if s and s.strip()), None):
            return found
    return None
