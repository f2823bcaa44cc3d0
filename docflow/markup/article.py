"""Full-text articles to Markdown.

An article becomes ``# title``, ``## Abstract``, the abstract and the body, as blocks with a blank line between, in NFC, with one
final newline. Each block kind has a method, found by the element's name; elements without one give way to their children.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

from . import fixed
from .inline import escape, guard, inner, line, mixed, nfc, plain, tidy
from .tables import table_markdown
from .tree import Node

DEEPEST_HEADING = 6
#: Paragraphs, and what stands in them, come in parts of three kinds.
TEXT, LIST, BLOCK = "text", "list", "block"
Part = tuple[str, str]


def title_of(article: Node) -> str | None:
    return plain(article.first("front/article-meta/title-group/article-title")) or None


def convert(article: Node, title: str, fallback_abstract: Sequence[tuple[str | None, str]] = ()) -> str:
    """fallback_abstract: (label, text) sections, used if the article has no abstract of its own."""
    page = _Page()
    opening = [f"# {escape(title)}", "## Abstract", *page.abstract(article, fallback_abstract)]
    body = article.first("body")
    main = list(page.blocks(body, 2)) if body is not None else []
    if main and not main[0].startswith("## "):
        main.insert(0, f"## {fixed.LEADING_HEADING}")  # else it would stand under the abstract
    return nfc("\n\n".join(filter(None, opening + main)) + "\n")


def hidden_section(section: Node) -> bool:
    title = section.first("title")
    by_title = title is not None and fixed.HIDDEN_SECTION_TITLE.fullmatch(plain(title))
    return (section.get("sec-type") or "").casefold() in fixed.HIDDEN_SECTION_TYPES or bool(by_title)


def fenced(kind: str, ident: str | None, fallback: str, parts: Iterable[str]) -> str:
    name = re.sub(r"[^A-Za-z0-9_.:-]+", "_", (ident or "").strip()) or fallback
    return "\n\n".join([f"::: {kind} id={name}", *parts, ":::"])


class _Page:
    def __init__(self) -> None:
        self.seen = {"table": 0, "figure": 0}
        self.kinds = {
            "sec": self.section, "p": lambda n, _: (text for _, text in self.paragraph(n, guard)), "list": lambda n, _: [self.items(n)], "def-list": lambda n, _: [definitions(n)],
            "table-wrap": lambda n, _: self.table(n), "table": lambda n, _: [table_markdown(n)], "fig": lambda n, _: self.figure(n), "disp-formula": lambda n, _: [tidy(mixed([n]))],
            "boxed-text": self.box, "disp-quote": lambda n, _: [self.quotation(n)], "preformat": lambda n, _: [code(n)], "code": lambda n, _: [code(n)], "statement": self.statement,
            "heading": lambda n, _: [f"{'#' * int(n.get('level') or 1)} {escape(plain(n))}"] if plain(n) else [],
        }

    def blocks(self, parent: Node, level: int) -> Iterator[str]:
        for child in parent.elements:
            yield from self.block(child, level)

    def block(self, node: Node, level: int) -> Iterator[str]:
        if node.name not in fixed.NEVER_SHOWN:
            yield from filter(None, self.kinds.get(node.name, self.blocks)(node, level))

    def abstract(self, article: Node, fallback: Sequence[tuple[str | None, str]]) -> list[str]:
        for own in article.all("front/article-meta/abstract"):
            if (own.get("abstract-type") or "abstract").casefold() in fixed.ABSTRACT_TYPES and (found := list(self.blocks(own, 3))):
                return found
        return [x for label, text in fallback for x in ([f"### {escape(label)}"] if label else []) + [guard(text)]]

    def section(self, node: Node, level: int) -> Iterator[str]:
        """A section without a title does not use up a level."""
        if hidden_section(node):
            return
        if title := plain(node.first("title")):
            yield f"{'#' * min(level, DEEPEST_HEADING)} {escape(title)}"
            level += 1
        yield from self.blocks(node, level)

    def paragraph(self, node: Node, shield=lambda text: text) -> Iterator[Part]:
        """Runs of inline content as text, and the blocks between them."""
        apart = lambda c: isinstance(c, Node) and c.name in fixed.BLOCKS_IN_PARAGRAPHS
        for is_block, run in groupby(node.children, apart):
            if not is_block:
                if text := tidy(mixed(run)):
                    yield TEXT, shield(text)
                continue
            for child in run:
                yield from self.nested(child)

    def nested(self, node: Node) -> Iterator[Part]:
        if node.name == "list":
            if text := self.items(node):
                yield LIST, text
        else:
            yield from ((BLOCK, text) for text in self.block(node, 2))

    def item(self, node: Node) -> Iterator[Part]:
        for child in node.children:
            if isinstance(child, str):
                if text := tidy(escape(child)):
                    yield TEXT, text
            elif child.name == "p":
                yield from self.paragraph(child)
            else:
                yield from self.nested(child)

    def items(self, node: Node) -> str:
        """Continuations are indented by the marker's width; lists stand close, other blocks after a blank line."""
        numbered = (node.get("list-type") or "").casefold() in fixed.NUMBERED_LISTS
        out: list[str] = []
        filled = (parts for item in node.all("list-item") if (parts := list(self.item(item))))
        for number, parts in enumerate(filled, 1):
            mark = f"{number}. " if numbered else "- "
            pad = " " * len(mark)
            for at, (kind, text) in enumerate(parts):
                if kind == TEXT:
                    out += [mark + text] if at == 0 else ["", pad + text]
                    continue
                if at == 0:
                    out.append(mark.rstrip())
                elif kind == BLOCK:
                    out.append("")
                out += [pad + x if x else x for x in text.split("\n")]
        return "\n".join(out)

    def box(self, node: Node, level: int) -> Iterator[str]:
        title = next((t for path in ("title", "caption/title") if (t := node.first(path)) is not None), None)
        if plain(title):
            yield f"**{line(title)}**"
        yield from self.blocks(node, level)

    def quotation(self, node: Node) -> str:
        return "\n>\n".join(f"> {text}" for p in node.all("p") for _, text in self.paragraph(p))

    def statement(self, node: Node, level: int) -> Iterator[str]:
        if head := " ".join(filter(None, (plain(node.first("label")), plain(node.first("title"))))):
            yield f"**{escape(head)}**"
        yield from self.blocks(node, level)

    def number(self, kind: str) -> int:
        self.seen[kind] += 1
        return self.seen[kind]

    def figure(self, node: Node) -> list[str]:
        fallback, parts = f"f{self.number('figure')}", caption(node)
        return [fenced("figure", node.get("id"), fallback, parts)] if parts else []

    def table(self, node: Node) -> list[str]:
        fallback = f"t{self.number('table')}"
        grid = next((n for n in node.walk() if n.name == "table"), None)
        parts = [*caption(node), *filter(None, [table_markdown(grid) if grid is not None else ""]), *footnotes(node)]
        return [fenced("table", node.get("id"), fallback, parts)] if parts else []


def definitions(node: Node) -> str:
    pairs = ((line(n.first("term")), line(n.first("def"))) for n in node.walk() if n.name == "def-item")
    return "\n".join(f"- **{t}**: {d}" if t and d else f"- {t or d}" for t, d in pairs if t or d)


def code(node: Node) -> str:
    text = node.text.strip("\n")
    return f"```\n{text}\n```" if text.strip() else ""


def caption(node: Node) -> list[str]:
    """Label and title in bold; a caption without a title gives its first paragraph for it; then its paragraphs."""
    label, words = plain(node.first("label")).rstrip(".:"), node.first("caption")
    title = line(words.first("title")) if words is not None else ""
    rest = [text for p in (words.all("p") if words is not None else ()) if (text := line(p))]
    if not title and rest:
        title, *rest = rest
    head = " ".join(filter(None, (label and f"{label}.", title)))
    return ([f"**{head}**"] if head else []) + [guard(text) for text in rest]


def footnotes(node: Node) -> list[str]:
    out = []
    for note in (n for foot in node.all("table-wrap-foot") for n in foot.walk() if n is not foot or n.name in ("fn", "p")):
        if note.name == "fn":
            label, text = plain(note.first("label")), " ".join(filter(None, map(line, note.all("p"))))
            if text:
                out.append(f"<sup>{label}</sup> {text}" if label else text)
        elif note.name == "p" and all(a.name != "fn" for a in note.ancestors()) and (text := tidy(inner(note))):
            out.append(guard(text))
    return out
