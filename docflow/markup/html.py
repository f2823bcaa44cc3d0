"""Web pages to Markdown: a forgiving parser that builds the article tree, so that one converter serves both."""

from __future__ import annotations

from html.parser import HTMLParser

from . import fixed
from .article import _Page
from .inline import nfc
from .tree import Node

# HTML names of article elements, elements without content, and what pages show beside their text.
NAMES = {"ul": "list", "ol": "list", "li": "list-item", "br": "break", "a": "ext-link", "pre": "preformat", "blockquote": "disp-quote", "dl": "def-list", "figure": "fig", "figcaption": "caption"}
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
HIDDEN = ("script", "style", "nav", "footer", "head", "noscript", "template", "form", "aside", "iframe", "svg")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
BLOCKS = ("p", "div", "ul", "ol", "table", "article", "section", "main", "body", "blockquote", "pre", "dl", "figure", *HEADINGS)


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = self.top = Node("html")
        self.open: list[tuple[str, Node]] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        have = dict(attrs)
        if self.hidden or tag in HIDDEN or (tag == "div" and "ad" in (have.get("class") or "").split()):
            self.hidden += tag not in VOID
            return
        if tag in BLOCKS:
            self._close(("p",))
        if tag == "li":
            self._close(("li",), until=("ul", "ol"))
        if tag in ("tr", "td", "th"):
            self._close(("td", "th") if tag != "tr" else ("tr",), until=("table", "tr") if tag != "tr" else ("table",))
        attributes = {("", k): v or "" for k, v in have.items()}
        if tag == "a":
            attributes[fixed.XLINK, "href"] = have.get("href") or ""
        if tag == "ol":
            attributes["", "list-type"] = "order"
        if tag in HEADINGS:
            attributes["", "level"] = tag[1]
        if tag in VOID:
            if tag == "br":
                Node("break", "", {}, self.at)
            return
        self.at = Node("heading" if tag in HEADINGS else NAMES.get(tag, tag), "", attributes, self.at)
        self.open.append((tag, self.at))

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            self.hidden -= tag not in VOID
        else:
            self._close((tag,), until=() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        if self.at.name in ("html", "body", "article", "main", "section", "div") and data.strip():
            Node("p", "", {}, self.at).add_text(data)
        else:
            self.at.add_text(data)

    def _close(self, tags: tuple[str, ...], until: tuple[str, ...] = ()) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                self.at = self.open[i][1].parent or self.top
                del self.open[i:]
                return
            if self.open[i][0] in until:
                return


def html_markdown(source: str) -> str:
    """Headings, paragraphs, lists and tables of a page, less menus, adverts, scripts and footers."""
    reader = _Reader()
    reader.feed(source)
    reader.close()
    return nfc("\n\n".join(_Page().blocks(reader.top, 1)) + "\n")
