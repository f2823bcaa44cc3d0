"""Inline markup to Markdown.

A removed citation leaves GONE behind until ``tidy``, which then knows what brackets and separators were only for it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

from . import fixed
from .tree import Node

GONE = fixed.GONE
_CITED = dict.fromkeys(map(ord, GONE + fixed.SEPARATORS + fixed.DASHES))
TEX_FRAME = re.compile(r"^\\\[|\\\]$|^\$+|\$+$")


def nfc(text: str) -> str:
    return unicodedata.normalize("NFC", text)


def squeeze(text: str) -> str:
    return " ".join(text.split())


def spaced(text: str) -> str:
    """As squeeze, with a space for white space at either end."""
    words = squeeze(text)
    return f"{' ' * text[:1].isspace()}{words}{' ' * text[-1:].isspace()}" if words else " " * bool(text)


def escape(text: str) -> str:
    return fixed.OPENING.sub("&lt;", fixed.SPECIAL.sub(r"\\\g<0>", text))


def plain(node: Node | None) -> str:
    """Text alone, for titles and labels; empty without a node."""
    return nfc(squeeze(node.text)) if node is not None else ""


class Gaps:
    """A text cut at its removed citations: ``texts`` stand around the gaps that are left, one more than there are gaps."""

    def __init__(self, text: str) -> None:
        self.texts = text.split(GONE)

    def close(self, decide: Callable[[str, str], tuple[str, str] | None]) -> None:
        """Each gap in turn: decide(left, right) gives what is left of the texts beside it if it closes, None if it stays.

        To a later gap, what stands before an earlier one is out of sight.
        """
        done, now = [""], self.texts[0]
        for right in self.texts[1:]:
            if (closed := decide(now, right)) is None:
                done[-1] += now
                done.append("")
                now = right
            else:
                done[-1] += closed[0]
                now = closed[1]
        done[-1] += now
        self.texts = done

    def merge(self) -> None:
        """Gaps with no more than a separator between them are one."""
        ends = (self.texts[0], self.texts[-1]) if len(self.texts) > 1 else ()
        between = [t for t in self.texts[1:-1] if t.strip() not in {"", *fixed.SEPARATORS, *fixed.DASHES}]
        self.texts = [ends[0], *between, ends[1]] if ends else self.texts


def _ends(text: str, marks: str) -> bool:
    return text.rstrip()[-1:] in {*marks}


def _begins(text: str, marks: str) -> bool:
    return text.lstrip()[:1] in {*marks}


def _alone_in_brackets(left: str, right: str) -> tuple[str, str] | None:
    opening, closing = fixed.BRACKETS
    return (left.rstrip()[:-1].rstrip(), right.lstrip()[1:]) if _ends(left, opening) and _begins(right, closing) else None


def _first_in_brackets(left: str, right: str) -> tuple[str, str] | None:
    return (left.rstrip(), right.lstrip()[1:].lstrip()) if _ends(left, fixed.BRACKETS[0]) and _begins(right, fixed.SEPARATORS) else None


def _last_in_brackets(left: str, right: str) -> tuple[str, str] | None:
    return (left.rstrip()[:-1], right.lstrip()) if _ends(left, fixed.SEPARATORS) and _begins(right, fixed.BRACKETS[1]) else None


def tidy(text: str) -> str:
    """Without gaps, and without the brackets, separators and spaces that were there for citations alone."""
    gaps = Gaps(spaced(text))
    gaps.merge()
    for decide in (_alone_in_brackets, _first_in_brackets, _last_in_brackets):
        gaps.close(decide)
    return nfc(squeeze("".join([*(t.rstrip() for t in gaps.texts[:-1]), gaps.texts[-1]])))


def guard(paragraph: str) -> str:
    """A paragraph that would be read as a list, heading, quotation or fence, with a backslash."""
    digits = next((i for i, c in enumerate(paragraph) if not c.isdecimal()), len(paragraph))
    if digits and paragraph[digits : digits + 1] in (".", ")") and paragraph[digits + 1 : digits + 2].isspace():
        return f"{paragraph[:digits]}\\{paragraph[digits:]}"
    mark = len(paragraph) - len(paragraph.lstrip("#")) or (paragraph[:1] in (">", "+", "-"))
    marked = 0 < mark <= 6 and paragraph[mark : mark + 1].isspace()
    return "\\" + paragraph if marked or paragraph.startswith((":::", "---")) else paragraph


def mixed(children: Iterable[Node | str]) -> str:
    """Children in order, not yet tidy."""
    return "".join(escape(c) if isinstance(c, str) else render(c) for c in children)


def inner(node: Node) -> str:
    return mixed(node.children)


def line(node: Node | None) -> str:
    return tidy(inner(node)) if node is not None else ""


def render(node: Node) -> str:
    how = _RENDER.get(node.name)
    return how(node) if how else inner(node)


def _emphasis(mark: str) -> Callable[[Node], str]:
    def wrapped(node: Node) -> str:
        text = inner(node)
        core = text.strip()
        return text.replace(core, f"{mark}{core}{mark}", 1) if core else text

    return wrapped


def _raised(node: Node) -> str:
    text = inner(node)
    if not text.strip() or GONE in text and not text.translate(_CITED).strip():
        return GONE if GONE in text else ""
    return f"<{node.name}>{text.strip()}</{node.name}>"


def _reference(node: Node) -> str:
    return GONE if node.get("ref-type") in fixed.CITING_REFS else inner(node)


def _link(node: Node) -> str:
    text, href, shown = inner(node), node.get("href", fixed.XLINK) or "", squeeze(node.text)
    named = href.startswith(("http://", "https://")) and shown not in ("", href)
    return f"[{text.strip()}]({href})" if named else text


def _math(node: Node) -> str:
    return escape(squeeze(node.text))


def _formula(node: Node) -> str:
    """TeX if the element holds any, else its text."""
    for tex in (TEX_FRAME.sub("", squeeze(n.text)).strip() for n in node.walk() if n.name == "tex-math"):
        if tex:
            return f"$${tex}$$" if node.name == "disp-formula" else f"${tex}$"
    return _math(node)


def _one_of(node: Node) -> str:
    """The same content in several forms: TeX, or else the first that is not a picture."""
    if node.first("tex-math"):
        return _formula(node)
    return next((render(c) for c in node.elements if c.name not in ("graphic", "media", "inline-graphic")), "")


_RENDER: dict[str, Callable[[Node], str]] = {
    **{name: lambda node: f" {inner(node)} " for name in fixed.SPACED},
    **dict.fromkeys(fixed.ITALIC, _emphasis("*")),
    **dict.fromkeys(fixed.BOLD, _emphasis("**")),
    **{name: lambda node: "" for name in fixed.INLINE_DROPPED},
    "break": lambda node: " ", "sup": _raised, "sub": _raised, "xref": _reference, "ext-link": _link, "uri": _link,
    "inline-formula": _formula, "disp-formula": _formula, "math": _math, "alternatives": _one_of,
}
