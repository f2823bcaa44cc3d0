"""A small element tree on expat that never loads a DTD, reads a file or expands an entity."""

from __future__ import annotations

from collections.abc import Iterator
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr


class Node:
    """An element: local name, namespace, attributes by (namespace, name) or name, and children, nodes and strings in order."""

    __slots__ = ("attributes", "children", "name", "parent", "space")

    def __init__(self, name: str, space: str = "", attributes: dict | None = None, parent: Node | None = None) -> None:
        self.name, self.space, self.attributes, self.parent = name, space, attributes or {}, parent
        self.children: list[Node | str] = []
        if parent is not None:
            parent.children.append(self)

    def add_text(self, text: str) -> None:
        if self.children and isinstance(self.children[-1], str):
            self.children[-1] += text
        else:
            self.children.append(text)

    def get(self, name: str, space: str = "") -> str | None:
        return self.attributes.get((space, name))

    @property
    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def all(self, path: str) -> Iterator[Node]:
        """Elements at a path of names below this one, in document order."""
        head, _, rest = path.partition("/")
        for child in self.elements:
            if child.name == head:
                if rest:
                    yield from child.all(rest)
                else:
                    yield child

    def first(self, path: str) -> Node | None:
        return next(self.all(path), None)

    def walk(self) -> Iterator[Node]:
        """This element and all below it, in document order, without recursion."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(reversed(node.elements))

    @property
    def text(self) -> str:
        out: list[str] = []
        todo: list[Node | str] = [self]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                out.append(item)
            else:
                todo.extend(reversed(item.children))
        return "".join(out)

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


def _split(name: str) -> tuple[str, str]:
    space, _, local = name.rpartition(" ")
    return space, local


class _Builder:
    def __init__(self) -> None:
        self.top = Node("")
        self.at = self.top

    def start(self, name: str, attributes: dict[str, str]) -> None:
        space, local = _split(name)
        self.at = Node(local, space, {_split(k): v for k, v in attributes.items()}, self.at)

    def end(self, name: str) -> None:
        self.at = self.at.parent or self.top

    def data(self, text: str) -> None:
        self.at.add_text(text)


def parse_xml(data: bytes | str) -> Node:
    """Root element. Comments, processing instructions and entities other than the five of XML are skipped; ValueError if not well-formed."""
    builder, parser = _Builder(), expat.ParserCreate(namespace_separator=" ")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = builder.start, builder.end, builder.data
    parser.DefaultHandler = lambda _: None  # a default handler that does not expand keeps internal entities out
    parser.SetParamEntityParsing(expat.XML_PARAM_ENTITY_PARSING_NEVER)
    parser.UseForeignDTD(True)
    parser.ExternalEntityRefHandler = lambda *_: 1
    try:
        parser.Parse(data, True)
    except expat.ExpatError as problem:
        raise ValueError(f"not well-formed XML: {problem}") from problem
    root = builder.top.elements[0]
    root.parent = None
    return root


_PREFIXES = {"http://www.w3.org/1999/xlink": "xlink", "http://www.w3.org/1998/Math/MathML": "mml", "http://www.niso.org/schemas/ali/1.0/": "ali"}
_XML = "http://www.w3.org/XML/1998/namespace"


def to_xml(root: Node) -> bytes:
    """The element as a document of its own, UTF-8 with a declaration; namespaces get prefixes at the root."""
    spaces = {s for n in root.walk() for s in (n.space, *(k[0] for k in n.attributes)) if s and s != _XML}
    prefix = {s: _PREFIXES.get(s, f"ns{i}") for i, s in enumerate(sorted(spaces))} | {_XML: "xml"}
    declared = "".join(f" xmlns:{prefix[s]}={quoteattr(s)}" for s in sorted(spaces))
    out = ["<?xml version='1.0' encoding='utf-8'?>\n"]
    todo: list[Node | str | tuple[str]] = [root]
    while todo:
        item = todo.pop()
        if isinstance(item, tuple):
            out.append(item[0])
            continue
        if isinstance(item, str):
            out.append(escape(item))
            continue
        full = f"{prefix[item.space]}:{item.name}" if item.space else item.name
        attributes = "".join(f" {prefix[s] + ':' if s else ''}{k}={quoteattr(v)}" for (s, k), v in item.attributes.items())
        head = f"<{full}{declared if item is root else ''}{attributes}"
        if item.children:
            out.append(head + ">")
            todo.append((f"</{full}>",))
            todo.extend(reversed(item.children))
        else:
            out.append(head + "/>")
    return "".join(out).encode("utf-8")
