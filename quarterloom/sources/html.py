"""A small tolerant HTML tree and the grid of a table, from the standard library.

Unclosed rows, cells, paragraphs and list items end where the next begins;
``thead`` and ``tbody`` are looked through; a hidden row is no row; a lone cell
spans the table; ``th`` is a cell.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

# Fixed values.
VOID = frozenset(["br", "hr", "img", "input", "meta", "link", "col", "area", "base", "wbr"])
_ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "li": ("li",), "p": ("p",), "option": ("option",)}
_WALLS = {"td": "tr", "th": "tr", "tr": "table", "li": "ul", "p": "td", "option": "select"}
#: Cell texts that stand for nothing.
NOTHING = frozenset(["", "#N/A", "N/A", "NA", "n/a", "NULL", "null", "NaN", "nan", "-NaN", "-nan", "<NA>", "None"])

HIDDEN = re.compile(r"visibility:\s*hidden")


class Node:
    __slots__ = ("_grid", "attrs", "children", "name", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Node | str] = []
        self._grid: list[list[str | None]] | None = None

    def walk(self, name: str) -> Iterator[Node]:
        """Elements of that name in document order."""
        for c in self.children:
            if isinstance(c, Node):
                if c.name == name:
                    yield c
                yield from c.walk(name)

    def has(self, name: str) -> bool:
        return next(self.walk(name), None) is not None

    def strings(self) -> Iterator[str]:
        for c in self.children:
            if isinstance(c, Node):
                yield from c.strings()
            else:
                yield c

    def texts(self) -> Iterator[str]:
        """Stripped text parts, depth first; after a table's own parts the
        first column of its grid."""
        for c in self.children:
            if isinstance(c, Node):
                yield from c.texts()
            elif t := c.strip():
                yield t
        if self.name == "table" and not self.has("table"):
            for row in self.grid():
                if row and row[0] is not None:
                    yield row[0]

    def before(self, levels: int, most: int, enough: int = 2) -> Iterator[Node]:
        """Elements before this one, nearest first; where fewer than
        ``enough`` lie on a level the search goes on before the parent, up to
        the text's own element."""
        node: Node | None = self
        while node is not None and node.parent is not None:
            seen = 0
            at = node.parent.children.index(node)
            for c in reversed(node.parent.children[:at]):
                if isinstance(c, Node):
                    yield c
                    seen += 1
                    if seen == most:
                        break
            if seen >= enough or levels <= 0 or node.parent.name in ("text", "#root"):
                return
            levels -= 1
            node = node.parent

    def grid(self) -> list[list[str | None]]:
        """Cells by row and column, spans written out, None for nothing."""
        if self._grid is None:
            self._grid = _grid(self)
        return self._grid


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def _close(self, names: tuple[str, ...], wall: str) -> None:
        node = self.at
        while node.parent is not None and node.name != wall and node.name not in ("table", "#root"):
            if node.name in names:
                self.at = node.parent
                # a new row ends an open cell and its row
                if len(names) < 3 or node.name == "tr":
                    return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _ENDS:
            self._close(_ENDS[tag], _WALLS[tag] if tag not in ("td", "th") else "tr")
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.name != tag:
            if node.name == "table" and tag not in ("body", "html", "text"):
                return  # a stray end inside a table closes nothing outside it
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def _rows(table: Node) -> Iterator[Node]:
    for c in table.children:
        if isinstance(c, Node) and c.name != "table":
            if c.name == "tr":
                if not HIDDEN.search(c.attrs.get("style", "")):
                    yield c
            else:
                yield from _rows(c)


def _cells(row: Node) -> Iterator[Node]:
    for c in row.children:
        if isinstance(c, Node) and c.name not in ("table", "tr"):
            if c.name in ("td", "th"):
                yield c
            else:
                yield from _cells(c)


def _span(cell: Node, name: str) -> int:
    m = re.match(r"\s*(\d+)", cell.attrs.get(name, ""))
    return min(max(int(m.group(1)), 1), 1000) if m else 1


def _grid(table: Node) -> list[list[str | None]]:
    rows = [list(_cells(r)) for r in _rows(table)]
    width = max((sum(_span(c, "colspan") for c in r) for r in rows), default=0)
    if not width:
        return []
    out: list[list[str | None]] = []
    carried: dict[int, tuple[int, str | None]] = {}  # column -> rows left, text
    for cells in rows:
        line: dict[int, str | None] = {}
        below: dict[int, tuple[int, str | None]] = {}
        for col, (left, text) in carried.items():
            line[col] = text
            if left > 1:
                below[col] = (left - 1, text)
        col = 0
        for c in cells:
            text: str | None = " ".join("".join(c.strings()).split())
            text = None if text in NOTHING else text
            wide = width if len(cells) == 1 and "colspan" not in c.attrs else _span(c, "colspan")
            deep = _span(c, "rowspan")
            for _ in range(wide):
                while col in line:
                    col += 1
                line[col] = text
                if deep > 1:
                    below[col] = (deep - 1, text)
                col += 1
        carried = below
        out.append([line.get(i) for i in range(max(line, default=-1) + 1)])
    width = max(map(len, out))
    return [r + [None] * (width - len(r)) for r in out]
