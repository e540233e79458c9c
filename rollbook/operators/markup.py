"""Listing markup -> cell texts, for one page.

The tree rules are those of a lenient tag-soup reader: an end tag closes the
nearest open element of its name and everything opened since, an end tag without
an open element is ignored, nothing is closed by a start tag, void elements hold
nothing, and a text of nothing but spaces shrinks to one line break or space.
Rows, cells and children are kept as ranges over document order, so a page costs
time linear in its length however deeply its cells are nested.

Pages are cut into tokens by one regular expression as long as their markup is
clean; the first token that is not clean sends the page through ``html.parser``
from its start, which is several times slower.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape
from html.parser import HTMLParser

from rollbook.sources.sites import Cell, Layout

# Elements without content.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)

# Fixed value: the characters that count as spaces.
SPACES = " \n\t\f\r"

_ATTRIBUTES = r"""((?:\s++[^\s/=>"'<]++(?:=(?:"[^"]*+"|'[^']*+'|[^\s"'=<>`]++))?+)*+)\s*+"""

# Text, then one tag, comment, doctype or whole raw element, or a ``<`` that is none of these.
_TOKEN = re.compile(
    rf"""([^<]*+)(?:
      </([a-zA-Z][a-zA-Z0-9:-]*+)\s*+>
    | <([sS][cC][rR][iI][pP][tT]|[sS][tT][yY][lL][eE])(?=[\s>]){_ATTRIBUTES}>
      (?:[^<]++|<(?!/(?i:script|style)))*+</(?i:\3)\s*+>
    | <(?!(?i:script|style)[\s/>])([a-zA-Z][a-zA-Z0-9:-]*+){_ATTRIBUTES}(/?)>
    | <!--(?:[^-]|-(?!-))*+-->
    | <![dD][oO][cC][tT][yY][pP][eE]\s[^>\[]*+>
    | (<)
    | \Z)""",
    re.VERBOSE,
)
_ATTRIBUTE = re.compile(r"""\s+([^\s=]+)(?:=(?:"([^"]*)"|'([^']*)'|(\S+)))?""")


class PageError(ValueError):
    """Why a page is discarded as a whole."""


class _Closed(Exception):
    """The container has ended; the rest of the page cannot matter."""


class _Unclean(Exception):
    """A token the fast pass does not know."""


def _attributes(raw: str | list) -> dict[str, str]:
    """Attributes from a tag's text or from ``html.parser`` pairs; the last of a name wins."""
    if isinstance(raw, list):
        return {name: value or "" for name, value in raw}
    return {
        name.lower(): unescape(double or single or bare)
        for name, double, single, bare in _ATTRIBUTE.findall(raw)
    }


# An element is a span: the numbers of texts, cells and children before it, and those at its end.
_TEXTS, _CELLS, _KIDS, _END = range(4)


class _Tree:
    """Keeps what the layout asks for while tags and texts pass in document order."""

    def __init__(self, layout: Layout):
        self.layout = layout
        self.row, self.cell = layout.row, layout.cell
        self.child_tags = {cell.child for _, cell in layout.fields if cell.child}
        self.kept = {layout.row, layout.cell, *self.child_tags}
        self.open: list[tuple[str, list | None]] = []
        self.counts: defaultdict[str, int] = defaultdict(int)
        self.base: int | None = None
        self.texts: list[str] = []
        self.cells: list[tuple[list, str | list]] = []
        self.kids: list[tuple[str, str | list]] = []
        self.rows: list[list] = []

    def _mark(self):
        return len(self.texts), len(self.cells), len(self.kids)

    def _span(self):
        return [len(self.texts), len(self.cells), len(self.kids), None]

    def _is_container(self, tag, raw):
        if self.layout.container_id:
            return bool(raw) and _attributes(raw).get("id") == self.layout.container_id
        return tag == self.layout.container_tag

    def _is_row(self):
        if not self.layout.direct:
            return True
        return len(self.open) == self.base + 2 and self.open[-1][0] == "tbody"

    def _keep(self, tag, raw):
        span = None
        # A child belongs to the cells that are already open.
        if tag in self.child_tags:
            self.kids.append((tag, raw))
        if tag == self.row and self._is_row():
            span = self._span()
            self.rows.append(span)
        if tag == self.cell:
            span = span or self._span()
            self.cells.append((span, raw))
        if span and tag in VOID:
            span[_END] = self._mark()
        return span

    def start(self, tag, raw):
        span = None
        if self.base is None:
            if self._is_container(tag, raw):
                self.base = len(self.open)
                if tag in VOID:
                    raise _Closed
        elif tag in self.kept:
            span = self._keep(tag, raw)
        if tag in VOID:
            return
        self.open.append((tag, span))
        self.counts[tag] += 1

    def end(self, tag):
        counts, opened = self.counts, self.open
        if not counts[tag]:
            return
        name = None
        while name != tag:
            name, span = opened.pop()
            counts[name] -= 1
            if span:
                span[_END] = len(self.texts), len(self.cells), len(self.kids)
            if len(opened) == self.base:
                raise _Closed

    def text(self, data):
        """One whole text: what stands between two pieces of markup."""
        counts = self.counts
        if self.base is None or counts["script"] or counts["style"] or counts["template"]:
            return
        if data.isspace() and not data.strip(SPACES) and not (counts["pre"] or counts["textarea"]):
            data = "\n" if "\n" in data else " "
        self.texts.append(data)

    def finish(self):
        last = self._mark()
        for span in [*self.rows, *(span for span, _ in self.cells)]:
            span[_END] = span[_END] or last

    def value(self, row_no: int, row: list, field: Cell) -> str:
        at, stop = row[_CELLS] + field.at, row[_END][_CELLS]
        if at >= stop:
            raise PageError(f"row {row_no}: {stop - row[_CELLS]} cells, cell {field.at} wanted")
        span, raw = self.cells[at]
        if field.child:
            inside = self.kids[span[_KIDS]:span[_END][_KIDS]]
            raw = next((found for tag, found in inside if tag == field.child), None)
            if raw is None:
                raise PageError(f"row {row_no}: no {field.child} in cell {field.at}")
        if not field.attr:
            return "".join(self.texts[span[_TEXTS]:span[_END][_TEXTS]])
        attributes = _attributes(raw)
        if field.attr not in attributes:
            raise PageError(f"row {row_no}: no {field.attr} in cell {field.at}")
        return attributes[field.attr]


class _Lenient(HTMLParser):
    """Any markup, by the standard library's rules."""

    def __init__(self, tree: _Tree):
        super().__init__(convert_charrefs=True)
        self.tree = tree
        self.pieces: list[str] = []

    def handle_data(self, data):
        self.pieces.append(data)

    def flush(self, *_):
        if self.pieces:
            self.tree.text("".join(self.pieces))
            self.pieces.clear()

    handle_comment = handle_decl = handle_pi = unknown_decl = flush

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.tree.start(tag, attrs)

    def handle_endtag(self, tag):
        self.flush()
        self.tree.end(tag)


def _read_lenient(html: str, tree: _Tree) -> None:
    reader = _Lenient(tree)
    try:
        reader.feed(html)
        reader.close()
        reader.flush()
    except AssertionError as problem:
        raise PageError(f"markup rejected: {problem}") from problem


def _read_clean(html: str, tree: _Tree) -> None:
    start, end = tree.start, tree.end
    tokens = map(re.Match.groups, _TOKEN.finditer(html))
    for data, closed, raw_tag, raw_attributes, tag, attributes, slash, unclean in tokens:
        if data and tree.base is not None:
            tree.text(unescape(data) if "&" in data else data)
        if tag:
            tag = tag.lower()
            start(tag, attributes)
            if slash:
                end(tag)
        elif closed:
            end(closed.lower())
        elif raw_tag:
            start(raw_tag.lower(), raw_attributes)
            end(raw_tag.lower())
        elif unclean:
            raise _Unclean


def _read(html: str, layout: Layout) -> _Tree:
    for reader in (_read_clean, _read_lenient):
        tree = _Tree(layout)
        try:
            reader(html, tree)
        except _Unclean:
            continue
        except _Closed:
            pass
        tree.finish()
        return tree


def read_listing(html: str | None, layout: Layout | None) -> list[list[str]]:
    """The field values of every row but the skipped ones; raises :class:`PageError`."""
    if html is None:
        raise PageError("no response text")
    if layout is None:
        raise PageError("no layout for this site")
    tree = _read(html, layout)
    if tree.base is None and not layout.direct:
        raise PageError("no container")
    return [
        [tree.value(no, row, cell) for _, cell in layout.fields]
        for no, row in enumerate(tree.rows[layout.skip:], start=1)
    ]
