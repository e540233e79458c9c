"""Main text of web pages by removing what a site repeats.

1. Each page becomes a tree of elements (unclosed and stray tags are tolerated). Parts that
   are never text (scripts, styles, head, forms, ...) and parts that say what they are
   (navigation, headers and footers of the page, adverts, notices, sidebars, comments of
   readers) go by element, role, class and id.
2. The subtrees of what remains are hashed. Spark counts, per host, the pages on which each
   hash occurs (reduced on the map side; a hot host is spread over its hashes).
3. A subtree is deleted from a page if it recurs on ``MANY_PAGES`` pages of the host with
   different content, however many the host has; on a small host, on ``MIN_PAGES`` and
   ``MIN_SHARE`` of its pages. ``subtrees`` says which never are. Recurring hashes meet pages
   as rows, so no list grows with a host.
4. The rest is written block by block, in page order: what the page's ``main`` element holds,
   or else its one ``article``, or else all of it.

Pages with identical html count once per host, so that a repeated page is not its own
template. Nulls and empties: a null html is empty and has an empty text; a null or
unreadable url belongs to the host "". Every row gives one row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollbook.llm.shared import keyed, land, texts

#: A subtree is template from so many different pages of its host; or from so few, if they are
#: such a share of them.
MANY_PAGES, MIN_PAGES, MIN_SHARE = 50, 5, 0.2
#: Words from which a run of text is a passage, which a site may well repeat.
PASSAGE_WORDS = 12

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
NEVER = frozenset(
    "head script style noscript template svg math canvas iframe object embed button select option textarea input "
    "label datalist nav footer menu audio video map title xmp noembed noframes".split()
)
#: Elements that go unless the page's content is inside: some sites put all of a page into one.
MOSTLY = frozenset("form fieldset aside dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext "
    "pre search section summary table caption colgroup tbody td tfoot th thead tr ul".split()
)
#: An opening tag closes an open element of these without end tag.
_CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup", "legend", "option", "optgroup"}
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
}
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alertdialog alert tablist".split()
)
#: Words in a class or id that say what an element is.
_LABEL = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert(?:s|isements?|ising)?|adsense|banner|sponsor(?:ed|s)?|promo(?:s|tions?)?|nav(?:bar|igation)?|menu|"
    r"breadcrumbs?|sidebar|side-bar|aside|footer|foot|masthead|topbar|top-bar|toolbar|cookies?|consent|gdpr|notices?|"
    r"notifications?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|"
    r"recommend(?:ed|ations?)?|comments?|commentlist|disqus|respond|replies|reply|widget|pagination|pager|skip|skip-?link|"
    r"search(?:-?(?:form|box))?|copyright|site-header|page-header)\d*(?:$|[\s_-])|^\s*header\s*$",
    re.I,
)
#: Those of them that content may be about: within an article they say nothing against an
#: element that holds a passage.
_AMBIGUOUS = re.compile(
    r"(?:^|[\s_-])(?:notices?|notifications?|alert|share|sharing|social|related|recommend(?:ed|ations?)?|promo(?:s|tions?)?|"
    r"search|copyright|menu|subscription)\d*(?=$|[\s_-])", re.I
)
#: The same of an element that is an article by its name.
_NO_ARTICLE = re.compile(r"(?:^|[\s_-])(?:comments?|reply|replies|ads?|advert\w*|promo|sponsored|related)\d*(?:$|[\s_-])", re.I)
_PHRASES = frozenset("html body main a b i em strong u s small sub sup code h1 h2 h3 h4 h5 h6".split())
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("name", "label", "children", "drop", "doubt", "mild")

    def __init__(self, name: str, label: str = "", drop: bool = False, doubt: bool = False, mild: bool = False):
        self.name, self.label = name, label
        self.drop, self.doubt = drop, doubt  # goes; goes unless the content is inside
        self.mild = mild  # stays for a passage too
        self.children: list = []  # elements and strings


def _open(name: str, attributes: str, stack: list[Element]) -> Element:
    label, drop, doubt, mild = "", name in NEVER, name in MOSTLY, False
    if attributes.strip(" \t\r\n/"):
        found = {}
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
        label = f"{found.get('class', '')} {found.get('id', '')}".strip()
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        hidden = hidden or "display:none" in found.get("style", "").replace(" ", "").lower()
        drop = drop or hidden or found.get("role", "").lower() in _ROLES
        if label and not drop and not doubt and name not in _PHRASES:
            words = _CAMEL.sub("-", label)
            doubt = bool((_NO_ARTICLE if name == "article" else _LABEL).search(words))
            within = any(e.name in ("article", "main") for e in stack)
            mild = doubt and within and not _LABEL.search(_AMBIGUOUS.sub(" ", words))
    if name == "header" and not any(e.name in ("article", "main") for e in stack):
        drop = True
    return Element(name, label, drop, doubt, mild)


def parse(html: str) -> Element:
    """The element tree of a page; whatever the markup, all its text is somewhere in it."""
    root = Element("#root")
    stack, at, n = [root], 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            stack[-1].children.append(unescape(html[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            _close(name, stack)
            continue
        if name in _CLOSES_P and any(e.name == "p" for e in stack):
            _close_within(stack, {"p"}, {"td", "th", "table", "li", "div", "article", "section", "body", "button"} - {name})
        if name in _SIBLINGS:
            _close_within(stack, *_SIBLINGS[name])
        element = _open(name, m[3], stack)
        stack[-1].children.append(element)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else n
            continue
        stack.append(element)
    return root


def _close(name: str, stack: list[Element]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name == name:
            del stack[k:]
            return
        # The end of a phrase does not reach out of its block.
        if name not in BLOCKS and stack[k].name in BLOCKS:
            return


def _close_within(stack: list[Element], names: set[str], limits: set[str]) -> None:
    """Closes the outermost open element of ``names`` above the nearest of ``limits``."""
    lowest = None
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            lowest = k
        elif stack[k].name in limits:
            break
    if lowest is not None:
        del stack[lowest:]


def _hash_of(parts: list[str]) -> int:
    digest = hashlib.blake2b("\x1f".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _prune(root: Element) -> None:
    """Takes out what is dropped, in loops: trees may be deep.

    What only a class or id speaks against, and a form or aside, stays if the page's article or
    main element is inside, or, comments and adverts apart, more than half of the page's words
    are. Labels that content has too do not count against a passage in the article."""
    order, todo = [], [root]
    while todo:
        e = todo.pop()
        order.append(e)
        e.children = [c for c in e.children if isinstance(c, str) or not c.drop]
        todo.extend(c for c in e.children if not isinstance(c, str))
    if not any(e.doubt for e in order):
        return
    known: dict[int, tuple[int, bool, bool]] = {}
    for e in reversed(order):
        inside = [known[id(c)] for c in e.children if not isinstance(c, str)]
        words = sum(len(c.split()) for c in e.children if isinstance(c, str)) + sum(x[0] for x in inside)
        held = e.name in ("article", "main") and not e.doubt or any(x[1] for x in inside)
        known[id(e)] = words, held, e.name == "p" and words >= PASSAGE_WORDS or any(x[2] for x in inside)
    half = known[id(root)][0] / 2
    for e in order:
        e.children = [
            c for c in e.children
            if isinstance(c, str) or not c.doubt or known[id(c)][1] or c.mild and known[id(c)][2]
            or known[id(c)][0] > half and not _NO_ARTICLE.search(_CAMEL.sub("-", c.label))
        ]


def subtrees(root: Element) -> list[tuple[Element, int]]:
    """The block elements of a page that may be template, with the hashes of their subtrees.

    Never template: the page's own elements, a subtree with more than half of the page's
    words, and what reads as content even if pages share it: a paragraph, heading or
    quotation inside an article, or one anywhere that holds a passage."""
    order, parent, inside = [], {}, {}
    todo = [(root, False)]
    while todo:
        e, within = todo.pop()
        order.append(e)
        inside[id(e)] = within
        for c in e.children:
            if not isinstance(c, str):
                parent[id(c)] = e
                todo.append((c, within or e.name in ("article", "main")))
    known: dict[int, tuple[int, int, bool]] = {}
    found = []
    for e in reversed(order):
        parts, words, passage = [e.name, e.label], 0, False
        for c in e.children:
            if isinstance(c, str):
                text = _SPACE.sub(" ", c).strip()
                parts.append(text)
                n = text.count(" ") + 1 if text else 0
                words, passage = words + n, passage or n >= PASSAGE_WORDS
            else:
                h, n, long = known[id(c)]
                parts.append(str(h))
                words, passage = words + n, passage or long
        known[id(e)] = (_hash_of(parts), words, passage)
        content = e.name in ("p", "h1", "h2", "h3", "blockquote", "pre") and (passage or inside[id(e)])
        if e.name in BLOCKS and e.name not in ("html", "body", "main", "article") and words and not content:
            found.append((e, known[id(e)][0], words))
    half = known[id(root)][1] / 2
    return [(e, h) for e, h, words in found if words <= half]


def main_root(root: Element) -> Element:
    """The page's one main element or article if it has one with text, else all of it."""
    for name in ("main", "article"):
        found, todo = [], [root]
        while todo:
            e = todo.pop()
            if e.name == name:
                found.append(e)
            else:
                todo.extend(c for c in e.children if not isinstance(c, str))
        if len(found) == 1 and blocks(found[0]):
            return found[0]
    return root


def blocks(root: Element) -> list[str]:
    """Texts of the blocks in page order, white space as one space, without empty ones."""
    out, held = [], []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(held)).strip()
        if text:
            out.append(text)
        held.clear()

    todo: list = [root]
    while todo:
        node = todo.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            held.append(node)
        elif node.name == "br":
            held.append(" ")
        elif node.name in BLOCKS:
            flush()
            todo.append(None)
            todo.extend(reversed(node.children))
        else:
            todo.extend(reversed(node.children))
    flush()
    return out


def _pruned(html: str) -> Element:
    root = parse(html)
    _prune(root)
    return root


def _hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
    for batch in batches:
        rows: list[tuple] = []
        for key, host, html in zip(batch["key"].to_pylist(), batch["host"].to_pylist(), texts(batch["html"])):
            found = {h for _, h in subtrees(_pruned(html))}
            same = _hash_of([html])
            rows.extend((key, host, h, same) for h in found)
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "host", "subtree", "page"])


def recurring(pages: DataFrame) -> DataFrame:
    """The template of each page: ``key``, ``subtrees`` (array). ``pages``: key (a number of
    each row's own), host, html."""
    seen = land(pages.mapInArrow(_hasher, "key bigint, host string, subtree bigint, page bigint"), "subtrees")
    # Equal pages of a host count once.
    counts = seen.select("host", "subtree", "page").distinct().groupBy("host", "subtree").count().where(F.col("count") >= MIN_PAGES)
    totals = pages.select("host", F.xxhash64("html").alias("page")).distinct().groupBy("host").agg(F.count("*").alias("pages"))
    often = (F.col("count") >= MANY_PAGES) | (F.col("count") >= MIN_SHARE * F.col("pages"))
    template = land(counts.join(totals, "host").where(often).select("host", "subtree"), "templates")
    return seen.join(template, ["host", "subtree"]).groupBy("key").agg(F.collect_list("subtree").alias("subtrees"))


def text_of(html: str, template: frozenset[int] | set[int]) -> str:
    root = _pruned(html)
    if template:
        doomed = {id(e) for e, h in subtrees(root) if h in template}
        todo = [root]
        while todo and doomed:
            e = todo.pop()
            e.children = [c for c in e.children if isinstance(c, str) or id(c) not in doomed]
            todo.extend(c for c in e.children if not isinstance(c, str))
    return "\n".join(blocks(main_root(root)))


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch["subtrees"], texts(batch["html"]))
        out = [text_of(html, set(template.as_py() or ())) for template, html in pairs]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of each page."""
    rows, key = keyed(pages)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)", 1))
    read = rows.select(
        F.col(key).alias("key"), F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"),
    )
    template = recurring(read.select("key", "host", "html"))
    return read.join(template, "key", "left").select("page_id", "url", "html", "subtrees").mapInArrow(
        _extractor, "page_id bigint, url string, text string, n_chars bigint"
    )
