"""Listing sites as configuration: URL shape, kinds, page range, table layout."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Cell:
    """Where a value sits: cell ordinal, then its text or an attribute.

    With ``attr`` the attribute is read from the first ``child`` element inside
    the cell, or from the cell itself when ``child`` is empty.
    """

    at: int
    attr: str = ""
    child: str = ""


@dataclass(frozen=True)
class Layout:
    """A container (by id, or by tag), rows in it, cells in a row."""

    fields: tuple[tuple[str, Cell], ...]
    container_id: str = ""
    container_tag: str = ""
    row: str = "tr"
    cell: str = "td"
    skip: int = 1
    # Only rows on the path container > tbody > row; a missing container is then
    # an empty page.
    direct: bool = False


@dataclass(frozen=True)
class Site:
    name: str
    domain: str
    url_head: str
    url_tail: str
    kinds: tuple[tuple[str, str], ...]
    first_page: int
    last_page: int
    layout: Layout
    foreign_prefix: bool = False


WIDE_TABLE = Layout(
    container_id="ip_list",
    fields=(
        ("ip", Cell(1)),
        ("port", Cell(2)),
        ("address", Cell(3)),
        ("label", Cell(4)),
        ("http", Cell(5)),
        ("speed", Cell(6, attr="title", child="div")),
        ("resptime", Cell(7, attr="title", child="div")),
        ("alivetime", Cell(8)),
        ("testtime", Cell(9)),
    ),
)

NARROW_TABLE = Layout(
    container_id="list",
    fields=(
        ("ip", Cell(0)),
        ("port", Cell(1)),
        ("label", Cell(2)),
        ("http", Cell(3)),
        ("address", Cell(4)),
        ("speed", Cell(5)),
        ("resptime", Cell(6)),
    ),
)

# Hosts, URL shapes, kinds with their descriptions, page ranges.
# A URL is head + kind + tail + page number.
SITES = (
    Site(
        name="xici",
        domain="www.xicidaili.com",
        url_head="http://www.xicidaili.com/",
        url_tail="/",
        kinds=(("nn", "国内高匿"), ("nt", "国内普通"), ("wn", "国外高匿"), ("wt", "国外普通")),
        first_page=1,
        last_page=3,
        layout=WIDE_TABLE,
    ),
    Site(
        name="cloud",
        domain="www.ip3366.net",
        url_head="http://www.ip3366.net/free/?stype=",
        url_tail="&page=",
        kinds=(("1", "国内高匿"), ("2", "国内普通"), ("3", "国外高匿"), ("4", "国外普通")),
        first_page=1,
        last_page=6,
        layout=NARROW_TABLE,
        foreign_prefix=True,
    ),
    Site(
        name="kuaidaili",
        domain="www.kuaidaili.com",
        url_head="https://www.kuaidaili.com/free/",
        url_tail="/",
        kinds=(("inha", "国内高匿"), ("intr", "国内普通")),
        first_page=1,
        last_page=3,
        layout=NARROW_TABLE,
    ),
)
