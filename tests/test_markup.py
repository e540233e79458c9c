import random
from dataclasses import replace

import pytest
from hypothesis import given, settings, strategies as st

from listings import narrow_page, narrow_row, wide_page, wide_row
from rollbook.operators import markup
from rollbook.operators.markup import PageError, read_listing
from rollbook.sources.sites import NARROW_TABLE, WIDE_TABLE, Cell

ONE = replace(NARROW_TABLE, fields=(("a", Cell(0)),), skip=0)


def lenient(html, layout):
    """The same page by the slow reader alone."""
    tree = markup._Tree(layout)
    try:
        markup._read_lenient(html, tree)
    except markup._Closed:
        pass
    tree.finish()
    if tree.base is None and not layout.direct:
        raise PageError("no container")
    return [
        [tree.value(no, row, cell) for _, cell in layout.fields]
        for no, row in enumerate(tree.rows[layout.skip:], start=1)
    ]


def test_wide_page():
    rows = read_listing(wide_page(wide_row("192.0.2.1", "80"), wide_row("192.0.2.2", "81")), WIDE_TABLE)
    assert rows[1] == [
        "192.0.2.2", "81", "\n某地\n", "高匿", "HTTPS", "0.3秒", "0.3秒", "41天", "24-03-05 07:10"
    ]
    assert len(rows) == 2


def test_narrow_page_in_a_div():
    rows = read_listing(narrow_page(narrow_row("192.0.2.1", "80")), NARROW_TABLE)
    assert rows == [["192.0.2.1", "80", "高匿名", "http", " 某地 ", "1秒", "2024/03/05 07:10:00"]]


@pytest.mark.parametrize("html", ["<table id=ip_list></table>", wide_page(), "<p id=ip_list>x"])
def test_container_without_rows_is_an_empty_page(html):
    assert read_listing(html, WIDE_TABLE) == []


def test_first_row_is_dropped_even_if_it_is_data():
    html = wide_page(wide_row("192.0.2.2", "81"), head=wide_row("192.0.2.1", "80"))
    assert [r[0] for r in read_listing(html, WIDE_TABLE)] == ["192.0.2.2"]


@pytest.mark.parametrize(
    "html, why",
    [
        ("<table></table>", "no container"),
        ("", "no container"),
        (None, "no response text"),
        (wide_page(wide_row("a", "1"), "<tr><td>x</td></tr>"), "row 2: 1 cells, cell 1 wanted"),
        (wide_page(wide_row("a", "1"), "<tr><th>x</th></tr>"), "row 2: 0 cells"),
        (wide_page(wide_row("a", "1").replace("<div title", "<p title").replace("<div class", "<p class")), "no div in cell 6"),
        (wide_page(wide_row("a", "1").replace('title="0.3秒"', "")), "no title in cell 6"),
    ],
)
def test_failures_discard_the_page(html, why):
    with pytest.raises(PageError, match=why):
        read_listing(html, WIDE_TABLE)


def test_title_of_the_first_div_only():
    row = wide_row("a", "1").replace('<div title="0.3秒"', '<div><div title="0.3秒"', 1)
    with pytest.raises(PageError, match="no title"):
        read_listing(wide_page(row), WIDE_TABLE)


def test_first_of_two_containers():
    html = "<p id=list><tr><td>1</td></tr></p><p id=list><tr><td>2</td></tr></p>"
    assert read_listing(html, ONE) == [["1"]]


def test_container_nested_in_the_container_adds_its_rows_once():
    html = "<div id=list><tr><td>1</td></tr><div id=list><tr><td>2</td></tr></div></div><tr><td>3</td></tr>"
    assert read_listing(html, ONE) == [["1"], ["2"]]


def test_text_is_decoded_and_not_trimmed():
    html = "<p id=list><tr><td> &lt;a&gt;<b>b</b><br>&#20013;&nbsp;<!-- no --><script>no</script>\n</td></tr>"
    assert read_listing(html, ONE) == [[" <a>b中\xa0\n"]]


@pytest.mark.parametrize(
    "inner, text",
    [
        ("   ", " "),
        ("&#32;&#32;", " "),
        (" \t\r\n ", "\n"),
        ("&nbsp;&nbsp;", "\xa0\xa0"),
        ("  x  ", "  x  "),
        ("  <b>x</b>\n\n", " x\n"),
        ("  <!-- c -->  ", "  "),
        ("<pre>   </pre>", "   "),
        ("a <  <b></b>", "a <  "),
        ("", ""),
    ],
)
def test_texts_of_spaces_shrink(inner, text):
    assert read_listing(f"<p id=list><tr><td>{inner}</td></tr>", ONE) == [[text]]


def test_unclosed_cells_nest():
    two = replace(ONE, fields=(("a", Cell(0)), ("b", Cell(1))))
    assert read_listing("<p id=list><tr><td>1<td>2</tr>", two) == [["12", "2"]]


def test_nested_cells_come_in_document_order():
    three = replace(ONE, fields=tuple((str(i), Cell(i)) for i in range(3)))
    html = "<p id=list><tr><td>1<table><td>2</td></table></td><td>3</td></tr>"
    assert read_listing(html, three) == [["12", "2", "3"]]


def test_row_inside_a_row_is_a_row_of_its_own():
    html = "<p id=list><tr><td>1<table><tr><td>2</td></tr></table></td></tr>"
    assert read_listing(html, ONE) == [["12"], ["2"]]


def test_cells_beyond_the_layout_are_ignored():
    assert read_listing("<p id=list><tr><td>1</td><td>2</td></tr>", ONE) == [["1"]]


def test_outer_end_tag_closes_the_container():
    html = "<div><p id=list><tr><td>1</td></tr></div><tr><td>2</td></tr>"
    assert read_listing(html, ONE) == [["1"]]


def test_direct_rows_need_the_strict_path():
    direct = replace(ONE, direct=True)
    html = "<table id=list><tr><td>1</td></tr><tbody><tr><td>2</td></tr></tbody></table>"
    assert read_listing(html, direct) == [["2"]]
    assert read_listing("<p>", direct) == []


def test_deep_nesting_is_linear():
    html = "<p id=list><tr>" + "<td>x" * 50_000
    assert len(read_listing(html, ONE)[0][0]) == 50_000


PIECES = [
    "<td>", "</td>", "<tr>", "</tr>", "<table id=list>", "</table>", "<div title='a'>", "</div>", "<br>",
    "<br/>", "x", "&amp;", "&lt", "<b", "<", "</", "<!-- c -->", "<!-- -- -->", "<script>a<b</script>",
    "<p/>", "<td/>", "<DIV TITLE=\"q&amp;r\" id='z'>", "<a href=/x/>", "<td title>", " = ", "<a b = 'c'>",
    "  ", "\n ", "<pre>", "</pre>", "</tbody >", "<tbody>", "<style>", "</style>", "&nbsp;", "<?x?>", "<template>", "</template>",
]
LAYOUTS = [
    ONE,
    replace(ONE, direct=True),
    replace(ONE, fields=(("a", Cell(0, attr="title")),)),
    replace(ONE, skip=1, fields=(("a", Cell(0)), ("b", Cell(1)), ("c", Cell(0, attr="title", child="div")))),
]


def outcome(read, html, layout):
    try:
        return read(html, layout)
    except PageError as problem:
        return str(problem)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25), st.sampled_from(LAYOUTS), st.booleans())
def test_clean_pass_equals_the_lenient_reader(pieces, layout, inside):
    html = ("<table id=list><tbody><tr><td>" if inside else "") + "".join(pieces)
    assert outcome(read_listing, html, layout) == outcome(lenient, html, layout)


def test_clean_pass_is_taken_for_listing_pages():
    rng = random.Random(1)
    rows = [wide_row(f"192.0.2.{rng.randrange(255)}", "80") for _ in range(100)]
    tree = markup._Tree(WIDE_TABLE)
    with pytest.raises(markup._Closed):
        markup._read_clean(wide_page(*rows), tree)
    assert len(tree.rows) == 101
