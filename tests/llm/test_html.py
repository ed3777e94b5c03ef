import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stakeline.llm import html_text as H

CASES = {
    "<p>One<p>two": "One\n\ntwo",
    "<ul><li>a<li>b<ol><li>x<li>y</ol></ul>c": "- a\n- b\n  1. x\n  2. y\n\nc",
    "<ol start=3><li>c<li>d</ol>": "3. c\n4. d",
    "<table><tr><th>H<th>Head two<tr><td>long cell<td>2</table>": "H          Head two\nlong cell  2",
    "a<script>x<p></script><style>y</style><b hidden>z</b><i style='display: none'>q</i>b": "ab",
    "<head><title>t</title></head><body>seen &amp; read</body>": "seen & read",
    "<pre> a\n  b</pre>": " a\n  b",
    "x<br>y<br/>z": "x\ny\nz",
    "a   b\n c": "a b c",
    "<div>a<div>b</div></div>c": "a\nb\nc",
    "<!-- no --><p>yes</p></i></p>": "yes",
    "": "",
    "   ": "",
    "<table></table>": "",
    "<tr><td>x": "x",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert H.render(html) == CASES[html]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<li>", "<ul>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "word", " ", "\n", "<b", ">", "&lt;",
                                 "<div hidden>", "</div>", "<pre>", "<br>", "é", "<ol start=x>"]), max_size=40))
def test_broken_markup_never_fails(parts):
    H.render("".join(parts))


def test_visible_words_survive():
    words = [f"w{i}" for i in range(500)]
    html = "".join(f"<div><p>{w}" for w in words)
    assert H.render(html).split() == words


def test_pages(spark):
    rows = [(1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (2, None, None, None), (None, "v", "", "y"), (4, "w", "<p>" + "long " * 100_000, "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(repr(tuple(r)) for r in H.extract_text(pages).collect())
    assert got == sorted(repr((i, u, None if h is None else H.render(h))) for i, u, h, _ in rows)
    assert H.extract_text(pages.limit(0)).count() == 0


TABLES_AND_CONTROLS = {
    "<table><tr><form><td>a<td>b</form></tr><tr><td>c<td>d</table>": "a  b\nc  d",
    "<table><form><tr><td>a<td>b</form></table>": "a  b",
    "<table><tr><div><td>a</td></div><td>b</table>": "a  b",
    "<table><td>a<td>b</table>": "a  b",
    "<table><tr>note<td>a</tr><tbody><p>other</p><tr><b>third</b><td>b</table>": "note\n\nother\n\nthird\na\nb",
    "<table><tr><td><table><tr>in<td>x</table><td>y</table>": "in  y\nx",
    "<table><tr hidden><td>no</tr><tr><td hidden>no<td>yes</table>": "yes",
    "pick<select><option>one<optgroup><option>two</select>now": "pick\none\ntwo\nnow",
    "<textarea>a\n  b</textarea>": "a\n  b",
    "<p><math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>no</annotation></math></p>": "x=1 2",
    "<svg>no<title>no</title><desc/><g><path/><text>seen</text></g><defs><text>no</text></defs></svg>end": "seen\nend",
    "<object data=x>instead</object><canvas>no</canvas>": "instead",
    "<annotation>kept</annotation> <desc>too</desc>": "kept too",
}


@pytest.mark.parametrize("html", TABLES_AND_CONTROLS)
def test_all_that_browsers_show(html):
    assert H.render(html) == TABLES_AND_CONTROLS[html]


SPANS_AND_VISIBILITY = {
    "<table><tr><td colspan=2>A<td>B<tr><td>1<td>2<td>3</table>": "A     B\n1  2  3",
    "<table><tr><td rowspan=2>A<td>B<tr><td>C</table>": "A  B\n   C",
    "<table><tr><td>a<td rowspan=3>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>": "a  b  c\nd     e\nf     g",
    "<table><tbody><tr><td rowspan=9>a<td>b</tbody><tbody><tr><td>c<td>d</table>": "a  b\nc  d",
    "<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>": "a  b\n   c\n   d",
    "<table><tr><td colspan=2>wide heading<td>z<tr><td>1<td>2<td>3</table>": "wide heading  z\n1  2          3",
    "<table><tr><td colspan=1000>a<td>b<tr><td>c</table>": "a  b\nc",
    "<table><tr><td colspan=x>a<td rowspan=-1>b</table>": "a  b",
    "<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div>": "yes",
    "<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>": "- yes",
    "<p style='display:block;display:none'>no</p><p style='display:none;display:block'>yes": "yes",
    "<p style='display:none'><b style='display:inline;visibility:visible'>no</b></p>yes": "yes",
}


@pytest.mark.parametrize("html", SPANS_AND_VISIBILITY)
def test_spans_and_visibility(html):
    assert H.render(html) == SPANS_AND_VISIBILITY[html]


@pytest.mark.parametrize("depth", [10, H.DEPTH - 2, H.DEPTH - 1, H.DEPTH, 250, 5000])
def test_hidden_at_any_depth(depth):
    html = ("<div>" * depth + "<script>var x=1;</script>a<span style='display:none'>secret<p>secret<br>secret</p>secret</span>"
            "<b style='visibility:hidden'>secret<i style='visibility:visible'>b</i>secret</b><p hidden>secret<div>c</div>"
            "<ul><li>d<li>e</ul><svg><desc>secret</desc><g/></svg>" + "</div>" * depth + "f")
    # below DEPTH inline elements may begin lines of their own
    assert "".join(H.render(html).split()) == "abc-d-ef"


def plain_grid(rows):
    """Every cell by the places it takes, one by one."""
    taken, first = set(), []
    for y, row in enumerate(rows):
        x, mine = 0, []
        for across, down in row:
            while (y, x) in taken:
                x += 1
            mine.append((x, x + across))
            taken |= {(y + dy, x + dx) for dy in range(down or len(rows)) for dx in range(across)}
            x += across
        first.append(mine)
    return first


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 4)), max_size=5), max_size=6))
def test_cells_stand_where_a_grid_puts_them(rows):
    cells = []
    for row in rows:
        cells.append([])
        for across, down in row:
            cell = H.Node("td")
            cell.across, cell.down = across, down
            cells[-1].append(cell)
    assert H._places(cells, set()) == plain_grid(rows)
