"""Visible text of small pages, written out by hand."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm.html import extract, render

PAGES = [
    ("<p>One <b>two</b>\n three<p>Four", "One two three\n\nFour"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<div>a</div><div>b</div> <span>c</span><span> d</span>", "a\nb\nc d"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>x<li value=9>y<li>z</ol>", "3. x\n9. y\n10. z"),
    ("<table><tr><th>Name<th>N<tr><td>long cell<td>1</table>", "Name      | N\nlong cell | 1"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><tr><td colspan=2>wide<td>x<tr><td>1<td>2<td>3</table>", "wide |   | x\n1    | 2 | 3"),
    ("<table><tr><td>a<br>b<td>c</table>", "a | c\nb |"),
    ("<pre>\n a\n\n  b</pre>", " a\n\n  b"),
    ("<title>t</title><style>p{}</style><script>var t='</p>';</script>x<!-- no -->y", "xy"),
    ("<style>.x{display:none} #y, b{visibility:hidden}</style><p class=x>no<p id=y>no<p>yes <b>no</b>", "yes"),
    ("<p hidden>no<p style='DISPLAY: none'>no<p>a", "a"),
    ("<i style='visibility:hidden'>no <b style='visibility:visible'>yes</b></i>", "yes"),
    ("<select><option>A<option selected>B</select>", "B"),
    ("<details><summary>S</summary>no</details><details open>yes</details>", "S\nyes"),
    ("<dl><dt>T<dd>D<dt>U</dl>", "T\n  D\nU"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("1 &lt; 2 &amp; 3 < 4 &copy;&nbsp;x", "1 < 2 & 3 < 4 © x"),
    ("<a href='x>y'>link</a></b></td>t", "linkt"),
    ("<td>stray", "stray"),
    ("<textarea> a\n b</textarea>", " a\n b"),
    # Rules count where their medium is a wide screen.
    ("<style>@media print{.n{display:none}}</style><p class=n>yes", "yes"),
    ("<style>@media print{.m{color:red}} .n{display:none}</style><p class=n>no<p class=m>yes", "yes"),
    ("<style>@media screen and (min-width: 600px){.n{display:none}}</style><p class=n>no<p>yes", "yes"),
    ("<style>@media (max-width:600px){.n{display:none}}</style><p class=n>yes", "yes"),
    ("<style>@media print, screen{.n{display:none}}</style><p class=n>no<p>yes", "yes"),
    ("<style>@media not print{.n{display:none}}</style><p class=n>no<p>yes", "yes"),
    ("<style media=print>.n{display:none}</style><p class=n>yes", "yes"),
    ("<style>@supports (display:x){.n{display:none}} @keyframes k{p{visibility:hidden}}</style><p class=n>yes", "yes"),
    ("<style>@import 'x'; @layer{.n{display:none}} .m{visibility:hidden</style><p class=n>no<p class=m>no<p>yes", "yes"),
    # Drawings and formulas.
    ("a<svg><title>no</title><defs><text>no</text></defs><path d=''/><text>one</text><text>two</text></svg>b", "a one twob"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>", "x=1"),
    ("<svg/>a<svg><desc/><text>b</text></svg>", "a b"),
    # Inputs.
    ("<input value=v> <input type=hidden value=no><input type=password value=no>x", "v x"),
    ("<input placeholder=p><input type=checkbox value=no>", "p"),
    ("<input type=submit value=Go>", "Go"),
    ("<div style='visibility:hidden'><input type=submit value=no></div>yes", "yes"),
    # Wide cells and deep lists.
    (f"<table><tr><td>{'w' * 70}<td>x<tr><td>a<td>y</table>", f"{'w' * 70} | x\na{' ' * 69} | y"),
    ("<ul><li>" * 15 + "x<li>y", "- " * 15 + "x\n" + "  " * 12 + "- y"),
    ("<ol><li>" * 14 + "x<li><li>z", "1. " * 14 + "x\n" + "   " * 12 + "3. z"),
    ("", ""),
    ("<p> </p>", ""),
    ("<scr", ""),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_pages(page, want):
    assert render(page) == want


TAGS = "p div ul ol li table tr td th b pre br script style select option dl dd blockquote details html body head !--".split()


@given(st.lists(st.sampled_from([f"<{t}>" for t in TAGS] + [f"</{t}>" for t in TAGS] + ["x", " ", "\n", "<", '"', "&amp"]), max_size=30))
@settings(max_examples=300, deadline=None)
def test_any_tags_give_text(parts):
    out = render("".join(parts))
    assert set(out) <= set("x <>&\"\n|-0123456789.amp/!;")


@given(st.lists(st.sampled_from(["<p>", "<div>", "</div>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<b>", "</b>"]), max_size=40))
@settings(max_examples=200, deadline=None)
def test_no_word_is_lost(tags):
    page = "".join(f"{t}w{i} " for i, t in enumerate(tags))
    out = render(page)
    assert all(f"w{i}" in out for i in range(len(tags)))


def test_depth_and_length():
    deep = "<div><ul><li><table><tr><td>" * 3000
    assert render(deep + "x").strip("-| \n") == "x"
    assert len(render("<p>a" * 20000)) == 20000 + 2 * 19999
    wide = "<table><tr><td>" + "y" * 100_000 + "<td>b" + "<tr><td>a<td>b" * 500 + "</table>"
    assert len(render(wide)) < 110_000


def test_column(spark):
    pages = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (3, "<p>a", "z"), (3, "<p>a", "z")], "page_id long, html string, visible_text string")
    got = extract(pages)
    assert got.columns == ["page_id", "html", "visible_text"]
    assert sorted("null" if r["visible_text"] is None else r["visible_text"] for r in got.collect()) == ["", "a", "a", "null"]
    assert extract(pages.limit(0)).count() == 0


def test_padding_of_a_table_stays_in_proportion():
    rows = 3_000
    page = f"<table><tr><td>{'w' * 100_000}<td>x" + "<tr><td>a<td>y" * rows + "</table>"
    out = render(page)
    assert len(out) < 16 * 100_000 + 600 * (rows + 1)
    assert out.startswith("w" * 100_000) and out.endswith("a | y")


# A second renderer, straight from the rules: a tree becomes text with marks for borders of blocks, which is then cut into lines.
BLOCK, SPACED, LINE = "\1", "\2", "\3"
INLINE = ("b", "span")
NAMES = st.sampled_from(["div", "p", "b", "span", "ul", "ol", "blockquote", "table", "dl"])
WORD = st.sampled_from(["one", " two", "three ", " four five ", "six<br>seven", " "])


def trees(depth):
    inline = st.lists(st.one_of(WORD, st.tuples(st.sampled_from(INLINE), st.booleans(), st.lists(WORD, max_size=2))), max_size=3)
    if not depth:
        return inline
    inside = trees(depth - 1)

    def node(name):
        if name in ("ul", "ol"):
            kids = st.lists(st.tuples(st.just("li"), st.booleans(), inside), max_size=3)
        elif name == "dl":
            kids = st.lists(st.tuples(st.just("dd"), st.booleans(), inside), max_size=3)
        elif name == "table":
            cell = st.tuples(st.just("td"), st.just(True), inside)
            kids = st.lists(st.tuples(st.just("tr"), st.just(True), st.lists(cell, max_size=3)), max_size=3)
        else:
            kids = inline if name == "p" else inside
        return st.tuples(st.just(name), st.booleans(), kids)

    return st.lists(st.one_of(WORD, NAMES.flatmap(node)), max_size=4)


def source(kids):
    return "".join(k if isinstance(k, str) else f"<{k[0]}{'' if k[1] else ' hidden'}>{source(k[2])}</{k[0]}>" for k in kids)


def box(lines):
    return "\4".join(lines).replace(" ", "\5")


def laid_out(marked):
    """Lines of marked text: a blank one between two blocks if a border between them asks for it."""
    out, gap = [], False
    for part in re.split("([\1\2])", marked):
        if part == SPACED:
            gap = True
        lines = [re.sub(" +", " ", x).strip() for x in part.split(LINE)]
        if part in (BLOCK, SPACED) or not any(lines):
            continue
        out += [""] if gap and out else []
        out += [x.replace("\5", " ") for x in "\4".join(lines).split("\4")]
        gap = False
    return out


def marked(kids, listed=False):
    out = ""
    number = 0
    for kid in kids:
        if isinstance(kid, str):
            out += kid.replace("<br>", LINE)
            continue
        name, shown, below = kid
        if not shown:
            continue
        if name in ("ul", "ol"):
            border = BLOCK if listed else SPACED
            items = ""
            number = 0
            for _, visible, inner in below:
                if visible:
                    number += 1
                    sign = "- " if name == "ul" else f"{number}. "
                    lines = laid_out(marked(inner, True))
                    items += BLOCK + box([(" " * len(sign) if k else sign) + x if x else "" for k, x in enumerate(lines)]) + BLOCK
            out += border + items + border
        elif name == "table":
            cells = [[laid_out(marked(td[2], listed)) for td in tr[2]] for tr in below]
            width = [max((len(x) for row in cells if len(row) > c for x in row[c]), default=0) for c in range(3)]
            lines = []
            for row in cells:
                for k in range(max(map(len, row), default=0)):
                    lines.append(" | ".join((x[k] if k < len(x) else "").ljust(width[c]) for c, x in enumerate(row)).rstrip())
            out += SPACED + box(lines) + SPACED
        elif name == "dl":
            out += SPACED + marked(below, listed) + SPACED
        elif name in ("blockquote", "dd"):
            border = SPACED if name == "blockquote" else BLOCK
            out += border + box(["  " + x if x else "" for x in laid_out(marked(below, listed))]) + border
        else:
            border = {"div": BLOCK, "p": SPACED}.get(name, "")
            out += border + marked(below, listed) + border
    return out


@given(trees(3))
@settings(max_examples=400, deadline=None)
def test_trees_against_a_plain_renderer(tree):
    assert render(source(tree)) == "\n".join(laid_out(marked(tree)))
