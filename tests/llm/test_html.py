"""HTML rendering: layouts worked out by hand, and every visible word kept."""

import html
import random
import re

import pytest

from pagemill.llm import html_text

CASES = [
    (None, ""),
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<head><title>t</title><p>body begins", "body begins"),
    ("<head><title>t</title>text ends the head", "text ends the head"),
    ("a <b> b</b>c <i>d </i> e", "a bc d e"),
    ("<script>var t='</p>';</script>x<style>p{}</style><!-- c --><!doctype html>y", "xy"),
    ("<div hidden>a<p>b</div><div style='DISPLAY : none'>c</div><span style='visibility:hidden'>d</span>e", "e"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
    ("<ol start=9><li>a<li><p>b<p>c</ol>", "9. a\n10. b\n\n    c"),
    ("<table><tr><th>name<th>n<tr><td>apple<td>1<tr><td>fig<td>22</table>z", "name   n\napple  1\nfig    22\n\nz"),
    ("<table><tr><td>a<br>b<td>c</tr><tr><td colspan=2>wide</td></tr></table>", "a  c\nb\nwide"),
    ("<table><tr><td>out<table><tr><td>in</table>", "out\nin"),
    ("<pre>  x\n   y</pre>z", "  x\n   y\n\nz"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\nd\nu"),
    ("<p>a</b></i></p></div>b", "a\n\nb"),
    ("<a title='x > y' href=z>link</a> 1 < 2 <3", "link 1 < 2 <3"),
    ("unclosed <!-- comment", "unclosed"),
    ("unclosed <p class='x", "unclosed"),
    ("&copy; &middot; &#8364;&lt;b&gt;", "© · €<b>"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ("<table><tr><td>a<td rowspan=2 colspan=2>b<td>c<tr><td>d<td>e<tr><td>f<td>g<td>h<td>i</table>", "a  b     c\nd        e\nf  g  h  i"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
    ("<table><tr><td colspan=2>a wide head<td>x<tr><td>b<td>c<td>y</table>", "a wide head  x\nb  c         y"),
    (f"<table><tr><td>{'word ' * 13}<td>x<tr><td>b<td>y</table>", "word word word word word word word word word word word word  x\nword\nb" + " " * 60 + "y"),
    (f"<table><tr><td>b<td>{'word ' * 13}<tr><td>ccc<td>y</table>", "b    " + " ".join(["word"] * 13) + "\nccc  y"),
    (f"<table><tr><td>{'x' * 65}<td>x<tr><td>b<td>y</table>", "x" * 65 + "  x\nb" + " " * 66 + "y"),
    ("<style>.x{display:none} p.y , #z { visibility: hidden; color:red }</style><p class='a x'>1<p class=y>2<div class=y>3</div><i id=z>4</i>5", "3\n5"),
    ("<p class=x>early</p>a<style media=print>b{display:none}</style><style>/* i{display:none} */ @import 'u'; @media print { i {display:none} } @media screen{u{display:none}} .x{display:none}</style><b>b</b><i>c</i><u>d</u>", "abc"),
    ("<style>div span{display:none} .x{display:none!important} .y{display:none} #k{display:block}</style><div><span>a</span><b class=x style='display:inline'>b</b><b class=y id=k>c</b><b class=y style='display:block'>d</b></div>", "acd"),
    ("<!-- <style>b{display:none}</style> --><style><!-- i{display:none} --></style><b>a</b><i>b</i>", "a"),
    ("<div style='visibility:hidden'>a<p style='visibility:visible'>b</p>c</div>d", "b\n\nd"),
    ("<div style='display:none'>a<p style='visibility:visible;display:block'>b</p>c</div>d", "d"),
    ("<ol><li>a<li style='visibility:hidden'>b<li>c</ol>", "1. a\n3. c"),
    ("<style>[hidden]{display:block} .v{display:block}</style><p hidden>a<p hidden class=v>b", "b"),
]


@pytest.mark.parametrize("source, text", CASES)
def test_layout(source, text):
    assert html_text.render(source) == text


def tree(draw, depth, kind="flow"):
    """A random well-formed fragment: strings, and (tag, attributes, children)."""
    out = []
    for _ in range(draw.randrange(1, 4)):
        pick = draw.randrange(9) if depth else 0
        attrs = draw.choice(["", "", "", "", " hidden", " style='display: none'", " class=gone", " class='q seen'"])
        text = draw.choice(["one", " two ", "three four", "\n five\n", "", " ", "six"])
        if pick < 3 or kind == "inline" and pick > 4:
            out.append(text)
        elif pick < 5:
            out.append((draw.choice(["b", "span"]), attrs, tree(draw, depth - 1, "inline")))
        elif pick == 5:
            out.append(("p", attrs, tree(draw, depth - 1, "inline")))
        elif pick == 6:
            out.append((draw.choice(["div", "section", "h2"]), attrs, tree(draw, depth - 1)))
        elif pick == 7:
            out.append((draw.choice(["ul", "ol"]), attrs, [("li", draw.choice(["", "", " hidden"]), tree(draw, depth - 1)) for _ in range(draw.randrange(1, 4))]))
        else:
            out.append(("table", attrs, [("tr", "", [("td", "", [draw.choice(["x", "long cell", "", "y<br>z"])]) for _ in range(draw.randrange(1, 4))]) for _ in range(draw.randrange(1, 4))]))
    return out


def written(nodes):
    return "".join(n if isinstance(n, str) else f"<{n[0]}{n[1]}>{written(n[2])}</{n[0]}>" for n in nodes)


def boxes(nodes, in_list=False):
    """[(line breaks before, line)], box by box, and the breaks due after them."""
    out, due, run = [], 1, ""

    def flush():
        nonlocal run, due
        if words := run.split():
            out.append((due, " ".join(words)))
            due = 1
        run = ""

    def place(nodes):
        nonlocal run, due
        number = 0
        for node in nodes:
            if isinstance(node, str):
                run += node
                continue
            tag, attrs, below = node
            number += tag == "li" and not ("hidden" in attrs or "none" in attrs or "gone" in attrs)
            if "hidden" in attrs or "none" in attrs or "gone" in attrs:
                continue
            if tag in ("b", "span"):
                place(below)
                continue
            flush()
            margin = 1 if tag in ("div", "section", "li") or tag in ("ul", "ol") and in_list else 2
            if tag == "table":
                rows = [[re.sub("<br>", "\n", c[2][0]).split("\n") for c in row[2]] for row in below]
                wide = [max([len(x) for row in rows if len(row) > k for x in row[k]], default=0) for k in range(3)]
                inner = [("  ".join((c[k] if k < len(c) else "").ljust(w) for c, w in zip(row, wide)).rstrip()) for row in rows for k in range(max(map(len, row)))]
                inner, after = [(1, x) for x in inner if x], 1
            elif tag in ("ul", "ol"):
                inner, after = [], 1
                for k, (_, a, item) in enumerate([i for i in below if "hidden" not in i[1]], 1):
                    mark = f"{k}. " if tag == "ol" else "- "
                    held, last = boxes(item, True)
                    inner += [(max(after, 1 if j == 0 else gap), (mark if j == 0 else " " * len(mark)) + x) if j == 0 else (gap, " " * len(mark) + x) for j, (gap, x) in enumerate(held)]
                    after = max(1, last) if held else after
            else:
                inner, after = boxes(below, in_list)
            due = max(due, margin)
            for gap, x in inner:
                out.append((max(gap, due), x))
                due = 1
            due = max(due, margin, after)
    place(nodes)
    flush()
    return out, due


def test_layout_of_random_trees_is_that_of_nested_boxes():
    style = "<style>.gone { display: none }</style>"
    for seed in range(3000):
        nodes = tree(random.Random(seed), 4)
        lines, _ = boxes(nodes)
        want = "".join(("\n" * gap if k else "") + x for k, (gap, x) in enumerate(lines))
        assert html_text.render(style + written(nodes)) == want, written(nodes)


def test_depth_and_length_do_not_matter():
    assert html_text.render("<div>" * 50_000 + "x") == "x"
    assert html_text.render("<ul><li>" * 300 + "x").endswith("- x")
    assert len(html_text.render("<p>word " * 100_000)) == 6 * 100_000 - 2


def test_every_visible_word_of_the_pages_is_kept(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = {r.page_id: r for r in html_text.extract(pages.selectExpr("*", "'x' AS text", "1 AS n_chars")).collect()}
    assert len(rows) == pages.count()
    for page in pages.collect():
        bare = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>|<[^>]*>", " ", page.html)
        got = re.sub(r"^\s*(-|\d+\.) ", "", rows[page.page_id].text, flags=re.M)
        assert got.replace(" ", "").split() and "".join(got.split()) == "".join(html.unescape(bare).split())


def test_empty_table(spark):
    assert html_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
