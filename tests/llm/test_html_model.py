"""Extraction: message passing against enumeration, parsing, held-out pages."""

import html
import itertools
import re

import numpy as np
import pytest

from tessera.llm import html_model as hm
from tests.conftest import SF001

MODEL = hm.default_model()


def extracted(page):
    tree = hm.parse(page)
    return hm.text_of(tree, MODEL.content([tree])[0])


def all_text(page):
    tree = hm.parse(page)
    return hm.text_of(tree, np.ones(len(tree.parent)))


def test_sum_product_equals_enumeration():
    rng = np.random.default_rng(3)
    parent = np.array([-1, 0, 0, 1, 1, 2, 3])
    depth, kind = np.array([0, 1, 1, 2, 2, 2, 3]), rng.integers(0, 3, 7)
    unary, pair = rng.normal(size=7), rng.normal(size=(len(hm.KINDS), 2, 2))
    belief, joint = hm.sum_product(unary, pair, parent, depth, kind)
    total, one, two = 0.0, np.zeros(7), np.zeros((7, 2, 2))
    for y in itertools.product((0, 1), repeat=7):
        p = np.exp(sum(unary[i] * y[i] + (pair[kind[i], y[parent[i]], y[i]] if parent[i] >= 0 else 0) for i in range(7)))
        total += p
        one += p * np.array(y)
        for i in range(1, 7):
            two[i, y[parent[i]], y[i]] += p
    assert np.allclose(np.exp(belief[:, 1]), one / total)
    assert np.allclose(np.exp(joint[1:]), two[1:] / total)


def test_held_out_layouts():
    trees = [hm.parse(p) for p in hm.labelled_pages(300, seed=77)]
    same = [hm.text_of(t, c) == hm.text_of(t, np.array([float(bool(v)) for v in t.label]))
            for t, c in zip(trees, MODEL.content(trees))]
    assert np.mean(same) > 0.95


def test_pages_of_the_table(spark):
    df = spark.read.parquet(f"{SF001}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in hm.extract(df).collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.DOTALL)[1]
        want = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))
        want = " ".join(html.unescape(want).split())
        assert got[r.page_id] == (want, len(want))


@pytest.mark.parametrize("page, want", [
    ("a<p title='x>y'>b&amp;c &#233;&eacute;\n d</p>e", "a b&c éé d e"),
    ("<p>one<p>two<b>three</b> four<br>five", "one twothree four five"),
    ("x<!-- <p>no</p> -->y<script>if (a<b) '</p>'</script>z<style>p{}</style>", "xyz"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "a b c d e"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<SCRIPT>never ends <p>text", ""),
    ("<p>cut &am", "cut &am"), ("<p>cut <a href='x", "cut"), ("a < b <3 <p>c", "a < b <3 c"),
    ("<div><b>a</div>b</b>c", "a bc"), ("", ""), ("plain", "plain"), ("<p don't>x</p>", "x"),
    ("<select><option>a</select><textarea><p>b</textarea><title>t</title>c", "c"),
])
def test_parsing(page, want):
    assert all_text(page) == want


def test_parts_that_are_not_content():
    body = "<p>" + "The council met on Monday, and it decided about the bridge. " * 4 + "</p>"
    text = ("The council met on Monday, and it decided about the bridge. " * 4).strip()
    for main in ("<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>", "<div id=content>{}</div>"):
        page = ("<html><body><header><a href=/>Site</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>"
                "<div class='cookie-notice'>We use cookies. <button>OK</button></div><div class=ad>Buy now</div>" + main.format(body) +
                "<section class='comments'><h3>Comments</h3><p>Nice one, thanks. I agree.</p></section>"
                "<aside class=sidebar><h4>More</h4><ul><li><a href=c>Other story</a></ul></aside>"
                "<form><label>Mail</label><input></form><footer>&copy; Site</footer></body></html>")
        assert extracted(page) == text


def test_articles_without_a_wrapper():
    body = "The council met on Monday, and it decided about the bridge. " * 4
    text = body.strip()
    for page, want in (
            (f"<html><body><h1>Bridge news</h1><p>{body}</p><p>{body}</p></body></html>", f"Bridge news {text} {text}"),
            (f"<p>{body}</p>", text), (f"<p>{body}<p>{body}", f"{text} {text}"), (body, text),
            (f"<html><body>{body}<br>{body}</body></html>", f"{text} {text}"), ("Short text.", "Short text."),
            (f"<body>Before <b>bold</b> {body}<div class=ad>Buy now</div>{body}", f"Before bold {text} {text}"),
            (f"<html><body><nav><ul><li><a href=x>Home</a></ul></nav><h1>Bridge</h1><p>{body}</p><p>{body}</p>"
             "<div class=ad>Buy now</div><footer>&copy; Site</footer></body></html>", f"Bridge {text} {text}")):
        assert extracted(page) == want


def test_misleading_names():
    body = "<p>" + "The council met on Monday, and it decided about the bridge. " * 4 + "</p>"
    text = ("The council met on Monday, and it decided about the bridge. " * 4).strip()
    for main in ("<article class='comment-analysis'>{}</article>", "<div class='page-body top-story'>{}</div>"):
        for page in (main, "<html><body><nav><a href=x>Home</a></nav>" + main + "<footer>&copy; Site</footer></body></html>"):
            assert extracted(page.format(body)) == text


def test_edge_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "x", "<p>no id</p>"), (3, "y", "<div>" * 3000 + "deep"),
            (4, "z", "<article><p>" + "word " * 200000 + "</p></article>"), (4, "z", "<article><p>" + "word " * 200000 + "</p></article>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = hm.extract(df).collect()
    assert len(got) == 6 and {r.page_id: r.text for r in got}[1] == {r.page_id: r.text for r in got}[2] == ""
    assert [r.n_chars for r in got if r.page_id == 4] == [200000 * 5 - 1] * 2
    assert hm.extract(df.limit(0)).count() == 0
