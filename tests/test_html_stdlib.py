"""Main text, links and URLs against the standard library's parser and urljoin,
on the page shapes that regex passes get wrong most easily, and on random ones."""

import random
import re
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from tessera import fixed
from tessera.functions import html as hx
from tessera.functions import text as tx
from tessera.functions import urls as ux
from tessera.operators import links

BLOCKS = {"p", "h1", "h2", "h3"}
BOUNDS = BLOCKS | set("h4 h5 h6 div article section ul ol li table nav header footer aside main body blockquote pre form".split())


class Reader(HTMLParser):
    """Container and block texts by events: depth counting for the container."""

    def __init__(self, tag, wanted):
        super().__init__(convert_charrefs=True)
        self.tag, self.wanted, self.depth, self.done = tag, wanted, 0, False
        self.blocks, self.open, self.hrefs, self.skip = [], False, [], 0

    def handle_starttag(self, tag, attrs):
        attrs = [(k, v) for k, v in attrs]
        if tag in ("script", "style"):
            self.skip += 1
        if tag == "a":
            self.hrefs += [v for k, v in attrs if k == "href" and v is not None][:1]
        if tag == self.tag:
            if self.depth:
                self.depth += 1
            elif not self.done and self.wanted(dict(reversed(attrs))):
                self.depth = 1
                return
        if self.depth and tag in BOUNDS:
            self.open = tag in BLOCKS
            if self.open:
                self.blocks.append([])

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip -= 1
        if self.depth and tag in BOUNDS:
            self.open = False
        if tag == self.tag and self.depth:
            self.depth -= 1
            self.done = self.depth == 0

    def handle_data(self, data):
        if self.depth and self.open and not self.skip:
            self.blocks[-1].append(data)


def read(page):
    for tag, wanted in (("div", lambda a: any(c in (a.get("class") or "") for c in fixed.CONTAINER_CLASSES)),
                        ("article", lambda a: True), ("body", lambda a: True)):
        r = Reader(tag, wanted)
        r.feed(page)
        r.close()
        if r.done or r.depth:
            return r
    raise AssertionError("pages here have a body")


def cleaned(blocks):
    s = re.sub(r"\s+", " ", "\n".join(" ".join(b) for b in blocks))
    s = re.sub("[^" + fixed.CRAWL_KEEP_CLASS + "]", " ", s)
    return re.sub(r"[.,?!]{2,}", " ", s).split()


PAGES = [
    "<body><p>&epsilon;&pi;&#941;&#x3bd; caf&#101;, 3&#44;5 &lpar;x&rpar; AT&T R&D &copy 1 &ampx &notit; &#0; &#x80; &#11;k</p></body>",
    "<body><article><p>one<article><p>nested two</article><p>three</article><p>four</body>",
    "<body><div class='x post-content y'><p>a<div><p>b</div><p>c</div><p>d</body>",
    "<body><div data-class='post-content'><p>no</div><div class=entry-content><p>yes</div></body>",
    "<body><p title='a>b' data-x=\"c>d\">one <b title=\">\">two</b></p><h2 id='>'>three</h2></body>",
    "<body><p>5 < 6 and 7 <3 then</p></body>", "<BODY><P>upper<H1>case</H1></BODY>",
    "<body><script>var p='<p>no</p>'</script><!-- <p>no</p> --><p>yes<style>p{}</style></p></body>",
    "<body class='article-body'><div id=x class = \"a article-body\" ><h3>t</h3>loose<p>in</p></div></body>",
    "<body><p>no&nbsp;break&#160;here&Omega;&thetasym;&amp;amp;</p></body>",
    "<body><article class='a'><div>x</div><p>y<br>z<p>w</article >tail</body>",
]


def random_pages(n):
    rng = random.Random(11)
    words = ["alpha", "beta&amp;", "&gamma;", "&#937;", "x&lt;y", "AT&T", "&nbsp;", "12,5", "end.", "&copy;", "&eacute;t"]
    tags = ["p", "h1", "h2", "h4", "b", "i", "span", "div", "article", "li", "section"]
    for _ in range(n):
        parts, stack = [], []
        for _ in range(rng.randrange(5, 60)):
            if stack and rng.random() < 0.4:
                parts.append(f"</{stack.pop()}>")
            elif rng.random() < 0.5:
                t = rng.choice(tags)
                at = rng.choice(["", " class='post-content'", " data-class='entry-content'", " title=\"a>b\"", " id=x", " class=\"q article-body\" hidden"])
                parts.append(f"<{t}{at}>")
                stack.append(t)
            else:
                parts.append(" ".join(rng.choices(words, k=rng.randrange(1, 4))) + " ")
        yield "<html><body>" + "".join(parts) + "".join(f"</{t}>" for t in reversed(stack)) + "</body></html>"


def test_page_text(spark):
    pages = PAGES + list(random_pages(150))
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").withColumn("url", F.lit("http://s/"))
    got = {r.page_id: r.page_text.split() for r in links.page_texts(df).collect()}
    for i, page in enumerate(pages):
        assert got[i] == cleaned(read(page).blocks), page


def test_references(spark):
    from html.entities import html5
    rng = random.Random(3)
    texts = [f"a&{n}b" for n, c in html5.items() if n.endswith(";") and hx._is_kept(c)]
    texts += ["&#%d;" % c for c in rng.sample(range(32, 0xD7FF), 300) if not 127 <= c < 160] + ["&#x%x" % c for c in (65, 0x3B1, 0x1F00, 0x1F600)]
    texts += ["AT&T", "a && b", "&", "&;", "&#;", "&#x;", "&amp;lt;", "&ltfoo", "&eacutex", "100&percnt;", "&#1114112;", "&#55296;", "&#0"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.u for r in df.select("i", hx.unescape("t").alias("u")).collect()}
    assert [got[i] for i in range(len(texts))] == [unescape(t) for t in texts]


@pytest.mark.parametrize("page, want", [
    ("<a data-href='/wrong' href='/right'>x</a>", ["/right"]), ("<a title='href=/no' href=/yes>x", ["/yes"]),
    ("<a href='?a=1&amp;b=2&copy;&#47;x'>", ["?a=1&b=2©/x"]), ("<a\nclass='>' href = \"x y\">", ["x y"]), ("<abbr href='/no'>", []),
    ("<A HREF='/Up'>", ["/Up"]), ("<a name=x>", []),
])
def test_hrefs(spark, page, want):
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(hx.hrefs("html")).first()[0] == want
    r = Reader("none", lambda a: False)
    r.feed(page)
    assert r.hrefs == want


def test_resolution(spark):
    base = "http://s.example/dir/page.html?q=1"
    hrefs = [" /a", "/a \n", "b\tc", "HTTPS://s.example/x/1", "HTTP:/rel", "http://S.example/y/2", "//s.example/z/3", "../up/4", "?n=5", "mailto:x@y", "Https://o/"]
    df = spark.createDataFrame([(k, 0, base, h) for k, h in enumerate(hrefs)], "page_id int, pos int, url string, href string")
    got = {r.page_id: r.dst for r in links.resolve_links(df).collect()}
    want = {k: urldefrag(urljoin(base, h.strip()))[0] for k, h in enumerate(hrefs) if h != "HTTP:/rel"}
    assert {k: got[k] for k in want} == want
    kept = {r.page_id for r in links.internal_links(links.resolve_links(df)).collect()} - {hrefs.index("HTTP:/rel")}
    assert kept == {k for k, u in want.items() if urlparse(u).scheme in ("http", "https") and urlparse(u).netloc == "s.example"}
    assert hrefs.index("HTTPS://s.example/x/1") in kept


def test_white_space_is_pythons(spark):
    cps = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, "a" + chr(c) + "b") for c in cps], "c int, t string")
    got = {r.c for r in df.where(F.regexp_replace("t", tx.WHITESPACE_RUN, "") == "ab").collect()}
    assert got == {c for c in cps if chr(c).isspace()}
