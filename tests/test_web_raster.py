"""Fixture tests with brute-force references: URL resolution vs the standard
library, stencils vs numpy, BFS vs a Python BFS, page-file scan, metrics at
the zero-division edges, blend threshold strictness."""

import os
import random
import tempfile
from collections import deque
from urllib.parse import urljoin, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import html as hx
from tessera.functions import urls as ux
from tessera.operators import graph, metrics, raster, series
from tessera.sources import pages as ps

BASE = "http://www.site.gr:8080/news/2024/story.html?x=1"
HREFS = ["other.html", "../up.html", "../../../../x", "./a/./b/../c", "/root/p",
         "//cdn.site.gr/lib.js", "?q=2", "https://else.gr/y#frag", "#top", "sub/dir/",
         "..", ".", "a//b", "/page/3", "mailto:x@y.gr", "HTTP://Upper.gr/Z"]


def test_resolve_matches_urljoin(spark):
    df = spark.createDataFrame([(BASE, h) for h in HREFS], "url string, href string")
    got = [r.dst for r in df.select(ux.drop_fragment(ux.resolve("url", "href")).alias("dst")).collect()]
    want = [urlparse(urljoin(BASE, h))._replace(fragment="").geturl() for h in HREFS]
    assert got == want


def test_link_filters(spark):
    html = ('<html><body><a href="/a/1">x</a><a href="#top">t</a><a href="JavaScript:void(0)">j</a>'
            '<a href="">e</a><a class="c" href=\'/b\'>b</a><script>var s="<a href=\\"/no\\">";</script>'
            '<a href="http://other.gr/x">o</a><a href="/c?p=1&amp;q=2">c</a></body></html>')
    df = spark.createDataFrame([(1, "http://site.gr/", html)], "page_id long, url string, html string")
    hrefs = df.select(F.explode(hx.hrefs("html")).alias("h")).filter(hx.keep_href("h"))
    assert [r.h for r in hrefs.collect()] == ["/a/1", "/b", "http://other.gr/x", "/c?p=1&q=2"]
    arts = spark.createDataFrame([("http://s/page/3",), ("http://s/about",), ("http://s/a/b",),
                                  ("http://s/x1",), ("http://s",)], "u string")
    assert [r.k for r in arts.select(ux.article_like("u").alias("k")).collect()] == \
        [True, False, True, True, False]


def test_block_text_implicit_close(spark):
    html = ('<html><body><nav><p>menu</p></nav><div class="x post-content y"><h1>Title</h1>'
            '<p><b>one</b> two<br><p>three &quot;q&quot; &amp; four</div><article><p>no</p></article>'
            '</body></html>')
    df = spark.createDataFrame([(html,)], "html string")
    kind = df.select(hx.container_kind(hx.strip_scripts("html"))).first()[0]
    text = df.select(hx.page_text("html")).first()[0]
    assert kind == "div"
    assert text.split("\n") == ["Title", " one  two ", "three \"q\" & four"]


def _np_blur(img, taps):
    k = len(taps) // 2
    p = np.pad(img, k, mode="reflect")   # numpy 'reflect' = reflect-101
    t = np.array(taps)
    rows = np.array([[np.dot(t, p[i, j:j + len(t)]) for j in range(img.shape[1])]
                     for i in range(p.shape[0])])
    return np.array([[np.dot(t, rows[i:i + len(t), j]) for j in range(img.shape[1])]
                     for i in range(img.shape[0])])


@pytest.mark.parametrize("kind", ["impulse", "ramp", "random"])
def test_stencils_match_numpy(spark, kind):
    h, w = 5, 7
    if kind == "impulse":
        img = np.zeros((h, w)); img[2, 3] = 255
    elif kind == "ramp":
        img = np.add.outer(np.arange(h) * 10, np.arange(w) * 3).astype(float)
    else:
        img = np.random.default_rng(1).integers(0, 256, (h, w)).astype(float)
    rows = [(1, [int(v) for v in img.ravel()])]
    df = spark.createDataFrame(rows, "id long, vals array<int>")
    px = raster.explode_raster(df, "id", "vals", h, w)
    f = {(r.y, r.x): r for r in raster.pixel_features(px).collect()}
    b3, b7 = _np_blur(img, raster.GAUSS3), _np_blur(img, raster.GAUSS7)
    gx = _np_blur_sep(img, raster.DIFF3, raster.SMOOTH3)
    gy = _np_blur_sep(img, raster.SMOOTH3, raster.DIFF3)
    msq = _np_blur(img * img, raster.GAUSS3)
    for (y, x), r in f.items():
        assert r.blur3 == pytest.approx(b3[y, x])
        assert r.blur7 == pytest.approx(b7[y, x])
        assert r.dog == pytest.approx((b3[y, x] - b7[y, x]) / 255.0)
        assert r.sobel == pytest.approx(np.hypot(gx[y, x], gy[y, x]) / 255.0)
        assert r.var == pytest.approx(msq[y, x] - b3[y, x] ** 2)


def _np_blur_sep(img, tx, ty):
    k = 1
    p = np.pad(img, k, mode="reflect")
    tx, ty = np.array(tx), np.array(ty)
    rows = np.array([[np.dot(tx, p[i, j:j + 3]) for j in range(img.shape[1])] for i in range(p.shape[0])])
    return np.array([[np.dot(ty, rows[i:i + 3, j]) for j in range(img.shape[1])] for i in range(img.shape[0])])


def test_bfs_cyclic_graph(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "f"), ("b", "a")]
    df = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    got = {r.node: r.depth for r in graph.bfs_depth(df, seeds, 2).collect()}
    adj = {}
    for s, d in edges:
        adj.setdefault(s, []).append(d)
    want, q = {"a": 0}, deque(["a"])
    while q:
        n = q.popleft()
        for m in adj.get(n, []):
            if m not in want and want[n] < 2:
                want[m] = want[n] + 1
                q.append(m)
    assert got == want  # e (depth 3) and f are beyond the bound


def test_running_sum_and_rank_with_hot_group(spark):
    # one group holds most rows: ranks must still be exact
    rows = [(1 if i % 10 else 2, i, float(i % 7)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, k long, v double")
    out = series.running_sum(df, ["k"], "v", "c", buckets=16, partition_cols=["g"]).collect()
    acc = {}
    for r in sorted(out, key=lambda r: (r.g, r.k)):
        acc[r.g] = acc.get(r.g, 0.0) + r.v
        assert r.c == pytest.approx(acc[r.g])
    ranks = series.rank_within(df, ["k"], "rk", ["g"], buckets=16).collect()
    for g in (1, 2):
        ks = sorted(r.k for r in ranks if r.g == g)
        assert sorted((r.k, r.rk) for r in ranks if r.g == g) == list(zip(ks, range(1, len(ks) + 1)))


def test_metrics_zero_division(spark):
    cases = [(0, 0, 5, 5), (0, 5, 0, 5), (4, 0, 0, 6)]
    df = spark.createDataFrame(cases, "tp long, fp long, fn long, tn long")
    m = [r.asDict() for r in metrics.segmentation_metrics(df).collect()]
    assert m[0]["precision"] == 0 and m[0]["recall"] == 0 and m[0]["iou"] == 0
    assert m[1]["recall"] == 0 and m[1]["dice"] == 0
    assert m[2]["iou"] == 1 and m[2]["dice"] == 1 and m[2]["accuracy"] == 1
    for r in m:
        assert r["dice"] == pytest.approx(2 * r["iou"] / (1 + r["iou"]))


def test_blend_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.4, 0.4), (0.5, 0.25), (0.0, 1.0)], "a double, b double")
    out = df.select(metrics.threshold(metrics.blend("a", "b")).alias("p")).collect()
    # 0.6*0.4+0.4*0.4 = 0.4 (not > 0.4); 0.4; 0.4
    assert [r.p for r in out] == [0, 0, 0]


def test_page_files_scan(spark):
    root = tempfile.mkdtemp(prefix="tessera-pages-")
    files = {
        "cycle_001/site.gr/page_1.txt": "URL=http://site.gr/a\nDATE=2025-03-18\n  first line \nsecond\n",
        "cycle_001/site.gr/page_2.txt": "URL=http://site.gr/b\nbody without date\n",
        "cycle_002/other.gr/page_1.txt": "no header at all\n",
        "cycle_002/other.gr/page_2.txt": "",
    }
    for rel, body in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8") as f:
            f.write(body)
    rows = {(r.cycle, r.domain, r.file): r for r in ps.scan_page_files(spark, root).collect()}
    assert len(rows) == 3  # the empty file is skipped
    a = rows[(1, "site.gr", "page_1.txt")]
    assert (a.url, a.date, a.content) == ("http://site.gr/a", "2025-03-18", "first line second ")
    b = rows[(1, "site.gr", "page_2.txt")]
    assert b.url == "http://site.gr/b" and len(b.date) == 10 and b.content == "body without date "
    c = rows[(2, "other.gr", "page_1.txt")]
    assert c.url == "Unknown URL" and c.content == "no header at all "
    # the record store: numbered by its folders, and dated by its file where a page has no date
    store = os.path.join(root, "store")
    assert ps.next_cycle(spark, store) == 1
    rows = [(c, "x.gr", f"http://x.gr/{c}", d, "text") for c, d in ((1, "2025-01-01"), (3, None))]
    ps.write_page_store(spark.createDataFrame(rows, "cycle int, domain string, url string, date string, text string"), store)
    assert ps.next_cycle(spark, store) == 4
    dates = {r.cycle: r.date for r in ps.scan_page_store(spark, store).collect()}
    assert dates[1] == "2025-01-01" and len(dates[3]) == 10


def test_page_store_loses_no_page(spark):
    """Round trip of odd pages: nulls, separators, line breaks, text that looks like a head line."""
    root = os.path.join(tempfile.mkdtemp(prefix="tessera-pages-"), "store")
    rng = random.Random(5)
    odd = ["\u001e", "\u001f", "\u001fr", "\u001fu", "\u001f0", "\n", "\r", " ", "URL=", "DATE=", "a", "β", "\\", "\\n", ""]
    texts = [None, "", "\u001e", "DATE=2020-01-01", "URL=x\nDATE=y\nz"] + \
        ["".join(rng.choices(odd, k=rng.randint(0, 12))) for _ in range(300)]
    urls = [None, "", "\u001f0", "http://a/\u001e\nb"]
    dates = [None, "2025-01-01", "2024-12-31"]
    rows = [(1, "x.gr", urls[i % 4] if i % 3 else f"http://x.gr/{i}", dates[i % len(dates)], t) for i, t in enumerate(texts)]
    ps.write_page_store(spark.createDataFrame(rows, "cycle int, domain string, url string, date string, text string"), root)
    got = ps.scan_page_store(spark, root).collect()
    today = {r.date for r in got} - set(dates)
    assert len(got) == len(rows) and len(today) == 1 and len(today.pop()) == 10
    want = sorted(("Unknown URL" if u is None else u, d or "", " ".join(x.strip(" ") for x in (t or "").split("\n")))
                  for _, _, u, d, t in rows)
    assert sorted((r.url, r.date if r.date in dates else "", r.content) for r in got) == want


def _parser_container(html):
    """Brute force: the standard library's HTML parser, depth-counted."""
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=False)
            self.depth, self.start, self.end = 0, None, None

        def handle_starttag(self, tag, attrs):
            if tag != "div" or self.end is not None:
                return
            cls = dict(attrs).get("class") or ""
            if self.start is None and re_container.search(cls):
                self.start, self.depth = self.getpos(), 1
                self.start_end = self.rawdata.index(">", self._offset()) + 1
            elif self.start is not None:
                self.depth += 1

        def handle_endtag(self, tag):
            if tag == "div" and self.start is not None and self.end is None:
                self.depth -= 1
                if self.depth == 0:
                    self.end = self._offset()

        def _offset(self):
            line, col = self.getpos()
            return sum(len(x) for x in self.rawdata.splitlines(True)[:line - 1]) + col

    import re as _re
    re_container = _re.compile("article-body|entry-content|post-content")
    p = P()
    p.feed(html)
    p.close()
    return html[p.start_end:p.end if p.end is not None else len(html)]


def test_balanced_div_container(spark):
    pages = [
        '<body><div class="post-content"><p>a</p><div class="inner"><p>b</p></div><p>c</p></div><p>out</p></body>',
        '<body><div id="x"><div class="entry-content main"><div><div>deep</div></div>tail</div></div>after</body>',
        '<body><DIV class="article-body">unclosed <div>x</div> to the end',
        '<body><div class="other">no</div><article><p>art</p></article></body>',
    ]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i long, h string")
    got = {r.i: r.c for r in df.select("i", hx.main_container("h").alias("c")).collect()}
    for i, h in enumerate(pages[:3]):
        assert got[i] == _parser_container(h), i
    assert got[3] == "<p>art</p>"


def test_pixel_sample_against_a_sort(spark):
    """One image with most pixels, images whose share is nothing, one or everything."""
    from hashlib import md5
    from math import floor

    from tessera import fixed
    from tessera.operators import raster

    sizes = {1: (90, 70), 2: (1, 1), 3: (3, 7), 4: (40, 5), None: (2, 2)}
    rows = [(i, y, x, y * x, h, w) for i, (h, w) in sizes.items() for y in range(h) for x in range(w)]
    px = spark.createDataFrame(rows, "image_id long, y int, x int, v int, height int, width int").repartition(7)
    key = lambda r: (md5(f"{fixed.SPLIT_SEED}:{r[0]}:{r[1]}:{r[2]}".encode()).hexdigest(), r[1], r[2])
    for fraction in (0.0, 0.05, 0.5, 1.0):
        got = raster.pixel_sample(px, fraction)
        assert got.columns == px.columns
        want = []
        for i in (1, 2, 3, 4):
            own = sorted((r for r in rows if r[0] == i), key=key)
            want += own[:floor(len(own) * fraction)]
        assert sorted(map(tuple, got.collect())) == sorted(want), fraction
    assert raster.pixel_sample(px.limit(0)).count() == 0


def _resized(img, out_h, out_w):
    """Bilinear targets from the taps that are there, per definition."""
    px, h, w = img
    out = {}
    for ty in range(out_h):
        for tx_ in range(out_w):
            sy, sx = (max((t + 0.5) * n / m - 0.5, 0.0) for t, n, m in ((ty, h, out_h), (tx_, w, out_w)))
            y0, x0 = min(int(sy), h - 1), min(int(sx), w - 1)
            y1, x1, fy, fx = min(y0 + 1, h - 1), min(x0 + 1, w - 1), sy - y0, sx - x0
            taps = [(y0, x0, (1 - fy) * (1 - fx)), (y0, x1, (1 - fy) * fx), (y1, x0, fy * (1 - fx)), (y1, x1, fy * fx)]
            there = [(px[y, x], k) for y, x, k in taps if (y, x) in px]
            if there:
                known = [v * k for v, k in there if v is not None]
                out[ty, tx_] = sum(known) if known else None
    return out


def test_resampling_needs_no_join_and_bounds_its_tasks(spark, monkeypatch):
    import random
    rng = random.Random(3)
    images = {}
    for k, (h, w) in enumerate([(1, 1), (1, 7), (8, 8), (5, 3), (20, 2), (13, 13)]):
        images[k] = ({(y, x): rng.randrange(256) for y in range(h) for x in range(w)}, h, w)
    px, _, _ = images[2]
    del px[0, 0], px[3, 3], px[3, 4], px[4, 3], px[4, 4], px[2, 2]
    px[7, 7] = px[7, 6] = px[6, 7] = px[6, 6] = None
    rows = [(k, y, x, v, h, w) for k, (p, h, w) in images.items() for (y, x), v in p.items()] + [(None, 0, 0, 5, 1, 1)]
    df = spark.createDataFrame(rows, "image_id long, y int, x int, v int, height int, width int")
    for out_h, out_w in ((4, 4), (13, 13), (1, 1), (3, 9), (40, 17)):
        got = {(r.image_id, r.y, r.x): r.v for r in raster.resample_bilinear(df, out_h, out_w).collect()}
        want = {(k, *at): v for k, img in images.items() for at, v in _resized(img, out_h, out_w).items()}
        assert got.keys() == want.keys()
        assert all(got[i] is None if v is None else abs(got[i] - v) < 1e-9 for i, v in want.items())
    twice = raster.resample_bilinear(df.where("image_id = 3").unionAll(df.where("image_id = 3")), 4, 4)
    assert {(r.y, r.x): round(r.v / 2, 9) for r in twice.collect()} == {at: round(v, 9) for at, v in _resized(images[3], 4, 4).items()}
    # no side is ever broadcast, and parts follow the weighted pixels
    monkeypatch.setattr(raster, "RESAMPLE_ROWS", 100)
    out = raster.resample_bilinear(df, 13, 13)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.rdd.getNumPartitions() >= 40
