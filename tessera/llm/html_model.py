"""Main text of pages by a tree-structured graphical model over the DOM.

Every block of a page is content or not. A node's potential comes from its tag,
its class, id and role words, and the text below it; parent-child potentials,
one table per kind of child, tie it to its parent. Sum-product messages go up
the tree and down again and give every node's marginal; text is kept where its
node is likelier content. Pages of a slice are solved together, level by level.

The model is trained on labelled pages that ``labelled_pages`` lays out: the
usual parts of pages under many tags and names, in random order and nesting,
with labels known by construction.

An article may stand directly in the body: the root, which is the body too, has
a label of its own, and each of its stretches of bare text is a leaf.

Defined results: a null or empty page has empty text; text outside any element
is a leaf of the page's root; unclosed elements end with the page; unknown tags
are plain containers; repeated rows are read one by one; an empty table gives
no rows; extra columns of any name are not read.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_texts

# ---- parsing ---------------------------------------------------------------

#: A comment, a declaration, a tag (quoted attribute values may hold ">"), or
#: a tag with an unclosed quote, which ends at the next ">".
MARKUP = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+(?:>|\Z)|</>"
                    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>=`]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never the page's text; the first group holds raw text.
RAW = frozenset("script style title textarea xmp noembed noframes iframe".split())
UNSEEN = RAW | frozenset("head noscript template svg math object audio video canvas select option button datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
#: A start tag of the key ends open elements of the value, up to the given ends.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
          "option": ("option",), "body": ("head",)}
SCOPE = frozenset("ul ol dl table html body div section article main aside nav header footer form".split())
PARAGRAPH_SCOPE = frozenset("html body td th caption button object".split())

TAG_GROUPS = {t: g for g, ts in enumerate((
    "html body", "article", "main", "section", "div center", "p", "h1 h2", "h3 h4 h5 h6", "ul ol dl menu", "li dt dd",
    "table tbody thead tfoot tr", "td th caption", "pre", "blockquote", "figure figcaption", "nav", "header", "footer",
    "aside", "form fieldset legend label input", "address details summary dialog")) for t in ts.split()}
N_TAGS = max(TAG_GROUPS.values()) + 4          # one for bare text, one for inline nodes, one for the rest

#: Unnamed blocks that, directly in the body, are a kind of their own beside bare text.
LOOSE = frozenset(TAG_GROUPS[t] for t in ("p", "h1", "h3", "pre", "blockquote"))

#: Words of class, id and role attributes, by what they usually name.
NAME_GROUPS = {w: g for g, ws in enumerate((
    "content contents article articlebody post entry story main text body copy prose richtext hentry",
    "nav navbar navigation menu submenu breadcrumb breadcrumbs crumbs pagination pager toc tabs skip skiplink",
    "header masthead topbar top logo branding siteheader tagline",
    "footer bottom copyright legal colophon contentinfo sitefooter credits disclaimer",
    "sidebar side aside widget widgets related recommended recommendations more popular trending complementary rail teaser teasers",
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner adbox adslot dfp outbrain taboola",
    "comment comments commentlist reply replies respond discussion disqus thread responses reader feedback",
    "cookie cookies consent gdpr notice notices notification alert warning popup modal overlay newsletter subscribe subscription signup paywall message",
    "share sharing social follow facebook twitter print toolbar tools buttons button",
    "search login form register contact input field",
    "hidden invisible offscreen visuallyhidden srl sronly")) for w in ws.split()}
N_NAMES = max(NAME_GROUPS.values()) + 1
NAME_WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

KINDS = ("container", "paragraph", "heading", "list item", "named", "inline", "loose")
N_FEATURES = 1 + N_TAGS + N_NAMES + 11


class Page:
    """Nodes (in page order, parents first) and text runs of one page."""

    __slots__ = ("parent", "depth", "tag", "names", "kind", "chars", "linked", "marks", "blocks", "label", "runs")

    def __init__(self):
        self.parent, self.depth, self.tag, self.names, self.kind = [-1], [0], [0], [()], [0]
        self.chars, self.linked, self.marks, self.blocks = [0], [0], [0], [0]
        self.label: list = [None]
        self.runs: list[tuple[int, str, bool]] = []      # node, text, new block before it

    def add(self, parent, tag, names, kind, label):
        for c, v in zip((self.parent, self.depth, self.tag, self.names, self.kind, self.chars, self.linked, self.marks, self.blocks),
                        (parent, self.depth[parent] + 1, tag, names, kind, 0, 0, 0, 0)):
            c.append(v)
        self.label.append(self.label[parent] if label is None else label)
        return len(self.parent) - 1


def attributes(raw: str) -> tuple[tuple[int, ...], bool | None]:
    """Name groups of a tag's attributes, and the label of a training page."""
    groups, label = set(), None
    for name, a, b, c in ATTRIBUTE.findall(raw):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            words = NAME_WORD.findall(CAMEL.sub(" ", entities.unescape(value)).lower())
            groups.update(NAME_GROUPS[w] for w in words if w in NAME_GROUPS)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or \
                name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            groups.add(NAME_GROUPS["hidden"])
        elif name == "data-label":
            label = value == "1"
    return tuple(sorted(groups)), label


def parse(text: str, memo: dict | None = None) -> Page:
    """The page's tree. Inline elements belong to the block around them, unless
    their attributes name a part of the page."""
    memo = {} if memo is None else memo
    page = Page()
    stack: list[tuple[str, int]] = [("#root", 0)]      # tag, node
    at = links = 0
    unseen = 0                                         # open elements without text
    fresh = True                                       # a block boundary since the last run
    leaf = 0                                           # the root's open stretch of bare text

    def run(raw: str) -> None:
        nonlocal fresh, leaf
        if not raw or unseen:
            return
        s = entities.unescape(raw) if "&" in raw else raw
        solid = len("".join(s.split()))
        node = stack[-1][1]
        if node == 0:
            if fresh:
                leaf = page.add(0, N_TAGS - 3, (), 6, None) if solid else 0
            elif solid and not leaf:
                leaf = page.add(0, N_TAGS - 3, (), 6, None)
            node = leaf
        page.runs.append((node, s, fresh))
        if solid:
            page.chars[node] += solid
            page.linked[node] += solid if links else 0
            page.marks[node] += s.count(".") + s.count(",") + s.count(";") + s.count("!") + s.count("?")
            page.blocks[node] += fresh
        fresh = False

    def pop() -> None:
        nonlocal links, unseen, fresh
        tag, _ = stack.pop()
        links -= tag == "a"
        unseen -= tag in UNSEEN
        if tag not in INLINE and tag not in UNSEEN:
            fresh = True

    while True:
        m = MARKUP.search(text, at)
        if m is None:
            run(text[at:])
            break
        run(text[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None or m[5] is not None and not m[0].endswith(">"):
            continue                                   # a comment, or a tag cut off by the end
        tag, raw, closing = tag.lower(), m[3] if m[2] else m[6], m[1] or m[4]
        if closing:
            depth = len(stack) - 1
            while depth > 0 and stack[depth][0] != tag:
                if tag in INLINE and stack[depth][0] not in INLINE:
                    depth = 0                          # no inline end tag leaves its block
                    break
                depth -= 1
            if depth > 0:
                while len(stack) > depth:
                    pop()
            elif tag not in INLINE and tag not in UNSEEN:
                fresh = True
            continue
        if tag == "br" or tag == "hr":
            fresh = True
            continue
        if tag in VOID:
            continue
        if tag not in INLINE and tag not in UNSEEN:
            fresh = True
            depth = len(stack) - 1                     # a block start ends an open paragraph
            while depth > 0 and stack[depth][0] not in PARAGRAPH_SCOPE and stack[depth][0] != "p":
                depth -= 1
            if stack[depth][0] == "p":
                while len(stack) > depth:
                    pop()
        ends = CLOSES.get(tag)
        if ends:
            depth = len(stack) - 1
            while depth > 0 and stack[depth][0] not in ends and stack[depth][0] not in SCOPE:
                depth -= 1
            if stack[depth][0] in ends:
                while len(stack) > depth:
                    pop()
        names, label = memo.get(raw) or memo.setdefault(raw, attributes(raw)) if raw and "=" in raw or "hidden" in raw else ((), None)
        inline = tag in INLINE
        node = stack[-1][1]
        if tag in ("html", "body"):                    # the root itself, whatever stands before
            if label is not None:
                page.label[0] = label
        elif not inline and tag not in UNSEEN or names or label is not None:
            group = TAG_GROUPS.get(tag, N_TAGS - 1 if not inline else N_TAGS - 2)
            kind = (5 if inline else 4 if names else 6 if node == 0 and TAG_GROUPS.get(tag) in LOOSE else 1 if tag == "p" else 2 if tag[0] == "h" and tag[1:].isdigit() else
                    3 if tag in ("li", "dt", "dd", "td", "th") else 0)
            node = page.add(node, group, names, kind, label)
        if raw.endswith("/") and tag in ("svg", "math"):
            continue
        stack.append((tag, node))
        links += tag == "a"
        unseen += tag in UNSEEN
        if tag in RAW:                                 # nothing in it is markup but its own end
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(text, at)
            at = end.start() if end else len(text)
            if end is None:
                break
    return page


# ---- the model -------------------------------------------------------------

def arrays(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features, parents, depths and kinds of the nodes of all pages."""
    size = np.array([len(p.parent) for p in pages])
    base = np.cumsum(size) - size

    def flat(name):
        return np.fromiter((x for p in pages for x in getattr(p, name)), np.int64, int(size.sum()))

    parent = flat("parent")
    parent = np.where(parent < 0, -1, parent + np.repeat(base, size))
    depth, tag, kind = flat("depth"), flat("tag"), flat("kind")
    below = np.column_stack([flat(k) for k in ("chars", "linked", "marks", "blocks")]).astype(float)
    own = below[:, 0].copy()
    levels = by_level(depth)
    for at in reversed(levels[1:]):
        np.add.at(below, parent[at], below[at])
    whole = np.maximum(np.repeat(below[base, 0], size), 1)
    chars, linked, marks, blocks = below.T
    up = np.where(parent < 0, 0, parent)
    n = len(tag)
    x = np.zeros((n, N_FEATURES))
    x[:, 0] = 1
    x[np.arange(n), 1 + tag] = 1
    at = [(i, 1 + N_TAGS + g) for i, names in enumerate(x for p in pages for x in p.names) for g in names]
    if at:
        x[tuple(np.array(at).T)] = 1
    none = chars == 0
    names = x[:, 1 + N_TAGS:1 + N_TAGS + N_NAMES]
    noisy = names[:, 1:NAME_GROUPS["hidden"]].any(axis=1)          # names that mislead on what holds most of the page
    article = np.isin(tag, [TAG_GROUPS["article"], TAG_GROUPS["main"]])
    density = np.where(none, 0, linked / np.maximum(chars, 1))
    x[:, 1 + N_TAGS + N_NAMES:] = np.column_stack([
        np.log1p(chars) / 8, density, np.where(none, 0, density > 0.6), np.minimum(marks / np.maximum(chars, 1) * 40, 2),
        np.log1p(chars / np.maximum(blocks, 1)) / 6, chars / whole, np.log1p(own) / 8, none,
        (chars[up] - chars) / whole, noisy * chars / whole, noisy & article])
    return x, parent, depth, kind


def by_level(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def sum_product(unary: np.ndarray, pair: np.ndarray, parent, depth, kind):
    """Log marginals [node, not content / content] and the pairwise marginals
    [node, parent label, own label] of every node below a root.

    ``unary`` are log potentials of content against not; ``pair`` log
    potentials [kind, parent label, own label]."""
    phi = np.column_stack([np.zeros(len(unary)), unary])
    levels = by_level(depth)
    up = phi.copy()                                    # belief from below
    message = np.zeros_like(phi)
    for at in reversed(levels[1:]):
        m = np.logaddexp.reduce(pair[kind[at]] + up[at][:, None, :], axis=2)
        m -= m.max(axis=1, keepdims=True)
        message[at] = m
        np.add.at(up, parent[at], m)
    belief = up.copy()
    joint = np.zeros((len(unary), 2, 2))
    belief[levels[0]] -= np.logaddexp.reduce(belief[levels[0]], axis=1)[:, None]
    for at in levels[1:]:
        rest = belief[parent[at]] - message[at]        # the parent without this child
        j = rest[:, :, None] + pair[kind[at]] + up[at][:, None, :]
        j -= np.logaddexp.reduce(j.reshape(len(at), 4), axis=1)[:, None, None]
        joint[at] = j
        belief[at] = np.logaddexp.reduce(j, axis=1)
    return belief, joint


@dataclass
class Model:
    weights: np.ndarray
    pair: np.ndarray

    def content(self, pages: list[Page]) -> list[np.ndarray]:
        """Per page the marginal of content for every node."""
        x, parent, depth, kind = arrays(pages)
        belief, _ = sum_product(x @ self.weights, self.pair, parent, depth, kind)
        return np.split(np.exp(belief[:, 1]), np.cumsum([len(p.parent) for p in pages])[:-1])


def fit(pages: list[Page], steps: int = 250) -> Model:
    """Gradient ascent on the likelihood of the labels, exact by sum-product.
    Nodes without a label of their own (the page's frame) are not content."""
    x, parent, depth, kind = arrays(pages)
    y = np.array([bool(v) for p in pages for v in p.label]).astype(int)
    child = np.flatnonzero(parent >= 0)
    seen = np.zeros((len(KINDS), 2, 2))
    np.add.at(seen, (kind[child], y[parent[child]], y[child]), 1)
    w, pair = np.zeros(N_FEATURES), np.zeros((len(KINDS), 2, 2))
    m, v = np.zeros(len(w) + pair.size), np.zeros(len(w) + pair.size)
    for step in range(1, steps + 1):
        belief, joint = sum_product(x @ w, pair, parent, depth, kind)
        want = np.zeros_like(seen)
        np.add.at(want, kind[child], np.exp(joint[child]))
        grad = np.concatenate([x.T @ (y - np.exp(belief[:, 1])) - 0.5 * w, (seen - want).ravel() - 0.5 * pair.ravel()]) / len(y)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        move = 0.2 * (1 - step / (steps + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
        w, pair = w + move[:len(w)], pair + move[len(w):].reshape(pair.shape)
    return Model(w, pair)


# ---- labelled pages --------------------------------------------------------

def labelled_pages(n: int, seed: int = 1) -> list[str]:
    """Pages whose parts carry data-label="1" (main text) or "0"."""
    rng = random.Random(seed)
    pick, some = rng.choice, rng.random

    def words(lo, hi):
        return " ".join("".join(rng.choices("aeinorstlduchmg", k=rng.randrange(1, 11))) for _ in range(rng.randrange(lo, hi)))

    def sentences(lo, hi):
        return " ".join(words(3, 18).capitalize() + pick(".,.?!.;.") for _ in range(rng.randrange(lo, hi)))

    def links(lo, hi, wrap="li"):
        items = "".join(f"<{wrap}><a href='/{words(1, 2)}'>{words(1, 4)}</a></{wrap}>" for _ in range(rng.randrange(lo, hi)))
        return f"<ul>{items}</ul>" if wrap == "li" else items

    def misleading(label):
        group = pick([g for g in range(N_NAMES - 1) if g > 0]) if label else 0       # "hidden" never misleads
        return pick([w for w, g in NAME_GROUPS.items() if g == group])

    def named(tags, names, body, label):
        tag = pick(tags.split())
        name = pick(names.split()) if names else ""
        if some() < 0.15:
            name += pick("- ") + misleading(label)
        if name and some() < 0.5:
            name = pick(("", "site-", "page-", "main-", "c-", "block ")) + name
        at = f' {pick(("class", "id", "class"))}="{name}"' if name else ""
        return f'<{tag}{at} data-label="{label}">{body}</{tag}>'

    def inline(s):
        if some() < 0.3:
            s = s.replace(" ", f" <{pick(('b', 'i', 'em', 'strong'))}>", 1) + ("" if some() < 0.3 else "</b>")
        if some() < 0.2:
            s += f" <a href='#'>{words(1, 4)}</a> {words(2, 8)}."
        return s

    def content():
        parts = [f"<h1>{words(2, 9)}</h1>"] if some() < 0.8 else []
        for _ in range(pick((1, 1, 2, 3, 5, 8))):
            kind = some()
            if kind < 0.72:
                parts.append(f"<p>{inline(sentences(1, pick((2, 5, 9))))}" + ("" if some() < 0.2 else "</p>"))
            elif kind < 0.8:
                parts.append(f"<h{pick('23')}>{words(1, 7)}</h2>")
            elif kind < 0.87:
                parts.append("<ul>" + "".join(f"<li>{words(2, 14)}" for _ in range(rng.randrange(2, 6))) + "</ul>")
            elif kind < 0.9:
                parts.append(f"<blockquote><p>{sentences(1, 3)}</p></blockquote>")
            elif kind < 0.93:
                parts.append(f"<pre>{words(4, 20)}</pre>")
            elif kind < 0.96:
                parts.append("<table><tr>" + "".join(f"<td>{words(1, 4)}</td>" for _ in range(6)) + "</tr></table>")
            else:
                parts.append(f"<figure><img src=x><figcaption>{words(3, 12)}</figcaption></figure>")
            if some() < 0.05:
                parts.append(advert())
            if some() < 0.03:
                parts.append(share())
            if some() < 0.08:
                parts[-1] = f"<div>{parts[-1]}</div>"
        return "".join(parts)

    def plain():
        lines = [inline(sentences(1, pick((2, 5, 9)))) for _ in range(pick((1, 1, 2, 4, 7)))]
        return (f"<h1>{words(2, 9)}</h1>" if some() < 0.3 else "") + pick(("<br>", "<br><br>", "\n")).join(lines)

    def advert():
        return named("div aside section span", "ad ads advert advertisement sponsored promo ad-box banner", pick((
            words(2, 9), sentences(1, 2), f"<a href=x>{words(2, 8)}</a>", f"<p>{sentences(1, 2)}</p>")), 0)

    def share():
        return named("div ul", "share social share-buttons", links(2, 5), 0)

    def comments():
        one = lambda: named("div li article", "comment comment-body reply", f"<b>{words(1, 3)}</b><p>{sentences(1, 5)}</p>", 0)
        return named("section div ol", "comments comment-list discussion replies responses disqus_thread reader-comments",
                     pick(("", "<h3>Comments</h3>", f"<h2>{words(1, 3)}</h2>")) + "".join(one() for _ in range(rng.randrange(1, 6))), 0)

    def notice():
        return named("div section aside p", "notice cookie-notice consent alert newsletter subscribe popup message", pick((
            sentences(1, 3), f"<p>{sentences(1, 3)}</p><a href=x>{words(1, 3)}</a>", f"<span>{sentences(1, 2)}</span><button>ok</button>")), 0)

    def form():
        return f"<form data-label='0'>{words(1, 4)} <label>{words(1, 3)}</label><input name=q><p>{words(2, 10)}</p><button>{words(1, 2)}</button></form>"

    def side():
        body = pick((f"<h3>{words(1, 4)}</h3>{links(3, 8)}", f"<h4>{words(1, 3)}</h4><p>{sentences(1, 3)}</p>", links(3, 9),
                     f"<p>{sentences(1, 2)}</p><p><a href=x>{words(2, 9)}</a></p>"))
        return named("aside div", "sidebar widget related recommended popular more", body, 0) if some() < 0.7 else f"<aside data-label='0'>{body}</aside>"

    def head():
        body = pick((f"<h1>{words(1, 4)}</h1><p>{words(2, 9)}</p>", f"<a href=/>{words(1, 3)}</a>", words(1, 5), f"<p>{sentences(1, 2)}</p>")) + \
            (navigation() if some() < 0.4 else "")
        return f"<header data-label='0'>{body}</header>" if some() < 0.5 else named("div", "header masthead topbar site-header", body, 0)

    def navigation():
        body = pick((links(3, 10), links(3, 8, "div"), " | ".join(f"<a href=x>{words(1, 3)}</a>" for _ in range(5)), links(2, 12)))
        return f"<nav data-label='0'>{body}</nav>" if some() < 0.6 else named("div ul", "nav menu navbar breadcrumbs navigation", body, 0)

    def foot():
        body = pick((f"&copy; {words(1, 3)} &middot; {sentences(1, 2)}", f"<p>{sentences(1, 3)}</p>", links(2, 6) + f"<p>&copy; {words(1, 5)}</p>",
                     words(3, 12)))
        return f"<footer data-label='0'>{body}</footer>" if some() < 0.6 else named("div", "footer copyright legal site-footer", body, 0)

    pages = []
    for _ in range(n):
        body = content()
        if some() < 0.15:
            body += comments()
        if some() < 0.1:
            body += form()
        kind = some()
        odd = f' class="{pick(("", "top-", "c-"))}{misleading(1)}-{words(1, 2)}"' if some() < 0.3 else ""
        main = (f"<article{odd} data-label='1'>{body}</article>" if kind < 0.4 else f"<main{odd} data-label='1'>{body}</main>" if kind < 0.55 else
                named("div section", "content post entry-content article-body story main text", body, 1) if kind < 0.85 else
                f"<div data-label='1'>{body}</div>")
        if some() < 0.2:
            main = f"<{pick(('main', 'div', 'section'))} data-label='1'>{main}{side() if some() < 0.3 else ''}</div>"
        before = [f() for f, p in ((head, 0.6), (navigation, 0.75), (notice, 0.3), (advert, 0.4), (form, 0.15)) if some() < p]
        after = [f() for f, p in ((side, 0.5), (advert, 0.3), (comments, 0.3), (share, 0.15), (form, 0.15), (notice, 0.2), (foot, 0.8)) if some() < p]
        if some() < 0.15:
            rng.shuffle(before)
        bare = some()                                  # an article without a wrapper, as blocks or as plain text
        if bare < 0.25:
            main = content() if bare < 0.15 else plain()
            if some() < 0.4:
                before, after = [], []
        page = pick((f"<html><head><title>{words(1, 6)}</title></head>", "")) if bare < 0.25 else f"<html><head><title>{words(1, 6)}</title></head>"
        page += f"<body data-label='{int(bare < 0.25)}'>" + "".join([*before, main, *after])
        pages.append(page + ("</body></html>" if some() < 0.9 else ""))
    return pages


@cache
def default_model(pages: int = 900, seed: int = 1, steps: int = 400) -> Model:
    return fit([parse(p) for p in labelled_pages(pages, seed)], steps)


# ---- extraction ------------------------------------------------------------

def text_of(page: Page, content: np.ndarray) -> str:
    """Kept runs, blocks joined by one space, white space made one space."""
    out: list[str] = []
    gap = False
    for node, s, fresh in page.runs:
        gap = gap or fresh
        if content[node] > 0.5:
            if gap:
                out.append(" ")
            out.append(s)
            gap = False
    return " ".join("".join(out).split())


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = model or default_model()
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    memo: dict = {}

    def run(rows: dict) -> dict:
        if len(memo) > 200_000:
            memo.clear()
        trees = [parse(h, memo) for h in rows["html"]]
        text = [text_of(t, c) for t, c in zip(trees, model.content(trees))]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": text, "n_chars": list(map(len, text))}

    return map_texts(rows, run, "page_id long, url string, text string, n_chars long", column="html", limit=2 << 20)
