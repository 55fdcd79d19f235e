"""HTML main-content and link extraction as column expressions (H1-H3).

The per-row DOM parser of the original is re-aimed as regex passes that run
inside the JVM over the whole ``pages`` table. Patterns use possessive
quantifiers, so a pass is linear in the page and never recurses.

Semantics: the container is the first ``div`` whose class contains one of
the fixed container classes, else the first ``article``, each up to its
balancing end tag (nested ones are counted), else ``body``, else the whole
document. A text block opens at ``<p>``/``<h1-3>`` and ends at the next block
start or end tag (a new ``<p>`` implicitly closes an open one, as HTML parsers
do); its text is its tags replaced by spaces and character references decoded.
A tag is ``<`` before a letter, ``/``, ``!`` or ``?``; quoted attribute values
may hold ``>``; attribute names are whole words (``data-href`` is not ``href``).
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import fixed

# Private-use code points mark block starts and ends during extraction.
OPEN_MARK = "\ue000"
CLOSE_MARK = "\ue001"

SCRIPT_STYLE = r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>"
COMMENT = r"(?s)<!--.*?-->"
NEST_MARK = "\ue002"
# What may follow a tag's name up to its end; one attribute; a quoted or bare value.
TAG_REST = r"(?:[\s/][^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)?>"
VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++)"
ATTRS = r"(?:[\s/]++[^\s=>\"'/]++(?:\s*=\s*" + VALUE + r")?)*?"
_CLASSES = "(?:" + "|".join(fixed.CONTAINER_CLASSES) + ")"
DIV_OPEN = (r"(?is)<div" + ATTRS + r"[\s/]++class\s*=\s*(?:\"[^\"]*?" + _CLASSES + r"|'[^']*?" + _CLASSES
            + r"|[^\s\"'>]*?" + _CLASSES + ")")
ARTICLE_OPEN = r"(?is)<article[\s/>]"
BODY = r"(?is)<body" + TAG_REST + r"(.*?)(?:</body\s*>|\z)"
BODY_OPEN = r"(?is)<body[\s/>]"
BLOCK_OPEN = r"(?i)<(?:p|h[1-3])" + TAG_REST
BLOCK_CLOSE = (r"(?i)</?(?:p|h[1-6]|div|article|section|ul|ol|li|table|nav|header|footer|"
               r"aside|main|body|blockquote|pre|form)" + TAG_REST)
BLOCK_TEXT = OPEN_MARK + "([^" + OPEN_MARK + CLOSE_MARK + "]*)"
ANCHOR_HREF = r"(?i)<a" + ATTRS + r"[\s/]++href\s*=\s*(" + VALUE + ")"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_scripts(c) -> Column:
    """Drop script/style elements and comments (never visible text)."""
    return F.regexp_replace(F.regexp_replace(_col(c), SCRIPT_STYLE, " "), COMMENT, " ")


def container_kind(html) -> Column:
    h = _col(html)
    return (F.when(h.rlike(DIV_OPEN), F.lit("div"))
            .when(h.rlike(ARTICLE_OPEN), F.lit("article"))
            .when(h.rlike(BODY_OPEN), F.lit("body"))
            .otherwise(F.lit("document")))


def main_container(html) -> Column:
    """Inner HTML of the main-content container (H1)."""
    h = _col(html)
    return (F.when(h.rlike(DIV_OPEN), balanced(h, "div", DIV_OPEN))
            .when(h.rlike(ARTICLE_OPEN), balanced(h, "article", ARTICLE_OPEN))
            .when(h.rlike(BODY_OPEN), F.regexp_extract(h, BODY, 1))
            .otherwise(h))


def balanced(html, tag: str, opening: str) -> Column:
    """Inner HTML of the first ``tag`` that ``opening`` finds, nested ones counted.

    A marker goes before every start and end tag of that name, so splitting on
    it gives segments that each start with one of them (segment 1 is empty,
    segment 2 the container's own opening tag). A depth fold finds the index of
    the segment whose tag closes the container; only integers are carried, so
    the work is linear in the page. An unclosed container runs to the end.
    """
    h = _col(html)
    start = F.length(F.regexp_extract(h, "(?is)^(.*?)" + opening[len("(?is)"):], 1)) + 1
    tail = h.substr(start, F.length(h))
    segs = F.split(F.regexp_replace(tail, rf"(?i)(</?{tag}(?=[\s/>]))", NEST_MARK + "$1"), NEST_MARK)

    def step(st, seg):
        d = st["depth"] + F.when(seg.rlike(f"^(?i)<{tag}"), 1).when(seg.rlike(f"^(?i)</{tag}"), -1).otherwise(0)
        i = st["i"] + 1
        end = F.when((st["end"] < 0) & (d == 0) & (i > 2), i).otherwise(st["end"])
        return F.struct(d.alias("depth"), i.alias("i"), end.alias("end"))

    init = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("i"), F.lit(-1).alias("end"))
    end = F.aggregate(segs, init, step)["end"]
    last = F.when(end > 0, end - 1).otherwise(F.size(segs))
    first = F.regexp_replace(segs[1], f"(?i)^<{tag}" + TAG_REST, "")
    rest = F.array_join(F.slice(segs, 3, F.greatest(last - 2, F.lit(0))), "")
    return F.concat(first, rest)


def _is_kept(char: str) -> bool:
    return len(char) == 1 and (ord(char) < 0x100 or 0x370 <= ord(char) < 0x400 or 0x1F00 <= ord(char) < 0x2000)


#: Named references (with and without the final semicolon, from the standard
#: library's table) that give an ASCII, Latin-1 or Greek character. Others give
#: symbols, which the cleaner blanks.
NAMED = {n.rstrip(";"): c for n, c in html5.items() if _is_kept(c)}
#: The other names, all with a final semicolon.
OTHER = sorted({n.rstrip(";") for n in html5 if n.endswith(";")} - set(NAMED))
#: Names that also count without a semicolon, whatever follows; longest first.
BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _character(code: Column) -> Column:
    """The character a numeric reference stands for; as HTML has it, a few
    control codes stand for nothing."""
    bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    nothing = code.between(1, 8) | code.between(14, 31) | (code == 11) | (code == 127)
    utf32 = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (F.when(bad, F.lit("\ufffd")).when(nothing, F.lit(""))
            .when(code.between(0x80, 0x9F), F.lit(" "))  # symbols of a Windows code page
            .otherwise(utf32))


def unescape(c) -> Column:
    """Character references decoded: numeric ones, and the named ones in
    ``NAMED``; other names become a space, and ``&`` before anything else stays."""
    s = _col(c)
    other = F.from_json(F.lit(json.dumps(OTHER)), "array<string>")
    named = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")

    def one(seg: Column) -> Column:
        dec = F.regexp_extract(seg, r"^#([0-9]{1,7})", 1)
        hexa = F.regexp_extract(seg, r"^#[xX]([0-9a-fA-F]{1,6})", 1)
        code = F.when(dec != "", dec.cast("int")).when(hexa != "", F.conv(hexa, 16, 10).cast("int"))
        name = F.regexp_extract(seg, r"^([a-zA-Z][a-zA-Z0-9]*);", 1)
        bare = F.regexp_extract(seg, "^(" + "|".join(BARE) + ")", 1)
        return (F.when(code.isNotNull(), F.concat(
                    _character(code), F.regexp_replace(seg, r"^#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?", "")))
                .when((name != "") & (F.try_element_at(named, name).isNotNull() | F.array_contains(other, name)),
                      F.concat(F.coalesce(F.try_element_at(named, name), F.lit(" ")),
                               seg.substr(F.length(name) + 2, F.length(seg))))
                .when(bare != "", F.concat(F.coalesce(F.try_element_at(named, bare), F.lit(" ")),
                                           seg.substr(F.length(bare) + 1, F.length(seg))))
                .otherwise(F.concat(F.lit("&"), seg)))

    segs = F.split(s, "&")
    decoded = F.concat(segs[0], F.array_join(F.transform(F.slice(segs, 2, F.size(segs)), one), ""))
    return F.when(s.contains("&"), decoded).otherwise(s)


# A tag that cannot span a block marker: stripping tags over the whole marked
# container then equals stripping them block by block. The second form is a tag
# with an unclosed quote.
_NO = OPEN_MARK + CLOSE_MARK
TAG_IN_BLOCK = (rf"<[a-zA-Z/!?][^>\"'{_NO}]*+(?:\"[^\"{_NO}]*+\"[^>\"'{_NO}]*+|'[^'{_NO}]*+'[^>\"'{_NO}]*+)*+>"
                rf"|<[a-zA-Z/!?][^>{_NO}]*+>")


def text_blocks(container) -> Column:
    """Array of block texts (tags -> space, entities decoded) (H2).

    Tag stripping and entity decoding run once over the marked container
    (codegen'd string passes) instead of per block in a lambda."""
    marked = F.regexp_replace(_col(container), BLOCK_OPEN, OPEN_MARK)
    marked = F.regexp_replace(marked, BLOCK_CLOSE, CLOSE_MARK)
    cleaned = unescape(F.regexp_replace(marked, TAG_IN_BLOCK, " "))
    return F.regexp_extract_all(cleaned, F.lit(BLOCK_TEXT), 1)


def page_text(html) -> Column:
    """Blocks of the main container joined by newlines (before cleaning)."""
    return F.array_join(text_blocks(main_container(strip_scripts(html))), "\n")


def hrefs(html) -> Column:
    """Array of raw ``href`` values of every anchor, in document order (H3)."""
    raw = F.regexp_extract_all(strip_scripts(html), F.lit(ANCHOR_HREF), 1)
    return F.transform(raw, _unquote_attr)


def _unquote_attr(v: Column) -> Column:
    quoted = F.substring(v, 1, 1).isin('"', "'")
    return unescape(F.when(quoted, F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))


def keep_href(h) -> Column:
    """Drop empty, fragment-only and ``javascript:`` links."""
    h = _col(h)
    return (h != "") & ~h.startswith("#") & ~F.lower(h).startswith("javascript:")
