"""DuckDB spellings of the HTML and URL functions for the oracle SQL.

By another route than the Spark functions, and without their patterns: a page
is split at every ``<`` into pieces that begin with a tag, lists of pieces are
cut, folded and mapped, and URLs are taken apart with string functions. Values
of character references come from the standard library. Pages with ``<`` inside
attribute values, which the tables don't hold, would be split too often.
"""

from __future__ import annotations

import html
from html.entities import html5

from tessera import fixed
from tessera.plans.registry import sql_str
from tessera.plans.sqltext import sql_clean

# Private-use characters before a block's text and behind it.
OPEN, CLOSE = chr(0xE010), chr(0xE011)
STARTS = ("p", "h1", "h2", "h3")
ENDS = tuple(s + t for s in ("", "/") for t in (
    "h4 h5 h6 div article section ul ol li table nav header footer aside main body blockquote pre form".split()))
ENDS += tuple("/" + t for t in STARTS)

_ATTRIBUTES = r"""(?:[\s/]+[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*?[\s/]+"""
_VALUE = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_TO_TAG_END = r"""^[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>"""


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is computed once a row."""
    return f"(SELECT {body} FROM (SELECT {value} AS {name}))"


def _in(names) -> str:
    return "(" + ", ".join(map(sql_str, names)) + ")"


def sql_strip_scripts(e: str) -> str:
    both = r"(?is)<(?:script|style)(?:\s[^>]*)?>.*?</(?:script|style)\s*>"
    return f"regexp_replace(regexp_replace({e}, {sql_str(both)}, ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g')"


def _name(x: str) -> str:
    return f"lower(regexp_extract({x}, {sql_str(r'^(/?[a-zA-Z][a-zA-Z0-9]*)[\s/>]')}, 1))"


def _after(x: str) -> str:
    """What follows the tag that a piece begins with."""
    return f"regexp_replace({x}, {sql_str(_TO_TAG_END)}, '')"


def _is_container(x: str) -> str:
    value = f"lower(regexp_extract({x}, {sql_str('(?is)^div' + _ATTRIBUTES + 'class' + _VALUE)}, 1))"
    return "(" + " OR ".join(f"contains({value}, {sql_str(c)})" for c in fixed.CONTAINER_CLASSES) + ")"


def _first(pieces: str, test: str) -> str:
    """Index of the first piece ``x`` that passes, or 0."""
    return f"coalesce(list_position(list_transform({pieces}, lambda x: {test}), TRUE), 0)"


def _found(pieces: str) -> str:
    """Indices of the three kinds of containers."""
    return (f"struct_pack(dv := {_first(pieces, _is_container('x'))}, art := {_first(pieces, _name('x') + ' = ' + sql_str('article'))}, "
            f"bod := {_first(pieces, _name('x') + ' = ' + sql_str('body'))})")


def _to_end(pieces: str, k: str, tag: str) -> str:
    """Inner HTML from piece k to the end tag that balances it."""
    step = f"CASE {_name('x')} WHEN '{tag}' THEN 1 WHEN '/{tag}' THEN -1 ELSE 0 END"
    fold = (f"list_reduce(({pieces})[{k}:], lambda st, x: struct_pack(dep := st.dep + {step}, at := st.at + 1, "
            f"fin := CASE WHEN st.fin = 0 AND st.dep + {step} = 0 THEN st.at + 1 ELSE st.fin END), "
            "struct_pack(dep := 0, at := 0, fin := 0)).fin")
    last = f"CASE WHEN {fold} > 0 THEN {k} + {fold} - 2 ELSE len({pieces}) END"
    return f"array_to_string(list_concat([{_after(f'({pieces})[{k}]')}], ({pieces})[{k} + 1:{last}]), '<')"


def sql_container_kind(h: str) -> str:
    kind = "CASE WHEN f0.dv > 0 THEN 'div' WHEN f0.art > 0 THEN 'article' WHEN f0.bod > 0 THEN 'body' ELSE 'document' END"
    return _let(f"string_split({h}, '<')", "p0", _let(_found("p0"), "f0", kind))


def sql_main_container(h: str) -> str:
    body = f"array_to_string(list_concat([{_after('p1[f1.bod]')}], p1[f1.bod + 1:]), '<')"
    body = f"split_part(regexp_replace({body}, {sql_str(r'(?i)</body\s*>')}, {sql_str(CLOSE)}), {sql_str(CLOSE)}, 1)"
    inner = (f"CASE WHEN f1.dv > 0 THEN {_to_end('p1', 'f1.dv', 'div')} WHEN f1.art > 0 THEN {_to_end('p1', 'f1.art', 'article')} "
             f"WHEN f1.bod > 0 THEN {body} ELSE array_to_string(p1, '<') END")
    return _let(f"string_split({h}, '<')", "p1", _let(_found("p1"), "f1", inner))


def _reference_values() -> dict[str, str]:
    out = {}
    for name in html5:
        value = html.unescape("&" + name)
        plain = len(value) == 1 and (ord(value) < 256 or 0x370 <= ord(value) <= 0x3FF or 0x1F00 <= ord(value) <= 0x1FFF)
        if plain and name.endswith(";"):
            out[name[:-1]] = value
    return out


def sql_unescape(e: str) -> str:
    """Character references decoded; ``e`` is a column or lambda variable."""
    values = _reference_values()
    table = "MAP([" + ", ".join(map(sql_str, values)) + "], [" + ", ".join(map(sql_str, values.values())) + "])"
    bare = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
    number = "regexp_extract(x, '^#([0-9]{1,7})', 1)"
    hexa = "regexp_extract(x, '^#[xX]([0-9a-fA-F]{1,6})', 1)"
    code = f"CAST(CASE WHEN {number} <> '' THEN {number} ELSE '0x' || {hexa} END AS INTEGER)"
    char = (f"CASE WHEN {code} = 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343 THEN chr(65533) "
            f"WHEN {code} BETWEEN 1 AND 8 OR {code} BETWEEN 14 AND 31 OR {code} IN (11, 127) THEN '' "
            f"WHEN {code} BETWEEN 128 AND 159 THEN ' ' ELSE chr({code}) END")
    one = ("CASE WHEN regexp_matches(x, '^#(?:[0-9]|[xX][0-9a-fA-F])') "
           f"THEN {char} || regexp_replace(x, '^#(?:[0-9]{{1,7}}|[xX][0-9a-fA-F]{{1,6}});?', '') "
           f"WHEN contains(x, ';') AND split_part(x, ';', 1) IN {_in(n[:-1] for n in html5 if n.endswith(';'))} "
           f"THEN coalesce(({table})[split_part(x, ';', 1)], ' ') || substring(x, length(split_part(x, ';', 1)) + 2) "
           f"WHEN regexp_matches(x, '^(?:{bare})') THEN coalesce(({table})[regexp_extract(x, '^({bare})', 1)], ' ') "
           f"|| substring(x, length(regexp_extract(x, '^({bare})', 1)) + 1) ELSE '&' || x END")
    return f"(string_split({e}, '&')[1] || array_to_string(list_transform(string_split({e}, '&')[2:], lambda x: {one}), ''))"


def sql_page_text(html_: str) -> str:
    piece = (f"CASE WHEN {_name('x')} IN {_in(STARTS)} THEN {sql_str(OPEN)} || {_after('x')} "
             f"WHEN {_name('x')} IN {_in(ENDS)} THEN {sql_str(CLOSE)} || {_after('x')} "
             f"WHEN regexp_matches(x, '^[a-zA-Z/!?]') THEN ' ' || {_after('x')} ELSE '<' || x END")
    marked = f"p2[1] || array_to_string(list_transform(p2[2:], lambda x: {piece}), '')"
    blocks = f"list_transform(string_split(m2, {sql_str(OPEN)})[2:], lambda b: split_part(b, {sql_str(CLOSE)}, 1))"
    text = _let(f"array_to_string({blocks}, chr(10))", "t2", _let(sql_unescape("t2"), "u2", sql_clean("u2")))
    return _let(f"string_split({sql_main_container(sql_strip_scripts(html_))}, '<')", "p2", _let(marked, "m2", text))


def sql_hrefs(html_: str) -> str:
    raw = f"regexp_extract(x, {sql_str('(?is)^a' + _ATTRIBUTES + 'href' + _VALUE)}, 1)"
    plain = "CASE WHEN left(v, 1) IN ('\"', '''') THEN substring(v, 2, length(v) - 2) ELSE v END"
    values = f"list_filter(list_transform(string_split({sql_strip_scripts(html_)}, '<'), lambda x: {raw}), lambda v: v <> '')"
    return f"list_transform(list_transform({values}, lambda v: {plain}), lambda y: {sql_unescape('y')})"


def sql_keep_href(h: str) -> str:
    return f"({h} <> '' AND NOT starts_with({h}, '#') AND NOT starts_with(lower({h}), 'javascript:'))"


def _url(u: str) -> str:
    """Struct of a URL's parts, cut off one after the other."""
    cut = f"SELECT {u} AS u"
    for name, value in (("nf", "split_part(u, '#', 1)"), ("nq", "split_part(nf, '?', 1)"), ("head", "split_part(nq, ':', 1)"),
                        ("sch", "CASE WHEN head <> nq AND NOT contains(head, '/') THEN head ELSE '' END"),
                        ("rest", "CASE WHEN sch <> '' THEN substring(nq, length(sch) + 2) ELSE nq END"),
                        ("auth", "CASE WHEN starts_with(rest, '//') THEN split_part(substring(rest, 3), '/', 1) ELSE '' END")):
        cut = f"SELECT *, {value} AS {name} FROM ({cut})"
    return ("(SELECT struct_pack(scheme := sch, authority := auth, "
            "path := CASE WHEN starts_with(rest, '//') THEN substring(rest, length(auth) + 3) ELSE rest END, "
            f"query := substring(nf, length(nq) + 1), fragment := substring(u, length(nf) + 1)) FROM ({cut}))")


def sql_url_part(u: str, part: str) -> str:
    return f"{_url(u)}.{part}"


def _without_dots(p: str, relative: bool) -> str:
    segs = f"string_split({p}, '/')"
    if relative:
        segs = _let(segs, "s7", "CASE WHEN len(s7) >= 2 THEN list_concat([s7[1]], "
                    "list_filter(s7[2:len(s7)-1], lambda s: s <> ''), [s7[-1]]) ELSE s7 END")
    fold = ("list_reduce(s8, lambda acc, s: CASE WHEN s = '..' THEN acc[1:greatest(len(acc) - 1, 0)] "
            "WHEN s = '.' THEN acc ELSE list_append(acc, s) END, []::VARCHAR[])")
    fold = f"array_to_string(CASE WHEN s8[-1] IN ('.', '..') THEN list_append({fold}, '') ELSE {fold} END, '/')"
    out = "CASE WHEN o8 = '' THEN '/' WHEN NOT starts_with(o8, '/') THEN '/' || o8 ELSE o8 END"
    return _let(segs, "s8", _let(fold, "o8", out))


def sql_trimmed(h: str) -> str:
    """A reference without blanks and controls around it and breaks inside."""
    blank = " || ".join(f"chr({c})" for c in range(1, 33))
    h = f"trim({h}, {blank})"
    for c in (9, 10, 13):
        h = f"replace({h}, chr({c}), '')"
    return h


def sql_resolve(b: str, h: str) -> str:
    """``h`` must have been through ``sql_trimmed``."""
    origin = "b9.scheme || '://' || b9.authority"
    folder = "left(b9.path, length(b9.path) - length(split_part(b9.path, '/', -1)))"
    folder = f"(CASE WHEN {folder} = '' AND b9.authority <> '' THEN '/' ELSE {folder} END)"
    whole = (f"CASE WHEN h9.scheme <> '' THEN (CASE WHEN lower(h9.scheme) = b9.scheme "
             f"THEN lower(h9.scheme) || substring({h}, length(h9.scheme) + 1) ELSE {h} END) "
             f"WHEN starts_with({h}, '//') THEN b9.scheme || ':' || {h} "
             f"WHEN h9.path = '' THEN {origin} || b9.path || CASE WHEN h9.query <> '' THEN h9.query ELSE b9.query END || h9.fragment "
             f"WHEN starts_with(h9.path, '/') THEN {origin} || {_without_dots('h9.path', False)} || h9.query || h9.fragment "
             f"ELSE {origin} || {_without_dots('(' + folder + ' || h9.path)', True)} || h9.query || h9.fragment END")
    return _let(_url(b), "b9", _let(_url(h), "h9", whole))


def sql_drop_fragment(u: str) -> str:
    return f"split_part({u}, '#', 1)"


def sql_article_like(u: str) -> str:
    digits = " OR ".join(f"contains(p9, '{d}')" for d in range(10))
    return _let(sql_url_part(u, "path"), "p9", f"({digits} OR len(list_filter(string_split(p9, '/'), lambda s: s <> '')) >= 2)")
