"""URL parsing, resolution and link heuristics as column expressions (H4-H7).

URLs are split with the RFC 3986 appendix-B expression (it never fails,
unlike ``parse_url`` which raises in ANSI mode on malformed input). Relative
references resolve like the standard library's ``urljoin``: scheme-bearing
hrefs stay as they are, ``//`` takes the base scheme, ``/`` the base origin,
``?`` the base path, anything else the base directory; dot segments are then
folded with a stack (``aggregate``), and empty inner segments dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URL_PARTS = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?"
_GROUP = {"scheme": 2, "authority": 4, "path": 5, "query": 6, "fragment": 7}
_HAS_AUTHORITY = r"^([^:/?#]+:)?//"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_part(u, part: str) -> Column:
    """scheme, authority (host[:port]), path, query (with '?'), fragment."""
    return F.regexp_extract(_col(u), URL_PARTS, _GROUP[part])


def authority(u) -> Column:
    return url_part(u, "authority")


def domain(u) -> Column:
    """Authority with every ``www.`` removed (as the original does)."""
    return F.replace(authority(u), F.lit("www."), F.lit(""))


def drop_fragment(u) -> Column:
    return F.regexp_replace(_col(u), "#.*$", "")


def _remove_dots(path: Column, relative: bool) -> Column:
    """Fold ``.``/``..`` segments with a stack; empty inner segments are
    dropped for merged relative paths only; a path losing its root gets it
    back (a URL with an authority always has an absolute path)."""
    segs = F.split(path, "/")
    if relative:
        n = F.size(segs)
        inner = F.filter(F.slice(segs, 2, F.greatest(n - 2, F.lit(0))), lambda s: s != "")
        segs = F.when(n >= 2, F.concat(F.array(segs[0]), inner, F.array(F.element_at(segs, -1)))) \
                .otherwise(segs)
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        segs, empty,
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                        .when(s == ".", acc)
                        .otherwise(F.concat(acc, F.array(s))))
    last = F.element_at(segs, -1)
    folded = F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    out = F.array_join(folded, "/")
    return F.when(out == "", F.lit("/")).when(~out.startswith("/"), F.concat(F.lit("/"), out)) \
            .otherwise(out)


def resolve(base, href) -> Column:
    """Absolute URL of ``href`` relative to ``base`` (fragment kept).

    Blanks and control characters around a reference, and tabs and line breaks
    inside it, are no part of it.
    """
    b = _col(base)
    h = F.regexp_replace(F.regexp_replace(_col(href), r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\r\n]", "")
    b_scheme, b_auth = url_part(b, "scheme"), url_part(b, "authority")
    b_path, b_query = url_part(b, "path"), url_part(b, "query")
    h_path, h_query, h_frag = url_part(h, "path"), url_part(h, "query"), url_part(h, "fragment")
    origin = F.concat(b_scheme, F.lit("://"), b_auth)
    base_dir = F.regexp_replace(b_path, "[^/]*$", "")
    base_dir = F.when((base_dir == "") & (b_auth != ""), F.lit("/")).otherwise(base_dir)
    h_scheme = url_part(h, "scheme")
    same = F.concat(F.lower(h_scheme), h.substr(F.length(h_scheme) + 1, F.length(h)))
    return (F.when(h_scheme != "", F.when(F.lower(h_scheme) == b_scheme, same).otherwise(h))
            .when(h.rlike(_HAS_AUTHORITY), F.concat(b_scheme, F.lit(":"), h))
            .when(h_path == "", F.concat(origin, b_path,
                                         F.when(h_query != "", h_query).otherwise(b_query), h_frag))
            .when(h_path.startswith("/"), F.concat(origin, _remove_dots(h_path, False), h_query, h_frag))
            .otherwise(F.concat(origin, _remove_dots(F.concat(base_dir, h_path), True), h_query, h_frag)))


def is_web(u) -> Column:
    return F.lower(url_part(u, "scheme")).isin("http", "https")


def article_like(u) -> Column:
    """Keep iff pagination, any digit, or at least two non-empty path segments.

    The original's comment says the opposite; its code keeps these (Q3).
    """
    p = url_part(u, "path")
    p = F.when(p == "", F.lit("/")).otherwise(p)
    depth = F.size(F.filter(F.split(p, "/"), lambda s: s != ""))
    return p.rlike(r"/page/\d+/?$") | p.rlike(r"\d") | (depth >= 2)
