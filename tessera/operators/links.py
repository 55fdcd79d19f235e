"""Whole-corpus page and link operators.

Each function stages its expensive expressions in their own projection so a
regex pass runs once per row, not once per reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import fixed
from tessera.functions import html as hx
from tessera.functions import text as tx
from tessera.functions import urls as ux
from tessera.operators.frames import computed_once


def with_stripped_html(pages: DataFrame, keep: list[str]) -> DataFrame:
    return pages.select(*keep, hx.strip_scripts("html").alias("_h"))


def main_container(pages: DataFrame) -> DataFrame:
    """(page_id, container, inner) - H1."""
    h = with_stripped_html(pages, ["page_id"])
    return h.select("page_id", hx.container_kind("_h").alias("container"),
                    hx.main_container("_h").alias("inner"))


def page_texts(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(keep..., page_text) with page_text = cleaned block text (H1+H2+X1)."""
    keep = keep or ["page_id", "url"]
    h = with_stripped_html(pages, keep)
    inner = h.select(*keep, hx.main_container("_h").alias("_inner"))
    return computed_once(inner.select(*keep, tx.clean_text(
        F.array_join(hx.text_blocks("_inner"), "\n")).alias("page_text")))


def extract_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, pos, href) for every kept anchor (H3)."""
    h = with_stripped_html(pages, ["page_id", "url"])
    raw = h.select("page_id", "url", F.posexplode(hx.hrefs("_h")).alias("pos", "href"))
    return raw.filter(hx.keep_href("href"))


def resolve_links(links: DataFrame) -> DataFrame:
    """Adds ``dst``: absolute URL, fragment dropped (H4)."""
    return computed_once(links.withColumn("dst", ux.drop_fragment(ux.resolve("url", "href"))))


def internal_links(resolved: DataFrame) -> DataFrame:
    """http(s) links whose authority equals the source page's (H5)."""
    return resolved.filter(ux.is_web("dst") & (ux.authority("dst") == ux.authority("url")))


def page_budget(df: DataFrame, host_col: str, order_cols: list[str],
                n: int = fixed.CRAWL_MAX_PAGES) -> DataFrame:
    """First ``n`` rows per host in the given order.

    ``row_number() <= n`` lets Catalyst insert a per-partition group limit
    before the shuffle, so a host holding a third of all pages sends at most
    ``n`` rows per map task.
    """
    w = Window.partitionBy(host_col).orderBy(*order_cols)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


RULE_SCHEMA = T.StructType([
    T.StructField("host", T.StringType(), False),
    T.StructField("rule_pos", T.IntegerType(), False),
    T.StructField("allow", T.BooleanType(), False),
    T.StructField("prefix", T.StringType(), False),
])


def apply_rules(urls: DataFrame, rules: DataFrame | None, url_col: str = "url",
                default_rules: list[tuple[int, bool, str]] | None = None,
                small_rules: bool = False) -> DataFrame:
    """Adds ``allowed``.

    ``rules`` rows are ``(host, rule_pos, allow, prefix)``: each host's own
    rules; ``default_rules`` ``(rule_pos, allow, prefix)`` apply to every
    host after its own. The first listed rule whose prefix starts the URL
    path (with query) wins; no match allows.

    A host's rules are one small robots file, so they are grouped into a
    sorted array per host; each URL picks up its host's array with an
    equi-join on host (``small_rules=True`` broadcasts a rule table the
    caller knows is small; otherwise AQE decides from its measured size and
    splits a hot host's partition)
    and finds the first matching prefix with array functions. No shuffle of
    the URL table, no regrouping by URL.
    """
    path = ux.url_part(url_col, "path")
    u = urls.withColumn("_host", ux.authority(url_col)).withColumn(
        "_path", F.concat(F.when(path == "", F.lit("/")).otherwise(path), ux.url_part(url_col, "query")))
    rule_t = "array<struct<rule_pos:int,allow:boolean,prefix:string>>"
    if rules is not None:
        per_host = rules.groupBy(F.col("host").alias("_host")).agg(
            F.array_sort(F.collect_list(F.struct("rule_pos", "allow", "prefix"))).alias("_rules"))
        per_host = F.broadcast(per_host) if small_rules else per_host
        u = u.join(per_host, "_host", "left")
    else:
        u = u.withColumn("_rules", F.lit(None).cast(rule_t))
    dflt = F.array(*[F.struct(F.lit(p).cast("int").alias("rule_pos"), F.lit(a).alias("allow"),
                              F.lit(x).alias("prefix"))
                     for p, a, x in sorted(default_rules or [])]).cast(rule_t)
    own_hit = F.filter(F.coalesce("_rules", F.array().cast(rule_t)),
                       lambda r: F.col("_path").startswith(r["prefix"]))
    dflt_hit = F.filter(dflt, lambda r: F.col("_path").startswith(r["prefix"]))
    allowed = F.coalesce(F.try_element_at(own_hit, F.lit(1))["allow"],
                         F.try_element_at(dflt_hit, F.lit(1))["allow"],
                         F.lit(True))
    return u.withColumn("allowed", allowed).drop("_host", "_path", "_rules")


def rules_for_agent(rules: DataFrame, agent: str) -> DataFrame:
    """The rules (host, agent, rule_pos, allow, prefix) that bind ``agent``: a
    host's group for a name that is part of the agent's, else its ``*`` group."""
    name = agent.split("/")[0].lower()
    own = (F.col("agent") != "*") & F.lit(name).contains(F.lower("agent"))
    marked = rules.withColumn("_own", F.coalesce(own, F.lit(False)))
    has = marked.groupBy("host").agg(F.bool_or("_own").alias("_has"))
    return (marked.join(has, "host").filter((F.col("_own") & F.col("_has")) | (~F.col("_has") & (F.col("agent") == "*")))
            .select("host", "rule_pos", "allow", "prefix"))


def crawl_cycle(pages: DataFrame, rules: DataFrame, agent: str, seen: DataFrame | None = None,
                letter_class: str = fixed.GREEK_LETTER_CLASS, per_domain: int = fixed.CRAWL_MAX_PAGES,
                max_depth: int = fixed.CRAWL_MAX_DEPTH, harvest_links: bool = False) -> tuple[DataFrame, DataFrame]:
    """One crawl cycle over landed pages (page_id, url, html, depth): the pages
    to save and the links to fetch next.

    In the original's order: pages too deep or forbidden by robots rules go;
    text that is blank or in another script goes; content seen in earlier cycles
    (``seen``: content_hash) or on an earlier page in (depth, page_id) order
    goes; of the rest each domain saves its first ``per_domain``. Links are the
    internal ones that look like articles, are allowed, and were not landed,
    each at its smallest depth. As in the original, blank pages give links and
    pages in another script give none; ``harvest_links`` takes them of all pages.

    Whole texts stay where they are read: what moves is narrow.
    """
    bound = rules_for_agent(rules, agent)
    near = apply_rules(pages.filter(F.col("depth") <= max_depth), bound).filter("allowed").drop("allowed")
    read = page_texts(near, ["page_id", "url", "depth"]).select(
        "page_id", "url", "depth", ux.domain("url").alias("domain"), tx.nonblank("page_text").alias("filled"),
        tx.script_ratio_ok("page_text", letter_class).alias("script"), tx.word_count("page_text").alias("direct_terms"),
        tx.content_hash("page_text").alias("content_hash"))
    new = read.filter("filled and script")
    if seen is not None:
        new = new.join(seen.select("content_hash").distinct(), "content_hash", "left_anti")
    row = F.struct("page_id", "url", "domain", "depth", "direct_terms")
    first = new.groupBy("content_hash").agg(F.min_by(row, F.struct("depth", "page_id")).alias("r")).select("r.*", "content_hash")
    saved = page_budget(first, "domain", ["depth", "page_id"], per_domain)

    source = near
    if not harvest_links:
        source = near.join(read.filter("script or not filled").select("page_id"), "page_id", "left_semi")
    depth = source.select("page_id", (F.col("depth") + 1).alias("depth"))
    found = internal_links(resolve_links(extract_links(source))).filter(ux.article_like("dst")).join(depth, "page_id")
    found = found.filter(F.col("depth") <= max_depth).groupBy("dst").agg(F.min("depth").alias("depth"))
    found = apply_rules(found, bound, "dst").filter("allowed").select(F.col("dst").alias("url"), "depth")
    frontier = found.join(pages.select("url").distinct(), "url", "left_anti")
    return saved, frontier
