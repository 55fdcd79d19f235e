"""Registered page, link, graph and knowledge-graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import fixed
from tessera.functions import text as tx
from tessera.functions import urls as ux
from tessera.operators import dedup, graph, links
from tessera.plans.registry import register, sql_str
from tessera.plans.sqltext import sql_word_count
from tessera.plans.sqlweb import (sql_article_like, sql_container_kind, sql_drop_fragment,
                                  sql_hrefs, sql_keep_href, sql_main_container, sql_page_text,
                                  sql_resolve, sql_strip_scripts, sql_trimmed, sql_url_part)
from tessera.session import stored
from tessera.sources.tables import read_table


def _pages(spark, sf, cols=("page_id", "url", "html")):
    return read_table(spark, sf, "pages", list(cols))


# --- H1 ----------------------------------------------------------------------
@register("html_main_container",
          f"SELECT page_id, {sql_container_kind('h')} AS container, {sql_main_container('h')} AS inner "
          f"FROM (SELECT page_id, {sql_strip_scripts('html')} AS h FROM pages)")
def html_main_container(spark, sf):
    return links.main_container(_pages(spark, sf, ("page_id", "html")))


# --- H2 + X1 -----------------------------------------------------------------
@register("html_block_text",
          f"SELECT page_id, {sql_page_text('html')} AS page_text FROM pages")
def html_block_text(spark, sf):
    return links.page_texts(_pages(spark, sf, ("page_id", "html")), ["page_id"])


# --- F2 + X7 over extracted page text ------------------------------------------
@register("page_direct_terms",
          f"SELECT page_id, {sql_word_count('t')} AS direct_terms FROM "
          f"(SELECT page_id, {sql_page_text('html')} AS t FROM pages) WHERE trim(t) <> ''")
def page_direct_terms(spark, sf):
    t = links.page_texts(_pages(spark, sf, ("page_id", "html")), ["page_id"])
    return (t.filter(tx.nonblank("page_text"))
            .select("page_id", tx.word_count("page_text").alias("direct_terms")))


# --- H3 ----------------------------------------------------------------------
_LINKS_SQL = (f"SELECT page_id, url, CAST(pos AS INTEGER) AS pos, href FROM (SELECT page_id, url, "
              f"unnest(range(len(l))) AS pos, unnest(l) AS href FROM "
              f"(SELECT page_id, url, {sql_hrefs('html')} AS l FROM pages)) "
              f"WHERE {sql_keep_href('href')}")


@register("link_extract", f"SELECT page_id, pos, href FROM ({_LINKS_SQL})")
def link_extract(spark, sf):
    return links.extract_links(_pages(spark, sf)).select("page_id", "pos", "href")


# --- H4 ----------------------------------------------------------------------
_RESOLVED_SQL = (f"SELECT page_id, url, pos, {sql_drop_fragment(sql_resolve('url', 'h'))} AS dst "
                 f"FROM (SELECT page_id, url, pos, {sql_trimmed('href')} AS h FROM ({_LINKS_SQL}))")


@register("link_resolve", f"SELECT page_id, pos, dst FROM ({_RESOLVED_SQL})")
def link_resolve(spark, sf):
    return links.resolve_links(links.extract_links(_pages(spark, sf))).select("page_id", "pos", "dst")


# --- H5 ----------------------------------------------------------------------
@register("link_internal",
          f"SELECT page_id, pos, dst FROM ({_RESOLVED_SQL}) "
          f"WHERE lower({sql_url_part('dst', 'scheme')}) IN ('http', 'https') "
          f"AND {sql_url_part('dst', 'authority')} = {sql_url_part('url', 'authority')}")
def link_internal(spark, sf):
    r = links.resolve_links(links.extract_links(_pages(spark, sf)))
    return links.internal_links(r).select("page_id", "pos", "dst")


# --- H6 ----------------------------------------------------------------------
@register("url_article_heuristic",
          f"SELECT page_id, {sql_article_like('url')} AS is_article FROM pages")
def url_article_heuristic(spark, sf):
    return _pages(spark, sf, ("page_id", "url")).select(
        "page_id", ux.article_like("url").alias("is_article"))


# --- H7 ----------------------------------------------------------------------
@register("pages_per_domain",
          f"SELECT replace({sql_url_part('url', 'authority')}, 'www.', '') AS domain, "
          "count(*) AS pages FROM pages GROUP BY 1")
def pages_per_domain(spark, sf):
    return (_pages(spark, sf, ("url",)).groupBy(ux.domain("url").alias("domain"))
            .agg(F.count(F.lit(1)).alias("pages")))


# --- H8 ----------------------------------------------------------------------
# Default rules applied to every host (host '*'), in listed order.
DEFAULT_RULES = [("*", 0, True, "/en/1"), ("*", 1, False, "/en/"), ("*", 2, False, "/de/")]


def _rules_sql() -> str:
    vals = ", ".join(f"({sql_str(h)}, {p}, {str(a).upper()}, {sql_str(x)})" for h, p, a, x in DEFAULT_RULES)
    path = sql_url_part("url", "path")
    fullpath = f"(CASE WHEN {path} = '' THEN '/' ELSE {path} END) || {sql_url_part('url', 'query')}"
    return (f"WITH r(host, rule_pos, allow, prefix) AS (VALUES {vals}), "
            f"u AS (SELECT page_id, {fullpath} AS p FROM pages) "
            "SELECT u.page_id, coalesce(arg_min(r.allow, r.rule_pos), TRUE) AS allowed "
            "FROM u LEFT JOIN r ON starts_with(u.p, r.prefix) GROUP BY u.page_id")


@register("url_rules_filter", _rules_sql())
def url_rules_filter(spark, sf):
    dflt = [(pos, allow, prefix) for _, pos, allow, prefix in DEFAULT_RULES]
    out = links.apply_rules(_pages(spark, sf, ("page_id", "url")), None, default_rules=dflt)
    return out.select("page_id", "allowed")


# --- H10 ---------------------------------------------------------------------
@register("top_n_per_host",
          f"SELECT page_id, host, rank FROM (SELECT page_id, {sql_url_part('url', 'authority')} AS host, "
          f"CAST(row_number() OVER (PARTITION BY {sql_url_part('url', 'authority')} ORDER BY page_id) AS INTEGER) AS rank "
          f"FROM pages) WHERE rank <= {fixed.CRAWL_MAX_PAGES}")
def top_n_per_host(spark, sf):
    p = _pages(spark, sf, ("page_id", "url")).select("page_id", ux.authority("url").alias("host"))
    return links.page_budget(p, "host", ["page_id"]).select("page_id", "host", "rank")


# --- H9 / E18 ----------------------------------------------------------------
_EDGES_SQL = """
  one AS (SELECT 'n:' || n_nationkey AS src, 'r:' || n_regionkey AS dst FROM nation
          UNION ALL SELECT 's:' || s_suppkey, 'n:' || s_nationkey FROM supplier
          UNION ALL SELECT 'c:' || c_custkey, 'n:' || c_nationkey FROM customer),
  e AS (SELECT src, dst FROM one UNION ALL SELECT dst, src FROM one)"""


def _bfs_sql(seed_sql: str, depth: int) -> str:
    return (f"WITH RECURSIVE {_EDGES_SQL.strip()}, "
            f"b(node, depth) AS (SELECT node, 0 FROM ({seed_sql}) "
            f"UNION SELECT e.dst, b.depth + 1 FROM b JOIN e ON e.src = b.node WHERE b.depth < {depth}) "
            "SELECT node, min(depth) AS depth FROM b GROUP BY node")


def _edges(spark, sf):
    return graph.star_schema_edges(read_table(spark, sf, "region"), read_table(spark, sf, "nation"),
                                   read_table(spark, sf, "supplier"), read_table(spark, sf, "customer"))


@register("bfs_depth", _bfs_sql("SELECT 'r:' || r_regionkey AS node FROM region WHERE r_regionkey = 0",
                                fixed.CRAWL_MAX_DEPTH))
def bfs_depth(spark, sf):
    seeds = read_table(spark, sf, "region", ["r_regionkey"]).filter(F.col("r_regionkey") == 0) \
        .select(F.concat(F.lit("r:"), "r_regionkey").alias("node"))
    return graph.bfs_depth(_edges(spark, sf), seeds, fixed.CRAWL_MAX_DEPTH)


@register("kg_reach", _bfs_sql("SELECT 's:' || s_suppkey AS node FROM supplier WHERE s_suppkey = 1", 4))
def kg_reach(spark, sf):
    seeds = read_table(spark, sf, "supplier", ["s_suppkey"]).filter(F.col("s_suppkey") == 1) \
        .select(F.concat(F.lit("s:"), "s_suppkey").alias("node"))
    return graph.bfs_depth(_edges(spark, sf), seeds, 4)


# --- E16, E17, E19 -----------------------------------------------------------
_TRIPLES_SQL = """
SELECT 'r:' || r_regionkey AS subject, 'name' AS predicate, r_name AS object FROM region
UNION ALL SELECT 'n:' || n_nationkey, 'name', n_name FROM nation
UNION ALL SELECT 'n:' || n_nationkey, 'in_region', 'r:' || n_regionkey FROM nation
UNION ALL SELECT 's:' || s_suppkey, 'name', s_name FROM supplier
UNION ALL SELECT 's:' || s_suppkey, 'in_nation', 'n:' || s_nationkey FROM supplier
UNION ALL SELECT 'c:' || c_custkey, 'name', c_name FROM customer
UNION ALL SELECT 'c:' || c_custkey, 'in_nation', 'n:' || c_nationkey FROM customer
UNION ALL SELECT 'c:' || c_custkey, 'segment', c_mktsegment FROM customer"""


def _triples(spark, sf):
    return graph.kg_triples(read_table(spark, sf, "region"), read_table(spark, sf, "nation"),
                            read_table(spark, sf, "supplier"), read_table(spark, sf, "customer"))


@register("kg_triples", _TRIPLES_SQL)
def kg_triples(spark, sf):
    return _triples(spark, sf)


@register("kg_two_hop",
          f"WITH t AS ({_TRIPLES_SQL}) SELECT x.subject AS a, x.object AS b, y.object AS c "
          "FROM t x JOIN t y ON x.object = y.subject "
          "WHERE x.predicate = 'in_nation' AND y.predicate = 'in_region'")
def kg_two_hop(spark, sf):
    return graph.kg_two_hop(_triples(spark, sf), "in_nation", "in_region")


@register("kg_degree",
          f"WITH t AS ({_TRIPLES_SQL}), o AS (SELECT subject AS entity, count(*) AS out_degree "
          "FROM t GROUP BY 1), i AS (SELECT object AS entity, count(*) AS in_degree FROM t "
          "WHERE regexp_matches(object, '^[rnsc]:[0-9]+$') GROUP BY 1) "
          "SELECT entity, coalesce(out_degree, 0) AS out_degree, coalesce(in_degree, 0) AS in_degree "
          "FROM o FULL JOIN i USING (entity)")
def kg_degree(spark, sf):
    return graph.kg_degree(_triples(spark, sf))



# --- Crawl cycle (F2, F1, X6/D1, H7, H10, X7 composed) ------------------------
# The driver data holds no Greek, and the crawl cleaner keeps only ASCII and
# Greek letters: the script filter runs with capital ASCII letters as the
# stand-in class (same thresholds).
CRAWL_CLASS = "[A-Z]"


def _crawl_sql() -> str:
    from tessera.plans.text import _script_sql
    cond = _script_sql(CRAWL_CLASS).split(" WHERE ", 1)[1].replace("text", "t")
    dom = f"replace({sql_url_part('url', 'authority')}, 'www.', '')"
    return (f"WITH s AS (SELECT page_id, url, t, md5(t) AS h FROM (SELECT page_id, url, "
            f"{sql_page_text('html')} AS t FROM pages) WHERE trim(t) <> '' AND ({cond})), "
            "k AS (SELECT min(page_id) AS page_id FROM s GROUP BY h), "
            f"b AS (SELECT page_id, {dom} AS domain, t, CAST(row_number() OVER (PARTITION BY {dom} "
            "ORDER BY page_id) AS INTEGER) AS rank FROM s JOIN k USING (page_id)) "
            f"SELECT page_id, domain, rank, {sql_word_count('t')} AS direct_terms FROM b "
            f"WHERE rank <= {fixed.CRAWL_MAX_PAGES}")


@register("crawl_saved_pages", _crawl_sql())
def crawl_saved_pages(spark, sf):
    """One crawl cycle over landed pages: main text, non-blank, script
    filter, first copy of each content hash, 50 pages per domain in id
    order, word-count metric."""
    ok = _readable(spark, sf).drop("text")
    first = dedup.dedup_first(ok, "page_id", "content_hash", carry=True)
    kept = links.page_budget(first, "domain", ["page_id"])
    return kept.select("page_id", "domain", "rank", "direct_terms")


def _readable(spark, sf):
    """Pages with text that pass the script filter: narrow columns, and the
    leading sample of the text for language detection."""
    t = links.page_texts(_pages(spark, sf), ["page_id", "url"])
    t = t.filter(tx.nonblank("page_text") & tx.script_ratio_ok("page_text", CRAWL_CLASS))
    return t.select("page_id", ux.domain("url").alias("domain"), tx.word_count("page_text").alias("direct_terms"),
                    tx.content_hash("page_text").alias("content_hash"),
                    F.substring("page_text", 1, fixed.LANG_SAMPLE_CHARS).alias("text"))


# Language confirmation (F3) inside the crawl cycle: trigram profiles are
# trained on ``documents`` (which carry a language label) and the cleaned
# page text must be detected as the target language.
CRAWL_LANG = "en"


def _crawl_lang_sql() -> str:
    from tessera.plans.relational import _lang_sql
    from tessera.plans.text import _script_sql
    cond = _script_sql(CRAWL_CLASS).split(" WHERE ", 1)[1].replace("text", "t")
    dom = f"replace({sql_url_part('url', 'authority')}, 'www.', '')"
    base = (f"SELECT page_id, url, t FROM (SELECT page_id, url, {sql_page_text('html')} AS t FROM pages) "
            f"WHERE trim(t) <> '' AND ({cond})")
    lang = _lang_sql(f"SELECT page_id, t AS text FROM ({base})", "page_id")
    return (f"WITH s AS ({base}), l AS ({lang}), "
            f"e AS (SELECT s.*, md5(t) AS h FROM s JOIN l USING (page_id) WHERE l.pred_lang = '{CRAWL_LANG}'), "
            "k AS (SELECT min(page_id) AS page_id FROM e GROUP BY h), "
            f"b AS (SELECT page_id, {dom} AS domain, t, CAST(row_number() OVER (PARTITION BY {dom} "
            "ORDER BY page_id) AS INTEGER) AS rank FROM e JOIN k USING (page_id)) "
            f"SELECT page_id, domain, rank, {sql_word_count('t')} AS direct_terms FROM b "
            f"WHERE rank <= {fixed.CRAWL_MAX_PAGES}")


@register("crawl_cycle_lang", _crawl_lang_sql())
def crawl_cycle_lang(spark, sf):
    """The crawl cycle with the language confirmation step: non-blank,
    script filter, detected language == target, first copy per hash,
    50 pages per domain."""
    from tessera.operators import classify as cl
    ok = stored(_readable(spark, sf), "readable")
    docs = read_table(spark, sf, "documents", ["doc_id", "text", "lang"])
    pred = cl.language_scores(ok.select("page_id", "text"), "page_id", "text", cl.language_profiles(docs, "text", "lang"))
    kept = ok.drop("text").join(pred.filter(F.col("pred_lang") == CRAWL_LANG), "page_id", "left_semi")
    first = dedup.dedup_first(kept, "page_id", "content_hash", carry=True)
    budget = links.page_budget(first, "domain", ["page_id"])
    return budget.select("page_id", "domain", "rank", "direct_terms")


# --- the whole cycle: rules by agent, seen content, order by depth, links ----------
AGENT = "TesseraCrawler/1.0"
CYCLE_BUDGET = 2
#: (agent, rule_pos, allow, prefix) of hosts that begin with "m.", and of all others.
MOBILE_RULES = [("tesseracrawler", 0, True, "/en/1"), ("tesseracrawler", 1, False, "/en/"), ("*", 2, False, "/")]
OTHER_RULES = [("*", 0, False, "/de/"), ("another", 1, False, "/")]


def _cycle_sql() -> str:
    from tessera.plans.text import _script_sql
    cond = _script_sql(CRAWL_CLASS).split(" WHERE ", 1)[1].replace("text", "t")
    path = f"(CASE WHEN {sql_url_part('url', 'path')} = '' THEN '/' ELSE {sql_url_part('url', 'path')} END || {sql_url_part('url', 'query')})"
    allowed = ("CASE WHEN starts_with(host, 'm.') THEN starts_with(path, '/en/1') OR NOT starts_with(path, '/en/') "
               "ELSE NOT starts_with(path, '/de/') END")
    base = (f"SELECT *, CASE WHEN page_id = min(page_id) OVER (PARTITION BY host) THEN 0 ELSE 1 END AS depth FROM "
            f"(SELECT page_id, url, html, {sql_url_part('url', 'authority')} AS host, {path} AS path FROM pages)")
    links_ = (f"SELECT {sql_drop_fragment(sql_resolve('url', 'h'))} AS url, depth + 1 AS depth, host FROM (SELECT url, depth, host, "
              f"{sql_trimmed('href')} AS h FROM (SELECT url, depth, host, unnest({sql_hrefs('html')}) AS href FROM giving) WHERE {sql_keep_href('href')})")
    return (f"WITH base AS ({base}), near AS (SELECT * FROM base WHERE {allowed}), "
            f"s AS (SELECT page_id, url, depth, replace(host, 'www.', '') AS domain, {sql_page_text('html')} AS t FROM near), "
            f"n AS (SELECT *, md5(t) AS h FROM s WHERE trim(t) <> '' AND ({cond}) AND md5(t) NOT IN "
            f"(SELECT md5({sql_page_text('html')}) FROM pages WHERE starts_with(url, 'https:'))), "
            "f AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY h ORDER BY depth, page_id) = 1), "
            # pages in another script give no links, blank ones do
            f"giving AS (SELECT near.* FROM near JOIN s USING (page_id) WHERE trim(t) = '' OR ({cond})), "
            "saved AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY depth, page_id) AS rank FROM f), "
            f"found AS (SELECT url, depth, host, {path} AS path, {sql_url_part('url', 'scheme')} AS scheme, {sql_url_part('url', 'authority')} AS auth FROM ({links_})), "
            f"front AS (SELECT url, min(depth) AS depth FROM found WHERE auth = host AND lower(scheme) IN ('http', 'https') AND {sql_article_like('url')} "
            f"AND {allowed} AND url NOT IN (SELECT url FROM pages) GROUP BY url) "
            f"SELECT 'saved' AS kind, page_id, url, CAST(depth AS INTEGER) AS depth, CAST(rank AS INTEGER) AS rank, {sql_word_count('t')} AS direct_terms "
            f"FROM saved WHERE rank <= {CYCLE_BUDGET} "
            "UNION ALL SELECT 'queued', NULL, url, CAST(depth AS INTEGER), NULL, NULL FROM front")


@register("crawl_cycle_full", _cycle_sql())
def crawl_cycle_full(spark, sf):
    """A crawl cycle as the original runs it, after a cycle over the https pages:
    the first page of a host is its seed, the others were found from it."""
    pages = _pages(spark, sf).withColumn("host", ux.authority("url"))
    # the seeds from ids and hosts alone: one row per host meets the pages, which stay where they are
    seeds = _pages(spark, sf, ("page_id", "url")).groupBy(ux.authority("url").alias("host")).agg(F.min("page_id").alias("page_id"))
    pages = pages.join(seeds.select("page_id", F.lit(0).alias("depth")), "page_id", "left").withColumn("depth", F.coalesce("depth", F.lit(1)))
    hosts = seeds.select("host")

    def of(rules):
        return F.array(*(F.struct(F.lit(a).alias("agent"), F.lit(p).alias("rule_pos"), F.lit(w).alias("allow"), F.lit(x).alias("prefix"))
                         for a, p, w, x in rules))

    rules = hosts.select("host", F.inline(F.when(F.col("host").startswith("m."), of(MOBILE_RULES)).otherwise(of(OTHER_RULES))))
    earlier = links.page_texts(_pages(spark, sf).filter(F.col("url").startswith("https:")), ["page_id"])
    seen = earlier.select(tx.content_hash("page_text").alias("content_hash"))
    saved, frontier = links.crawl_cycle(pages.drop("host"), rules, AGENT, seen, CRAWL_CLASS, CYCLE_BUDGET)
    queued = frontier.select(F.lit("queued").alias("kind"), F.lit(None).cast("long").alias("page_id"), "url", "depth",
                             F.lit(None).cast("int").alias("rank"), F.lit(None).cast("int").alias("direct_terms"))
    return saved.select(F.lit("saved").alias("kind"), "page_id", "url", "depth", "rank", "direct_terms").unionByName(queued)
