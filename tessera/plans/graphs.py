"""Registered queries over link and knowledge graphs: the crawl by links (H9),
patterns (E17), rules with witnesses (E18).

No link of the stored pages leads to a stored page, so the site graph gives each
link a target on its own host: link p of the host's page i leads to its page
(3 i + p + 1) mod n.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import urls as ux
from tessera.operators import classify as cl
from tessera.operators import crawl, graph, links, series
from tessera.operators.reasoning import Rule, infer
from tessera.plans.registry import register
from tessera.plans.relational import _lang_sql
from tessera.plans.sqlweb import sql_hrefs, sql_keep_href, sql_page_text, sql_url_part
from tessera.plans.text import _script_sql
from tessera.plans.web import AGENT, CRAWL_CLASS, CRAWL_LANG, MOBILE_RULES, OTHER_RULES, _pages, _triples, _TRIPLES_SQL
from tessera.session import stored
from tessera.sources.tables import read_table

CRAWL_BUDGET, CRAWL_DEPTH = 3, 2


# --- the site graph -----------------------------------------------------------
def site_graph(spark, sf):
    """(src, pos, dst) and the seeds (page_id, pos): the first page of every host."""
    hosts = _pages(spark, sf, ("page_id", "url")).select("page_id", ux.authority("url").alias("host"))
    numbered = stored(series.rank_within(hosts, ["page_id"], "number", ["host"]).withColumn("number", F.col("number") - 1), "site-pages")
    sizes = numbered.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    hrefs = links.extract_links(_pages(spark, sf)).select("page_id", "pos")
    out = hrefs.join(numbered, "page_id").join(sizes, "host")
    out = out.select(F.col("page_id").alias("src"), "pos", "host", ((3 * F.col("number") + F.col("pos") + 1) % F.col("n")).alias("number"))
    target = numbered.select("host", "number", F.col("page_id").alias("dst"))
    return stored(out.join(target, ["host", "number"]).select("src", "pos", "dst"), "site-links"), \
        numbered.where("number = 0").select("page_id", F.lit(0).alias("pos"))


_SITE_SQL = f"""
hosts AS MATERIALIZED (SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) - 1 AS number,
                       count(*) OVER (PARTITION BY host) AS n
                       FROM (SELECT page_id, {sql_url_part('url', 'authority')} AS host FROM pages)),
hrefs AS (SELECT page_id, pos FROM (SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS href
                                    FROM (SELECT page_id, {sql_hrefs('html')} AS l FROM pages)) WHERE {sql_keep_href('href')}),
site AS MATERIALIZED (SELECT h.page_id AS src, h.pos, t.page_id AS dst FROM hrefs h JOIN hosts s USING (page_id)
                      JOIN hosts t ON t.host = s.host AND t.number = (3 * s.number + h.pos + 1) % s.n)"""


# --- H9 -----------------------------------------------------------------------
def _crawl_sql() -> str:
    cond = _script_sql(CRAWL_CLASS).split(" WHERE ", 1)[1].replace("text", "t")
    path = f"(CASE WHEN {sql_url_part('url', 'path')} = '' THEN '/' ELSE {sql_url_part('url', 'path')} END || {sql_url_part('url', 'query')})"
    allowed = ("CASE WHEN starts_with(host, 'm.') THEN starts_with(path, '/en/1') OR NOT starts_with(path, '/en/') "
               "ELSE NOT starts_with(path, '/de/') END")
    lang = _lang_sql("SELECT page_id, t AS text FROM texts", "page_id")
    ctes = [_SITE_SQL.strip(), f"""
texts AS MATERIALIZED (SELECT page_id, url, {sql_page_text('html')} AS t FROM pages)""", f"""
spoken AS MATERIALIZED ({lang})""", f"""
known AS MATERIALIZED (
  SELECT page_id, host, {allowed} AS allowed, trim(t) <> '' AS filled, ({cond}) AS script,
         coalesce(pred_lang = '{CRAWL_LANG}', FALSE) AS spoken, md5(t) AS h,
         md5(t) IN (SELECT md5(t) FROM texts WHERE starts_with(url, 'https:')) AS old
  FROM (SELECT page_id, url, t, {path} AS path FROM texts) JOIN hosts USING (page_id) LEFT JOIN spoken USING (page_id))""", """
f0 AS (SELECT page_id, [0] AS ord FROM hosts WHERE number = 0)"""]
    before = []
    for d in range(CRAWL_DEPTH + 1):
        saved = " UNION ALL ".join(f"SELECT * FROM s{k}" for k in before) or "SELECT NULL AS host, NULL AS h, NULL AS place WHERE FALSE"
        done = " UNION ALL ".join(f"SELECT host FROM e{k}" for k in before) or "SELECT NULL AS host WHERE FALSE"
        ctes.append(f"""
v{d} AS MATERIALIZED (SELECT * FROM f{d} JOIN known USING (page_id) WHERE allowed AND NOT EXISTS (SELECT 1 FROM ({done}) x WHERE x.host = known.host)),
n{d} AS (SELECT host, h, min(ord) AS ord FROM v{d} WHERE filled AND script AND spoken AND NOT old
         AND NOT EXISTS (SELECT 1 FROM ({saved}) x WHERE x.host = v{d}.host AND x.h = v{d}.h) GROUP BY host, h),
s{d} AS MATERIALIZED (SELECT host, h, ord, row_number() OVER (PARTITION BY host ORDER BY ord)
         + (SELECT count(*) FROM ({saved}) x WHERE x.host = n{d}.host) AS place FROM n{d} QUALIFY place <= {CRAWL_BUDGET}),
e{d} AS MATERIALIZED (SELECT host, ord AS fin FROM s{d} WHERE place = {CRAWL_BUDGET}),
p{d} AS MATERIALIZED (SELECT v.*, s.place FROM v{d} v LEFT JOIN e{d} e USING (host) LEFT JOIN s{d} s ON s.host = v.host AND s.ord = v.ord
         WHERE e.fin IS NULL OR v.ord <= e.fin)""")
        before.append(d)
        if d < CRAWL_DEPTH:
            old = " UNION ALL ".join(f"SELECT page_id FROM f{k}" for k in before)
            ctes.append(f"""
f{d + 1} AS MATERIALIZED (SELECT l.dst AS page_id, min(list_append(p.ord, l.pos::INTEGER)) AS ord FROM p{d} p JOIN site l ON l.src = p.page_id
         WHERE (p.script OR NOT p.filled) AND p.host NOT IN (SELECT host FROM e{d}) AND l.dst NOT IN ({old}) GROUP BY l.dst)""")
    return "WITH " + ",".join(ctes) + " UNION ALL ".join(
        f" SELECT page_id, host, {d} AS depth, place IS NOT NULL AS saved, place::INTEGER AS place FROM p{d}" for d in before)


@register("crawl_by_links", _crawl_sql())
def crawl_by_links(spark, sf):
    """Every page that a crawl of all hosts visits, round by round, after a cycle
    over the https pages; language profiles come from ``documents``."""
    def of(rules):
        return F.array(*(F.struct(F.lit(a).alias("agent"), F.lit(p).alias("rule_pos"), F.lit(w).alias("allow"), F.lit(x).alias("prefix"))
                         for a, p, w, x in rules))

    pages = _pages(spark, sf)
    read = links.page_texts(pages, ["page_id", "url"])
    read = stored(read.select("page_id", "url", ux.authority("url").alias("host"), tx.nonblank("page_text").alias("filled"),
                              tx.script_ratio_ok("page_text", CRAWL_CLASS).alias("script"), tx.content_hash("page_text").alias("content_hash"),
                              cl.lang_sample("page_text").alias("text")), "crawl-read")
    docs = read_table(spark, sf, "documents", ["doc_id", "text", "lang"])
    spoken = cl.language_scores(read.select("page_id", "text"), "page_id", "text", cl.language_profiles(docs, "text", "lang"))
    hosts = read.select("host").distinct()
    rules = hosts.select("host", F.inline(F.when(F.col("host").startswith("m."), of(MOBILE_RULES)).otherwise(of(OTHER_RULES))))
    known = links.apply_rules(read, links.rules_for_agent(rules, AGENT)).join(spoken, "page_id", "left")
    known = known.withColumn("language", F.coalesce(F.col("pred_lang") == CRAWL_LANG, F.lit(False)))
    seen = read.where(F.col("url").startswith("https:")).select("content_hash")
    site, seeds = site_graph(spark, sf)
    return crawl.crawl_links(known, site, seeds, seen, CRAWL_BUDGET, CRAWL_DEPTH)


# --- E17: who buys what from whom ------------------------------------------------
#: Marks of nodes in results; a node's number is 3 x key + the place of its mark.
TRADERS = ("c:", "s:", "p:")


def _trade_edges(spark, sf):
    """(u, v) of numbered nodes: what moves is a third of marked keys as text."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"])
    rows = li.join(read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"]), F.col("l_orderkey") == F.col("o_orderkey"))
    c, s, p = (3 * F.col(v).cast("long") + k for k, v in enumerate(("o_custkey", "l_suppkey", "l_partkey")))
    return rows.select(F.inline(F.array(*(F.struct(a.alias("u"), b.alias("v")) for a, b in ((c, s), (s, p), (c, p))))))


@register("kg_patterns", """
WITH rows AS (SELECT o_custkey AS c, l_suppkey AS s, l_partkey AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
cs AS (SELECT DISTINCT c, s FROM rows), sp AS (SELECT DISTINCT s, p FROM rows), cp AS (SELECT DISTINCT c, p FROM rows),
t AS MATERIALIZED (SELECT 'c:' || c AS c, 's:' || s AS s, 'p:' || p AS p FROM cs JOIN sp USING (s) JOIN cp USING (c, p)),
nodes AS (SELECT node, count(*) AS triangles FROM (SELECT unnest([c, s, p]) AS node FROM t) GROUP BY node),
sides AS (SELECT x, y, count(*) AS n FROM (SELECT c AS x, s AS y FROM t UNION ALL SELECT s, p FROM t UNION ALL SELECT c, p FROM t) GROUP BY x, y),
ends AS (SELECT node, sum(n * (n - 1) // 2)::BIGINT AS diamonds FROM (SELECT unnest([x, y]) AS node, n FROM sides) GROUP BY node)
SELECT node, triangles, diamonds FROM nodes JOIN ends USING (node)""")
def kg_patterns(spark, sf):
    """Triangles and diamonds of customers, suppliers and parts that traded."""
    counts = graph.pattern_counts(_trade_edges(spark, sf))
    mark = F.element_at(F.array(*map(F.lit, TRADERS)), (F.pmod("node", F.lit(3)) + 1).cast("int"))
    return counts.withColumn("node", F.concat(mark, F.expr("(node - pmod(node, 3)) div 3")))


# --- E18 ----------------------------------------------------------------------
RULES = [Rule("located_in", "in_nation"), Rule("located_in", "in_region"), Rule("located_in", "located_in", "located_in"),
         Rule("serves", "ships_to", "located_in")]


@register("kg_infer", f"""
WITH t AS ({_TRIPLES_SQL}),
ships AS (SELECT DISTINCT 's:' || l_suppkey AS x, 'c:' || o_custkey AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
near AS (SELECT subject AS x, object AS y, 1 AS n, [subject, object] AS w FROM t WHERE predicate IN ('in_nation', 'in_region')),
located AS (SELECT * FROM near UNION ALL SELECT a.x, b.y, 2, [a.x, a.y, b.y] FROM near a JOIN near b ON a.y = b.x),
served AS (SELECT s.x, l.y, min({{'n': l.n + 1, 'w': list_prepend(s.x, l.w)}}) AS m FROM ships s JOIN located l ON s.y = l.x GROUP BY s.x, l.y)
SELECT x AS subject, 'located_in' AS predicate, y AS object, n AS length, array_to_string(w, '>') AS witness FROM located
UNION ALL SELECT x, 'serves', y, m.n, array_to_string(m.w, '>') FROM served""")
def kg_infer(spark, sf):
    """What follows from nations, regions and shipments, each with its shortest proof."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey"])
    rows = li.join(read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"]), F.col("l_orderkey") == F.col("o_orderkey"))
    ships = rows.select(F.concat(F.lit("s:"), "l_suppkey").alias("subject"), F.lit("ships_to").alias("predicate"),
                        F.concat(F.lit("c:"), "o_custkey").alias("object"))
    facts = _triples(spark, sf).where(F.col("predicate").isin("in_nation", "in_region")).unionByName(ships)
    out = infer(facts, RULES).where(F.col("predicate").isin("located_in", "serves"))
    return out.select("subject", "predicate", "object", "length", F.array_join("path", ">").alias("witness"))


#: Longer than any shortest path of the site graph at the scale the SQL runs on.
MOST_HOPS = 12


@register("page_paths", f"""
WITH RECURSIVE {_SITE_SQL.strip()},
step AS (SELECT DISTINCT src, dst FROM site),
walk AS (SELECT 1 AS n, src, dst, [src, dst] AS w FROM step
         UNION ALL SELECT n + 1, walk.src, step.dst, min(list_append(w, step.dst)) FROM walk JOIN step ON step.src = walk.dst
         WHERE n < {MOST_HOPS} GROUP BY n, walk.src, step.dst)
SELECT src, dst, m.n AS length, array_to_string(m.w, '>') AS witness FROM (SELECT src, dst, min({{'n': n, 'w': w}}) AS m FROM walk GROUP BY src, dst)""")
def page_paths(spark, sf):
    """Which page leads to which over any number of links, by the shortest path."""
    site, _ = site_graph(spark, sf)
    facts = site.select(F.col("src").alias("subject"), F.lit("links").alias("predicate"), F.col("dst").alias("object"))
    out = infer(facts, [Rule("reaches", "links"), Rule("reaches", "reaches", "links")], by_subject=True).where("predicate = 'reaches'")
    return out.select(F.col("subject").alias("src"), F.col("object").alias("dst"), "length", F.array_join("path", ">").alias("witness"))
