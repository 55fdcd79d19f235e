"""One crawl cycle on a hand-made site: every filter takes something out."""

from tessera.functions import text as tx
from tessera.operators import links

RULES = [("s.gr", "*", 0, False, "/"), ("s.gr", "MyBot", 1, False, "/private/"), ("t.gr", "*", 0, False, "/no/"), ("t.gr", "OtherBot", 1, False, "/")]
WORD = "ΑΒΓΔ κείμενο σελίδας "


def page(i, url, depth, body, *hrefs):
    return (i, url, f"<body><p>{body}</p>" + "".join(f"<a href='{h}'>x</a>" for h in hrefs) + "</body>", depth)


PAGES = [
    page(1, "http://s.gr/", 0, WORD * 3 + "ένα", "/news/2", "/about", "http://t.gr/a/b", "#top", "/private/x/1"),
    page(2, "http://s.gr/news/2", 1, WORD * 3 + "δύο", "/news/3", "/news/2#c"),
    page(3, "http://s.gr/private/9", 1, WORD * 3 + "κρυφό", "/found/by/private"),     # forbidden to this agent
    page(4, "http://s.gr/old/1", 1, WORD * 3 + "ένα"),                                # the text of page 1
    page(5, "http://s.gr/latin/1", 1, "only latin words here " * 9, "/from/latin"),   # another script
    page(6, "http://s.gr/blank/1", 1, " ", "/from/blank"),                            # blank, its links count
    page(7, "http://s.gr/deep/1", 3, WORD * 3 + "βαθιά"),                             # too deep
    page(8, "http://s.gr/seen/1", 1, WORD * 3 + "παλιό"),                             # seen in an earlier cycle
    page(9, "http://s.gr/more/1", 2, WORD * 3 + "πολύ", "/next/level"),               # over the budget; its links are too deep
    page(10, "http://t.gr/x/1", 0, WORD * 3 + "άλλο", "/no/1", "/yes/1"),
]


def cycle(spark, **kw):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, depth int")
    rules = spark.createDataFrame(RULES, "host string, agent string, rule_pos int, allow boolean, prefix string")
    old = spark.createDataFrame([(1, "u", f"<body><p>{WORD * 3}παλιό</p></body>")], "page_id long, url string, html string")
    seen = links.page_texts(old).select(tx.content_hash("page_text").alias("content_hash"))
    saved, frontier = links.crawl_cycle(pages, rules, "MyBot/1.0", seen, per_domain=2, **kw)
    return ({(r.page_id, r["rank"]) for r in saved.collect()}, {(r.url, r.depth) for r in frontier.collect()})


def test_cycle(spark):
    saved, frontier = cycle(spark, harvest_links=True)
    assert saved == {(1, 1), (2, 2), (10, 1)}
    assert frontier == {("http://s.gr/news/3", 2), ("http://s.gr/from/latin", 2), ("http://s.gr/from/blank", 2), ("http://t.gr/yes/1", 1)}
    # by default as the original: pages in another script give no links
    assert cycle(spark) == (saved, frontier - {("http://s.gr/from/latin", 2)})


def test_agent_groups(spark):
    rules = spark.createDataFrame(RULES, "host string, agent string, rule_pos int, allow boolean, prefix string")
    got = {(r.host, r.prefix) for r in links.rules_for_agent(rules, "mybot/2").collect()}
    assert got == {("s.gr", "/private/"), ("t.gr", "/no/")}
