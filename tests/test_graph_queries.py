"""The crawl by links against a queue, patterns against all triples of nodes, rules
against plain saturation."""

import random
from collections import deque
from itertools import combinations

import pytest

from tessera.operators import crawl, graph
from tessera.operators.reasoning import Rule, infer


def _queue_crawl(pages, links, seeds, seen, budget, max_depth):
    """One host after the other, first in first out."""
    by, out = {p[0]: p for p in pages}, {}
    step = {}
    for src, pos, dst in sorted(links):
        step.setdefault(src, []).append(dst)
    for host in {p[1] for p in pages}:
        queue = deque((s, 0) for s, _ in sorted(seeds, key=lambda s: s[1]) if by[s][1] == host)
        queued, had, saved = {s for s, _ in queue}, set(), 0
        while queue and saved < budget:
            page, depth = queue.popleft()
            _, _, allowed, filled, script, language, content = by[page]
            if not allowed:
                continue
            place = None
            if filled and not script:
                out[page] = (depth, place)
                continue
            if filled and language and content not in seen and content not in had:
                had.add(content)
                saved += 1
                place = saved
            out[page] = (depth, place)
            for dst in step.get(page, []):
                if depth < max_depth and dst in by and by[dst][1] == host and dst not in queued:
                    queued.add(dst)
                    queue.append((dst, depth + 1))
    return out


SCHEMA = "page_id long, host string, allowed boolean, filled boolean, script boolean, language boolean, content_hash string"


@pytest.mark.parametrize("seed,budget,depth", [(1, 3, 2), (2, 6, 4), (3, 1, 3)])
def test_crawl_matches_a_queue(spark, seed, budget, depth):
    rng = random.Random(seed)
    pages = []
    for k in range(240):
        filled = rng.random() < 0.9
        pages.append((k, "hot" if k % 3 else f"h{k % 7}", rng.random() < 0.9, filled, filled and rng.random() < 0.8,
                      filled and rng.random() < 0.8, f"c{rng.randrange(60)}"))
    links = [(rng.randrange(240), pos, rng.randrange(250)) for pos in range(9) for _ in range(130)]
    links = list({(s, p): (s, p, d) for s, p, d in links}.values())
    seeds = [(k, k % 5) for k in range(0, 40, 3)] + [(k, 9) for k in (1, 2, 5)]
    seen = {"c1", "c2", "c3"}
    want = _queue_crawl(pages, links, seeds, seen, budget, depth)
    # seeds of equal position stand in no order of their own
    seeds = [(s, k) for k, (s, _) in enumerate(sorted(seeds, key=lambda s: s[1]))]
    got = crawl.crawl_links(spark.createDataFrame(pages, SCHEMA), spark.createDataFrame(links, "src long, pos int, dst long"),
                            spark.createDataFrame(seeds, "page_id long, pos int"),
                            spark.createDataFrame([(c,) for c in seen], "content_hash string"), budget, depth).collect()
    assert {r.page_id: (r.depth, r.place) for r in got} == want and len(got) == len(want)
    assert all(r.saved == (r.place is not None) for r in got)


def test_every_filter_cuts(spark):
    ok = ("h", True, True, True, True)
    pages = [(0, *ok, "a"), (1, "h", False, True, True, True, "b"), (2, "h", True, True, False, True, "c"), (3, "h", True, True, True, False, "d"),
             (4, "h", True, False, False, False, ""), (5, *ok, "a"), (6, *ok, "old"), (10, *ok, "e"), (11, *ok, "f"), (12, *ok, "g"), (13, *ok, "h"),
             (14, *ok, "i"), (15, "other", True, True, True, True, "j"), (20, *ok, "k"), (21, *ok, "l")]
    links = [(0, k, d) for k, d in enumerate((1, 2, 3, 4, 5, 6, 15, 99))]
    links += [(1, 0, 10), (2, 0, 11), (3, 0, 12), (4, 0, 13), (5, 0, 14), (6, 0, 20), (12, 0, 21)]
    args = (spark.createDataFrame(pages, SCHEMA), spark.createDataFrame(links, "src long, pos int, dst long"),
            spark.createDataFrame([(0, 0)], "page_id long, pos int"), spark.createDataFrame([("old",)], "content_hash string"))

    def run(budget, depth):
        return {(r.page_id, r.depth, r.place) for r in crawl.crawl_links(*args, budget, depth).collect()}

    first = {(0, 0, 1), (2, 1, None), (3, 1, None), (4, 1, None), (5, 1, None), (6, 1, None)}
    assert run(50, 2) == first | {(12, 2, 2), (13, 2, 3), (14, 2, 4), (20, 2, 5)}
    assert run(50, 3) == run(50, 2) | {(21, 3, 6)}
    assert run(3, 3) == first | {(12, 2, 2), (13, 2, 3)}       # the budget is full before 14, 20 and 21
    assert run(1, 3) == {(0, 0, 1)}
    assert crawl.crawl_links(args[0], args[1], args[2].limit(0)).count() == 0


def test_patterns(spark):
    rng = random.Random(8)
    edges = {tuple(sorted(rng.sample(range(30), 2))) for _ in range(150)} | {(0, k) for k in range(1, 30)}     # 0 is a hub
    rows = [(str(a), str(b)) for a, b in edges] + [(str(b), str(a)) for a, b in list(edges)[:40]] + [("5", "5")]
    df = spark.createDataFrame(rows, "u string, v string")
    found = [t for t in combinations(range(30), 3) if all(p in edges for p in combinations(t, 2))]
    got = {tuple(sorted(map(int, (r.a, r.b, r.c)))) for r in graph.triangles(df).collect()}
    assert got == set(found) and graph.triangles(df).count() == len(found)
    near = {k: {b for e in edges for b in e if k in e and b != k} for k in range(30)}
    diamonds = dict.fromkeys(range(30), 0)
    for x, y in edges:
        for _ in combinations(near[x] & near[y], 2):
            diamonds[x] += 1
            diamonds[y] += 1
    want = {str(k): (sum(k in t for t in found), diamonds[k]) for k in range(30) if any(k in t for t in found)}
    assert {r.node: (r.triangles, r.diamonds) for r in graph.pattern_counts(df).collect()} == want
    # the orientation bounds what leaves a node
    out = graph.oriented(df).groupBy("src").count().agg({"count": "max"}).first()[0]
    assert out <= (2 * len(edges)) ** 0.5


def _most_rows(plan):
    """The most rows that any step of an executed plan put out."""
    below = [plan.executedPlan()] if plan.nodeName() == "AdaptiveSparkPlan" else [plan.plan()] if "QueryStage" in plan.nodeName() else []
    below += [plan.children().apply(k) for k in range(plan.children().size())]
    rows = plan.metrics().get("numOutputRows")
    return max([rows.get().value() if rows.isDefined() else 0, *map(_most_rows, below)])


def test_triangles_do_not_list_every_two_edges_of_a_node(spark):
    # 60 x 60 nodes: 3,600 edges, 106,200 pairs of edges out of one node, one edge between two of them closes 60
    rows = [(f"a{x}", f"b{y}") for x in range(60) for y in range(60)] + [("b0", "b1"), (None, "b1"), ("a0", None), (None, None)]
    df = graph.triangles(spark.createDataFrame(rows, "u string, v string"))
    assert {tuple(sorted(r)) for r in df.collect()} == {(f"a{x}", "b0", "b1") for x in range(60)}
    assert _most_rows(df._jdf.queryExecution().executedPlan()) <= 2 * len(rows)


def test_traders_keep_their_marks(spark, tmp_path):
    from tessera.plans import graphs
    li = [(1, 5, 7), (1, 6, 7), (2, 5, 7), (3, 5, 8), (3, -4, 0), (4, 5, 7), (9, 1, 1), (None, 2, 2), (5, None, 3)]
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, 7), (2, 8), (3, -1), (4, None), (5, 1)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.node: (r.triangles, r.diamonds) for r in graphs.kg_patterns(spark, str(tmp_path)).collect()}
    # triangles: c:7 s:7 p:5 and p:6; c:8 s:7 p:5; c:-1 s:8 p:5; c:-1 s:0 p:-4. c:7 s:7 and s:7 p:5 are shared by two
    assert got == {"c:7": (2, 1), "s:7": (3, 2), "p:5": (3, 1), "p:6": (1, 0), "c:8": (1, 0), "c:-1": (2, 0), "s:8": (1, 0),
                   "s:0": (1, 0), "p:-4": (1, 0)}


def _saturate(facts, rules):
    known = {f: (1, (f[0], f[2])) for f in facts}
    while True:
        new = {}
        for head, p, q in rules:
            for (x, pred, y), (n, w) in known.items():
                if pred != p:
                    continue
                if q is None:
                    made = [((x, head, y), (n, w))]
                else:
                    made = [((x, head, z), (n + m, w + v[1:])) for (y2, pred2, z), (m, v) in known.items() if pred2 == q and y2 == y]
                for f, proof in made:
                    if proof < min(known.get(f, (99,)), new.get(f, (99,))):
                        new[f] = proof
        if not new:
            return known
        known |= new


def test_rules(spark):
    rng = random.Random(2)
    facts = [(f"n{rng.randrange(12)}", "to", f"n{rng.randrange(12)}") for _ in range(16)] + [(f"n{k}", "tag", f"t{k % 3}") for k in range(12)]
    rules = [Rule("far", "to"), Rule("far", "far", "far"), Rule("sees", "far", "tag"), Rule("back", "sees", "none")]
    got = {(r.subject, r.predicate, r.object): (r.length, tuple(r.path)) for r in
           infer(spark.createDataFrame(facts + facts[:3], "subject string, predicate string, object string"), rules).collect()}
    assert got == _saturate(set(facts), rules)
    assert max(n for n, _ in got.values()) > 3


def test_facts_that_no_rule_derives_are_written_once(spark, monkeypatch):
    from tessera.operators import reasoning
    written = []

    def counted(df, name):
        out = stored(df, name)
        written.append((name, out.where("predicate = 'tag'").count()))
        return out

    stored = reasoning.stored
    monkeypatch.setattr(reasoning, "stored", counted)
    facts = [(f"n{k}", "to", f"n{k + 1}") for k in range(5)] + [(f"n{k}", "tag", "t") for k in range(6)] + [("n5", "far", "n0"), ("z", None, "z")]
    rules = [Rule("far", "to"), Rule("far", "far", "far"), Rule("sees", "far", "tag")]
    got = {(r.subject, r.predicate, r.object): (r.length, tuple(r.path)) for r in
           reasoning.infer(spark.createDataFrame(facts + facts, "subject string, predicate string, object string"), rules).collect()}
    assert got == _saturate(set(facts), rules)
    assert [n for _, n in written] == [6] + [0] * (len(written) - 1) and len(written) > 4


@pytest.mark.parametrize("most", [2, 16])
def test_found_facts_are_not_written_again(spark, monkeypatch, most):
    from tessera.operators import reasoning
    written = []

    def counted(df, name):
        out = stored(df, name)
        written.append((name, out.count()))
        return out

    stored = reasoning.stored
    monkeypatch.setattr(reasoning, "stored", counted)
    monkeypatch.setattr(reasoning, "MOST_TABLES", most, raising=False)
    facts = [(f"n{k}", "to", f"n{(k + s) % 9}") for k in range(9) for s in (1, 2)]
    rules = [Rule("far", "to"), Rule("far", "far", "to")]
    got = {(r.subject, r.predicate, r.object): (r.length, tuple(r.path)) for r in
           reasoning.infer(spark.createDataFrame(facts, "subject string, predicate string, object string"), rules).collect()}
    assert got == _saturate(set(facts), rules)
    assert sum(n for name, n in written if name == "delta") == 81
    assert [name for name, _ in written].count("facts") == (0 if most == 16 else 2)


@pytest.mark.parametrize("batch,states,most,least", [(512, 1 << 20, 1 << 14, 1 << 13), (3, 40, 2, 1)])
def test_a_closure_by_subject_writes_no_derived_fact(spark, monkeypatch, batch, states, most, least):
    from tessera.operators import graph as gr
    from tessera.operators import reasoning
    written = []

    def counted(df, name):
        out = stored(df, name)
        written.append((name, out.count()))
        return out

    stored = reasoning.stored
    for module in (reasoning, gr):
        monkeypatch.setattr(module, "stored", counted)
    for name, value in (("BATCH", batch), ("MOST_STATES", states), ("MOST_ROWS", most), ("LEAST_ROWS", least)):
        monkeypatch.setattr(reasoning, name, value)
    rng = random.Random(4)
    facts = [(f"n{k}", "to", f"n{k // 20 * 20 + rng.randrange(20)}") for k in range(60) for _ in range(2)]
    facts += [("n7", "far", "n50"), ("n7", "far", "n90x"), ("n90", "to", "n90"), (None, "to", "n3"), (None, "to", "n41"), ("n41", "to", None),
              (None, "to", None), ("n5", "tag", "n6"), ("n5", None, "n6"), ("lone", "to", "lone"), ("lone", "far", None)]
    rules = [Rule("far", "to"), Rule("far", "far", "to")]
    known = {f: (1, (f[0], f[2])) for f in facts}
    steps = {}
    for x, p, y in facts:
        if p == "to" and x is not None:
            steps.setdefault(x, []).append(y)
    new = {(x, "far", y): (1, (x, y)) for x, p, y in facts if p in ("to", "far")}
    while new:
        known |= new
        made = {}
        for (x, _, y), (n, w) in new.items():
            for z in steps.get(y, ()) if y is not None else ():
                proof = (n + 1, (*w, z))
                if (x, "far", z) not in known and [e or "" for e in proof[1]] < [e or "" for e in made.get((x, "far", z), (0, ["~"]))[1]]:
                    made[x, "far", z] = proof
        new = made
    df = spark.createDataFrame(facts + facts[:9], "subject string, predicate string, object string")
    rows = reasoning.infer(df, rules, by_subject=True).collect()
    got = {(r.subject, r.predicate, r.object): (r.length, tuple(r.path)) for r in rows}
    assert got == known and len(rows) == len(known) and max(n for n, _ in known.values()) > 3
    assert max(n for _, n in written) <= 2 * len(set(facts)) < len(known)
    numbers = spark.createDataFrame([(1, "to", 10), (10, "to", 9), (1, "to", 2), (2, "to", 9)], "subject long, predicate string, object long")
    assert {(r.subject, r.object): r.path for r in infer(numbers, rules, by_subject=True).where("predicate = 'far'").collect()} == {
        (1, 10): [1, 10], (1, 2): [1, 2], (10, 9): [10, 9], (2, 9): [2, 9], (1, 9): [1, 2, 9]}


def test_patterns_by_slices(spark, monkeypatch):
    """Where lists are many times the edges, slices are counted one after the other."""
    written = []

    def counted(df, name, give_back=False):
        written.append((name, give_back))
        return stored(df, name, give_back)

    stored = graph.stored
    monkeypatch.setattr(graph, "stored", counted)
    rng = random.Random(3)
    rows = [(f"a{rng.randrange(25)}", f"b{rng.randrange(25)}") for _ in range(260)] + [(f"b{k}", f"b{k + 1}") for k in range(24)] + [(None, "b1")]
    df = spark.createDataFrame(rows, "u string, v string")
    whole = {tuple(r) for r in graph.pattern_counts(df).collect()}
    assert len(whole) > 30 and [n for n, _ in written] == ["graph-pairs", "graph-after"]
    monkeypatch.setattr(graph, "SLICE_FROM", 1)
    monkeypatch.setattr(graph, "SLICE_NODES", 1)
    assert {tuple(r) for r in graph.pattern_counts(df).collect()} == whole
    assert len([n for n, _ in written if n == "edge-counts"]) > 1 and all(back for _, back in written)
    # tables that nothing reads any more are gone, the edge counts are not
    from tessera import session
    before = len(session._written)
    left = graph.pattern_counts(df)
    assert {p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in session._written[before:]} == {"edge-counts"} and left.count() == len(whole)
    assert graph.pattern_counts(df.limit(0)).count() == 0
