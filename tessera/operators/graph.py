"""Bounded BFS reachability (H9, E18) and knowledge-graph operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import fixed
from tessera.session import checkpoint_dir, dropped, stored


def bfs_depth(edges: DataFrame, seeds: DataFrame,
              max_depth: int = fixed.CRAWL_MAX_DEPTH, checkpoint: bool = True) -> DataFrame:
    """``(node, depth)``: minimum hop count from any seed, up to ``max_depth``.

    One round per depth: the frontier joins the edge table on ``src``, the
    reached ``dst`` are de-duplicated (partial aggregation, so a hub's many
    in-links collapse map-side), and the already visited are removed with an
    anti join. Cycles therefore cannot re-expand. A frontier that AQE measures
    as small is broadcast at run time; a skewed hub in the edge side is split
    by AQE's skew-join handling. Each round is checkpointed to the shared
    checkpoint folder, so lineage stays one round deep and a lost executor
    recomputes at most one round.
    """
    if checkpoint:
        checkpoint_dir(edges.sparkSession)
    frontier = seeds.select(F.col("node")).distinct().withColumn("depth", F.lit(0))
    visited = frontier
    e = edges.select("src", "dst")
    for d in range(1, max_depth + 1):
        reached = (frontier.join(e, frontier["node"] == e["src"])
                   .select(F.col("dst").alias("node")).distinct())
        new = reached.join(visited.select("node"), "node", "left_anti") \
                     .withColumn("depth", F.lit(d))
        if checkpoint:
            new = new.checkpoint(eager=True)
        visited = visited.unionByName(new)
        frontier = new
    return visited


def star_schema_edges(region: DataFrame, nation: DataFrame, supplier: DataFrame,
                      customer: DataFrame) -> DataFrame:
    """Undirected (hence cyclic) link graph over the star-schema keys."""
    one_way = (
        nation.select(F.concat(F.lit("n:"), "n_nationkey").alias("src"),
                      F.concat(F.lit("r:"), "n_regionkey").alias("dst"))
        .unionByName(supplier.select(F.concat(F.lit("s:"), "s_suppkey").alias("src"),
                                     F.concat(F.lit("n:"), "s_nationkey").alias("dst")))
        .unionByName(customer.select(F.concat(F.lit("c:"), "c_custkey").alias("src"),
                                     F.concat(F.lit("n:"), "c_nationkey").alias("dst"))))
    return one_way.unionByName(one_way.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def kg_triples(region: DataFrame, nation: DataFrame, supplier: DataFrame,
               customer: DataFrame) -> DataFrame:
    """``(subject, predicate, object)`` triples from projections."""
    def t(df, s, p, o):
        return df.select(s.alias("subject"), F.lit(p).alias("predicate"), o.alias("object"))
    r, n, s, c = region, nation, supplier, customer
    return (t(r, F.concat(F.lit("r:"), r.r_regionkey), "name", r.r_name)
            .unionByName(t(n, F.concat(F.lit("n:"), n.n_nationkey), "name", n.n_name))
            .unionByName(t(n, F.concat(F.lit("n:"), n.n_nationkey), "in_region",
                           F.concat(F.lit("r:"), n.n_regionkey)))
            .unionByName(t(s, F.concat(F.lit("s:"), s.s_suppkey), "name", s.s_name))
            .unionByName(t(s, F.concat(F.lit("s:"), s.s_suppkey), "in_nation",
                           F.concat(F.lit("n:"), s.s_nationkey)))
            .unionByName(t(c, F.concat(F.lit("c:"), c.c_custkey), "name", c.c_name))
            .unionByName(t(c, F.concat(F.lit("c:"), c.c_custkey), "in_nation",
                           F.concat(F.lit("n:"), c.c_nationkey)))
            .unionByName(t(c, F.concat(F.lit("c:"), c.c_custkey), "segment", c.c_mktsegment)))


def kg_two_hop(triples: DataFrame, p1: str, p2: str) -> DataFrame:
    """MATCH (a)-[p1]->(b)-[p2]->(c): self-join on the shared variable."""
    a = triples.filter(F.col("predicate") == p1).select(
        F.col("subject").alias("a"), F.col("object").alias("b"))
    b = triples.filter(F.col("predicate") == p2).select(
        F.col("subject").alias("b"), F.col("object").alias("c"))
    return a.join(b, "b").select("a", "b", "c")


def kg_degree(triples: DataFrame) -> DataFrame:
    """Per-entity profile: out-degree, in-degree over entity objects."""
    out_d = triples.groupBy(F.col("subject").alias("entity")).agg(
        F.count(F.lit(1)).alias("out_degree"))
    in_d = (triples.filter(F.col("object").rlike("^[rnsc]:[0-9]+$"))
            .groupBy(F.col("object").alias("entity")).agg(F.count(F.lit(1)).alias("in_degree")))
    return (out_d.join(in_d, "entity", "full")
            .select("entity", F.coalesce("out_degree", F.lit(0)).alias("out_degree"),
                    F.coalesce("in_degree", F.lit(0)).alias("in_degree")))


def oriented(edges: DataFrame) -> DataFrame:
    """(src, dst) of an undirected graph (u, v), each edge once, from the end of
    smaller (degree, id) to the larger one.

    A node has at most sqrt(2 x edges) edges out of it, hubs among them, which
    bounds every list of the nodes after a node without a cap.
    """
    pairs = edges.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).where("a <> b").distinct()
    pairs = stored(pairs, "graph-pairs", give_back=True)
    degree = (pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count(F.lit(1)).alias("degree")))
    both = (pairs.join(degree.select(F.col("node").alias("a"), F.col("degree").alias("da")), "a")
            .join(degree.select(F.col("node").alias("b"), F.col("degree").alias("db")), "b"))
    up = F.col("da") <= F.col("db")                  # a is the smaller id
    return both.select(F.when(up, F.col("a")).otherwise(F.col("b")).alias("src"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("dst"))


#: Triangles are counted by slices of their first nodes: a slice moves so many
#: nodes of lists for each edge, or that many in all.
SLICE_NODES, SLICE_FROM = 3, 1 << 25


def _after(edges: DataFrame) -> DataFrame:
    """(src, after): the list of the nodes after a node, for nodes that have some."""
    both = oriented(edges)
    after = stored(both.groupBy("src").agg(F.collect_list("dst").alias("after")), "graph-after", give_back=True)
    dropped(both)
    return after


def _closed(first: DataFrame, after: DataFrame) -> DataFrame:
    """(a, b, c) of the triangles whose first node is in ``first``, rows of ``after``."""
    ways = first.select(F.col("src").alias("a"), F.explode("after").alias("b"))
    ways = ways.join(after.select(F.col("src").alias("b"), F.col("after").alias("of_b")), "b")
    ways = ways.join(first.select(F.col("src").alias("a"), F.col("after").alias("of_a")), "a")
    return ways.select("a", "b", F.explode(F.array_intersect("of_a", "of_b")).alias("c"))


def triangles(edges: DataFrame) -> DataFrame:
    """(a, b, c) of every triangle once, in the order of the orientation: MATCH
    (a)-(b)-(c)-(a) (E17).

    An edge from a to b takes the nodes after b to the nodes after a; those in
    both close a triangle. Moved are a list an edge, none where nothing comes
    after b, and not a row for each two edges out of a node.
    """
    after = _after(edges)
    return _closed(after, after)


def _slices(after: DataFrame) -> int:
    """Slices of the first nodes, by the lists that edges take to them."""
    ways = after.select(F.explode("after").alias("src")).groupBy("src").agg(F.count(F.lit(1)).alias("ways"))
    moved = ways.join(after.select("src", F.size("after").alias("n")), "src").agg(F.sum(F.col("ways") * F.col("n"))).first()[0]
    edges = after.agg(F.sum(F.size("after").cast("long"))).first()[0]
    return -(-(moved or 0) // max(SLICE_FROM, SLICE_NODES * (edges or 0)))


def pattern_counts(edges: DataFrame) -> DataFrame:
    """(node, triangles, diamonds): the triangles a node is in, and the diamonds -
    two triangles on one edge, MATCH (x)-(y), (x)-(p)-(y), (x)-(q)-(y) - whose
    shared edge it ends. An edge in t triangles is shared by t (t - 1) / 2, so
    diamonds are counted without listing them, and a triangle has two edges at
    each of its nodes, so triangles are counted once, by edge. Where the lists
    that edges take are many times the edges, slices of the first nodes are counted
    one after the other, and what a slice has moved is given back when it is."""
    sides = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("a").alias("x"), F.col("c").alias("y")),
                    F.struct(F.col("b").alias("x"), F.col("c").alias("y")))

    def by_edge(found):
        return found.select(F.inline(sides)).groupBy("x", "y").agg(F.count(F.lit(1)).alias("t"))

    after = _after(edges)
    slices = _slices(after)
    if slices <= 1:
        shared = by_edge(_closed(after, after))
    else:
        held = [stored(by_edge(_closed(after.where(F.pmod(F.xxhash64("src"), F.lit(slices)) == k), after)), "edge-counts", give_back=True)
                for k in range(slices)]
        dropped(after)
        shared = reduce(DataFrame.unionByName, held).groupBy("x", "y").agg(F.sum("t").alias("t"))
    ends = shared.select(F.explode(F.array("x", "y")).alias("node"), "t", F.expr("t * (t - 1) div 2").alias("n"))
    return ends.groupBy("node").agg(F.expr("sum(t) div 2").alias("triangles"), F.sum("n").alias("diamonds"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of ``links`` (u, v); the component is the
    smallest node reachable.

    Large-star: every node hands its larger neighbours to its smallest one;
    small-star: its smaller neighbours likewise. Each round is two aggregates
    to the smallest neighbour and two joins on the node, so a node with any
    number of links is pre-aggregated and its join can be split; the rounds end
    when every component is a star, after a number of them that follows the
    logarithm of the size. Each round is a written table.
    """
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u > v").distinct(), "links")
    before = None
    while True:
        near = _both_ways(edges)
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = near.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u > v").distinct()
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        edges = stored(edges, "stars")
        # order-free digest; hash halves keep the sums inside a long
        now = edges.agg(F.count("*"), F.sum(F.shiftrightunsigned(F.xxhash64("u", "v"), 32)),
                        F.sum(F.xxhash64("v", "u").bitwiseAND(0xFFFFFFFF))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
