"""Merkle manifest of a dataset by concatenated-level strings.

Every row is a leaf; per source the leaves, by ascending ``doc_id``, are the
lowest level of a tree whose nodes are hashes of runs of 16. The subroots of all
sources, by source, are the leaves of one tree more, whose root is the manifest.

A block is 256 aligned nodes of a level. It keeps that level as one string of
fixed-width hex digests: the parents are hashes of its substrings of 16 digests,
the siblings of a node are the two substrings that flank it in its run, and 256
nodes shrink to one in two levels of string work inside a row. The blocks' tops
are the next level's nodes, so the rounds follow the logarithm of the rows to
the base 256, and all rounds above the first hold a 256th of the rows together.
Going down again, each block hands its own segments and those above to its
nodes, so a leaf meets its whole proof without a join on a source.

Positions come from range partitions of (source, doc_id) numbered in passing
and offset by counts per (partition, source): no source is one group.

Defined results: a null source is a source of its own, first in order; a null
doc_id comes first in its source and is never tampered with; rows that share a
doc_id are ordered by their leaf, and equal rows are leaves each; a null text
stays null when tampered with; texts of any length are hashed whole; an empty
table gives no rows; columns other than the five are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import stored

#: Nodes of a run, hex digits of a digest, levels inside a block.
ARITY, WIDTH, DEPTH = 16, 64, 2
BLOCK = ARITY ** DEPTH
#: Tampering takes the documents whose id's crc32 this number divides.
TAMPER = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered) of every row; ``tampered`` is null where the
    text is left alone. ``tree`` is the source with a mark that orders null first."""
    source = docs["source"].cast("string")
    fields = [docs["doc_id"].cast("long"), source, docs["lang"], docs["n_chars"].cast("long")]
    text = docs["text"].cast("string")

    def leaf(text):
        return _digest(F.concat(*map(_field, [*fields, text])))

    picked = F.crc32(docs["doc_id"].cast("long").cast("string").cast("binary")) % TAMPER == 0
    return docs.select(F.coalesce(F.concat(F.lit("1"), source), F.lit("0")).alias("tree"),
                       docs["doc_id"].cast("long").alias("doc_id"), leaf(text).alias("leaf"),
                       F.when(picked, leaf(F.translate(text, UPPER, LOWER))).alias("tampered"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (0-based in its tree, by ``order``) and ``n`` (rows of
    its tree). A range partition counts its rows tree by tree as they stream by;
    what earlier partitions hold of a tree is added from a table of counts. The
    row number at the end of the order only lets ranges split equal rows."""
    order = ["tree", *order, "tie"]
    ranged = (rows.select("tree", *[c for c in rows.columns if c != "tree"], F.monotonically_increasing_id().alias("tie"))
              .repartitionByRange(*order).sortWithinPartitions(*order)
              .select("*", F.spark_partition_id().alias("part"), F.lit(0).cast("long").alias("nth")))

    def count(batches):
        tree, seen = None, 0
        for batch in batches:
            runs, nth = pc.run_end_encode(batch.column(0)), np.arange(batch.num_rows)
            at = 0
            for key, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                seen = seen if key == tree else 0
                nth[at:end] += seen - at
                tree, seen, at = key, seen + end - at, end
            yield batch.set_column(batch.num_columns - 1, "nth", pa.array(nth, pa.int64()))

    ranged = stored(ranged.mapInArrow(count, ranged.schema).drop("tie"), "merkle-order")
    by_part = Window.partitionBy("tree").orderBy("part")
    counts = ranged.groupBy("tree", "part").agg(F.count("*").alias("m"))
    counts = stored(counts.select(
        "tree", "part", F.sum("m").over(Window.partitionBy("tree")).alias("n"),
        (F.sum("m").over(by_part.rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")).alias("before")), "merkle-counts")
    return ranged.join(counts, ["tree", "part"]).withColumn("pos", F.col("before") + F.col("nth")).drop("part", "nth", "before")


def _parents(level: Column) -> Column:
    """The level above, from one fixed-width substring per run."""
    runs = F.ceil(F.length(level) / F.lit(ARITY * WIDTH)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda k: _digest(
        F.substring(level, k * (ARITY * WIDTH) + 1, F.lit(ARITY * WIDTH)))), "")


def _segment(level: Column, at: Column) -> Column:
    """What flanks node ``at`` in its run: (before, after), as strings of digests."""
    run = F.floor(at / ARITY).cast("int") * (ARITY * WIDTH)
    own = at * WIDTH
    return F.struct(F.substring(level, run + 1, own - run).alias("before"),
                    F.substring(level, own + (WIDTH + 1), run + (ARITY - 1) * WIDTH - own).alias("after"))


def _blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """One row per block of 256 nodes: its members in order and its levels. The
    levels end where one node is left of a whole tree (``n`` of a block's tree)."""
    b = (nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block"))
         .agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "node", *carried))).alias("nodes")))
    level, names = F.array_join(F.transform("nodes", lambda x: x["node"]), ""), ["level0"]
    b = b.withColumn("level0", level)
    for k in range(1, DEPTH + 1):
        b = b.withColumn(f"level{k}", F.when(F.col("n") > ARITY ** (k - 1), _parents(F.col(names[-1]))))
        names.append(f"level{k}")
    return b.withColumn("top", F.coalesce(*[F.col(c) for c in reversed(names)]))


def _handed_down(blocks: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes of ``blocks`` with their proofs: own segments, then the block's."""
    b = blocks.select("*", F.explode("nodes").alias("x")).drop("nodes")
    at = (F.col("x.pos") % BLOCK).cast("int")
    own = [F.when(F.col(f"level{k + 1}").isNotNull(), _segment(F.col(f"level{k}"), F.floor(at / ARITY ** k).cast("int")))
           for k in range(DEPTH)]
    proof = F.concat(F.filter(F.array(*own), lambda s: s.isNotNull()), F.col("proof"))
    return b.select("tree", F.col("x.pos").alias("pos"), F.col("x.node").alias("node"),
                    *[F.col(f"x.{c}").alias(c) for c in carried],
                    *[c for c in ("subroot", "root") if c in b.columns], proof.alias("proof"))


def build(nodes: DataFrame, carried: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks over ``nodes`` (tree, pos, n, node, ``carried``), and
    (tree, subroot, round in which the tree came down to one block)."""
    rounds, ends = [], None
    while True:
        blocks = stored(_blocks(nodes, carried if not rounds else []), f"merkle-blocks{len(rounds)}")
        done = blocks.where(F.col("n") <= BLOCK).select("tree", F.col("top").alias("subroot"), F.lit(len(rounds)).alias("round"))
        ends = done if ends is None else ends.unionByName(done)
        rounds.append(blocks)
        rest = blocks.where(F.col("n") > BLOCK)
        if rest.isEmpty():
            return rounds, ends
        nodes = rest.select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("node"))


def proofs(rounds: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """Every node of the lowest round with its whole proof. ``tops`` holds for
    each tree its ``round``, the proof of its subroot and columns to hand down."""
    above = None
    for k in reversed(range(len(rounds))):
        ended = tops.where(F.col("round") == k).drop("round").withColumn("block", F.lit(0).cast("long"))
        above = ended if above is None else above.unionByName(ended)
        below = _handed_down(rounds[k].join(above, ["tree", "block"]), carried if k == 0 else [])
        above = below.drop("node").withColumnRenamed("pos", "block")
    return below


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and folded proof of every row (see the module)."""
    carried = ["doc_id", "tampered"]
    rows = numbered(leaves(docs), ["doc_id", "leaf", "tampered"]).withColumnRenamed("leaf", "node")
    rounds, ends = build(rows, carried)
    ends = stored(ends, "merkle-subroots")

    # the tree of subroots has one tree key; its nodes are ordered by source
    roots = numbered(ends.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("node"), "round"), ["of"])
    upper, root = build(roots, ["of", "round"])
    whole = root.select("tree", F.col("subroot").alias("root"), "round", F.expr(
        "cast(array() as array<struct<before: string, after: string>>)").alias("proof"))
    tops = proofs(upper, whole, ["of", "round"]).select(
        F.col("of").alias("tree"), "round", F.col("node").alias("subroot"), "root", "proof")

    out = proofs(rounds, stored(tops, "merkle-tops"), carried)
    folded = F.aggregate("proof", F.coalesce("tampered", "node"),
                         lambda acc, s: _digest(F.concat(s["before"], acc, s["after"])))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["after"])), "")
    return (out.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", _digest(siblings).alias("proof_sha256"),
                       folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
