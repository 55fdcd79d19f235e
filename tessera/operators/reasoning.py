"""Inference by rules to a fixpoint, with the shortest witness of every fact.

Rules are chains: ``head(x, y) :- p(x, y)`` or ``head(x, z) :- p(x, y), q(y, z)``.
Evaluation is semi-naive: a round joins only the facts that were new or got a
shorter witness in the round before, on either side of a rule, with all facts.
Facts whose predicate no rule derives never change: they are written once, and
rounds only read them. A round's new facts are a written table, so a lost
executor costs tasks of one round. They are added to the derived ones as they
are; only a round that found shorter witnesses, or ``MOST_TABLES`` tables, has
the derived facts written anew. A fact's witness is the
path of nodes of its shortest proof, of equal ones the smallest; a longer one is
dropped before the shuffle that compares it (partial aggregation). Joins are on
the shared node, which Spark can split where a node is a hub.

The closure of a given predicate - ``head(x, y) :- p(x, y)`` and ``head(x, z) :-
head(x, y), p(y, z)`` - has up to the square of the nodes as facts, and a proof
of x only goes on from proofs of x. So it can be made by subject (``by_subject``):
what moves are the given facts, and derived ones are handed on, never written.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.graph import components
from tessera.session import default_parallelism, stored

FACT = ["subject", "predicate", "object"]

#: Tables of derived facts that rounds read before they are written as one.
MOST_TABLES = 16

#: By subject: the subjects of a batch, of which a component has MOST_BATCHES at
#: most (then its batches are larger); nodes that walks which advance together may
#: come to; facts handed on at once; facts from which a task's groups are walked.
BATCH, MOST_BATCHES, MOST_STATES, MOST_ROWS, LEAST_ROWS = 512, 128, 1 << 20, 1 << 14, 1 << 13


class Rule(NamedTuple):
    head: str
    first: str
    then: str | None = None


def _best(facts: DataFrame) -> DataFrame:
    """The shortest witness of each fact, of equal ones the smallest."""
    return (facts.groupBy(*FACT).agg(F.min(F.struct("length", "path")).alias("w"))
            .select(*FACT, F.col("w.length").alias("length"), F.col("w.path").alias("path")))


def _apply(rule: Rule, left: DataFrame, right: DataFrame | None) -> DataFrame:
    """What a rule makes of facts; the proofs of given ones are not moved."""
    carried = [(c, k) for c, k in (("length", "m"), ("path", "p")) if c in left.columns]
    a = left.where(F.col("predicate") == rule.first).select(
        F.col("subject").alias("x"), F.col("object").alias("y"), *(F.col(c).alias(k) for c, k in carried))
    m, p = (F.col("m"), F.col("p")) if carried else (F.lit(1), F.array("x", "y"))
    if rule.then is None:
        return a.select(F.col("x").alias("subject"), F.lit(rule.head).alias("predicate"), F.col("y").alias("object"),
                        m.alias("length"), p.alias("path"))
    carried = [(c, k) for c, k in (("length", "n"), ("path", "q")) if c in right.columns]
    b = right.where(F.col("predicate") == rule.then).select(
        F.col("subject").alias("y"), F.col("object").alias("z"), *(F.col(c).alias(k) for c, k in carried))
    n, rest = (F.col("n"), F.expr("slice(q, 2, size(q) - 1)")) if carried else (F.lit(1), F.array("z"))
    return a.join(b, "y").select(F.col("x").alias("subject"), F.lit(rule.head).alias("predicate"), F.col("z").alias("object"),
                                 (m + n).alias("length"), F.concat(p, rest).alias("path"))


def _closure(rules: list[Rule]) -> tuple[str, str] | None:
    """(head, p) of rules that make head the closure of p."""
    for rule in rules:
        if rule.then is None and rule.head != rule.first and set(rules) == {rule, Rule(rule.head, rule.head, rule.first)}:
            return rule.head, rule.first
    return None


def _walks(n: int, steps: np.ndarray, starts: np.ndarray):
    """Paths from subjects to all that they reach, arrays of a path a row: by the
    walks that begin with a fact of ``starts`` and go on by ``steps``, for each
    object the smallest of the shortest.

    Facts are rows of two places below ``n``, in the order of nodes. Walks of
    several subjects advance together. A round's walks are in order of subject
    and path, and the steps out of a node in order of their object; so walks made
    in that order are in order too, and the first to come to a node has the
    smallest path.
    """
    steps, starts = (a[np.lexsort((a[:, 1], a[:, 0]))] for a in (steps, starts))
    first = np.searchsorted(steps[:, 0], np.arange(n + 1))
    after, out = steps[:, 1], np.diff(first)
    subjects, begin = np.unique(starts[:, 0], return_index=True)
    begin, at_once = np.append(begin, len(starts)), max(1, MOST_STATES // n)
    came = np.empty(min(at_once, len(subjects)) * n, np.int32)
    for low in range(0, len(subjects), at_once):
        high = min(low + at_once, len(subjects))
        there = starts[begin[low]:begin[high], 1]
        whose = np.repeat(np.arange(high - low), np.diff(begin[low:high + 1]))
        walks, at = subjects[low:high, None].astype(np.int32), whose
        seen = np.zeros((high - low) * n, bool)
        while True:                                  # at: the walk that each step goes on from, whose: its subject
            state = whose * n + there
            new = np.flatnonzero(~seen[state])
            order = np.arange(len(new), dtype=np.int32)
            came[state[new[::-1]]] = order[::-1]     # the first to come is written last
            new = new[came[state[new]] == order]
            if not len(new):
                break
            seen[state[new]] = True
            whose, walks = whose[new], np.column_stack((walks[at[new]], there[new].astype(np.int32)))
            yield walks
            end = walks[:, -1]
            n_out = out[end]
            at = np.repeat(np.arange(len(end)), n_out)
            there = after[np.arange(len(at)) + np.repeat(first[end] - np.cumsum(n_out) + n_out, n_out)]
            whose = whose[at]


def _reached(table: pa.Table):
    """Batches (subject, object, length, path) from rows (subject, object, step, start)."""
    ends = [table["subject"].combine_chunks(), table["object"].combine_chunks()]
    nodes = pc.drop_null(pc.unique(pa.concat_arrays(ends)))
    nodes = nodes.take(pc.sort_indices(nodes))
    facts = np.column_stack([pc.fill_null(pc.index_in(e, value_set=nodes), len(nodes)).to_numpy() for e in ends]).astype(np.int64)
    nodes = pa.concat_arrays([nodes, pa.nulls(1, nodes.type)])      # null: no step goes on from it
    step, start = (table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("step", "start"))
    for walks in _walks(len(nodes), facts[step], facts[start]):
        for low in range(0, len(walks), MOST_ROWS):
            some = walks[low:low + MOST_ROWS]
            rows, wide = some.shape
            path = pa.ListArray.from_arrays(pa.array(np.arange(0, rows * wide + 1, wide, dtype=np.int32)), nodes.take(pa.array(some.ravel())))
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(some[:, 0])), nodes.take(pa.array(some[:, -1])),
                                              pa.array(np.full(rows, wide - 1, np.int32)), path], ["subject", "object", "length", "path"])


def _reached_by_group(batches):
    """``_reached`` of the rows of each group (subject, object, step, start, group),
    which come together; small groups, which do not meet, are taken at once."""
    held, size, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(4).to_numpy()
        low = 0
        for cut in np.flatnonzero(np.append(last is not None and group[0] != last, np.diff(group) != 0)).tolist():
            if size + cut - low >= LEAST_ROWS:
                yield from _reached(pa.Table.from_batches([*held, batch.slice(low, cut - low)]))
                held, size, low = [], 0, cut
        held, size, last = [*held, batch.slice(low)], size + batch.num_rows - low, group[-1]
    if held:
        yield from _reached(pa.Table.from_batches(held))


def _by_subject(facts: DataFrame, p: str) -> DataFrame:
    """(subject, object, length, path) of the closure of ``p`` from all of ``facts``.

    What follows from a subject's facts stays in its component. A component's
    subjects are dealt over batches, and its steps go to each of them. What a null
    leads to is one component with the least of its objects.
    """
    kind = facts.schema["subject"].dataType
    least = facts.where(F.col("subject").isNull()).agg(F.min("object")).first()[0]
    node = F.coalesce("subject", F.lit(least).cast(kind))
    rows = facts.select("subject", "object", node.alias("node"), (F.col("predicate") == p).alias("step"))
    found = components(rows.select(F.col("node").alias("u"), F.col("object").alias("v")))
    rows = rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node")
    rows = stored(rows, "facts-by-component")
    sizes = rows.groupBy("component").agg(F.countDistinct("subject").alias("subjects"))
    batches = F.least(F.ceil(F.coalesce("subjects", F.lit(0)) / BATCH), F.lit(MOST_BATCHES)).cast("int")
    rows = rows.join(sizes, "component", "left").withColumn("batches", F.greatest(batches, F.lit(1)))
    own = F.pmod(F.xxhash64("subject"), F.col("batches")).cast("int")
    goes_on = F.col("step") & F.col("subject").isNotNull()
    rows = rows.withColumn("own", own).withColumn("batch", F.explode(F.when(goes_on, F.expr("sequence(0, batches - 1)")).otherwise(F.array("own"))))
    rows = rows.select("subject", "object", goes_on.alias("step"), (F.col("batch") == F.col("own")).alias("start"),
                       F.xxhash64("component", "batch").alias("group"))
    rows = rows.repartition(4 * default_parallelism(rows.sparkSession), "group").sortWithinPartitions("group")
    schema = T.StructType([T.StructField("subject", kind), T.StructField("object", kind), T.StructField("length", T.IntegerType()),
                           T.StructField("path", T.ArrayType(kind))])
    return rows.mapInArrow(_reached_by_group, schema)


def infer(facts: DataFrame, rules: list[Rule], by_subject: bool = False) -> DataFrame:
    """(subject, predicate, object, length, path) of all given facts (length 1)
    and all that follow from them by ``rules``; the same ``by_subject``, which is
    for a closure whose facts are too many to be written."""
    heads = {rule.head for rule in rules}
    derived = F.coalesce(F.col("predicate").isin(*heads), F.lit(False))
    rows = stored(facts.select(*FACT).distinct(), "facts-given")

    def proved(df):
        return df.select(*FACT, F.lit(1).alias("length"), F.array("subject", "object").alias("path"))

    if by_subject and (closure := _closure(rules)) is not None:
        head, p = closure
        made = _by_subject(rows.where(F.col("predicate").isin(head, p)), p)
        return proved(rows.where(~derived)).unionByName(made.withColumn("predicate", F.lit(head)))

    given, known, delta, tables = rows.where(~derived), proved(rows.where(derived)), None, 1

    def having(predicate):
        return known if predicate in heads else given

    while True:
        made = []
        for rule in rules:
            if delta is None:                        # the first round: all facts are new
                made.append(_apply(rule, having(rule.first), having(rule.then) if rule.then is not None else None))
                continue
            if rule.first in heads:
                made.append(_apply(rule, delta, having(rule.then) if rule.then is not None else None))
            if rule.then in heads:
                made.append(_apply(rule, having(rule.first), delta))
        if not made:
            return proved(given).unionByName(known)
        had = known.select(*FACT, F.struct("length", "path").alias("had"))
        better = F.col("had").isNull() | (F.struct("length", "path") < F.col("had"))
        delta = _best(reduce(DataFrame.unionByName, made)).join(had, FACT, "left").where(better)
        delta = stored(delta.withColumn("shorter", F.col("had").isNotNull()).drop("had"), "delta")
        found = delta.agg(F.bool_or("shorter").alias("shorter")).first()
        if found.shorter is None:
            return proved(given).unionByName(known)
        again = tables >= MOST_TABLES or found.shorter
        known, delta = known.unionByName(delta.drop("shorter")), delta.drop("shorter")
        known, tables = (stored(_best(known), "facts"), 1) if again else (known, tables + 1)
