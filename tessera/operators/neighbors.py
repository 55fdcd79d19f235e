"""Exact k nearest neighbours by pivots and triangle bounds.

Points fall into cells by their nearest pivot and into rings of a cell by their
distance to it. A ring with its least and greatest distance bounds from below
how near a query can come to any point in it, from the query's own distance to
the pivot. A query first searches the rings that could be nearest, until they
hold enough points; the k-th distance found there rules out every ring whose
bound is above it, and the second pass searches the rest. The answer is that of
the full ranking, ties by id.

A ring of many points (a third of all may be equal) is dealt by hash over slabs,
and a slab that many queries visit is met by blocks of them, so a task compares
at most one slab with one block. Pivots and rings are a bounded table, whatever
the number of points.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import stored

PIVOTS, RINGS = 64, 16
#: Most points of a slab and queries of a block, in the mean of a hash.
SLAB, BLOCK = 4096, 256
#: Relative slack of the bounds against rounding.
SLACK = 1e-9


def _vectors(column) -> np.ndarray:
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 21) // max(1, b.size))
    for at in range(0, len(a), step):
        gap = a[at:at + step, None, :] - b[None]
        out[at:at + step] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
    return out


class Rings:
    """Pivots, ring width, and of each ring that holds points: cell, number of
    points, slabs, least and greatest distance to the pivot."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        apart = distances(pivots, pivots)
        self.width = float(apart.sum() / max(1, (apart > 0).sum())) / RINGS or 1.0

    def place(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ring number and distance to the pivot of every vector."""
        far = distances(vectors, self.pivots)
        cell = far.argmin(1)
        own = far[np.arange(len(far)), cell]
        return cell * RINGS + np.minimum(own / self.width, RINGS - 1).astype(np.int64), own

    def summarise(self, rows: list) -> None:
        self.ring = np.array([r.ring for r in rows], np.int64)
        self.n = np.array([r.n for r in rows], np.int64)
        self.low, self.high = (np.array([r[c] for r in rows], float) for c in ("low", "high"))
        self.slabs = -(-self.n // SLAB)

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """Least possible distance of each vector to a point of each ring."""
        far = distances(vectors, self.pivots)[:, self.ring // RINGS]
        return np.maximum(np.maximum(self.low - far, far - self.high), 0) * (1 - SLACK)

    def first(self, bounds: np.ndarray, enough: int) -> list[tuple[int, int]]:
        """(ring, slabs) to search first: by bound, until ``enough`` points. Of a
        ring in many slabs one is enough."""
        out, have = [], 0
        for k in np.argsort(bounds, kind="stable"):
            slabs = 1 if self.n[k] >= 4 * enough * self.slabs[k] else int(self.slabs[k])
            out.append((int(k), slabs))
            have += self.n[k] * slabs // self.slabs[k]
            if have >= enough:
                break
        return out


def _visits(queries: DataFrame, rings: Rings, k: int, second: bool) -> DataFrame:
    """(query, vector, ring, slab) of the first pass, or of the second (``bound``)."""
    def run(batches):
        for batch in batches:
            vectors = _vectors(batch.column("vector"))
            if not len(vectors):
                continue
            at, ring, slab = [], [], []
            limits = batch.column("bound").to_numpy(zero_copy_only=False) if second else None
            for row, bounds in enumerate(rings.nearest(vectors)):
                done = dict(rings.first(bounds, k + 1))
                todo = np.flatnonzero(bounds <= limits[row]) if second else done
                for r in todo:
                    slabs = range(done.get(int(r), 0), int(rings.slabs[r])) if second else range(done[r])
                    at += [row] * len(slabs)
                    ring += [int(rings.ring[r])] * len(slabs)
                    slab += slabs
            pick = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("query").take(pick), batch.column("vector").take(pick),
                                              pa.array(ring, pa.int64()), pa.array(slab, pa.int64())],
                                             names=["query", "vector", "ring", "slab"])

    return queries.mapInArrow(run, "query long, vector array<double>, ring long, slab long")


def _search(visits: DataFrame, points: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The k best of every visit, and the number of comparisons by slab."""
    visits = stored(visits, "knn-visits")
    counts = visits.groupBy("ring", "slab").agg(F.count("*").alias("n"))
    counts = stored(counts.withColumn("blocks", F.ceil(F.col("n") / BLOCK)), "knn-counts")
    block = F.pmod(F.xxhash64("query"), F.col("blocks"))
    left = visits.join(counts, ["ring", "slab"]).select("ring", "slab", block.alias("block"), "query", "vector")
    right = points.join(counts, ["ring", "slab"])
    compared = right.agg(F.sum("n").alias("compared"))
    right = right.select("ring", "slab", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "point", "label", "vector")

    def best(queries: pa.Table, others: pa.Table) -> pa.Table:
        q, p = queries.column("query").to_numpy(), others.column("point").to_numpy()
        out = [[], [], [], []]
        if len(q) and len(p):
            labels = others.column("label").combine_chunks()
            far = distances(_vectors(queries.column("vector")), _vectors(others.column("vector")))
            for row, own in enumerate(far):
                near = np.lexsort((p, own))[:k + 1]
                near = near[p[near] != q[row]][:k]
                out[0] += [q[row]] * len(near)
                out[1] += p[near].tolist()
                out[2] += labels.take(pa.array(near)).to_pylist()
                out[3] += own[near].tolist()
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                         pa.array(out[3], pa.float64())], names=["query", "point", "label", "distance"])

    key = ["ring", "slab", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(best, "query long, point long, label long, distance double")
    return stored(found, "knn-found"), compared


def knn(points: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
        label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(query, rank, point, label, distance): the k nearest ``points`` of every row
    of ``queries``, a point of the query's own id left out; and (queries, points,
    compared): the pairs compared, out of queries x points.

    Ids are unique in each table; rows with a null vector are left out.
    """
    def vectors(df, *names):
        return df.where(F.col(vec_col).isNotNull()).select(*names, F.col(vec_col).cast("array<double>").alias("vector"))

    pts = vectors(points, F.col(id_col).cast("long").alias("point"), F.col(label_col).cast("long").alias("label"))
    qs = vectors(queries, F.col(id_col).cast("long").alias("query"))
    pivots = [r.vector for r in pts.orderBy(F.xxhash64("point"), "point").limit(PIVOTS).collect()]
    if not pivots:
        none = points.sparkSession.createDataFrame([], "query long, rank int, point long, label long, distance double")
        return none, qs.agg(F.count("*").alias("queries"), F.lit(0).alias("points"), F.lit(0).alias("compared"))
    rings = Rings(np.array(pivots, float))

    def place(batches):
        for batch in batches:
            ring, far = rings.place(_vectors(batch.column("vector"))) if batch.num_rows else (np.zeros(0, np.int64), np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ring, pa.int64()), pa.array(far, pa.float64())],
                                             names=["point", "label", "vector", "ring", "far"])

    placed = stored(pts.mapInArrow(place, "point long, label long, vector array<double>, ring long, far double"), "knn-points")
    rings.summarise(placed.groupBy("ring").agg(F.count("*").alias("n"), F.min("far").alias("low"), F.max("far").alias("high"))
                    .orderBy("ring").collect())          # at most PIVOTS x RINGS rows
    slabs = F.broadcast(points.sparkSession.createDataFrame(
        pd.DataFrame({"ring": rings.ring, "slabs": rings.slabs}), "ring long, slabs long"))
    placed = placed.join(slabs, "ring").withColumn("slab", F.pmod(F.xxhash64("point"), F.col("slabs")))

    found, compared = _search(_visits(qs, rings, k, False), placed, k)
    by_distance = Window.partitionBy("query").orderBy("distance", "point")
    ranked = found.withColumn("rank", F.row_number().over(by_distance)).where(F.col("rank") <= k)
    bound = ranked.where(F.col("rank") == k).select("query", F.col("distance").alias("bound"))
    more = qs.join(bound, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    again, compared2 = _search(_visits(more.select("query", "vector", "bound"), rings, k, True), placed, k)
    out = found.unionByName(again).withColumn("rank", F.row_number().over(by_distance)).where(F.col("rank") <= k)
    report = qs.agg(F.count("*").alias("queries")).join(pts.agg(F.count("*").alias("points"))).join(
        compared.unionByName(compared2).agg(F.coalesce(F.sum("compared"), F.lit(0)).alias("compared")))
    return out.select("query", "rank", "point", "label", "distance"), report


def knn_vote(neighbors: DataFrame) -> DataFrame:
    """(query, pred): the label of most neighbours, the smallest of equal ones."""
    votes = neighbors.groupBy("query", "label").agg(F.count("*").alias("n"))
    return votes.groupBy("query").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("pred"))
