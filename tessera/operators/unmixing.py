"""Abundances of pixels under constraints, many rows at a time.

Both solvers keep a set of active endmembers per row and solve all rows of the
same set with one small system, so a batch costs a few matrix products whatever
its rows do. Every row carries its own certificate: a duality gap or the largest
violation of the optimality conditions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A multiplier or step below this share of the data's scale counts as zero.
TOLERANCE = 1e-12


def _by_set(active: np.ndarray):
    """(columns, rows) for every distinct active set."""
    sets, which = np.unique(active, axis=0, return_inverse=True)
    which = which.reshape(-1)
    for k, s in enumerate(sets):
        yield np.flatnonzero(s), np.flatnonzero(which == k)


def simplex_ls(x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Abundances a >= 0 with sum 1 that minimise |x - a.ends|**2 / 2, for every row
    of ``x``, and their duality gaps.

    Primal active sets: a row starts at its nearest endmember; the least-squares
    mixture of its set is taken whole if it is not negative, else as far as the
    first abundance that reaches zero, which leaves the set; a row at its set's
    optimum takes in the endmember with the most negative multiplier. With g the
    gradient, max over mixtures of g.(a - b) bounds how far a row is from the
    optimum; that is the gap.
    """
    n, k = len(x), len(ends)
    gram, cross = ends @ ends.T, x @ ends.T
    scale = max(float(np.abs(gram).max(initial=0)), 1e-300)
    start = (np.diag(gram) - 2 * cross).argmin(1) if n else np.zeros(0, int)
    a = np.zeros((n, k))
    a[np.arange(n), start] = 1.0
    active, todo = a > 0, np.arange(n)
    for _ in range(20 * k):
        if not len(todo):
            break
        z = np.zeros((len(todo), k))
        for cols, rows in _by_set(active[todo]):
            m = len(cols)
            kkt = np.ones((m + 1, m + 1))
            kkt[:m, :m], kkt[m, m] = gram[np.ix_(cols, cols)], 0
            rhs = np.ones((m + 1, len(rows)))
            rhs[:m] = cross[todo[rows]][:, cols].T
            z[np.ix_(rows, cols)] = np.linalg.lstsq(kkt, rhs, rcond=None)[0][:m].T
        own, was = active[todo], a[todo]
        below = own & (z < 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(below, was / (was - z), np.inf)
        reach = step.min(1)
        inside = ~below.any(1)
        part = np.minimum(reach, 1.0)[:, None]
        new = np.where(inside[:, None], z, was + part * (z - was))
        gone = below & (step <= reach[:, None])
        new[gone], own = 0.0, own & ~gone
        new = np.maximum(new, 0)
        a[todo], active[todo] = new, own
        grad = new @ gram - cross[todo]
        level = np.where(own, grad, 0).sum(1) / np.maximum(own.sum(1), 1)
        lead = np.where(own, np.inf, grad - level[:, None])
        enter = lead.argmin(1)
        grows = inside & (lead[np.arange(len(todo)), enter] < -TOLERANCE * scale)
        active[todo[grows], enter[grows]] = True
        todo = todo[~inside | grows]
    a /= np.maximum(a.sum(1, keepdims=True), 1e-300)
    grad = a @ gram - cross
    gap = (grad * a).sum(1) - grad.min(1, initial=np.inf) if n else np.zeros(0)
    return a, gap


def l1_path(x: np.ndarray, ends: np.ndarray, shares: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Abundances that minimise |x - a.ends|**2 / 2 + t |a|_1 for t = share * (the
    least t that makes the row zero), for every row and share in falling order,
    and the largest violation of the optimality conditions: (row, share, end)
    and (row, share).

    Each row goes down the path from its last solution, by active sets with
    signs: with the signs held, the aim is a quadratic whose optimum is taken
    whole if it fits them, else as far as the first abundance that reaches zero,
    which leaves; at the optimum of its signs a row takes in the endmember that
    violates its condition most.
    """
    n, k = len(x), len(ends)
    gram, cross = ends @ ends.T, x @ ends.T
    most = np.abs(cross).max(1, initial=0)
    a, signs = np.zeros((n, k)), np.zeros((n, k))
    out, off = np.zeros((n, len(shares), k)), np.zeros((n, len(shares)))
    for s, share in enumerate(shares):
        t, todo = share * most, np.arange(n)
        for _ in range(20 * k):
            if not len(todo):
                break
            z = np.zeros((len(todo), k))
            for kind, rows in _by_sign(signs[todo]):
                cols = np.flatnonzero(kind)
                if len(cols):
                    rhs = cross[todo[rows]][:, cols] - t[todo[rows], None] * kind[cols]
                    z[np.ix_(rows, cols)] = np.linalg.lstsq(gram[np.ix_(cols, cols)], rhs.T, rcond=None)[0].T
            own, was = signs[todo], a[todo]
            below = z * own < 0
            with np.errstate(divide="ignore", invalid="ignore"):
                step = np.where(below, was / (was - z), np.inf)
            reach, inside = step.min(1), ~below.any(1)
            new = np.where(inside[:, None], z, was + np.minimum(reach, 1.0)[:, None] * (z - was))
            gone = below & (step <= reach[:, None])
            new[gone], own[gone] = 0.0, 0.0
            grad = cross[todo] - new @ gram
            over = np.where(own != 0, 0, np.abs(grad) - t[todo, None])
            enter = over.argmax(1)
            grows = inside & (over[np.arange(len(todo)), enter] > TOLERANCE * np.maximum(most[todo], 1e-300))
            own[grows, enter[grows]] = np.sign(grad[grows, enter[grows]])
            a[todo], signs[todo] = new, own
            todo = todo[~inside | grows]
        grad = cross - a @ gram
        off[:, s] = np.where(a != 0, np.abs(grad - t[:, None] * np.sign(a)), np.maximum(np.abs(grad) - t[:, None], 0)).max(1, initial=0)
        out[:, s] = a
    return out, off


def _by_sign(signs: np.ndarray):
    """(signs, rows) for every distinct row of signs."""
    kinds, which = np.unique(signs, axis=0, return_inverse=True)
    which = which.reshape(-1)
    for k, row in enumerate(kinds):
        yield row, np.flatnonzero(which == k)


def unmix_simplex(df: DataFrame, id_col: str, vec_col: str, ends: np.ndarray) -> DataFrame:
    """(id, abundance, residual, gap): the mixture nearest to each pixel."""
    def run(batches):
        for pdf in batches:
            x = np.stack(pdf[vec_col].to_numpy()).astype(float) if len(pdf) else np.zeros((0, ends.shape[1]))
            a, gap = simplex_ls(x, ends)
            yield pd.DataFrame({id_col: pdf[id_col].to_numpy(), "abundance": list(a),
                                "residual": np.sqrt(((x - a @ ends) ** 2).sum(1)), "gap": gap})

    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("abundance", T.ArrayType(T.DoubleType())),
                           T.StructField("residual", T.DoubleType()), T.StructField("gap", T.DoubleType())])
    return df.select(id_col, F.col(vec_col).cast("array<double>").alias(vec_col)).mapInPandas(run, schema)


def unmix_sparse(df: DataFrame, id_col: str, vec_col: str, ends: np.ndarray, shares: list[float]) -> DataFrame:
    """(id, share, abundance, active, residual, violation): sparse mixtures of each
    pixel along the path of penalties (E8)."""
    shares = sorted(shares, reverse=True)

    def run(batches):
        for pdf in batches:
            x = np.stack(pdf[vec_col].to_numpy()).astype(float) if len(pdf) else np.zeros((0, ends.shape[1]))
            a, off = l1_path(x, ends, shares)
            gap = x[:, None, :] - a @ ends
            yield pd.DataFrame({id_col: np.repeat(pdf[id_col].to_numpy(), len(shares)), "share": np.tile(shares, len(x)),
                                "abundance": list(a.reshape(-1, len(ends))), "active": (a != 0).sum(2).ravel(),
                                "residual": np.sqrt((gap ** 2).sum(2)).ravel(), "violation": off.ravel()})

    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("share", T.DoubleType()),
                           T.StructField("abundance", T.ArrayType(T.DoubleType())), T.StructField("active", T.LongType()),
                           T.StructField("residual", T.DoubleType()), T.StructField("violation", T.DoubleType())])
    return df.select(id_col, F.col(vec_col).cast("array<double>").alias(vec_col)).mapInPandas(run, schema)
