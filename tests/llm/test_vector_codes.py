"""Codes against whole-number arithmetic in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from tessera.llm import vector_codes as vc
from tests.conftest import SF001


def brute(rows):
    """rows (vec_id, vector, label), all to be kept -> sorted result rows."""
    kept = sorted(((i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // 8

    def parts(v):
        return [v[p * d:p * d + d] for p in range(8)]

    books = [[parts(v)[p] for _, v, _ in kept[:16]] for p in range(8)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(6):
        groups = [[[] for _ in b] for b in books]
        for _, v, _ in kept:
            for p, part in enumerate(parts(v)):
                groups[p][best(part, books[p])[1]].append(part)
        books = [[[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(gs, b)] for gs, b in zip(groups, books)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by = [], {}
    for i, v, lab in kept:
        found = [best(part, books[p]) for p, part in enumerate(parts(v))]
        err = sum(f[0] for f in found)
        by[lab] = by.get(lab, 0) + err
        out.append((i, "".join(f"{f[1]:02x}" for f in found), err, lab))
    return sorted(((i, c, e, by[lab], digest) for i, c, e, lab in out), key=str)


def got(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vc.compress(df).collect()), key=str)


def test_limbs_are_exact():
    rng = random.Random(1)
    for bits, d in ((10, 8), (26, 64), (30, 3), (29, 8)):
        a = np.array([[rng.randrange(-2 ** bits, 2 ** bits + 1) for _ in range(d)] for _ in range(40)], np.int64)
        b = np.array([[rng.randrange(-2 ** bits, 2 ** bits + 1) for _ in range(d)] for _ in range(7)], np.int64)
        a[0], b[0] = -2 ** bits, -2 ** bits
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert vc.exact_dots(a, b.T.copy()).tolist() == want
        assert d * 2 ** (2 * vc.limb_bits(d)) < 2 ** 53


@pytest.mark.parametrize("kind,dims,size", [("float", 64, 1.0), ("double", 16, 30000.0), ("double", 8, 0.001), ("float", 24, 9.0)])
def test_random_vectors(spark, kind, dims, size):
    rng = random.Random(dims)
    rows = [(k * 3 - 40, [float(np.float32(rng.uniform(-size, size))) for _ in range(dims)], k % 4 or None) for k in range(70)]
    rows += [(1000 + k, rows[k % 3][1], 9) for k in range(30)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    assert got(df.repartition(5)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.25, -0.25, 1.0, -1.0, 0.0, -0.0, 0.1, -0.1]
    keep = [(5, v, 1), (5, v, 1), (5, [-x for x in v], None), (None, [1.0] * 8, None), (None, [1.0] * 8, 2), (7, [-1e-9] * 8, 2)]
    drop = [(1, None, 1), (2, [], 1), (3, [nan] + v[1:], 1), (4, v[:7] + [inf], 1), (6, [None] + v[1:], 1), (8, v[:7], 1),
            (9, v * 2, 1), (10, [-inf] * 8, 2), (11, [1e30] * 8, 1)]
    schema = "vec_id long, embedding array<double>, label int, code string, ints int"
    df = spark.createDataFrame([(*r, "x", 3) for r in keep + drop], schema)
    assert got(df) == brute(keep)
    assert vc.compress(df.limit(0)).count() == 0
    assert vc.compress(spark.createDataFrame([(*r, "x", 3) for r in drop if r[0] not in (9,)], schema)).columns == \
        ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_embeddings(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    assert got(df) == brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])
