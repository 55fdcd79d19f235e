"""The manifest against a plain tree, on odd rows and on trees of several rounds."""

import hashlib
import zlib

import pytest

from tessera.llm import merkle as mk
from tests.conftest import SF001


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """(root, proof of each node as [(before, after)])."""
    proofs, where, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, at in enumerate(where):
            run = at // 16 * 16
            proofs[k].append(("".join(level[run:at]), "".join(level[at + 1:run + 16])))
        level = [sha("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
        where = [at // 16 for at in where]
    return level[0], proofs


def brute(rows):
    """rows (doc_id, source, lang, n_chars, text) -> sorted result rows."""
    by = {}
    for r in rows:
        leaf, text = sha("".join(map(field, r))), r[4]
        if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        by.setdefault(r[1], []).append((r[0], leaf, sha("".join(map(field, (*r[:4], text))))))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([leaf for _, leaf, _ in by[s]])
    root, upper = tree([trees[s][0] for s in sources])
    out = []
    for s, above in zip(sources, upper):
        for (i, leaf, now), proof in zip(by[s], trees[s][1]):
            for before, after in (whole := proof + above):
                now = sha(before + now + after)
            out.append((i, leaf, trees[s][0], root, sha("".join(a + b for a, b in whole)), now, now == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                   for r in mk.manifest(df).collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, node int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_odd_rows(spark):
    rows = [(None, "a", "en", 1, "No Id"), (None, "a", "en", 2, "Other"), (3, None, None, None, None), (4, None, "el", 3, "Ab"),
            (5, "", "en", 0, ""), (5, "a", "en", 4, "SAME ID"), (5, "a", "en", 4, "same id"), (6, "é", "en", 1, "ÉÀ Z"),
            (7, "Z", "en", 1, "😀 Ü" * 3), (8, "\U00010000", "en", 1, "Q"), (9, "\uffff", "en", 1, "Q"), (10, "a", "en", 1, "L" * 300_000)]
    rows += [(11, "twin", "en", 1, "Twin")] * 40 + [(-7, "twin", "en", 9, "Minus")]
    assert rows_of(frame(spark, rows)) == brute(rows)
    assert mk.manifest(frame(spark, []).limit(0)).count() == 0
    one = [(1, "only", "en", 1, "A")]
    assert rows_of(frame(spark, one)) == brute(one)


@pytest.mark.parametrize("sizes", [(1, 16, 17, 256), (257, 4096, 4097), (5000, 33)])
def test_trees_of_several_rounds(spark, sizes):
    rows = [(k * 7 - 100, f"s{j}", "en", k, f"Text {k}") for j, n in enumerate(sizes) for k in range(n)]
    got = rows_of(frame(spark, rows).repartition(5))
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_more_sources_than_a_block(spark):
    rows = [(k, f"s{k % 300}", "en", k, "T") for k in range(700)]
    assert rows_of(frame(spark, rows)) == brute(rows)


def test_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    assert rows_of(df) == brute(rows)
