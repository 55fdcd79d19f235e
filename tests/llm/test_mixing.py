"""The mix against the contract's arithmetic and the schedule against counting."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing as mx
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """{source: target} by resharing what is over, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, full, target = 1.5 * sum(sizes.values()), set(), dict.fromkeys(order, 0.0)
    while True:
        free = [s for s in order if s not in full]
        if not free:
            return target
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > 2 * sizes[s]]
        if not over:
            return target | {s: share * weight[s] for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            full.add(s)


def check(rows, got):
    """rows (doc_id, text, source); got the rows of taken()."""
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    target = brute_targets(sizes)
    assert sorted((str(r.doc_id), str(r.source), r["size"]) for r in got) == sorted((str(i), str(s), len(WORD.findall(t or ""))) for i, t, s in rows)
    took = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r["size"]
        took[r.source] += r.taken
    for s in sizes:
        assert abs(took[s] - target[s]) <= 0.5 + 1e-6


def test_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    for block in (mx.BLOCK_WORDS, 16):
        got = mx.taken(df, block).collect()
        check(rows, got)
        assert sorted(map(str, got)) == sorted(map(str, mx.taken(df.repartition(7), block).collect()))


def test_hot_source_and_edge_rows(spark):
    rng = random.Random(4)
    rows = [(k, "w " * rng.randrange(0, 400), "hot") for k in range(300)] + [(1000 + k, "v " * rng.randrange(0, 90), f"s{k % 7}") for k in range(60)]
    rows += [(2000, None, "hot"), (2001, "", "empty"), (2002, "x y z", None), (None, "a b", None), (2003, "x" * 100000, "s1"),
             (2004, "long " * 50000, "s2"), (5, "same row", "s3"), (5, "same row", "s3"), (2005, "É ñ o", "Z")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    for block in (7, 512):
        check(rows, mx.taken(df, block).collect())
    assert mx.taken(df.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mx.taken(none).collect()] == [(0.0, 0)] * 2


def test_schedule_is_even(spark):
    """Every stretch of slots holds each source's share of them, to a few slots."""
    words = {0: 40000, 1: 9000, 2: 1000, 3: 0}
    total, at, rows = sum(words.values()), 0, []
    for k, w in words.items():
        rows.append((k, w, at / total, (at + w) / total))
        at += w
    src = spark.createDataFrame(rows, ["source_no", "words", "from", "to"])
    slots = sorted((r.slot, r.source_no, r["rank"]) for r in mx.schedule(src, 10).collect())
    for k, w in words.items():
        assert [r for _, s, r in slots if s == k] == list(range(w // 10))
    for lo in range(0, 4500, 500):
        part = [s for slot, s, _ in slots if lo <= slot < lo + 500]
        for k, w in words.items():
            assert abs(part.count(k) - 500 * w / total) <= 8


def test_slots_join_equal_blocks(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(k, "w " * rng.randrange(1, 60), f"s{k % 3}") for k in range(200)], "doc_id long, text string, source string")
    parts = mx.mix(df, 32).where("slot is not null")
    size = [r.n for r in parts.groupBy("source", "rank").agg(F.sum("taken").alias("n")).collect()]
    assert max(size) == 32 and sum(n < 32 for n in size) <= 3      # only a source's last slot is cut
    assert parts.where("word_from < 0 or word_to > size or word_from >= word_to").count() == 0


def test_mixed_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    out = mx.mixed_documents(df)
    assert out.columns == df.columns
    want = {r.doc_id: round(r.taken / max(r["size"], 1)) for r in mx.taken(df).collect()}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {k: v for k, v in want.items() if v}


def test_repeated_rows_without_words(spark):
    """One result for each row, also where rows share id, source and place."""
    rows = [(1, None, "a"), (1, None, "a"), (1, "", "a"), (None, " ", "a"), (None, None, "a"), (2, "b c", "a"), (2, "b c", "a")]
    got = mx.taken(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in got) == [("1", 0)] * 3 + [("2", 2)] * 2 + [("None", 0)] * 2
    assert all(r.taken == 0 for r in got if not r["size"])


def test_the_schedule_places_the_words(spark):
    """How much is taken follows the targets; where it stands follows the points."""
    rng = random.Random(9)
    df = spark.createDataFrame([(k, "w " * rng.randrange(1, 200), f"s{k % 4}") for k in range(120)], "doc_id long, text string, source string")
    golden, plain = ({r.doc_id: r for r in mx.taken(df, 32, step).collect()} for step in (mx.STEP, 1))
    assert {k: r.taken for k, r in golden.items()} == {k: r.taken for k, r in plain.items()}
    assert sum(golden[k].first_slot != plain[k].first_slot for k in golden if golden[k].taken) > 60
    assert sum(golden[k].slot_digest != plain[k].slot_digest for k in golden) > 60
    parts = mx.mix(df, 32).where("slot is not null").collect()
    assert {k: r.n_slots for k, r in golden.items() if r.n_slots} == {
        k: sum(p.doc_id == k for p in parts) for k in {p.doc_id for p in parts}}
