"""Repeated-substring removal against a dictionary of all 100-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm import suffix_dedup as sd
from tests.conftest import SF001

W = sd.WINDOW


def brute(rows):
    """[(doc_id, n_bytes, n_removed, n_spans, sha256)] for rows with distinct ids."""
    seen, out = {}, []
    texts = [(i, (t or "").encode()) for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0]))]
    for i, raw in texts:
        gone = np.zeros(len(raw) + 1, bool)
        for s in range(len(raw) - W + 1):
            x = raw[s:s + W]
            if x in seen:
                gone[s:s + W] = True
            else:
                seen[x] = (i, s)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    rows = sd.dedup_substrings(df).drop("kept").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))


def test_documents_match_brute_force(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").repartition(5)
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert sum(r[2] for r in want) > 0
    assert result(df) == want


@pytest.mark.parametrize("seed", range(3))
def test_pasted_passages(spark, seed, monkeypatch):
    """Passages of 90 to 400 bytes pasted anywhere, also next to shared text,
    overlapping themselves, and in runs of one letter."""
    rng = random.Random(seed)
    abc = "abcdefgh \né"
    shared = ["".join(rng.choices(abc, k=rng.randrange(90, 400))) for _ in range(6)] + ["x" * 300, "ab" * 150]
    rows = []
    for i in rng.sample(range(1000), 60):
        parts = []
        for _ in range(rng.randrange(1, 7)):
            p = rng.choice(shared)
            cut = rng.randrange(0, 60)
            parts += ["".join(rng.choices(abc, k=rng.randrange(0, 150))), p[cut:] if rng.random() < 0.5 else p]
        rows.append((i, "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df) == brute(rows)
    # the same with every anchor dealt over several tasks, and long texts cut
    monkeypatch.setattr(sd, "GROUP_ROWS", 3)
    monkeypatch.setattr(sd, "SEGMENT", 150)
    monkeypatch.setattr(sd, "HOT_ROWS", 64)
    monkeypatch.setattr(sd, "SAMPLE", 1)
    assert result(df) == brute(rows)


def test_edge_rows(spark):
    p = "".join(random.Random(9).choices("abcdefghij", k=250))
    rows = [(3, p, "x"), (1, None, None), (2, "", "y"), (None, "zz" + p + "y", "z"), (5, "short", "s"), (7, p, "a"), (7, p, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = result(df)
    assert [r[:4] for r in got] == [(1, 0, 0, 0), (2, 0, 0, 0), (3, 250, 0, 0), (5, 5, 0, 0), (7, 250, 250, 1), (7, 250, 250, 1),
                                    (None, 253, 250, 1)]
    twice = spark.createDataFrame([(4, p), (4, p)], "doc_id long, text string")
    assert [r[2] for r in result(twice)] == [0, 0]     # one place, neither is earlier
    assert result(df.limit(0)) == []


def test_suffix_sort_and_collisions(monkeypatch):
    rng = random.Random(1)
    raw = [bytes(rng.choices(b"ab", k=rng.randrange(0, 40))) for _ in range(500)]
    data = np.frombuffer(b"".join(raw), np.uint8)
    size = np.array(list(map(len, raw)))
    start, group = np.cumsum(size) - size, np.sort(np.array(rng.choices(range(40), k=500)))
    want = sd._plain_sort(data, start, size, group)
    for got in (sd.suffix_sort(data, start, size, group),):
        assert (got[0] == want[0]).all() and (got[1][1:] == want[1][1:]).all()
    # a hash that calls everything equal: the byte check finds out
    monkeypatch.setattr(sd, "_BYTE", np.zeros(256, np.uint64))
    got = sd.suffix_sort(data, start, size, group)
    assert (got[0] == want[0]).all() and (got[1][1:] == want[1][1:]).all()


def test_text_longer_than_a_segment(spark):
    half = "".join(random.Random(4).choices("abcdefghijklmnop ", k=sd.SEGMENT * 3 // 4))
    rows = [(1, half + "|" + half), (2, "q" + half[5:])]
    got = [r[:4] for r in result(spark.createDataFrame(rows, "doc_id long, text string"))]
    n = len(half)
    assert got == [(1, 2 * n + 1, n, 1), (2, n - 4, n - 5, 1)]


def test_group_of_more_bytes_than_a_block(spark, monkeypatch):
    """Distinct spans around one phrase, more of them than the hash tables cover."""
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choices("abcdefghijkl", k=n))
    phrase = letters(80)
    rows = [(i, letters(60) + phrase + letters(60)) for i in range(300)]
    rows += [(300 + i, rows[7 * i][1][:150] + letters(40)) for i in range(30)]
    monkeypatch.setattr(sd, "BLOCK", 1 << 12)
    sd._powers.cache_clear()
    group, n, off = np.zeros(len(rows), np.int64), np.full(len(rows), sd.GRAMS), np.full(len(rows), 60)
    raw = [t[:168].encode() for _, t in rows]
    seen, want = set(), np.zeros((len(rows), sd.GRAMS), np.int8)
    for r, x in enumerate(raw):
        for o in range(sd.GRAMS):
            if o <= 60:
                s = x[60 - o:60 - o + W]
                want[r, o] = 1 if s in seen else 2
                seen.add(s)
    got = sd.repeats(group, group, np.arange(len(rows)), n, off, raw)
    assert len(b"".join(raw)) > 10 * sd.BLOCK and (got == want).all()
    # the bytes decide the parts: the same rows as a job, dealt over many tasks
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)
    sd._powers.cache_clear()


def test_rows_that_share_an_id(spark):
    """Different texts under one id, many of them with equal low hash bits."""
    rng = random.Random(12)
    letters = lambda n: "".join(rng.choices("abcdefghijkl", k=n))
    shared = [letters(150) for _ in range(40)]
    texts = [letters(rng.randrange(60)) + rng.choice(shared)[:rng.randrange(90, 150)] + letters(120) for _ in range(900)]
    df = spark.createDataFrame([(rng.choice([None, 5]), t) for t in texts], "doc_id long, text string").repartition(4)
    rows = sorted(((r.doc_id is None, r.h, r.text) for r in df.selectExpr("*", "xxhash64(text) h").collect()))
    assert len({(none, h & 0x7FFF) for none, h, _ in rows}) < len(rows)
    want = brute([(k, t) for k, (_, _, t) in enumerate(rows)])
    got = [tuple(r)[1:] for r in sd.dedup_substrings(df).drop("kept").collect()]
    assert sorted(got) == sorted(r[1:] for r in want)


def test_repeated_rows_with_open_spans(spark):
    """Wholly equal rows do not repeat each other, also beside a near copy."""
    p = "".join(random.Random(3).choices("abcdefghij", k=300))
    rows = [(1, p), (1, p), (1, p), (2, p[:160] + "!" + p[160:])]
    got = [r[:3] for r in result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))]
    assert got == [(1, 300, 0)] * 3 + [(2, 301, 300)]


def test_memory_of_a_task():
    """What finds and merges the anchors of 24 MB of text takes a bounded share of
    an executor; three Python workers stand beside its heap."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, 200_000, dtype=np.uint8).tobytes().decode() for _ in range(120)]
    batches = [pa.RecordBatch.from_pydict({"doc": pa.array([k]), "digest": pa.array([0]), "text": pa.array([t])}) for k, t in enumerate(texts)]
    sd._powers.cache_clear()
    tracemalloc.start()
    rows = sum(b.num_rows for b in sd._pass_a(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 24_000_000 // sd.GRAMS and peak < 220 << 20
