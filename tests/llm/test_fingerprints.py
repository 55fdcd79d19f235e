"""Fingerprints: the walk step by step, likeness under edits, the job's rows."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm import fingerprints as fp
from tests.conftest import SF001


def slow_arrivals(text):
    """The same walk one step at a time, from the step bits."""
    bits = np.random.default_rng(77).integers(0, 2, (fp.PERIOD, fp.CLASSES), dtype=np.int8).astype(bool)
    bits[0] = True
    t, out = 0, []
    for c in fp.points_of(text):
        out.append(t)
        cls = int(fp.mix64(np.array([c], np.uint64))[0] % np.uint64(fp.CLASSES))
        while not bits[t % fp.PERIOD][cls]:
            t += 1
        t += 1
    return out, t


@pytest.mark.parametrize("text", ["", "a", "hello world", "aé日😀" * 40, "z" * 9000, "".join(random.Random(1).choices("abcdef ", k=12000))])
def test_walk(text, monkeypatch):
    for stride in (fp.STRIDE, 37):
        monkeypatch.setattr(fp, "STRIDE", stride)
        walk = fp.Walk().feed(fp.points_of(text))
        want, end = slow_arrivals(text)
        assert (np.concatenate(walk.arrive).tolist() if walk.arrive else []) == want and walk.step == end
        for n in (0, len(text) // 3, len(text)):
            again = walk.upto(n).feed(fp.points_of("tail"))
            assert again.fingerprint() == fp.fingerprint(text[:n] + "tail")


def test_likeness_follows_edit_distance():
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(300)]
    near = {0.002: [], 0.02: [], 0.1: []}
    for _ in range(20):
        text = " ".join(rng.choices(words, k=300))
        own = fp.fingerprint(text)
        assert fp.likeness(own, own) == 1.0
        assert fp.likeness(own, fp.fingerprint(" ".join(rng.choices(words, k=300)))) < 0.25
        for rate, found in near.items():
            t = list(text)
            for _ in range(max(1, int(len(t) * rate))):
                i = rng.randrange(len(t))
                t[i:i + rng.randrange(2)] = rng.choice(["", "q", "xy"])
            found.append(fp.likeness(own, fp.fingerprint("".join(t))))
    means = [np.mean(v) for v in near.values()]
    assert means[0] > 0.85 and means[0] > means[1] > means[2]


def brute(rows):
    """The contract, row by row; rows (doc_id, text) with distinct ids."""
    rows = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is None, r[0], r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(t) // 4
        e = t[:len(t) - n] + after[:n]
        a, b = fp.fingerprint(t), fp.fingerprint(e)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, fp.fingerprint(after))))
    return out


def result(df):
    return sorted((tuple(r) for r in fp.fingerprints(df).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def test_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").repartition(4)
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert result(df) == key(want)
    # the edit keeps three quarters; unrelated neighbours share next to nothing
    long = [r for r in want if r[1] > 400]
    assert np.median([r[5] for r in long]) > 0.6 > 0.2 > np.median([r[6] for r in long])


def test_edge_rows(spark):
    rows = [(5, None), (2, ""), (9, "x"), (7, "short text"), (7, "short text"), (3, "é😀" * 50000), (None, "no id")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, fingerprint string").repartition(3)
    assert result(df) == key(brute(rows))
    one = spark.createDataFrame([(1, "alone alone alone")], "doc_id long, text string")
    assert result(one) == brute([(1, "alone alone alone")])
    assert result(df.limit(0)) == []


def test_near_pairs(spark):
    rng = random.Random(8)
    base = ["".join(rng.choices("abcdefgh ijkl", k=1500)) for _ in range(20)]
    rows = [(k, t) for k, t in enumerate(base)] + [(100 + k, t[:700] + "!" + t[700:]) for k, t in enumerate(base[:8])] + [(200, base[0])]
    got = {(r.doc_id, r.other_id) for r in fp.near_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(k, 100 + k) for k in range(8)} | {(0, 200)}


def test_near_pairs_of_a_family(spark):
    """Texts of one template, most of them unlike: near copies inside it are
    linked though the smallest of their bands is a third text."""
    rng = random.Random(18)
    letters = lambda n: "".join(rng.choices("abcdefgh ijkl", k=n))
    template = [letters(160) for _ in range(12)]
    base = [" ".join(p if rng.random() < 0.86 else letters(160) for p in template) for _ in range(150)]
    rows = list(enumerate(base)) + [(200 + k, t[:900] + "!" + t[900:]) for k, t in enumerate(base)]
    prints = {i: fp.fingerprint(t) for i, t in rows}
    cut = lambda f: {(k, f[12 + k:12 + k + fp.BAND]) for k in range(0, fp.SAMPLES, fp.BAND)}
    near = {(i, j) for i in prints for j in prints if i < j and fp.likeness(prints[i], prints[j]) >= fp.ALIKE
            and cut(prints[i]) & cut(prints[j])}
    got = [(r.doc_id, r.other_id, r.likeness) for r in fp.near_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    pairs = {(i, j) for i, j, _ in got}
    assert pairs <= near and len(pairs) == len(got)
    assert all(v == fp.likeness(prints[i], prints[j]) for i, j, v in got)
    name, moved = {i: i for i in prints}, True
    while moved:
        moved = False
        for i, j in pairs:
            if name[i] != name[j]:
                name[i] = name[j] = min(name[i], name[j])
                moved = True
    assert all(name[i] == name[j] for i, j in near)
