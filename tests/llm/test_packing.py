"""Packing: tokens against the tokenizer itself, places against the contract."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing as pk
from tests.conftest import SF001

TOKENIZER = Tokenizer.from_file(pk.default_tokenizer())


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, pk.END_TOKEN]


def check(rows, out):
    """Every piece is right, sequences are gapless and within capacity."""
    want = []
    for doc, text in rows:
        ids = np.array(ids_of(text), "<u4")
        want += [(doc, k, k * pk.CAPACITY, len(p := ids[k * pk.CAPACITY:(k + 1) * pk.CAPACITY]), zlib.crc32(p.tobytes()))
                 for k in range(-(-len(ids) // pk.CAPACITY))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([tuple(r)[:5] for r in out], key=key) == sorted(want, key=key)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= pk.CAPACITY
    return len(bins)


def test_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    out = pk.packed(df).collect()
    n = check([(r.doc_id, r.text) for r in df.collect()], out)
    least = -(-sum(r.length for r in out) // pk.CAPACITY)
    assert n <= least + 1


def test_edge_rows(spark):
    long = "word another " * 9000
    rows = [(1, None, 1), (2, "", 2), (None, "null id", 3), (3, long, 4), (3, long, 5), (4, " \n\t", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length long")
    check([(r[0], r[1]) for r in rows], pk.packed(df).collect())
    assert pk.packed(df.limit(0)).collect() == []


def test_sequences_hold_the_ids(spark):
    rows = [(k, "some words " * (k * 37 % 900)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for r in pk.sequences(df).collect():
        ids, at = np.frombuffer(r.ids, "<u4"), 0
        assert len(ids) == r.length == sum(r.piece_lengths)
        for n in r.piece_lengths:
            got.append(tuple(ids[at:at + n]))
            at += n
    assert sorted(got) == sorted(tuple(ids_of(t)) for _, t in rows)


def test_word_cache_equals_tokenizer(monkeypatch):
    rng = random.Random(2)
    abc = list("abcXYZ09'!.,-%|<>_\"#$*()²½ªºµß éÀÖüñÿİΑΣςé́日本​\x01\x1c\x85\xa0 \n\t\x0b😀") + [
        "'s", "'re", "'ll", "<|endoftext|>", "<|startoftext|>", "don't", "I'VE", " ", " ", " "]
    texts = ["".join(rng.choices(abc, k=rng.randrange(0, 60))) for _ in range(4000)]
    for bound in (800_000, 3000, 5):
        monkeypatch.setattr(pk, "CACHE_WORDS", bound)
        cache = pk.WordIds(pk.default_tokenizer())
        for at in range(0, len(texts), 500):
            ids, ends = cache.encode(pa.array(texts).slice(at, 500), 1)
            for k, t in enumerate(texts[at:at + 500]):
                assert ids[ends[k]:ends[k + 1]].tolist() == ids_of(t), repr(t)


@pytest.mark.parametrize("seed", range(4))
def test_best_two_fit(seed):
    rng = random.Random(seed)
    n = np.array([min(100, int(rng.expovariate(0.04)) + 1) for _ in range(rng.randrange(1, 800))])
    bins, offsets = pk.best_two_fit(n, 100)
    fill = np.bincount(bins, weights=n)
    assert fill.max() <= 100 and fill.min() > 0
    for b in range(len(fill)):
        own = sorted((offsets[i], n[i]) for i in np.flatnonzero(bins == b))
        assert [o for o, _ in own] == np.cumsum([0, *(k for _, k in own)])[:-1].tolist()
    assert len(fill) <= -(-n.sum() // 100) + 2


def test_the_exchange_takes_the_tightest_pair():
    # 60 + 30 leaves 10; exchanging 30 for 22 + 18 closes the bin
    bins, _ = pk.best_two_fit(np.array([60, 30, 22, 18]), 100)
    assert bins[0] == bins[2] == bins[3] != bins[1]


def test_equal_pieces_spread_over_all_shards(spark):
    """Identical rows (null ids, empty texts) are not one group."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(None, "") for _ in range(2000)], "doc_id long, text string").repartition(4)
    cut = pk.stored(pk.pieces(df), "equal-pieces")
    out = pk.pack(cut, shard_pieces=100)
    sizes = [r["count"] for r in out.groupBy(F.shiftright("sequence_id", 32).alias("shard")).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 200 and sum(sizes) == 2000
