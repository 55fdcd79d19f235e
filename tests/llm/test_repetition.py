"""Repetition figures against plain counting."""

import random
import re

import numpy as np
import pytest

from tessera.llm import repetition as rp
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")

    def covered(n, later_only):
        where = {}
        for i in range(len(words) - n + 1):
            where.setdefault(tuple(words[i:i + n]), []).append(i)
        return {j for at in where.values() if len(at) > 1 for i in at[later_only:] for j in range(i, i + n)}

    lines, seen, dup, dup_chars, chars = (text or "").split("\n"), set(), 0, 0, 0
    for line in lines:
        if WORD.search(line):
            chars += len(line)
            if line in seen:
                dup, dup_chars = dup + 1, dup_chars + len(line)
            seen.add(line)
    n_chars = sum(map(len, words))
    repeat = len(covered(5, 0))
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    shares = {n: sum(len(words[j]) for j in covered(n, 1)) / max(n_chars, 1) for n in rp.NGRAM_LIMITS}
    kept = not failed and dup_chars / max(chars, 1) <= rp.LINE_LIMIT and all(shares[n] <= v for n, v in rp.NGRAM_LIMITS.items())
    return (len(words), n_chars, sum((text or "").count(c) for c in "#*$%&|<>"), dup, repeat, failed, kept,
            *(round(shares[n], 9) for n in rp.NGRAM_LIMITS))


def row(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept,
            *(round(r[f"dup_{n}gram_share"], 9) for n in rp.NGRAM_LIMITS))


def test_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: row(r) for r in rp.repetition_rules(df).collect()}
    assert got == {r.doc_id: brute(r.text) for r in df.collect()}


def test_random_texts_and_edges(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\n", "a " * 500, "one\n\none\n one\none", "  x " * 12, "#|<>&%$* " * 11, "w" * 200000]
    texts += ["".join(rng.choices(["a", "b", "cd", "é", " ", " ", "\n", "\t", "\x0b", "#"], k=rng.randrange(1, 300))) for _ in range(200)]
    rows = [(k, t, True) for k, t in enumerate(texts)] + [(0, None, True), (None, "same words here " * 9, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    got = sorted((str(r.doc_id), row(r)) for r in rp.repetition_rules(df).collect())
    assert got == sorted((str(i), brute(t)) for i, t, _ in rows)
    assert rp.repetition_rules(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [2, 5])
def test_colliding_hashes_fall_back(n, monkeypatch):
    ids, doc = np.array([1, 2, 1, 2, 1, 2, 3, 1, 2, 1, 2, 1] * 3), np.array([0] * 20 + [1] * 16)
    want = rp.duplicate_windows(ids, doc, n)
    monkeypatch.setattr(rp, "mix64", lambda x: x * np.uint64(0))
    got = rp.duplicate_windows(ids, doc, n)
    assert all((a == b).all() for a, b in zip(want, got))


def test_good_documents_are_kept(spark):
    """Documents labelled good that pass the base rule pass the verdict, nearly all."""
    sf = SF001.replace("0.001", "0.01")
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").select("doc_id")
    rows = rp.repetition_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(good, "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept for r in rows]) > 0.98
