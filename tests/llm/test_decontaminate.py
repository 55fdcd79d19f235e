"""Hits and items against plain window search."""

import hashlib
import random
import re

import pytest

from tessera.llm import decontaminate as dc
from tests.conftest import SF001

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    known = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[at:at + n]), set()).add("" if i is None else str(i))
    sizes, out = {len(k) for k in known}, []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (own := known.get(tuple(w[at:at + n]))):
                    hit |= set(range(at, at + n))
                    found |= own
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, token int")
    b = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, words string")
    return rows(dc.decontaminate(d.repartition(3), b, **kw))


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def test_documents(spark):
    d, b = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()])
    assert rows(dc.decontaminate(d, b)) == want and any(r[5] for r in want) and not all(r[5] for r in want)


@pytest.mark.parametrize("window,shingle", [(10, 3), (4, 2), (5, 5), (3, 1)])
def test_random_texts(spark, window, shingle, monkeypatch):
    """A small vocabulary: common shingles, windows inside one another, ends of texts."""
    monkeypatch.setattr(dc, "STRETCH", 64)
    monkeypatch.setattr(dc, "WORDS", 16)
    monkeypatch.setattr(dc, "COUNTS", 5)
    rng = random.Random(window)

    def text(n, vocab):
        return "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", "-", "/"]) for _ in range(n))

    vocab = ["a", "B", "cc", "é", "Ünï", "x9", "日本"]
    items = [(k, text(rng.randrange(0, 14), vocab)) for k in range(30)]
    docs = [(k, text(rng.randrange(0, 60), vocab)) for k in range(60)]
    docs += [(100 + k, text(5, vocab) + items[k][1].upper() + text(3, vocab)) for k in range(30)]
    assert got(spark, docs, items, window=window, shingle=shingle) == brute(docs, items, window)


def test_odd_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, passage), (1, "other words here"), (2, passage), (None, passage), (3, None), (4, ""), (5, " .,-! "), (6, "Solo"),
             (7, "zwölf Äpfel"), (8, "never seen anywhere"), (9, "w" * 300_000 + " huge")]
    docs = [(1, None), (2, ""), (None, passage), (None, "x " + passage + " " + passage), (3, "SOLO solo"), (3, "zwölf-Äpfel zwölf äpfel"),
            (4, passage.replace(" ", "--").upper()), (5, "one two three four five six seven eight nine"), (6, "pad " * 200_000 + passage),
            (7, "h" * 500_000 + " eleven " + passage), (8, "w" * 300_000 + " HUGE"), (9, "w" * 300_001 + " huge"), (10, "\x00solo\x00")]
    docs += [(11, "copy " + passage)] * 30
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, docs, []) == brute(docs, [])
    assert got(spark, [], items) == []


def test_words_do_not_join_across_texts(spark):
    items = [(1, "ab cd"), (2, "abcd")]
    assert not any(r[5] for r in got(spark, [(1, "x ab"), (2, "cd y"), (3, "ab"), (4, "cd")], items))
