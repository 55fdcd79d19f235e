"""Quality rules by repetition coverage.

Words are interned per slice of documents; polynomial rolling hashes over the
word numbers give every n-gram of several lengths at once, and sorting the
hashes finds the n-grams that a document holds more than once. Coverage is
measured in characters, for n-grams and for whole lines.

Defined results: a null or empty text has zero counts and fails the base rule;
repeated rows are judged one by one; an empty table gives no rows; extra
columns of any name are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tessera.llm.common import WORD, map_texts, mix64, texts

#: n-gram length -> largest share of word characters that later copies of
#: n-grams of this length may cover in a kept document.
NGRAM_LIMITS = {5: 0.20, 7: 0.19, 10: 0.18}
#: Largest share of line characters in lines equal to an earlier line.
LINE_LIMIT = 0.20
SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_N, REPEAT_PERCENT = 10, 5, 20

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, dup_line_share double, "
          + ", ".join(f"dup_{n}gram_share double" for n in NGRAM_LIMITS))


def duplicate_windows(ids: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all n-word windows inside one document, and for each whether
    the document holds the window twice or more, and whether it is a later copy.

    Equal rolling hashes are compared word by word; a window whose neighbour in
    hash order differs in any word sends its slice to exact grouping instead.
    """
    if len(ids) < n:
        none = np.zeros(0, bool)
        return np.zeros(0, np.int64), none, none
    base = np.uint64(0x9E3779B97F4A7C15)
    key = np.zeros(len(ids) - n + 1, np.uint64)
    word = mix64(ids.astype(np.uint64) + np.uint64(1))
    for k in range(n):
        key = key * base + word[k:len(ids) - n + 1 + k]
    at = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:])
    key = mix64(key[at]) ^ mix64(doc[at].astype(np.uint64) + np.uint64(0x51ED))
    order = np.argsort(key, kind="stable")
    k, a = key[order], at[order]
    same = np.zeros(len(k), bool)
    same[1:] = k[1:] == k[:-1]
    pairs = np.flatnonzero(same)
    equal = doc[a[pairs]] == doc[a[pairs - 1]]
    for j in range(n):
        equal &= ids[a[pairs] + j] == ids[a[pairs - 1] + j]
    if not equal.all():
        rows = np.stack([doc[at], *(ids[at + j] for j in range(n))], axis=1)
        key = np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)
        order = np.argsort(key, kind="stable")
        k = key[order]
        same[1:] = k[1:] == k[:-1]
    twice = same.copy()
    twice[:-1] |= same[1:]
    found, later = np.zeros(len(at), bool), np.zeros(len(at), bool)
    found[order], later[order] = twice, same
    return at, found, later


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(rows: dict) -> dict:
    """All figures of a slice of documents."""
    docs = rows["text"]
    words = [WORD.findall(t) for t in docs]
    n_words = np.array([len(w) for w in words], np.int64)
    flat = [w for ws in words for w in ws]
    doc = np.repeat(np.arange(len(docs)), n_words)
    ids = pd.factorize(np.array(flat, dtype=object))[0] if flat else np.zeros(0, np.int64)
    size = np.fromiter(map(len, flat), np.int64, len(flat))

    def per_doc(weights):
        return np.bincount(doc, weights=weights, minlength=len(docs)).astype(np.int64)

    word_chars = per_doc(size)
    at, found, _ = duplicate_windows(ids, doc, REPEAT_N)
    n_repeat = per_doc(_covered(at[found], REPEAT_N, len(flat)).astype(np.int64))
    shares = {}
    for n in NGRAM_LIMITS:
        at, _, later = duplicate_windows(ids, doc, n)
        shares[n] = per_doc(_covered(at[later], n, len(flat)) * size) / np.maximum(word_chars, 1)

    n_dup, line_share = np.zeros(len(docs), np.int64), np.zeros(len(docs))
    for i, t in enumerate(docs):
        seen, chars, dup_chars = set(), 0, 0
        for line in t.split("\n"):
            if not line.strip(" \t\n\x0b\x0c\r"):
                continue
            chars += len(line)
            if line in seen:
                n_dup[i] += 1
                dup_chars += len(line)
            seen.add(line)
        line_share[i] = dup_chars / max(chars, 1)

    failed = (n_words < MIN_WORDS) | (100 * n_repeat > REPEAT_PERCENT * n_words)
    kept = ~failed & (line_share <= LINE_LIMIT)
    for n, limit in NGRAM_LIMITS.items():
        kept &= shares[n] <= limit
    return {"doc_id": rows["doc_id"], "n_words": n_words, "word_chars": word_chars,
            "n_symbols": [sum(map(t.count, SYMBOLS)) for t in docs], "n_dup_lines": n_dup,
            "n_repeat_words": n_repeat, "base_failed": failed, "kept": kept, "dup_line_share": line_share,
            **{f"dup_{n}gram_share": shares[n] for n in NGRAM_LIMITS}}


def repetition_rules(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, duplicate coverage and the verdict."""
    return map_texts(texts(docs), measure, SCHEMA)
