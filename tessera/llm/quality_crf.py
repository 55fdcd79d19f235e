"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's potential depends on its own features and
on those of its neighbours, and transitions tie neighbouring labels. Forward
and backward passes give each line's marginal; their mean, weighted by line
length, and its log-odds go through a logistic curve to the document score.

Labels name documents, not lines, so the field is fitted in rounds: at first
every line has its document's label, then lines of bad documents that the
fitted field finds good change sides, except each document's worst line.
Training rows are at most ``GOOD`` and ``BAD`` labelled documents that are not
held out, taken by id hash, of at most ``TRAIN_LINES`` lines each.

Defined results: a null or empty text is one empty line and scores as such; a
line without a word is a line; repeated rows score one by one; without labels
of both kinds every score is 0.5; an empty table gives no rows; labels with
null id or null value are ignored, an id labelled twice is good if any row says
so; extra columns of any name are not read.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held_out, map_texts, one_text_each, mix64, texts
from tessera.llm.toxicity import row_weights, sample

THRESHOLD = 0.7
GOOD, BAD, TRAIN_LINES = 3000, 3000, 400
ROUNDS, STEPS = 3, 80

OWN = ("upper", "symbols", "bangs", "digits", "distinct", "doubled", "odd_ends", "seen", "as_before", "length",
       "word_length", "full_stop", "capital")
N_FEATURES = 1 + 3 * len(OWN)
_SPACE, _UPPER, _LETTER, _DIGIT, _STOP, _BANG, _PLAIN, _SYMBOL = range(8)


@cache
def _classes() -> np.ndarray:
    """Class of every code point of the basic plane."""
    out = np.full(1 << 16, _SYMBOL, np.int8)
    for cp in range(1 << 16):
        kind = unicodedata.category(chr(cp))
        if kind in ("Lu", "Lt"):
            out[cp] = _UPPER
        elif kind[0] in "LM":
            out[cp] = _LETTER
        elif kind[0] == "N":
            out[cp] = _DIGIT
        elif kind[0] == "Z":
            out[cp] = _SPACE
    out[[9, 10, 11, 12, 13]] = _SPACE
    for c, kind in ((".?…。", _STOP), ("!", _BANG), (",;:'\"-()’“”«»–—¿¡", _PLAIN)):
        out[[ord(x) for x in c]] = kind
    return out


def line_features(docs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text, line lengths, and lines per text.
    All lines of the slice are measured together over its code points."""
    points = np.frombuffer("\n".join([*docs, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    chars = np.fromiter(map(len, docs), np.int64, len(docs))
    doc_end = np.cumsum(chars + 1) - 1                       # the separator behind each text
    stop = np.flatnonzero(points == 10)
    doc = np.searchsorted(doc_end, stop, "left")
    start = np.concatenate([[0], stop[:-1] + 1])
    n_lines = len(stop)
    size = stop - start
    kind = _classes()[np.minimum(points, 0xFFFF)]

    def count(mask):
        upto = np.concatenate([[0], np.cumsum(mask)])
        return (upto[stop] - upto[start]).astype(float)

    solid = kind != _SPACE
    before = np.concatenate([[False], solid[:-1]])
    w_start = np.flatnonzero(solid & ~before)
    w_end = np.flatnonzero(~solid & before)                  # the last separator closes the last word
    w_line = np.searchsorted(stop, w_start, "right")
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.full(len(points) + 1, base, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    inverse = np.full(len(points) + 1, np.uint64(pow(int(base), -1, 1 << 64)), np.uint64)
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(mix64(points.astype(np.uint64) + np.uint64(1)) * power[:-1])])
    word = (prefix[w_end] - prefix[w_start]) * inverse[w_start]
    line = mix64((prefix[stop] - prefix[start]) * inverse[start] + size.astype(np.uint64))

    words = np.bincount(w_line, minlength=n_lines).astype(float)
    order = np.lexsort((word, w_line))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (word[order][1:] != word[order][:-1]) | (w_line[order][1:] != w_line[order][:-1])
    distinct = np.bincount(w_line[order][fresh], minlength=n_lines)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (w_line[1:] == w_line[:-1])
    odd = kind[w_end - 1] if len(w_end) else np.zeros(0, np.int8)
    odd = (odd == _SYMBOL) | (odd == _BANG)
    first = np.lexsort((np.arange(n_lines), line, doc))
    seen = np.zeros(n_lines, bool)
    seen[first[1:]] = (line[first[1:]] == line[first[:-1]]) & (doc[first[1:]] == doc[first[:-1]])
    as_before = np.zeros(n_lines, bool)
    as_before[1:] = (line[1:] == line[:-1]) & (doc[1:] == doc[:-1])
    blank = words == 0
    letters = count((kind == _UPPER) | (kind == _LETTER))
    w = np.maximum(words, 1)
    chars_ = np.maximum(count(solid), 1)
    last, head = np.maximum(stop - 1, 0), np.minimum(start, len(points) - 1)
    own = np.column_stack([
        count(kind == _UPPER) / np.maximum(letters, 1), count(kind == _SYMBOL) / chars_, count(kind == _BANG) / w,
        count(kind == _DIGIT) / chars_, np.where(blank, 1, distinct / w),
        np.bincount(w_line, weights=same, minlength=n_lines) / w,
        np.bincount(w_line, weights=odd, minlength=n_lines) / w, seen & ~blank, as_before & ~blank,
        np.log1p(size) / 6, np.minimum(chars_ / w, 40) / 10, (kind[last] == _STOP) & (size > 0),
        (kind[head] == _UPPER) & (size > 0)]).astype(float)
    up, down = np.zeros_like(own), np.zeros_like(own)
    inner = doc[1:] == doc[:-1]
    up[1:][inner] = own[:-1][inner]
    down[:-1][inner] = own[1:][inner]
    return np.column_stack([np.ones(n_lines), own, up, down]), size, np.bincount(doc, minlength=len(docs))


def marginals(logit: np.ndarray, n: np.ndarray, trans: np.ndarray, counts: bool = False):
    """Probability of good for every line of chains of ``n`` lines laid end to
    end; ``logit`` are the line potentials of good against bad, ``trans`` the
    log potentials [from, to]. With ``counts`` also the expected transitions.

    All chains step together, longest first, so a step handles the chains that
    are still running."""
    order = np.argsort(-n, kind="stable")
    length = n[order]
    first = (np.cumsum(n) - n)[order]
    a = np.exp(trans - trans.max())
    z = np.clip(logit, -30, 30)
    emit = np.column_stack([1 / (1 + np.exp(z)), 1 / (1 + np.exp(-z))])
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    running = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length.max(initial=0)) + 1)]
    state = None
    for t in range(len(running) - 1):
        k = running[t]
        at = first[:k] + t
        state = emit[at] if t == 0 else emit[at] * (state[:k] @ a)
        state = state / state.sum(axis=1, keepdims=True)
        alpha[at] = state
    pairs = np.zeros((2, 2))
    for t in range(len(running) - 2, 0, -1):
        at = first[:running[t]] + t
        back = emit[at] * beta[at]
        if counts:
            xi = alpha[at - 1][:, :, None] * a[None] * back[:, None, :]
            pairs += (xi / xi.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = back @ a.T
        beta[at - 1] = b / b.sum(axis=1, keepdims=True)
    p = alpha * beta
    p = p[:, 1] / p.sum(axis=1)
    return (p, pairs) if counts else p


def fit_field(x: np.ndarray, n: np.ndarray, bad_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Line weights and transitions from chains with document labels."""
    doc = np.repeat(np.arange(len(n)), n)
    first = np.zeros(len(doc), bool)
    first[(np.cumsum(n) - n)[n > 0]] = True
    y = ~bad_doc[doc]
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    for _ in range(ROUNDS):
        m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
        link = np.zeros((2, 2))
        inner = np.flatnonzero(~first)
        np.add.at(link, (y[inner - 1].astype(int), y[inner].astype(int)), 1)
        for step in range(1, STEPS + 1):
            p, pairs = marginals(x @ w, n, trans, True)
            grad = np.concatenate([x.T @ (y - p) - 1e-2 * w * len(n) / 100, (link - pairs).ravel() - 1e-2 * trans.ravel()]) / len(y)
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
            move = 0.3 * (1 - step / (STEPS + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
            w, trans = w + move[:-4], np.clip(trans + move[-4:].reshape(2, 2), -4, 4)
        p = marginals(x @ w, n, trans)
        worst = np.full(len(n), np.inf)
        np.minimum.at(worst, doc, p)
        y = ~bad_doc[doc] | (p > 0.5) & (p > worst[doc])
    return w, trans


@dataclass
class Model:
    weights: np.ndarray
    trans: np.ndarray
    curve: np.ndarray

    def documents(self, docs: list[str]) -> np.ndarray:
        """Per text: 1, log-odds of the length-weighted mean marginal, share of
        length in lines that are likelier bad."""
        x, size, n = line_features(docs)
        p = marginals(x @ self.weights, n, self.trans)
        doc = np.repeat(np.arange(len(n)), n)
        weight = size + 1.0
        whole = np.bincount(doc, weights=weight, minlength=len(n))
        q = np.clip(np.bincount(doc, weights=weight * p, minlength=len(n)) / whole, 1e-4, 1 - 1e-4)
        bad = np.bincount(doc, weights=weight * (p < 0.5), minlength=len(n)) / whole
        return np.column_stack([np.ones(len(n)), np.log(q / (1 - q)), bad])

    def scores(self, docs: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.documents(docs) @ self.curve, -30, 30)))


def _fit_curve(x: np.ndarray, y: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Logistic curve drawn weakly to a rising one (Newton steps)."""
    prior = np.array([0.0, 1.0, 0.0])
    c = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        step = np.linalg.solve((x * (of * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3), x.T @ ((p - y) * of) + 0.5 * (c - prior))
        c = c - step
        if np.abs(step).max() < 1e-6:
            break
    return c


def fit(docs: DataFrame, labels: DataFrame, good: int = GOOD, bad: int = BAD, train_lines: int = TRAIN_LINES) -> Model:
    """The field and its curve from labelled, not held out documents of ``docs``."""
    # bounded by good + bad rows of two numbers
    train = one_text_each(texts(docs).join(F.broadcast(sample(labels, "quality", good, bad)), "doc_id"))
    train = train.where(F.regexp_count("text", F.lit("\n")) < train_lines)

    def measured(rows: dict) -> dict:
        x, size, n = line_features(rows["text"])
        ends = np.cumsum(n)
        return {"doc_id": rows["doc_id"], "label": rows["label"], "n": n,
                "x": [x[e - k:e].astype(np.float32).tobytes() for e, k in zip(ends, n)],
                "size": [size[e - k:e].tobytes() for e, k in zip(ends, n)]}

    got = map_texts(train, measured, "doc_id long, label int, n int, x binary, size binary").collect()
    got.sort(key=lambda r: (r["doc_id"], r["x"]))
    y = np.array([r["label"] for r in got], float)
    if len(set(y)) < 2:
        return Model(np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(3))
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(r["n"], -1) for r in got]).astype(float)
    n = np.array([r["n"] for r in got])
    weights, trans = fit_field(x, n, y == 0)
    model = Model(weights, trans, np.zeros(3))
    size = np.concatenate([np.frombuffer(r["size"], np.int64) for r in got]) + 1.0
    p, doc = marginals(x @ weights, n, trans), np.repeat(np.arange(len(n)), n)
    whole = np.bincount(doc, weights=size)
    q = np.clip(np.bincount(doc, weights=size * p) / whole, 1e-4, 1 - 1e-4)
    part = np.bincount(doc, weights=size * (p < 0.5)) / whole
    model.curve = _fit_curve(np.column_stack([np.ones(len(n)), np.log(q / (1 - q)), part]), y, row_weights(y, labels, "quality"))
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""

    def scored(rows: dict) -> dict:
        s = model.scores(rows["text"])
        return {"doc_id": rows["doc_id"], "score": s, "predicted": (s >= threshold).astype(np.int32)}

    out = map_texts(texts(docs), scored, "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")
