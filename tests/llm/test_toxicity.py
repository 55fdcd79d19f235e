"""The clause grammar by hand, its training, and held-out accuracy."""

import zlib

import numpy as np
import pytest

from tessera.llm import toxicity as tx
from tests.conftest import SF01

PLAIN = tx.Model({"idiot": 3.0}, {"drat": 2.0}, tx.PRIOR)


def weights(text):
    """{(pattern, modifier): weight} of a text."""
    x = PLAIN.features(text, {})
    if x is None:
        return {}
    names = [(p, m) for p in tx.PATTERNS for m in tx.MODIFIERS]
    return {n: round(float(np.expm1(v)), 6) for n, v in zip(names, x) if v}


@pytest.mark.parametrize("text, want", [
    ("An idiot came.", {("insult", "asserted"): 3.0}),
    ("You are an IDIOT!", {("insult+target", "asserted"): 3.0}),
    ("you are not an idiot", {("insult+target", "negated"): 3.0}),
    ("you are not, idiot", {("insult", "asserted"): 3.0}),            # the comma ends the clause
    ("not one of them was the idiot", {("insult+target", "asserted"): 3.0}),  # out of the negation's reach
    ("she said he is an idiot", {("insult+target", "reported"): 3.0}),
    ("dratted idiot", {("insult", "asserted"): 5.0}),
    ("they kill time", {("threat+target", "asserted"): 2.0}),
    ("to kill time", {}), ("hello you", {}), ("", {}), ("###idiot%%%", {("insult", "asserted"): 3.0}),
])
def test_grammar(text, want):
    assert weights(text) == want


def test_stronger_patterns_score_higher():
    s = [PLAIN.score(PLAIN.features(t, {})) for t in ("a fine day", "he said you are no idiot", "an idiot", "you idiot")]
    assert s == sorted(s) and s[0] < 0.1 and s[-1] > 0.5


def test_composition_is_the_product():
    arcs, has_target = tx.composed()
    assert len(arcs) == 4 * 2 * 2 and sum(has_target) == len(arcs) // 2
    assert all(len(row) == 6 and all(0 <= to < len(arcs) for to, _, _ in row) for row in arcs)


def test_held_out_documents(spark):
    sf = SF01.replace("0.01", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = tx.fit(docs, labels)
    got = {r.doc_id: r for r in tx.score(docs, model).collect()}
    assert len(got) == docs.count()
    right = {0: [], 1: []}
    for r in labels.collect():
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3)
        if g.held_out:
            right[r.toxic].append(g.predicted == r.toxic)
    assert np.mean(right[1]) > 0.9 and np.mean(right[0]) > 0.97
    left = tx.without_toxic(docs, model)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.select("doc_id").collect()} == {i for i, g in got.items() if not g.predicted}


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "you idiot"), (3, "idiot " * 60000), (3, "a fine day"), (4, "fine"), (4, "fine")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        model = tx.fit(df, labels)
        got = sorted((str(r.doc_id), round(r.score, 9), r.predicted) for r in tx.score(df, model).collect())
        bias = round(1 / (1 + np.exp(3.5)), 9)
        assert len(got) == 7 and got[0] == ("1", bias, 0) and got[1] == ("2", bias, 0) and got[4] == got[5]
        assert [g[2] for g in got] == [0, 0, 0, 1, 0, 0, 1]
    assert tx.score(df.limit(0), model).count() == 0


def test_one_training_row_per_id(spark):
    """The bound on sampled ids is a bound on rows: repeated ids add none."""
    from tessera.llm.common import one_text_each

    rows = [(1, 0, "b"), (1, 0, "a"), (1, 0, "a"), (2, 1, None), (2, 1, "x")] + [(3, 1, f"t{k}") for k in range(500)]
    got = one_text_each(spark.createDataFrame(rows, "doc_id long, label int, text string").repartition(5)).collect()
    assert sorted((r.doc_id, r.label) for r in got) == [(1, 0), (2, 1), (3, 1)]
    assert {r.doc_id: r.text for r in got}[1] in ("a", "b")


PHRASES = [
    ("I am going to burn your house down", "threat chain", "asserted"),
    ("we will hurt you", "threat chain", "asserted"),
    ("I will never hurt you", "threat chain", "negated"),
    ("he says I will break your legs", "threat chain", "reported"),
    ("je vais brûler ta maison", "threat chain", "asserted"),
    ("we will cut your costs", None, None),            # no victim: costs are not a body or a home
    ("the fire will burn your house", None, None),      # no speaker
    ("I will burn. your house", None, None),            # the full stop ends the clause
    ("you people should all die", "ill wish", "asserted"),
    ("I hope you rot", "ill wish", "asserted"),
    ("you should not die", "ill wish", "negated"),
    ("we hope the flowers die", None, None),
    ("what a stupid idiot", "intensified insult", "asserted"),
    ("stupid, idiot", None, None),
]


@pytest.mark.parametrize("text, phrase, how", PHRASES)
def test_phrases_of_several_words(text, phrase, how):
    x = PLAIN.features(text, {})
    at = len(tx.PATTERNS) * len(tx.MODIFIERS)
    names = [(p, m) for p in tx.PHRASES for m in tx.MODIFIERS]
    got = [] if x is None else [n for n, v in zip(names, x[at:]) if v]
    assert got == ([(phrase, how)] if phrase else [])
    if phrase in ("threat chain", "ill wish"):
        assert (PLAIN.score(x) >= tx.THRESHOLD) == (how == "asserted")


def _alter(monkeypatch):
    """The grammar without its negation and report transducers."""
    tx.composed.cache_clear()
    tx.phrase_product.cache_clear()
    monkeypatch.setattr(tx, "_negation", plain := lambda state, cls: (0, ""))
    monkeypatch.setattr(tx, "TRANSDUCERS", (tx._insult, tx._target, plain, plain))
    monkeypatch.setattr(tx, "_report", plain)


def test_negation_and_report_decide(spark, monkeypatch):
    """The fitted grammar parts what asserts from what denies or reports, on
    words of its own lexicon; without the two transducers it can't."""
    heads = ["idiot", "moron", "imbecile", "scum", "vermin", "asshole"]
    toxic = ["you are such a {} today", "he is a real {} and everybody knows", "you {} listen"]
    clean = ["you are not a {} today", "she said he is a {} and everybody laughed", "he is no {} at all"]
    rows, labels = [], []
    for k in range(1200):
        form = (toxic if k % 2 else clean)[k // 2 % 3]
        rows.append((k, f"number {k * 7919 % 997} of the day. " + form.format(heads[k // 6 % 6])))
        labels.append((k, k % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels_ = spark.createDataFrame(labels, "doc_id long, toxic int")

    def accuracy(model):
        got = [(model.score(model.features(t, {})) >= tx.THRESHOLD) == bool(y)
               for (i, t), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 4 == 2]
        assert len(got) > 200
        return np.mean(got)

    whole = accuracy(tx.fit(docs, labels_))
    _alter(monkeypatch)
    try:
        # driver-side fit of the same lexicon and layer, so that the altered grammar is what is measured
        base = tx.Model({}, {}, tx.PRIOR)
        train = [(t, y) for (i, t), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 4 != 2]
        x = np.array([base.features(t, {}) for t, _ in train])
        base.layer = tx.fit_layer(x, np.array([y for _, y in train], float), np.ones(len(train)))
        without = accuracy(base)
    finally:
        monkeypatch.undo()
        tx.composed.cache_clear()
        tx.phrase_product.cache_clear()
    assert whole > 0.97 and without < 0.85, (whole, without)


def test_fitted_on_documents(spark):
    """On the tables' labels, too, denying and reporting change the prediction."""
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.fit(docs, labels)
    s = lambda t: model.score(model.features(t, {}))
    assert s("He is an idiot.") >= tx.THRESHOLD and s("You idiot!") >= tx.THRESHOLD
    assert s("He is not an idiot.") < tx.THRESHOLD
    assert s("She said he is an idiot.") < s("He is an idiot.")
    for t in ("I am going to burn your house down", "you people should all die"):
        assert s(t) >= tx.THRESHOLD, t
    for t in ("We will cut your costs", "I will never hurt you", "The fire will burn the house"):
        assert s(t) < tx.THRESHOLD, t
