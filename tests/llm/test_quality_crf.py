"""The line field against enumeration, its features by hand, held-out accuracy."""

import itertools

import numpy as np

from tessera.llm import quality_crf as qc
from tests.conftest import SF01


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    n = np.array([3, 1, 0, 5, 3])
    logit, trans = rng.normal(size=12) * 2, rng.normal(size=(2, 2))
    got, pairs = qc.marginals(logit, n, trans, True)
    at, want, links = 0, [], np.zeros((2, 2))
    for k in n:
        p, z, own = np.zeros(k), 0.0, np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(k)):
            w = np.exp(sum(logit[at + i] * y[i] for i in range(k)) + sum(trans[y[i - 1], y[i]] for i in range(1, k)))
            z += w
            p += w * np.array(y)
            for i in range(1, k):
                own[y[i - 1], y[i]] += w
        want += list(p / z)
        links += own / z
        at += k
    assert np.allclose(got, want) and np.allclose(pairs, links)


def test_line_features():
    x, size, n = qc.line_features(["One two.\nAB CD!!\n\nx x x", "", "Café 12%"])
    own = {k: x[:, 1 + i] for i, k in enumerate(qc.OWN)}
    assert n.tolist() == [4, 1, 1] and size.tolist() == [8, 7, 0, 5, 0, 8]
    assert np.allclose(own["upper"], [1 / 6, 1, 0, 0, 0, 1 / 4])
    assert np.allclose(own["bangs"], [0, 1, 0, 0, 0, 0])
    assert np.allclose(own["digits"], [0, 0, 0, 0, 0, 2 / 7])
    assert np.allclose(own["distinct"], [1, 1, 1, 1 / 3, 1, 1])
    assert np.allclose(own["doubled"], [0, 0, 0, 2 / 3, 0, 0])
    assert np.allclose(own["odd_ends"], [0, 1 / 2, 0, 0, 0, 1 / 2])
    assert own["full_stop"].tolist() == [1, 0, 0, 0, 0, 0] and own["capital"].tolist() == [1, 1, 0, 0, 0, 1]
    k = len(qc.OWN)
    assert np.allclose(x[1, 1 + k:1 + 2 * k], x[0, 1:1 + k]) and np.allclose(x[0, 1 + 2 * k:], x[1, 1:1 + k])
    assert not x[0, 1 + k:1 + 2 * k].any() and not x[3, 1 + 2 * k:].any()      # no neighbour beyond the text
    again, _, _ = qc.line_features(["a b\nc d\na b\na b"])
    assert again[:, 1 + qc.OWN.index("seen")].tolist() == [0, 0, 1, 1]
    assert again[:, 1 + qc.OWN.index("as_before")].tolist() == [0, 0, 0, 1]


def test_slices_do_not_matter():
    docs = ["One two three.\nFOUR!! FIVE!!", "", "x | y | z", "a\n" * 50, "Ends here."]
    whole = qc.line_features(docs)[0]
    assert np.allclose(whole, np.concatenate([qc.line_features([d])[0] for d in docs]))


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    got = {r.doc_id: r for r in qc.score(docs, qc.fit(docs, labels)).collect()}
    assert len(got) == docs.count()
    right = {0: [], 1: []}
    for r in labels.collect():
        g = got[r.doc_id]
        assert 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.7)
        if g.held_out:
            right[r.quality].append(g.predicted == r.quality)
    assert np.mean(right[1]) > 0.97 and np.mean(right[0]) > 0.9


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "One two."), (3, "line\n" * 50000), (4, "word " * 50000), (4, "word " * 50000), (5, "\n\n")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, predicted int")
    none = spark.createDataFrame([(1, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = qc.score(df, qc.fit(df, none)).collect()
    assert len(got) == 7 and {r.score for r in got} == {0.5} and {r.predicted for r in got} == {0}
    some = spark.createDataFrame([(1, 0, 0), (3, 0, 0), (4, 1, 1), (5, 1, 1)], "doc_id long, quality int, toxic int")
    got = qc.score(df, qc.fit(df, some)).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert qc.score(df.limit(0), qc.fit(df.limit(0), some)).count() == 0
