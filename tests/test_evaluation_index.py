"""AUC against all pairs, calibration bins, and the positional index against the texts."""

import random

from pyspark.sql import functions as F

from tessera.operators import index, metrics


def test_auc_counts_every_pair(spark):
    rng = random.Random(3)
    for scores in ([rng.randrange(6) for _ in range(200)], [rng.random() for _ in range(90)], [1, 1, 1]):
        rows = [(float(s), int(rng.random() < 0.4)) for s in scores] + [(None, 1), (0.5, None)]
        kept = [r for r in rows if None not in r]
        pairs = [(p, n) for p, a in kept if a for n, b in kept if not b]
        got = metrics.roc_auc(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
        want = sum((p > n) + 0.5 * (p == n) for p, n in pairs) / len(pairs) if pairs else None
        assert got.auc is None if want is None else abs(got.auc - want) < 1e-12
        assert (got.positives, got.negatives) == (sum(y for _, y in kept), sum(1 - y for _, y in kept))
    assert metrics.roc_auc(spark.createDataFrame([(1.0, 1)], "s double, y int"), "s", "y").first().auc is None
    assert metrics.roc_auc(spark.createDataFrame([], "s double, y int"), "s", "y").first().positives == 0


def test_calibration(spark):
    df = spark.createDataFrame([(0.0, 0), (0.05, 1), (1.0, 1), (0.95, 1), (0.3, 0)], "p double, y int")
    got = {r.bin: (r.n, round(r.mean_score, 3), r.share) for r in metrics.calibration(df, "p", "y").collect()}
    assert got == {0: (2, 0.025, 0.5), 9: (2, 0.975, 1.0), 3: (1, 0.3, 0.0)}


def test_index_and_phrases(spark):
    rng = random.Random(5)
    docs = [(k * 3, [rng.choice(["a", "b", "c"]) for _ in range(rng.randrange(0, 30))]) for k in range(80)]
    df = spark.createDataFrame(docs, "id long, w array<string>")
    lists = index.inverted_index(index.word_positions(df, "id", F.col("w")), "id", span=50)
    got = {}
    for r in lists.collect():
        assert [p.id // 50 for p in r.postings] == [r.part] * r.docs and [p.id for p in r.postings] == sorted(p.id for p in r.postings)
        assert r.occurrences == sum(len(p.positions) for p in r.postings)
        for p in r.postings:
            got[r.word, p.id] = p.positions
    assert got == {(w, i): [k for k, x in enumerate(ws) if x == w] for i, ws in docs for w in set(ws)}
    for phrase in (["a"], ["a", "b"], ["a", "a"], ["a", "b", "a", "b"], ["a", "zz"]):
        found = {(r.id, r.pos) for r in index.phrase_search(lists, "id", phrase).collect()}
        assert found == {(i, k) for i, ws in docs for k in range(len(ws)) if ws[k:k + len(phrase)] == phrase}


def test_lists_are_sorted_without_a_comparator(spark):
    """A comparator given as an expression is evaluated row by row; the order is the same."""
    docs = [(7, ["b", "a"]), (2, ["a", "b", "a"]), (7, ["a"]), (None, ["a"])]
    lists = index.inverted_index(index.word_positions(spark.createDataFrame(docs, "id long, w array<string>"), "id", F.col("w")), "id", span=50)
    assert {(r.word, r.part): [tuple(p) for p in r.postings] for r in lists.collect()} == {
        ("a", 0): [(2, [0, 2]), (7, [0, 1])], ("b", 0): [(2, [1]), (7, [0])], ("a", None): [(None, [0])]}
    plan = lists._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" in plan and "array_sort" not in plan


def test_positions_move_once(spark):
    """One shuffle, by word and part; ids below zero, of each width, null and repeated."""
    for kind in ("tinyint", "int", "long"):
        docs = [(-1, ["a", "b", "a"]), (-50, ["a"]), (-51, ["a", "a"]), (0, ["b"]), (99, ["a", "b"]), (99, ["b", "a"]), (None, ["a"]), (None, ["c", "a"])]
        words = index.word_positions(spark.createDataFrame(docs, f"id {kind}, w array<string>"), "id", F.col("w"))
        lists = index.inverted_index(words, "id", span=50)
        assert lists.schema["postings"].dataType.elementType["id"].dataType.simpleString() == words.schema["id"].dataType.simpleString()
        got = {(r.word, r.part): (r.docs, r.occurrences, [tuple(p) for p in r.postings]) for r in lists.collect()}
        assert got == {("a", -2): (1, 2, [(-51, [0, 1])]), ("a", -1): (2, 3, [(-50, [0]), (-1, [0, 2])]), ("b", -1): (1, 1, [(-1, [1])]),
                       ("b", 0): (1, 1, [(0, [0])]), ("a", 1): (1, 2, [(99, [0, 1])]), ("b", 1): (1, 2, [(99, [0, 1])]),
                       ("a", None): (1, 2, [(None, [0, 1])]), ("c", None): (1, 1, [(None, [0])])}
        assert lists._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    lists = index.inverted_index(spark.createDataFrame([("x", "a", 1), ("x", "a", 0)], "id string, word string, pos int")
                                 .withColumn("id", F.lit(1.5)), "id", span=1)
    assert [tuple(p) for p in lists.first().postings] == [(1.5, [0, 1])]
