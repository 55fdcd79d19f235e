"""Near-duplicate components against all pairs, and the edge cases."""

import random
import re

import numpy as np
import pytest

from tessera.llm import near_dedup as nd
from tessera.llm.graph import components
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else ({tuple(words)} if words else set())


def brute(rows):
    """{doc_id: (n_shingles, component)} by all pairs and union-find."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1:]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(df).collect()}


def test_documents_match_brute_force(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    assert result(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_family_with_chains_and_a_middling_crowd(spark):
    """A long chain of small edits, and many texts of one template that are
    alike but below the threshold: several rounds of pivots."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(4000)]
    rows, doc = [], 0
    text = rng.choices(words, k=120)
    for _ in range(60):
        text = list(text)
        text[rng.randrange(120)] = rng.choice(words)
        rows.append((doc, " ".join(text)))
        doc += 1
    template = rng.choices(words, k=120)
    for _ in range(60):
        own = list(template)
        for k in range(rng.choice([1, 4, 6, 8])):
            own[rng.randrange(120)] = rng.choice(words)
        rows.append((doc, " ".join(own)))
        doc += 1
    rng.shuffle(rows)
    want = brute(rows)
    assert len({c for _, c in want.values()}) > 3
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_threshold_is_inclusive_and_case_is_ascii(spark):
    base = [f"x{k}" for k in range(103)]          # 100 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:83])),   # 80 of 100: linked
            (3, " ".join(base[:82])),                         # 79 of 100 with 1, 79 of 80 with 2: linked through 2
            (4, "É a b c"), (5, "é a b c"), (6, "A B C D"), (7, "a b\tc\nd")]
    got = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [got[k][1] for k in range(1, 8)] == [1, 1, 1, 4, 5, 6, 6]


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "  \n", None), (None, "one two three four", "c"), (4, "one", "d"), (5, "ONE", "e"),
            (6, "same text here again", "f"), (6, "same text here again", "f"), (7, "z " * 30000, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id, r.kept)
                 for r in nd.near_duplicates(df).collect())
    assert got == [(-1, 1, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True),
                   (5, 1, 4, False), (6, 1, 6, True), (6, 1, 6, True), (7, 1, 7, True)]
    left = nd.one_of_each(df)
    assert left.columns == df.columns and left.count() == 8
    assert nd.near_duplicates(df.limit(0)).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(5)
    for share in (0.95, 0.8, 0.15):
        a = np.unique(rng.integers(0, 2**63, 2000, dtype=np.uint64))
        keep = int(len(a) * 2 * share / (1 + share))
        b = np.unique(np.concatenate([a[:keep], rng.integers(0, 2**63, len(a) - keep, dtype=np.uint64)]))
        (_, x), (_, y) = nd._signature(a), nd._signature(b)
        n = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        bits = nd.SKETCH_WORDS * 64
        estimate = 1 + bits / (4 * nd.BANDS * nd.ROWS) * np.log(max(1e-9, 1 - 2 * n / bits))
        assert abs(estimate - share) < 0.15
        assert (n <= nd.sketch_limit()) == (share > 0.6)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 160)]
    label = {x: x for e in links for x in e}
    for _ in range(200):
        for u, v in links:
            label[u] = label[v] = min(label[u], label[v])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    linked = {x for u, v in links for x in (u, v) if u != v}
    assert got == {x: label[x] for x in linked}


def brute_rows(rows):
    """[(doc_id, n_shingles, component)] of rows whose ids may repeat: all pairs of rows."""
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in enumerate(sets):
        for b in range(a):
            if s and sets[b] and 100 * len(s & sets[b]) >= 80 * len(s | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)] if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def test_repeated_ids_lose_no_text(spark):
    """A doc_id with unrelated texts joins no groups, and no text goes without a kept near copy."""
    rng = random.Random(12)
    words = [f"w{k}" for k in range(900)]
    a, b = (" ".join(rng.choices(words, k=60)) for _ in "ab")
    rows = [(3, a), (5, a + " more"), (5, b), (9, b)]
    assert brute_rows(rows) == [(3, 57, 3), (5, 57, 5), (5, 58, 3), (9, 57, 5)]
    bases = [rng.choices(words, k=80) for _ in range(12)]
    for _ in range(150):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 2, 5])):
            own[rng.randrange(80)] = rng.choice(words)
        rows.append((rng.randrange(100, 150), " ".join(own)))
    rows += [(rng.randrange(100, 150), None), (120, "")]
    df = spark.createDataFrame([(*r, "h") for r in rows], "doc_id long, text string, text_hash string")
    got = nd.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_rows(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = nd.one_of_each(df)
    assert left.columns == df.columns
    left = [(r.doc_id, r.text) for r in left.collect()]
    groups = _groups(rows)
    least = [min(i for i, t in rows if t in g) for g in groups]
    stay = [(i, t) for i, t in rows if all(t not in g or i == low for g, low in zip(groups, least))]
    assert sorted(left, key=str) == sorted(stay, key=str)
    assert all(any(t in g for _, t in left) for g in groups)


def _groups(rows):
    todo, groups = [t for t in {t for _, t in rows if t}], []
    while todo:
        group, edge = set(), [todo[0]]
        while edge:
            t = edge.pop()
            if t in group:
                continue
            group.add(t)
            s = shingles(t)
            edge += [u for u in todo if u not in group and 100 * len(s & shingles(u)) >= 80 * len(s | shingles(u))]
        groups.append(group)
        todo = [t for t in todo if t not in group]
    return groups
