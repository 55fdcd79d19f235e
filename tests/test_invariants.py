"""Randomised equivalence and whole-table invariants."""

import random
import re

from pyspark.sql import functions as F

from tessera import fixed
from tessera.functions import text as tx
from tessera.operators import terms
from tests.conftest import SF01

VOCAB = ["crypto", "Crypto", "CRYPTO", "token", "risk", "free", "risk-free", "riskfree", "buy", "now",
         "ETF", "etf", "κέρδος", "ΚΕΡΔΟΣ", "υψηλό", "γρήγορο", "ψηφιακό", "νόμισμα", "get", "rich",
         "the", "of", "and", "crypto2", "nft", "NFTs", "limited", "time", "guaranteed", "return",
         "all rights reserved", "newsletter", "&amp;", "<b>", "</b>", ",", ".", "!!", "-", "  ", "\n"]


def _regex_count(text, term):
    base = re.escape(term.lower().strip()).replace(r"\ ", r"\s+").replace(r"\-", r"[-\s]?")
    return len(re.findall(r"\b" + base + r"\b", text, flags=re.IGNORECASE))


def test_random_documents_match_regex(spark):
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choice(VOCAB) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.category, r.term): r.cnt
           for r in terms.term_counts(df, "text", ["doc_id"]).collect()}
    pre = {r.doc_id: r.c for r in df.select("doc_id", tx.preprocess_text("text").alias("c")).collect()}
    want = {}
    for i, text in pre.items():
        for cat, ts in fixed.TAXONOMY.items():
            for t in ts:
                n = _regex_count(text, t)
                if n:
                    want[(i, cat, t)] = n
    assert got == want and len(want) > 50


def test_series_sum_equals_category_totals(spark):
    from tessera.plans import queries
    q = queries()
    piv = q["source_category_pivot"](spark, SF01)
    series_sum = piv.select(sum(F.col(f"`{c}`") for c in fixed.TAXONOMY).alias("s")) \
        .agg(F.sum("s")).first()[0]
    totals = q["category_totals"](spark, SF01).agg(F.sum("cnt")).first()[0]
    assert series_sum == totals


def test_split_disjoint_and_complete(spark):
    from tessera.plans import queries
    s = queries()["three_way_split"](spark, SF01)
    ids = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id").distinct().count()
    assert s.count() == ids and s.select("image_id").distinct().count() == ids
    sizes = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sizes == {"train": int(0.7 * ids), "val": int(0.15 * ids),
                     "test": ids - int(0.7 * ids) - int(0.15 * ids)}
