"""Registered queries: one per operator over its whole table, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from tessera.llm import decontaminate, fingerprints, html_model, merkle, mixing, near_dedup, oracles, packing, quality_crf, repetition, secrets, suffix_dedup, toxicity, vector_codes

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_best_fit_packing(spark, sf_dir):
    """Every piece of every document and its place in sequences of 4096 tokens."""
    return packing.packed(_read(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark, sf_dir):
    """Toxicity score of every whole document by the clause grammar."""
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


@query
def op3_document_fingerprints(spark, sf_dir):
    """Fingerprints of every document and its edited text, and their likeness."""
    return fingerprints.fingerprints(_read(spark, sf_dir, "documents"))


@query
def op4_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html_model.extract(_read(spark, sf_dir, "pages"))


@query
def op5_suffix_array_dedup(spark, sf_dir):
    """Bytes of every document left when repeats of 100 bytes or more go."""
    return suffix_dedup.dedup_substrings(_read(spark, sf_dir, "documents")).drop("kept")


@query
def op6_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate component of every document."""
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"))


@query
def op7_mixing(spark, sf_dir):
    """Words each document gives to the weighted mix of all documents."""
    return mixing.taken(_read(spark, sf_dir, "documents"))


@query
def op8_quality_classifier(spark, sf_dir):
    """Quality score of every whole document by the line field."""
    docs = _read(spark, sf_dir, "documents")
    return quality_crf.score(docs, quality_crf.fit(docs, _read(spark, sf_dir, "labels")))


@query
def op9_secret_scan(spark, sf_dir):
    """Secret spans of every whole document."""
    return secrets.scan(_read(spark, sf_dir, "documents"))


@query
def op10_quality_rules(spark, sf_dir):
    """Base counts, repetition coverage and verdict of every whole document."""
    return repetition.repetition_rules(_read(spark, sf_dir, "documents"))


@query
def op11_vector_codes(spark, sf_dir):
    """Product code and error of every vector."""
    return vector_codes.compress(_read(spark, sf_dir, "embeddings"))


ORACLES["op11_vector_codes"] = oracles.VECTOR_CODES


@query
def op12_decontamination(spark, sf_dir):
    """Words of every document inside windows of benchmark items."""
    return decontaminate.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


ORACLES["op12_decontamination"] = oracles.DECONTAMINATE


@query
def op13_merkle_manifest(spark, sf_dir):
    """Leaf, subroot, root and folded proof of every document."""
    return merkle.manifest(_read(spark, sf_dir, "documents"))


ORACLES["op13_merkle_manifest"] = oracles.MERKLE


@query
def pipeline(spark, sf_dir):
    """The corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
