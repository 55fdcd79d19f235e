"""The corpus pipeline: toxic documents go, one document of each near-duplicate
group stays, secrets are masked, sources are mixed to their targets, and what
is left is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor
kept. ``run`` writes each stage's result as Parquet in the shared checkpoint
folder and rereads it, so a lost executor never costs more than one stage. All
stages but the last return the columns of ``documents``. Empty tables pass
through; a row with null text is clean, alone, without secrets and of size 0 in
the mix, which takes no row without words, so none reaches the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import mixing, near_dedup, packing, secrets, toxicity
from tessera.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar, fitted on the labelled ones, rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group stays."""
    return near_dedup.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret spans are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents repeat or drop out until it meets its target."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 4096 tokens."""
    return packing.packed(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("secrets", mask_secrets),
          ("source_mix", mix_sources), ("packing", pack_sequences)]

#: Trained scores, hashing and tokens are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
