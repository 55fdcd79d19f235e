"""Taxonomy term counting (J2, A1-A5) as token n-gram equality.

After ``preprocess_text`` a document is lower-case tokens separated by single
spaces, so a word-bounded, case-insensitive term regex matches exactly where
the term's normalised token sequence equals a run of tokens. Each term is
turned into the literal keys its regex can match (a hyphen gives a spaced and
a joined key; characters the cleaner removes make a term dead). Matching is
then linear in tokens:

* candidate positions are those whose first token starts some key of length
  n (an ``IN`` set, i.e. a hash lookup in codegen);
* only there is the n-gram string built and tested against the key set;
* the surviving matches - not all tokens - are exploded and joined to the
  taxonomy, which is a fixed ~110-row table and therefore broadcast.

Counts are aggregated with map-side partial aggregation, so one hot document,
date or term never lands whole in a single task before being reduced.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import fixed

_KEY_CHARS = re.compile("^[0-9a-zάέήίόύώϊΐϋΰα-ω ]+$")


def fold_sigma(s: str) -> str:
    """Final sigma and sigma compare equal under case-insensitive matching."""
    return s.replace("ς", "σ")


def term_keys(term: str) -> list[str]:
    """Literal token sequences that the term's pattern can match."""
    base = term.lower().strip()
    pieces = base.split("-")
    keys = []
    for seps in itertools.product(["", " "], repeat=len(pieces) - 1):
        cand = pieces[0] + "".join(s + p for s, p in zip(seps, pieces[1:]))
        cand = fold_sigma(cand)
        if not cand or "  " in cand or cand != cand.strip():
            continue
        if not _KEY_CHARS.match(cand):
            continue  # holds a character the cleaner removes: can never match
        keys.append(cand)
    return sorted(set(keys))


def taxonomy_rows(taxonomy: dict[str, list[str]] | None = None):
    """(cat_pos, category, term_pos, term) in listed order."""
    taxonomy = fixed.TAXONOMY if taxonomy is None else taxonomy
    for ci, (cat, terms) in enumerate(taxonomy.items()):
        for ti, term in enumerate(terms):
            yield ci, cat, ti, term


TAXONOMY_SCHEMA = T.StructType([
    T.StructField("cat_pos", T.IntegerType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("term_pos", T.IntegerType(), False),
    T.StructField("term", T.StringType(), False),
])

KEY_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("term", T.StringType(), False),
])


def taxonomy_frame(spark: SparkSession, taxonomy=None) -> DataFrame:
    return spark.createDataFrame(list(taxonomy_rows(taxonomy)), TAXONOMY_SCHEMA)


def key_frame(spark: SparkSession, taxonomy=None) -> DataFrame:
    """(key, category, term): one row per key per taxonomy entry."""
    rows = [(k, cat, term) for _, cat, _, term in taxonomy_rows(taxonomy)
            for k in term_keys(term)]
    return spark.createDataFrame(rows, KEY_SCHEMA)


def _keys_by_length(taxonomy=None) -> dict[int, set[str]]:
    out: dict[int, set[str]] = {}
    for _, _, _, term in taxonomy_rows(taxonomy):
        for k in term_keys(term):
            out.setdefault(k.count(" ") + 1, set()).add(k)
    return out


def _in(values):
    return lambda x: x.isin(values)


def _gram(tokens: Column, n: int):
    return lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(n)), " ")


def _starts_with_any(tokens: Column, firsts):
    return lambda i: tokens[i].isin(firsts)


def match_keys(tokens: Column, taxonomy=None) -> Column:
    """Array of every key occurrence in a token array (all lengths)."""
    parts = []
    for n, keys in sorted(_keys_by_length(taxonomy).items()):
        keys = sorted(keys)
        if n == 1:
            parts.append(F.filter(tokens, _in(keys)))
            continue
        firsts = sorted({k.split(" ")[0] for k in keys})
        starts = F.filter(F.sequence(F.lit(0), F.size(tokens) - n),
                          _starts_with_any(tokens, firsts))
        hits = F.filter(F.transform(starts, _gram(tokens, n)), _in(keys))
        parts.append(F.when(F.size(tokens) >= n, hits)
                     .otherwise(F.array().cast("array<string>")))
    if not parts:
        return F.array().cast("array<string>")
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def tokens_of(clean: Column) -> Column:
    """Tokens of preprocessed text, with final sigma folded (Q14)."""
    return F.split(F.translate(clean, "ς", "σ"), " ")


def term_matches(df: DataFrame, text_col: str, keep: list[str],
                 taxonomy=None, preprocessed: bool = False, keep_empty: bool = False) -> DataFrame:
    """One row per (kept columns, category, term) occurrence; with
    ``keep_empty`` a text without any gives one row of null category and term."""
    from tessera.functions.text import preprocess_text

    clean = F.col(text_col) if preprocessed else preprocess_text(text_col)
    spark = df.sparkSession
    # Tokens are computed once as a column; the lambdas below then index an
    # attribute rather than re-running the cleaning regexes per position.
    toks = df.select(*keep, tokens_of(clean).alias("_tok"))
    explode = F.explode_outer if keep_empty else F.explode
    hits = toks.select(*keep, explode(match_keys(F.col("_tok"), taxonomy)).alias("key"))
    # The key table is a fixed, tiny list: a proven-small broadcast side.
    return (hits.join(F.broadcast(key_frame(spark, taxonomy)), "key", "left" if keep_empty else "inner")
            .select(*keep, "category", "term"))


def term_counts(df: DataFrame, text_col: str, keys: list[str],
                taxonomy=None, preprocessed: bool = False) -> DataFrame:
    """A1: occurrence count per (keys..., category, term); zero counts absent."""
    return (term_matches(df, text_col, keys, taxonomy, preprocessed)
            .groupBy(*keys, "category", "term").agg(F.count(F.lit(1)).alias("cnt")))


def category_totals(counts: DataFrame, taxonomy=None) -> DataFrame:
    """A3: total per category, every category kept (zero when unseen)."""
    spark = counts.sparkSession
    cats = (taxonomy_frame(spark, taxonomy).groupBy("category")
            .agg(F.min("cat_pos").alias("cat_pos")))
    # The per-category aggregate has at most one row per category: it is the
    # broadcast (build) side; the taxonomy side is preserved by the left join.
    sums = counts.groupBy("category").agg(F.sum("cnt").alias("cnt"))
    return (cats.join(F.broadcast(sums), "category", "left")
            .select("category", "cat_pos", F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt")))


def term_totals(counts: DataFrame, taxonomy=None) -> DataFrame:
    """A4: total per term over its (category, term) rows, zero terms kept.

    A term listed under two categories is counted once per listing (Q7).
    """
    spark = counts.sparkSession
    tax = taxonomy_frame(spark, taxonomy)
    per = counts.groupBy("category", "term").agg(F.sum("cnt").alias("cnt"))
    return (tax.join(F.broadcast(per), ["category", "term"], "left")
            .groupBy("term").agg(F.sum(F.coalesce("cnt", F.lit(0))).cast("long").alias("cnt"),
                                 F.min(F.col("cat_pos") * 1000 + F.col("term_pos")).alias("pos")))


def totals_long(counts: DataFrame, taxonomy=None) -> DataFrame:
    """A5: ``(type, name, count)`` rows for categories then terms.

    One aggregate with GROUPING SETS ((category), (term)) over the
    (category, term) grain, with taxonomy rows left-joined so zeros survive.
    """
    spark = counts.sparkSession
    tax = taxonomy_frame(spark, taxonomy)
    per = counts.groupBy("category", "term").agg(F.sum("cnt").alias("cnt"))
    # at most one row per taxonomy entry: a bounded broadcast
    grain = (tax.join(F.broadcast(per), ["category", "term"], "left")
             .select("category", "term", F.coalesce("cnt", F.lit(0)).alias("cnt")))
    g = (grain.groupingSets([["category"], ["term"]], "category", "term")
         .agg(F.sum("cnt").cast("long").alias("count"), F.grouping_id().alias("gid")))
    return g.select(
        F.when(F.col("gid") == 1, F.lit("Category")).otherwise(F.lit("Term")).alias("type"),
        F.coalesce("category", "term").alias("name"),
        "count")
