"""Registered text-pipeline queries on ``documents`` and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import fixed
from tessera.functions import text as tx
from tessera.operators import dedup, index, series, terms
from tessera.operators.frames import computed_once
from tessera.plans.registry import register, sql_str
from tessera.plans.sqltext import (sql_boilerplate, sql_clean, sql_preprocess, sql_taxonomy_values,
                                   sql_term_counts, sql_word_count)
from tessera.session import stored
from tessera.sources.tables import read_table

# Event types of the driver's ``events`` table: the fixed pivot columns.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
CATEGORIES = list(fixed.TAXONOMY)


def _docs(spark, sf, cols=("doc_id", "text")):
    return read_table(spark, sf, "documents", list(cols))


def doc_term_counts(spark, sf):
    return terms.term_counts(_docs(spark, sf), "text", ["doc_id"])


# --- A1 / J2 ---------------------------------------------------------------
@register("term_count_long",
          sql_term_counts("documents", "doc_id", "text"))
def term_count_long(spark, sf):
    return doc_term_counts(spark, sf)


# --- A3 ----------------------------------------------------------------------
_CAT_SQL = f"""
WITH tc AS ({sql_term_counts("documents", "doc_id", "text")}),
tax(cat_pos, category, term_pos, term) AS ({sql_taxonomy_values()})
SELECT t.category, min(t.cat_pos) AS cat_pos, coalesce(sum(s.cnt), 0)::BIGINT AS cnt
FROM (SELECT category, min(cat_pos) AS cat_pos FROM tax GROUP BY 1) t
LEFT JOIN (SELECT category, sum(cnt) AS cnt FROM tc GROUP BY 1) s USING (category)
GROUP BY t.category"""


@register("category_totals", _CAT_SQL)
def category_totals(spark, sf):
    return terms.category_totals(doc_term_counts(spark, sf))


# --- A4 ----------------------------------------------------------------------
_TERM_SQL = f"""
WITH tc AS ({sql_term_counts("documents", "doc_id", "text")}),
tax(cat_pos, category, term_pos, term) AS ({sql_taxonomy_values()})
SELECT tax.term, coalesce(sum(tc.cnt), 0)::BIGINT AS cnt, min(cat_pos * 1000 + term_pos) AS pos
FROM tax LEFT JOIN tc ON tc.category = tax.category AND tc.term = tax.term
GROUP BY tax.term"""


@register("term_totals", _TERM_SQL)
def term_totals(spark, sf):
    return terms.term_totals(doc_term_counts(spark, sf))


# --- A5 / U2 -----------------------------------------------------------------
_TOTALS_SQL = f"""
WITH tc AS ({sql_term_counts("documents", "doc_id", "text")}),
tax(cat_pos, category, term_pos, term) AS ({sql_taxonomy_values()}),
g AS (SELECT tax.category, tax.term, coalesce(sum(tc.cnt), 0) AS cnt
      FROM tax LEFT JOIN tc ON tc.category = tax.category AND tc.term = tax.term
      GROUP BY tax.category, tax.term)
SELECT 'Category' AS type, category AS name, sum(cnt)::BIGINT AS count FROM g GROUP BY category
UNION ALL
SELECT 'Term' AS type, term AS name, sum(cnt)::BIGINT AS count FROM g GROUP BY term"""


@register("totals_grouping_sets", _TOTALS_SQL)
def totals_grouping_sets(spark, sf):
    return terms.totals_long(doc_term_counts(spark, sf))


# --- F4, F5 + O2 -------------------------------------------------------------
@register("totals_category_chart",
          f"SELECT name, count FROM ({_TOTALS_SQL}) WHERE type = 'Category'")
def totals_category_chart(spark, sf):
    return (terms.totals_long(doc_term_counts(spark, sf))
            .filter(F.col("type") == "Category").select("name", "count"))


@register("totals_term_chart",
          f"SELECT name, count FROM ({_TOTALS_SQL}) WHERE type = 'Term' AND count > 0 "
          "ORDER BY count, name")
def totals_term_chart(spark, sf):
    return (terms.totals_long(doc_term_counts(spark, sf))
            .filter((F.col("type") == "Term") & (F.col("count") > 0))
            .select("name", "count").orderBy("count", "name"))


# --- X1, X2, X3, X7 ----------------------------------------------------------
@register("clean_text",
          f"SELECT doc_id, {sql_clean('text')} AS clean FROM documents")
def clean_text(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.clean_text("text").alias("clean"))


@register("strip_boilerplate",
          f"SELECT doc_id, {sql_boilerplate('lower(text)')} AS stripped FROM documents")
def strip_boilerplate(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", tx.remove_boilerplate(F.lower("text")).alias("stripped"))


@register("preprocess_text",
          f"SELECT doc_id, {sql_preprocess('text')} AS content FROM documents")
def preprocess_text(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.preprocess_text("text").alias("content"))


@register("direct_terms",
          f"SELECT doc_id, {sql_word_count(sql_clean('text'))} AS direct_terms FROM documents")
def direct_terms(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", tx.word_count(tx.clean_text("text")).alias("direct_terms"))


# --- F1 ----------------------------------------------------------------------
def _script_sql(letter_class: str) -> str:
    n = f"CAST(len(regexp_extract_all(substring(text, 1, {fixed.SCRIPT_SAMPLE_CHARS}), {sql_str(letter_class)})) AS INTEGER)"
    total = f"length(substring(text, 1, {fixed.SCRIPT_SAMPLE_CHARS}))"
    return (f"SELECT doc_id, {n} AS letters FROM documents WHERE {n} >= {fixed.SCRIPT_MIN_COUNT} "
            f"OR ({total} > 0 AND {n} / {total} >= {fixed.SCRIPT_MIN_RATIO})")


def _script_query(letter_class):
    def q(spark, sf):
        n = fixed.SCRIPT_SAMPLE_CHARS
        d = computed_once(_docs(spark, sf).select(
            "doc_id", tx.script_count("text", letter_class).alias("letters"),
            F.length(F.substring("text", 1, n)).alias("total")))
        ok = (F.col("letters") >= fixed.SCRIPT_MIN_COUNT) | (
            (F.col("total") > 0) & (F.col("letters") / F.col("total") >= fixed.SCRIPT_MIN_RATIO))
        return d.filter(ok).select("doc_id", "letters")
    return q


register("script_ratio_filter", _script_sql(fixed.GREEK_LETTER_CLASS))(
    _script_query(fixed.GREEK_LETTER_CLASS))
# The same operator with the letter class as a parameter: Latin accented
# letters, so the driver data (which holds no Greek) exercises both rules.
register("script_ratio_latin", _script_sql("[à-ÿ]"))(_script_query("[à-ÿ]"))


# --- D1, J4 ------------------------------------------------------------------
@register("dedup_md5",
          f"SELECT min(doc_id) AS doc_id, md5({sql_clean('text')}) AS content_hash "
          "FROM documents GROUP BY 2")
def dedup_md5(spark, sf):
    d = _docs(spark, sf).select("doc_id", tx.content_hash(tx.clean_text("text")).alias("content_hash"))
    return dedup.dedup_first(d, "doc_id", "content_hash")


@register("new_content_only",
          f"SELECT doc_id, md5({sql_clean('text')}) AS content_hash FROM documents "
          f"WHERE md5({sql_clean('text')}) NOT IN (SELECT md5({sql_clean('text')}) FROM benchmark)")
def new_content_only(spark, sf):
    d = _docs(spark, sf).select("doc_id", tx.content_hash(tx.clean_text("text")).alias("content_hash"))
    seen = read_table(spark, sf, "benchmark", ["text"]).select(
        tx.content_hash(tx.clean_text("text")).alias("content_hash"))
    return dedup.exclude_seen(d, seen, "content_hash")


# --- A2 ----------------------------------------------------------------------
@register("daily_category_pivot",
          "SELECT CAST(ts AS DATE) AS date, "
          + ", ".join(f"count(*) FILTER (WHERE event_type = {sql_str(t)}) AS {t}" for t in EVENT_TYPES)
          + " FROM events GROUP BY 1")
def daily_category_pivot(spark, sf):
    ev = read_table(spark, sf, "events", ["ts", "event_type"])
    rows = ev.select(F.to_date("ts").alias("date"), "event_type")
    return series.zero_filled_pivot(rows, "date", "event_type", EVENT_TYPES)


def _source_pivot_sql() -> str:
    tc = sql_term_counts("documents", "doc_id", "text")
    cols = ", ".join(
        f"coalesce(sum(t.cnt) FILTER (WHERE t.category = {sql_str(c)}), 0)::BIGINT AS \"{c}\""
        for c in CATEGORIES)
    return (f"WITH tc AS ({tc}) SELECT d.source, {cols} FROM documents d "
            "LEFT JOIN tc t USING (doc_id) GROUP BY d.source")


@register("source_category_pivot", _source_pivot_sql())
def source_category_pivot(spark, sf):
    """A2 with ``source`` as the series key: every source, every category."""
    d = _docs(spark, sf, ("doc_id", "source", "text"))
    hits = terms.term_matches(d, "text", ["source"]).select("source", "category")
    present = d.select("source", F.lit(None).cast("string").alias("category"))
    return series.zero_filled_pivot(hits.unionByName(present), "source", "category", CATEGORIES)


# --- W1 / O3 -----------------------------------------------------------------
@register("cumulative_terms",
          "SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER "
          "(ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) "
          "AS cum_value FROM events")
def cumulative_terms(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts", "value"]).select(
        "event_id", "ts", F.col("value").cast("decimal(18,2)").alias("v"))
    out = series.running_sum(ev, ["ts", "event_id"], "v", "cum")
    return out.select("event_id", F.col("cum").cast("double").alias("cum_value"))


# --- E13 ---------------------------------------------------------------------
@register("word_count",
          f"SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split({sql_preprocess('text')}, ' ')) AS word "
          "FROM documents) WHERE word <> '' GROUP BY word")
def word_count(spark, sf):
    words = _docs(spark, sf, ("text",)).select(
        F.explode(F.split(tx.preprocess_text("text"), " ")).alias("word"))
    return words.filter(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


_WORDS_SQL = (f"SELECT doc_id, list_filter(string_split({sql_preprocess('text')}, ' '), lambda x: x <> '') AS w FROM documents")
INDEX_SPAN = 100


def _positions(spark, sf):
    words = F.filter(F.split(tx.preprocess_text("text"), " "), lambda w: w != "")
    return index.word_positions(_docs(spark, sf), "doc_id", words)


@register("inverted_index", f"""
WITH p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM ({_WORDS_SQL})),
d AS (SELECT word, doc_id, string_agg(pos, ',' ORDER BY pos) AS places, count(*) AS n FROM p GROUP BY word, doc_id)
SELECT word, doc_id // {INDEX_SPAN} AS part, count(*) AS docs, sum(n)::BIGINT AS occurrences,
       md5(string_agg(doc_id || ':' || places, ';' ORDER BY doc_id)) AS postings_md5 FROM d GROUP BY 1, 2""")
def inverted_index(spark, sf):
    """Posting lists with positions, common words' lists in parts; lists as digests."""
    lists = index.inverted_index(_positions(spark, sf), "doc_id", INDEX_SPAN)
    text = F.array_join(F.transform("postings", lambda p: F.concat(p["doc_id"].cast("string"), F.lit(":"), F.array_join(
        F.transform(p["positions"], lambda x: x.cast("string")), ","))), ";")
    return lists.select("word", "part", "docs", "occurrences", F.md5(text).alias("postings_md5"))


PHRASES = [["the", "and"], ["de", "la"], ["the", "the"], ["es", "de", "la"]]


@register("phrase_search", " UNION ALL ".join(
    f"SELECT {sql_str(' '.join(ph))} AS phrase, doc_id, i AS pos FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM ({_WORDS_SQL})) "
    f"WHERE w[i + 1 : i + {len(ph)}] = [{', '.join(map(sql_str, ph))}]" for ph in PHRASES))
def phrase_search(spark, sf):
    """Every place of a few phrases, found in the index."""
    lists = stored(index.inverted_index(_positions(spark, sf), "doc_id", INDEX_SPAN), "index")
    found = [index.phrase_search(lists, "doc_id", ph).select(F.lit(" ".join(ph)).alias("phrase"), "doc_id", "pos") for ph in PHRASES]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


# --- DM7: the expanded keyword list as extra taxonomy rows -------------------
FULL_TAXONOMY = {**fixed.TAXONOMY, **fixed.EXPANDED_TAXONOMY}


def _totals_sql(taxonomy) -> str:
    return f"""
WITH tc AS ({sql_term_counts("documents", "doc_id", "text", taxonomy)}),
tax(cat_pos, category, term_pos, term) AS ({sql_taxonomy_values(taxonomy)}),
g AS (SELECT tax.category, tax.term, coalesce(sum(tc.cnt), 0) AS cnt
      FROM tax LEFT JOIN tc ON tc.category = tax.category AND tc.term = tax.term
      GROUP BY tax.category, tax.term)
SELECT 'Category' AS type, category AS name, sum(cnt)::BIGINT AS count FROM g GROUP BY category
UNION ALL
SELECT 'Term' AS type, term AS name, sum(cnt)::BIGINT AS count FROM g GROUP BY term"""


@register("totals_expanded_taxonomy", _totals_sql(FULL_TAXONOMY))
def totals_expanded_taxonomy(spark, sf):
    counts = terms.term_counts(_docs(spark, sf), "text", ["doc_id"], FULL_TAXONOMY)
    return terms.totals_long(counts, FULL_TAXONOMY)
