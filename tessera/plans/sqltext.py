"""DuckDB spellings of the text functions, used by the oracle SQL.

The fixed character classes and phrases are shared with the Spark functions;
the white-space class is spelled out here, code point by code point.
"""

from __future__ import annotations

from tessera import fixed
from tessera.functions import text as tx
from tessera.operators.terms import taxonomy_rows, term_keys
from tessera.plans.registry import sql_str


#: Every code point that Python calls white space.
WHITESPACE_RUN = "[" + "".join(f"\\x{{{cp:x}}}" for cp in range(0x3100) if chr(cp).isspace()) + "]+"


def sql_clean(e: str) -> str:
    s = f"regexp_replace({e}, {sql_str(WHITESPACE_RUN)}, ' ', 'g')"
    s = f"regexp_replace({s}, {sql_str(tx.CRAWL_DROP)}, ' ', 'g')"
    s = f"regexp_replace({s}, {sql_str(tx.PUNCT_RUN)}, ' ', 'g')"
    return f"trim({s})"


def sql_boilerplate(e: str) -> str:
    for ph in fixed.BOILERPLATE_PHRASES:
        e = f"replace({e}, {sql_str(ph)}, ' ')"
    return e


def sql_preprocess(e: str) -> str:
    s = f"lower({e})"
    s = f"regexp_replace({s}, {sql_str(tx.TAG)}, ' ', 'g')"
    s = f"regexp_replace({s}, {sql_str(tx.ENTITY)}, ' ', 'g')"
    s = sql_boilerplate(s)
    s = f"regexp_replace({s}, {sql_str(tx.ANALYSIS_DROP_RUN)}, ' ', 'gi')"
    s = f"regexp_replace({s}, ' +', ' ', 'g')"
    return f"trim({s})"


def sql_word_count(e: str) -> str:
    s = f"regexp_replace({e}, {sql_str(WHITESPACE_RUN)}, ' ', 'g')"
    return f"CAST(len(list_filter(string_split({s}, ' '), lambda x: x <> '')) AS INTEGER)"


def sql_key_values(taxonomy=None) -> str:
    rows = [f"({sql_str(k)}, {sql_str(cat)}, {sql_str(term)})"
            for _, cat, _, term in taxonomy_rows(taxonomy) for k in term_keys(term)]
    return "VALUES " + ", ".join(rows)


def sql_taxonomy_values(taxonomy=None) -> str:
    rows = [f"({ci}, {sql_str(cat)}, {ti}, {sql_str(term)})"
            for ci, cat, ti, term in taxonomy_rows(taxonomy)]
    return "VALUES " + ", ".join(rows)


def sql_term_counts(source: str, id_cols: str, text_expr: str, taxonomy=None) -> str:
    """(id_cols, category, term, cnt) by padded substring counting.

    Doubling every space pads each token with its own separators, so
    counting non-overlapping ``' key '`` occurrences counts whole-token
    matches; an independent method from the n-gram join.
    """
    return f"""
    WITH d AS (
      SELECT {id_cols}, ' ' || replace(translate({sql_preprocess(text_expr)}, 'ς', 'σ'), ' ', '  ') || ' ' AS p
      FROM {source}),
    k(key, category, term) AS ({sql_key_values(taxonomy)}),
    m AS (
      SELECT {id_cols}, k.category, k.term,
             (length(d.p) - length(replace(d.p, ' ' || replace(k.key, ' ', '  ') || ' ', '')))
               // length(' ' || replace(k.key, ' ', '  ') || ' ') AS c
      FROM d, k)
    SELECT {id_cols}, category, term, sum(c)::BIGINT AS cnt
    FROM m GROUP BY ALL HAVING sum(c) > 0"""
