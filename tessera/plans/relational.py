"""Registered relational (E13/E15 SQL over temp views), regression and
aggregate-model queries (E5, E9, E11, F3)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tessera import fixed
from tessera.operators import classify as cl
from tessera.operators import neighbors as nb
from tessera.plans.registry import register
from tessera.sources.tables import read_table


def _sql(spark, sf, query, *tables):
    """``query`` over the tables, passed as DataFrames: no session-wide view is
    made or replaced."""
    for t in tables:
        query = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", query)
    return spark.sql(query, **{t: read_table(spark, sf, t) for t in tables})


# Money columns are summed as exact decimals in both engines, then turned
# into doubles, so results do not depend on summation order.
_REV = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"

_SELECT_PROJECT = ("SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
                   "WHERE o_orderstatus = 'F' AND o_totalprice > 100000")

_JOIN_GROUP = (f"SELECT n.n_name, CAST(sum({_REV}) AS DOUBLE) AS revenue, count(*) AS line_count "
               "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
               "JOIN customer c ON o.o_custkey = c.c_custkey "
               "JOIN nation n ON c.c_nationkey = n.n_nationkey "
               "WHERE l.l_returnflag = 'R' GROUP BY n.n_name")

_TOPK = ("SELECT c.c_custkey, c.c_name, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total "
         "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
         "GROUP BY c.c_custkey, c.c_name ORDER BY total DESC, c.c_custkey LIMIT 10")

_SET_OPS = ("SELECT 'both' AS kind, k FROM (SELECT s_nationkey AS k FROM supplier "
            "INTERSECT SELECT c_nationkey FROM customer) "
            "UNION ALL SELECT 'supplier_only', k FROM (SELECT s_nationkey AS k FROM supplier "
            "EXCEPT SELECT c_nationkey FROM customer) "
            "UNION ALL SELECT 'customer_only', k FROM (SELECT c_nationkey AS k FROM customer "
            "EXCEPT SELECT s_nationkey FROM supplier) "
            "UNION ALL SELECT 'neither', k FROM (SELECT n_nationkey AS k FROM nation "
            "EXCEPT (SELECT s_nationkey FROM supplier UNION SELECT c_nationkey FROM customer))")


@register("sql_select_project", _SELECT_PROJECT)
def sql_select_project(spark, sf):
    return _sql(spark, sf, _SELECT_PROJECT, "orders")


@register("sql_join_group", _JOIN_GROUP)
def sql_join_group(spark, sf):
    return _sql(spark, sf, _JOIN_GROUP, "lineitem", "orders", "customer", "nation")


@register("sql_topk", _TOPK)
def sql_topk(spark, sf):
    return _sql(spark, sf, _TOPK, "orders", "customer")


@register("sql_set_ops", _SET_OPS)
def sql_set_ops(spark, sf):
    return _sql(spark, sf, _SET_OPS, "supplier", "customer", "nation")


# --- E5: one-predictor least squares ------------------------------------------
@register("ols_price_qty",
          "SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, "
          "round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, "
          "round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n FROM lineitem")
def ols_price_qty(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_extendedprice", "l_quantity"])
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    return li.agg(F.round(F.regr_slope(y, x), 4).alias("slope"),
                  F.round(F.regr_intercept(y, x), 4).alias("intercept"),
                  F.round(F.regr_r2(y, x), 6).alias("r2"),
                  F.count(F.lit(1)).alias("n"))


# --- E9, E11 on embeddings -------------------------------------------------------
_LONG = ("lv AS (SELECT vec_id, label, unnest(range(len(embedding))) AS d, "
         "CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)")


def _vectors(spark, sf):
    return read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])


@register("gaussian_nb",
          f"WITH {_LONG}, st AS (SELECT label, d, avg(x) AS mu, var_pop(x) AS v FROM lv GROUP BY 1, 2), "
          "st2 AS (SELECT label, d, mu, v + (SELECT max(v) FROM st) * 1e-9 AS v FROM st), "
          "pr AS (SELECT label, ln(count(*) / (SELECT count(*) FROM embeddings)) AS lp "
          "FROM (SELECT DISTINCT vec_id, label FROM embeddings) GROUP BY 1), "
          "ll AS (SELECT lv.vec_id, st2.label, sum(-0.5 * ln(2 * pi() * st2.v) - "
          "(lv.x - st2.mu) * (lv.x - st2.mu) / (2 * st2.v)) AS ll FROM lv JOIN st2 USING (d) GROUP BY 1, 2), "
          "sc AS (SELECT ll.vec_id, ll.label, ll.ll + pr.lp AS s FROM ll JOIN pr USING (label)) "
          "SELECT vec_id, label AS pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id "
          "ORDER BY s DESC, label) AS rk FROM sc) WHERE rk = 1")
def gaussian_nb(spark, sf):
    emb = _vectors(spark, sf)
    return cl.gaussian_nb(emb, emb, "vec_id", "embedding", "label")


@register("min_distance",
          f"WITH {_LONG}, c AS (SELECT label, d, avg(x) AS c FROM lv GROUP BY 1, 2), "
          "dist AS (SELECT lv.vec_id, c.label, sum((lv.x - c.c) * (lv.x - c.c)) AS dist "
          "FROM lv JOIN c USING (d) GROUP BY 1, 2) "
          "SELECT vec_id, label AS pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id "
          "ORDER BY dist, label) AS rk FROM dist) WHERE rk = 1")
def min_distance(spark, sf):
    emb = _vectors(spark, sf)
    return cl.min_distance(emb, emb, "vec_id", "embedding", "label")


# --- E10 on embeddings ------------------------------------------------------------
NEIGHBORS = 5
#: Searches take every 50th row as a query, against all rows.
_QUERY = "vec_id % 50 = 0"
_KNN = (f"WITH q AS (SELECT * FROM embeddings WHERE {_QUERY}), d AS (SELECT q.vec_id, p.vec_id AS neighbor, p.label, "
        "sqrt(list_sum(list_transform(list_zip(q.embedding, p.embedding), lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) "
        "* (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE))))) AS distance FROM q JOIN embeddings p ON p.vec_id <> q.vec_id), "
        f"k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor) AS rank FROM d QUALIFY rank <= {NEIGHBORS}) ")


def _knn(spark, sf):
    emb = _vectors(spark, sf)
    return nb.knn(emb, emb.where(_QUERY), NEIGHBORS)


@register("knn_neighbors", _KNN + "SELECT vec_id, CAST(rank AS INTEGER) AS rank, neighbor, round(distance, 9) AS distance FROM k")
def knn_neighbors(spark, sf):
    """The nearest rows of every 50th row among all others."""
    found, _ = _knn(spark, sf)
    return found.select(F.col("query").alias("vec_id"), "rank", F.col("point").alias("neighbor"), F.round("distance", 9).alias("distance"))


@register("knn_vote", _KNN + ", v AS (SELECT vec_id, label, count(*) AS n FROM k GROUP BY 1, 2) SELECT vec_id, label AS pred FROM v "
          "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) = 1")
def knn_vote(spark, sf):
    """The label that most of a row's nearest others have."""
    found, _ = _knn(spark, sf)
    return nb.knn_vote(found).select(F.col("query").alias("vec_id"), F.col("pred").cast("int").alias("pred"))


@register("knn_visits", f"SELECT (SELECT count(*) FROM embeddings WHERE {_QUERY}) AS queries, count(*) AS points, "
          "TRUE AS within_all_pairs FROM embeddings")
def knn_visits(spark, sf):
    """The size of the search: the pairs compared are at most all pairs."""
    _, report = _knn(spark, sf)
    return report.select("queries", "points", (F.col("compared") <= F.col("queries") * F.col("points")).alias("within_all_pairs"))


# --- F3: language scoring ----------------------------------------------------------
def _lang_sql(score_sql: str, id_col: str) -> str:
    """Trigram profiles from ``documents``; best language for each row of
    ``score_sql`` (columns ``{id_col}, text``)."""
    n = fixed.LANG_SAMPLE_CHARS
    grams = ("unnest(CASE WHEN length(s) >= 3 THEN "
             "list_transform(range(1, length(s) - 1), lambda i: substring(s, i, 3)) ELSE [] END)")
    return (f"WITH ts AS (SELECT lang, lower(text) AS s FROM documents), "
            f"tg AS (SELECT lang, {grams} AS gram FROM ts), "
            "cnt AS (SELECT lang, gram, count(*) AS c FROM tg GROUP BY 1, 2), "
            "tot AS (SELECT lang, sum(c) AS t FROM cnt GROUP BY 1), "
            "voc AS (SELECT count(DISTINCT gram) AS v FROM cnt), "
            "prof AS (SELECT cnt.lang, gram, ln((c + 1) / (t + v)) AS logp, ln(1 / (t + v)) AS lu "
            "FROM cnt JOIN tot USING (lang), voc), "
            f"ss AS (SELECT {id_col}, lower(substring(text, 1, {n})) AS s FROM ({score_sql})), "
            f"sg AS (SELECT {id_col}, {grams} AS gram FROM ss), "
            f"dg AS (SELECT {id_col}, gram, count(*) AS n FROM sg GROUP BY 1, 2), "
            f"total AS (SELECT {id_col}, sum(n) AS total FROM dg GROUP BY 1), "
            f"m AS (SELECT {id_col}, prof.lang, sum(n * logp) AS s, sum(n) AS matched, any_value(lu) AS lu "
            "FROM dg JOIN prof USING (gram) GROUP BY 1, 2), "
            f"sc AS (SELECT m.{id_col}, m.lang, s + (total - matched) * lu AS score FROM m "
            f"JOIN total USING ({id_col})) "
            f"SELECT {id_col}, lang AS pred_lang FROM (SELECT *, row_number() OVER (PARTITION BY {id_col} "
            "ORDER BY score DESC, lang DESC) AS rk FROM sc) WHERE rk = 1")


@register("lang_score", _lang_sql("SELECT doc_id, text FROM documents", "doc_id"))
def lang_score(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text", "lang"])
    prof = cl.language_profiles(docs, "text", "lang")
    return cl.language_scores(docs, "doc_id", "text", prof)
