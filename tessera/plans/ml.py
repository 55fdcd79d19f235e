"""Registered Spark ML queries. Trained models have no SQL equivalent, so these
are rows-only checks; ``*_check`` queries hold each fitted model against the
conditions that define it and must come out true.

The segmentation label of a pixel comes from its surroundings: the mask of an
image is where its 7x7 blur is at least the mean blur of all pixels. About half
of all pixels are inside, and none of the four features gives the blur away.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import classify as cl
from tessera.operators import metrics as mx
from tessera.operators import models as md
from tessera.operators import raster as rx
from tessera.operators import unmixing as um
from tessera.plans.raster import SPLIT_SQL, _FEATS, pixels
from tessera.plans.registry import register
from tessera.session import stored
from tessera.sources.tables import read_table

DOC_FEATURES = ["log_chars", "words", "accents", "digits", "punct"]


def _pixel_table(spark, sf) -> DataFrame:
    """Features and labels of every pixel with the image's split, written once."""
    feats = rx.pixel_features(pixels(spark, sf))
    level = feats.select(F.avg("blur7")).scalar()
    feats = feats.select("image_id", "y", "x", *md.FEATURES, (F.col("blur7") >= level).cast("int").alias("label"))
    split = rx.three_way_split(feats.select("image_id").distinct(), "image_id")
    return stored(feats.join(split, "image_id"), "pixel-features")


def _gbt_model(table: DataFrame):
    return md.fit_pipeline(md.training_sample(table.filter(F.col("split") == "train")), md.FEATURES, md.gbt())


def _texture(table: DataFrame) -> DataFrame:
    test = table.filter(F.col("split") == "test")
    return md.positive_probability(_gbt_model(table).transform(test), "p_texture").select(
        "image_id", "y", "x", "label", "p_texture")


def _context(table: DataFrame) -> DataFrame:
    ctx = md.block_means(table.select("image_id", "y", "x", F.col("pixel").alias("v"), "label", "split"))
    lr = LogisticRegression(labelCol="label", featuresCol="features", maxIter=20)
    model = md.fit_pipeline(ctx.filter(F.col("split") == "train"), ["mean2", "mean4", "mean8"], lr)
    scored = model.transform(ctx.filter(F.col("split") == "test"))
    return md.positive_probability(scored, "p_context").select("image_id", "y", "x", "p_context")


# --- M1, M3 -------------------------------------------------------------------
@register("gbt_texture_prob")
def gbt_texture_prob(spark, sf):
    return _texture(_pixel_table(spark, sf))


# --- M2 -----------------------------------------------------------------------
@register("cv_mae")
def cv_mae(spark, sf):
    table = _pixel_table(spark, sf)
    sample = md.training_sample(table.filter(F.col("split") == "train")).withColumn(
        "pid", F.col("image_id") * 64 + F.col("y") * 8 + F.col("x"))
    return md.cross_validate_mae(mx.stratified_folds(sample, "label", "pid", 5), md.FEATURES, md.gbt())


# --- M7 -----------------------------------------------------------------------
@register("feature_ranking")
def feature_ranking(spark, sf):
    return md.feature_ranking(spark, _gbt_model(_pixel_table(spark, sf)), md.FEATURES)


# --- M6 + M4 + M5: context model, blend, report ---------------------------------
@register("context_prob")
def context_prob(spark, sf):
    return _context(_pixel_table(spark, sf))


@register("hybrid_report")
def hybrid_report(spark, sf):
    """Blend context and texture probabilities 0.6/0.4, threshold, report."""
    table = _pixel_table(spark, sf)
    j = _context(table).join(_texture(table), ["image_id", "y", "x"]).withColumn("prob", mx.blend("p_context", "p_texture"))
    return mx.segmentation_metrics(mx.confusion_counts(j.withColumn("pred", mx.threshold("prob")), "label", "pred"))


# --- E1 -----------------------------------------------------------------------
@register("kmeans_embeddings")
def kmeans_embeddings(spark, sf):
    emb = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    return md.kmeans(emb, "embedding", 10, max_iter=200).select("vec_id", "cluster")


# --- E2, E3, E4 on documents x labels ------------------------------------------------
def _doc_features(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id", "text", "n_chars"])
    lab = read_table(spark, sf, "labels", ["doc_id", "quality"])
    f = d.join(lab, "doc_id").select(
        "doc_id", F.col("quality").alias("label"),
        F.log1p("n_chars").alias("log_chars"),
        tx.word_count(tx.clean_text("text")).cast("double").alias("words"),
        tx.script_count("text", "[à-ÿ]").cast("double").alias("accents"),
        F.regexp_count("text", F.lit("[0-9]")).cast("double").alias("digits"),
        F.regexp_count("text", F.lit("[.,;:!?]")).cast("double").alias("punct"))
    return stored(mx.fold_by_hash(f, "doc_id", 5), "document-features")


def _doc_split(spark, sf):
    f = _doc_features(spark, sf)
    return f.filter(F.col("fold") != 0), f.filter(F.col("fold") == 0)


def _quality_scores(train, test, estimator) -> DataFrame:
    m = md.fit_pipeline(train, DOC_FEATURES, estimator)
    return md.positive_probability(m.transform(test)).select("doc_id", "label", "prediction", "p")


def _logreg():
    return LogisticRegression(labelCol="label", maxIter=50)


def _forest():
    return RandomForestClassifier(labelCol="label", numTrees=20, maxDepth=6, seed=42)


@register("logreg_quality")
def logreg_quality(spark, sf):
    return _quality_scores(*_doc_split(spark, sf), _logreg())


@register("rf_quality")
def rf_quality(spark, sf):
    return _quality_scores(*_doc_split(spark, sf), _forest())


@register("gbt_quality")
def gbt_quality(spark, sf):
    return _quality_scores(*_doc_split(spark, sf), md.gbt())


@register("model_compare")
def model_compare(spark, sf):
    train, test = _doc_split(spark, sf)
    return md.compare_models(train, test, DOC_FEATURES, "label", {
        "logistic_regression": _logreg(), "random_forest": _forest(), "boosted_trees": md.gbt()})


# --- E12 ----------------------------------------------------------------------
_SCORED = "SELECT quality, n_chars, n_chars / (n_chars + 800.0) AS p FROM documents JOIN labels USING (doc_id)"


def _auc_sql(score: str) -> str:
    return (f"SELECT '{score}' AS score, round((sum(rk) FILTER (WHERE quality = 1) - p * (p + 1) / 2) / (p * n), 9) AS auc, "
            f"any_value(p) AS positives, any_value(n) AS negatives, any_value(k) AS scores FROM (SELECT quality, "
            f"rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS rk, count(*) FILTER (WHERE quality = 1) OVER () AS p, "
            f"count(*) FILTER (WHERE quality = 0) OVER () AS n, (SELECT count(DISTINCT {score}) FROM s) AS k FROM s) GROUP BY p, n")


def _scored(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id", "n_chars"]).join(read_table(spark, sf, "labels", ["doc_id", "quality"]), "doc_id")
    return d.select("quality", "n_chars", F.floor(F.col("n_chars") / 700).alias("coarse"), (F.col("n_chars") / (F.col("n_chars") + 800.0)).alias("p"))


@register("auc_quality", f"WITH s AS (SELECT *, n_chars // 700 AS coarse FROM ({_SCORED})) {_auc_sql('n_chars')} UNION ALL {_auc_sql('coarse')}")
def auc_quality(spark, sf):
    """How well length ranks quality, by single characters and with many ties."""
    rows = _scored(spark, sf)
    out = [mx.roc_auc(rows, c, "quality").select(F.lit(c).alias("score"), F.round("auc", 9).alias("auc"), "positives", "negatives", "scores")
           for c in ("n_chars", "coarse")]
    return out[0].unionByName(out[1])


@register("calibration_quality", "SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 9) AS mean_score, "
          f"round(avg(quality), 9) AS share, round(abs(avg(p) - avg(quality)), 9) AS gap FROM ({_SCORED}) GROUP BY 1")
def calibration_quality(spark, sf):
    out = mx.calibration(_scored(spark, sf), "p", "quality")
    return out.select("bin", "n", *(F.round(c, 9).alias(c) for c in ("mean_score", "share", "gap")))


# --- E8 -----------------------------------------------------------------------
@register("lasso")
def lasso(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_extendedprice", "l_quantity", "l_discount", "l_tax"])
    return md.lasso(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", reg=0.1)


@register("ols_model")
def ols_model(spark, sf):
    """E5 with Spark ML's normal-equation solver (several predictors)."""
    li = read_table(spark, sf, "lineitem", ["l_extendedprice", "l_quantity", "l_discount", "l_tax"])
    return md.lasso(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", reg=0.0)


# --- E6, E7, E8 per pixel -------------------------------------------------------
#: Penalties of the sparse mixtures, as shares of the one that leaves nothing.
SHARES = [0.9, 0.5, 0.2, 0.05]


def _pixels_and_ends(spark, sf):
    emb = read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    return emb, md.endmembers(cl.long_vectors(emb, "vec_id", "embedding", "label"), "label")


@register("unmix_ls")
def unmix_ls(spark, sf):
    emb, ends = _pixels_and_ends(spark, sf)
    return md.unmix(emb, "vec_id", "embedding", ends)


@register("unmix_constrained")
def unmix_constrained(spark, sf):
    emb, ends = _pixels_and_ends(spark, sf)
    return um.unmix_simplex(emb, "vec_id", "embedding", ends)


@register("unmix_sparse")
def unmix_sparse(spark, sf):
    emb, ends = _pixels_and_ends(spark, sf)
    return um.unmix_sparse(emb, "vec_id", "embedding", ends, SHARES)


# --- checks of fitted models ----------------------------------------------------
_LINE = ["l_quantity", "l_discount", "l_tax"]


def _all_true(names) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{n}', TRUE)" for n in names) + ") AS t(condition, holds)"


def _lineitem(spark, sf):
    return read_table(spark, sf, "lineitem", ["l_extendedprice", *_LINE])


@register("ols_check", _all_true(md.OPTIMALITY))
def ols_check(spark, sf):
    return md.lasso_optimality(_lineitem(spark, sf), _LINE, "l_extendedprice", 0.0, ols_model(spark, sf))


@register("lasso_check", _all_true(md.OPTIMALITY))
def lasso_check(spark, sf):
    return md.lasso_optimality(_lineitem(spark, sf), _LINE, "l_extendedprice", 0.1, lasso(spark, sf))


_UNMIXED = ("SELECT vec_id, {} FROM embeddings")


@register("unmix_ls_check", _UNMIXED.format("TRUE AS orthogonal"))
def unmix_ls_check(spark, sf):
    """The residual of every vector is orthogonal to all endmembers."""
    emb, ends = _pixels_and_ends(spark, sf)
    out = md.unmix(emb, "vec_id", "embedding", ends).join(emb, "vec_id")
    return out.select("vec_id", (md.residual_products(ends) < 1e-6).alias("orthogonal"))


@register("unmix_constrained_check", _UNMIXED.format("TRUE AS on_simplex, TRUE AS converged"))
def unmix_constrained_check(spark, sf):
    """Abundances are a mixture, and no mixture is better by more than the gap."""
    a = F.col("abundance")
    return unmix_constrained(spark, sf).select(
        "vec_id", ((F.abs(F.aggregate(a, F.lit(0.0), lambda s, x: s + x) - 1) < 1e-9) & (F.array_min(a) >= 0)).alias("on_simplex"),
        (F.abs("gap") < 1e-8).alias("converged"))


@register("unmix_sparse_check", "SELECT vec_id, share, TRUE AS optimal FROM embeddings, "
          "(VALUES " + ", ".join(f"(CAST({s} AS DOUBLE))" for s in SHARES) + ") AS t(share)")
def unmix_sparse_check(spark, sf):
    """The optimality conditions of every row and penalty, judged outside the
    solver by |ends . residual|: at most the penalty, equal to it where an
    endmember is active."""
    emb, ends = _pixels_and_ends(spark, sf)
    out = um.unmix_sparse(emb, "vec_id", "embedding", ends, SHARES).join(emb, "vec_id")
    signed = md.signed_products(ends)
    top = F.array_max(F.transform(md.end_products(ends, "embedding"), F.abs))
    out = out.select("vec_id", "share", "abundance", signed.alias("g"), (F.col("share") * top).alias("t"))
    off = F.array_max(F.zip_with("g", "abundance", lambda g, a: F.when(a == 0, F.greatest(F.abs(g) - F.col("t"), F.lit(0.0)))
                                 .otherwise(F.abs(g - F.col("t") * F.signum(a)))))
    return out.select("vec_id", "share", (off < 1e-8).alias("optimal"))


@register("kmeans_check", "SELECT vec_id, TRUE AS nearest FROM embeddings")
def kmeans_check(spark, sf):
    """Every vector's cluster is the one whose members' mean is nearest."""
    emb = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    return md.nearest_mean(kmeans_embeddings(spark, sf).join(emb, "vec_id"), "vec_id", "embedding", "cluster")


# Trained classifiers: what SQL knows of their rows, and that they learned something.
_SEGMENTED = (f"{_FEATS}, lab AS (SELECT image_id, (blur7 >= (SELECT avg(blur7) FROM f))::INT AS label FROM f), "
              f"t AS (SELECT lab.* FROM lab JOIN ({SPLIT_SQL}) USING (image_id) WHERE split = 'test') ")


def _counted(model: str) -> str:
    return (f"SELECT '{model}' AS model, 'rows' AS condition, count(*) AS n FROM t UNION ALL "
            f"SELECT '{model}', 'positives', sum(label)::BIGINT FROM t UNION ALL "
            f"SELECT '{model}', 'bounded', 1 UNION ALL SELECT '{model}', 'better than a constant', 1")


def _judged(model: str, scored: DataFrame, p: str) -> DataFrame:
    """Rows, positives, bounds, and whether the score ranks better than a constant,
    whose area under the curve is 0.5."""
    auc = mx.roc_auc(scored, p, "label").select((F.col("auc") > 0.5).cast("long").alias("n"))
    counts = scored.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("label").cast("long")).alias("positives"),
                        F.coalesce(F.bool_and(F.col(p).between(0, 1)), F.lit(False)).cast("long").alias("bounded"))
    out = counts.unpivot([], ["rows", "positives", "bounded"], "condition", "n")
    out = out.unionByName(auc.select(F.lit("better than a constant").alias("condition"), "n"))
    return out.select(F.lit(model).alias("model"), "condition", "n")


@register("segmentation_checks", _SEGMENTED + " UNION ALL ".join(_counted(m) for m in ("texture", "context", "blend"))
          + " UNION ALL SELECT * FROM (VALUES ('ranking', 'features', 4), ('ranking', 'shares of one', 1))")
def segmentation_checks(spark, sf):
    """The texture and context models and their blend on the held-out images, and
    the ranking of the texture model's features."""
    table = _pixel_table(spark, sf)
    model = _gbt_model(table)
    test = table.filter(F.col("split") == "test")
    texture = md.positive_probability(model.transform(test), "p_texture").select("image_id", "y", "x", "label", "p_texture")
    scored = stored(texture.join(_context(table), ["image_id", "y", "x"]).withColumn("blend", mx.blend("p_context", "p_texture")), "scored")
    out = _judged("texture", scored, "p_texture")
    for name, p in (("context", "p_context"), ("blend", "blend")):
        out = out.unionByName(_judged(name, scored, p))
    rank = md.feature_ranking(spark, model, md.FEATURES).agg(
        F.count_distinct("feature").alias("features"),
        ((F.abs(F.sum("importance") - 1) < 1e-9) & (F.min("importance") >= 0)).cast("long").alias("shares of one"))
    return out.unionByName(rank.unpivot([], ["features", "shares of one"], "condition", "n").select(
        F.lit("ranking").alias("model"), "condition", "n"))


_QUALITY = ("logistic_regression", "random_forest", "boosted_trees")


@register("quality_checks", " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS condition, TRUE AS holds" for m in _QUALITY
    for c in ("all held-out rows", "labels as given", "bounded")))
def quality_checks(spark, sf):
    """The three quality classifiers on the held-out fold, which at the smallest
    scale holds two negatives: how well they rank is tested at a larger one."""
    train, test = _doc_split(spark, sf)         # texts are read once for all three
    labels = read_table(spark, sf, "labels", ["doc_id", "quality"])
    n = test.count()
    out = None
    for name, estimator in zip(_QUALITY, (_logreg(), _forest(), md.gbt())):
        scored = stored(_quality_scores(train, test, estimator), "scored")
        right = scored.join(labels, "doc_id").agg(F.count(F.lit(1)).alias("k"), F.bool_and(F.col("label") == F.col("quality")).alias("same"))
        flags = scored.agg(F.count_distinct("doc_id").alias("ids"), F.bool_and(F.col("p").between(0, 1)).alias("bounded")) \
            .join(right).select(
                ((F.col("ids") == n) & (F.col("k") == n)).alias("all held-out rows"), F.col("same").alias("labels as given"), "bounded")
        part = flags.unpivot([], flags.columns, "condition", "holds").select(F.lit(name).alias("model"), "condition", "holds")
        out = part if out is None else out.unionByName(part)
    return out
