"""Registered raster and metric queries.

The driver data holds no images; ``embeddings`` (64 floats per row) is read as
8x8 grey rasters, values quantised to 0..255 (``floor((e + 1) * 127.5)``).
The stand-in mask of an image keeps grey values >= ``MASK_LEVEL`` and zeroes
the rest; the context map is the 7x7 blur and the texture map the pixel value,
both scaled to [0, 1].
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import fixed
from tessera.operators import metrics as mx
from tessera.operators import raster as rx
from tessera.plans.registry import register
from tessera.sources.tables import read_table

SIDE = 8
MASK_LEVEL = 170


def pixels(spark, sf):
    emb = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    px = rx.explode_raster(emb, "vec_id", "embedding", SIDE, SIDE)
    return px.withColumn("v", rx.quantise("v"))


def masks(px):
    return px.withColumn("v", F.when(F.col("v") >= MASK_LEVEL, F.col("v")).otherwise(F.lit(0)))


# ---- SQL building blocks -----------------------------------------------------
_PX = ("px AS (SELECT image_id, CAST(pos // 8 AS INTEGER) AS y, CAST(pos % 8 AS INTEGER) AS x, "
       "CAST(floor((CAST(e AS DOUBLE) + 1) * 127.5) AS INTEGER) AS v FROM "
       "(SELECT vec_id AS image_id, unnest(range(len(embedding))) AS pos, unnest(embedding) AS e "
       "FROM embeddings))")


def _reflect(e: str) -> str:
    return f"(CASE WHEN {e} < 0 THEN -({e}) WHEN {e} > 7 THEN 14 - ({e}) ELSE {e} END)"


def _taps(name: str, taps: list[float]) -> str:
    k = len(taps) // 2
    vals = ", ".join(f"({i - k}, {repr(float(w))})" for i, w in enumerate(taps))
    return f"{name}(d, w) AS (VALUES {vals})"


def _conv2d(name: str, src: str, col: str, ky: str, kx: str) -> str:
    """2-D stencil by offset-table join: an independent spelling of the
    separable window passes."""
    return (f"{name} AS (SELECT p.image_id, p.y, p.x, sum(a.w * b.w * q.{col}) AS val "
            f"FROM {src} p, {ky} a, {kx} b, {src} q WHERE q.image_id = p.image_id "
            f"AND q.y = {_reflect('p.y + a.d')} AND q.x = {_reflect('p.x + b.d')} "
            f"GROUP BY p.image_id, p.y, p.x)")


_KERNELS = ", ".join([_taps("g3", rx.GAUSS3), _taps("g7", rx.GAUSS7),
                      _taps("sm", rx.SMOOTH3), _taps("df", rx.DIFF3)])
_FEATS = (f"WITH {_PX}, {_KERNELS}, pxx AS (SELECT image_id, y, x, CAST(v AS DOUBLE) AS v, "
          "CAST(v AS DOUBLE) * v AS vsq FROM px), "
          f"{_conv2d('b3', 'pxx', 'v', 'g3', 'g3')}, {_conv2d('b7', 'pxx', 'v', 'g7', 'g7')}, "
          f"{_conv2d('msq', 'pxx', 'vsq', 'g3', 'g3')}, {_conv2d('gx', 'pxx', 'v', 'sm', 'df')}, "
          f"{_conv2d('gy', 'pxx', 'v', 'df', 'sm')}, "
          "f AS (SELECT pxx.image_id, pxx.y, pxx.x, pxx.v / 255.0 AS pixel, "
          "(b3.val - b7.val) / 255.0 AS dog, sqrt(gx.val * gx.val + gy.val * gy.val) / 255.0 AS sobel, "
          "msq.val - b3.val * b3.val AS var, b3.val AS blur3, b7.val AS blur7 FROM pxx "
          "JOIN b3 USING (image_id, y, x) JOIN b7 USING (image_id, y, x) "
          "JOIN msq USING (image_id, y, x) JOIN gx USING (image_id, y, x) "
          "JOIN gy USING (image_id, y, x))")


def _features(spark, sf):
    return rx.pixel_features(pixels(spark, sf))


# ---- P1 ------------------------------------------------------------------------
@register("raster_explode", f"WITH {_PX} SELECT image_id, y, x, v FROM px")
def raster_explode(spark, sf):
    return pixels(spark, sf).select("image_id", "y", "x", "v")


# ---- P2-P5, F9 -------------------------------------------------------------------
def _feature_query(col):
    def q(spark, sf):
        return _features(spark, sf).select("image_id", "y", "x", col)
    return q


for _name, _col in [("gaussian_blur3", "blur3"), ("gaussian_blur7", "blur7"), ("dog", "dog"),
                    ("sobel", "sobel"), ("local_variance", "var")]:
    register(_name, f"{_FEATS} SELECT image_id, y, x, {_col} FROM f")(_feature_query(_col))


@register("pixel_features", f"{_FEATS} SELECT image_id, y, x, pixel, dog, sobel, var FROM f")
def pixel_features(spark, sf):
    return _features(spark, sf).select("image_id", "y", "x", "pixel", "dog", "sobel", "var")


def _mod256(e: str) -> str:
    return f"((({e}) % 256 + 256) % 256)"


@register("pixel_features_wrap",
          f"{_FEATS} SELECT f.image_id, f.y, f.x, {_mod256('round(blur3) - round(blur7)')} / 255.0 AS dog, "
          f"{_mod256('round(msq.val) - round(blur3 * blur3)')} AS var FROM f JOIN msq USING (image_id, y, x)")
def pixel_features_wrap(spark, sf):
    """The features as 8-bit arithmetic leaves them: differences wrap around."""
    return rx.pixel_features(pixels(spark, sf), wrap=True).select("image_id", "y", "x", "dog", "var")


# ---- F6, J1 ----------------------------------------------------------------------
@register("mask_sum_filter",
          f"WITH {_PX} SELECT image_id, count(*) AS pixels FROM px WHERE image_id IN "
          f"(SELECT image_id FROM px GROUP BY image_id HAVING sum(CASE WHEN v >= {MASK_LEVEL} "
          f"THEN v ELSE 0 END) > {fixed.INK_MIN_SUM}) GROUP BY image_id")
def mask_sum_filter(spark, sf):
    px = pixels(spark, sf)
    kept = rx.mask_sum_filter(px, masks(px))
    return kept.groupBy("image_id").agg(F.count(F.lit(1)).alias("pixels"))


# ---- P6 --------------------------------------------------------------------------
def _resize_sql(n: int) -> str:
    return (f"WITH {_PX}, t AS (SELECT image_id, ty, tx FROM (SELECT DISTINCT image_id FROM px), "
            f"range({n}) r1(ty), range({n}) r2(tx)), "
            f"s AS (SELECT image_id, ty, tx, greatest((ty + 0.5) * 8 / {n} - 0.5, 0.0) AS sy, "
            f"greatest((tx + 0.5) * 8 / {n} - 0.5, 0.0) AS sx FROM t), "
            "c AS (SELECT *, least(floor(sy)::INT, 7) AS y0, least(floor(sx)::INT, 7) AS x0 FROM s), "
            "w AS (SELECT image_id, ty, tx, y0 AS y, x0 AS x, (1 - (sy - y0)) * (1 - (sx - x0)) AS wt FROM c "
            "UNION ALL SELECT image_id, ty, tx, y0, least(x0 + 1, 7), (1 - (sy - y0)) * (sx - x0) FROM c "
            "UNION ALL SELECT image_id, ty, tx, least(y0 + 1, 7), x0, (sy - y0) * (1 - (sx - x0)) FROM c "
            "UNION ALL SELECT image_id, ty, tx, least(y0 + 1, 7), least(x0 + 1, 7), (sy - y0) * (sx - x0) FROM c) "
            "SELECT w.image_id, CAST(w.ty AS INTEGER) AS y, CAST(w.tx AS INTEGER) AS x, sum(w.wt * px.v) AS v FROM w JOIN px "
            "USING (image_id, y, x) GROUP BY w.image_id, w.ty, w.tx")


@register("resample_bilinear", _resize_sql(4))
def resample_bilinear(spark, sf):
    return rx.resample_bilinear(pixels(spark, sf), 4, 4)


@register("resample_enlarge", _resize_sql(13))
def resample_enlarge(spark, sf):
    """Back to a larger size, as a probability map returns to its slice's."""
    return rx.resample_bilinear(pixels(spark, sf), 13, 13)


# ---- P7 --------------------------------------------------------------------------
@register("pixel_sample",
          f"WITH {_PX}, r AS (SELECT image_id, y, x, row_number() OVER (PARTITION BY image_id ORDER BY "
          f"md5(concat_ws(':', '{fixed.SPLIT_SEED}', image_id::VARCHAR, y::VARCHAR, x::VARCHAR)), y, x) AS rk, "
          "count(*) OVER (PARTITION BY image_id) AS n FROM px) "
          f"SELECT image_id, y, x FROM r WHERE rk <= floor(n * {fixed.SAMPLE_FRACTION})")
def pixel_sample(spark, sf):
    return rx.pixel_sample(pixels(spark, sf)).select("image_id", "y", "x")


# ---- P8 --------------------------------------------------------------------------
def _split_sql(case: str) -> str:
    return ("WITH ids AS (SELECT DISTINCT vec_id AS image_id FROM embeddings), "
            "r AS (SELECT image_id, row_number() OVER (ORDER BY "
            f"md5(concat_ws(':', '{fixed.SPLIT_SEED}', image_id::VARCHAR)), image_id) AS rk, "
            f"count(*) OVER () AS n FROM ids) SELECT image_id, CASE {case} END AS split FROM r")


_F0, _F1 = fixed.SPLIT_FALLBACK
#: The original's fixed sizes, a quarter of them so that the small tables have rows to spare.
FIXED_SIZES = tuple(k // 4 for k in fixed.SPLIT_SIZES)


def _image_ids(spark, sf):
    return read_table(spark, sf, "embeddings", ["vec_id"]).select(F.col("vec_id").alias("image_id")).distinct()


SPLIT_SQL = _split_sql(
    f"WHEN rk <= floor(n * {_F0}) THEN 'train' WHEN rk <= floor(n * {_F0}) + floor(n * {_F1}) THEN 'val' ELSE 'test'")


@register("three_way_split", SPLIT_SQL)
def three_way_split(spark, sf):
    return rx.three_way_split(_image_ids(spark, sf), "image_id").select("image_id", "split")


@register("three_way_split_fixed", _split_sql(
    f"WHEN rk <= {FIXED_SIZES[0]} THEN 'train' WHEN rk <= {sum(FIXED_SIZES[:2])} THEN 'val' "
    f"WHEN rk <= {sum(FIXED_SIZES)} THEN 'test' ELSE 'unused'"))
def three_way_split_fixed(spark, sf):
    return rx.three_way_split(_image_ids(spark, sf), "image_id", sizes=FIXED_SIZES).select("image_id", "split")


# ---- J6, M4, F8 --------------------------------------------------------------------
def _blend_df(spark, sf):
    px = pixels(spark, sf)
    feats = rx.pixel_features(px)
    ctx = feats.select("image_id", "y", "x", (F.col("blur7") / 255.0).alias("p_context"))
    tex = px.select("image_id", "y", "x", (F.col("v") / 255.0).alias("p_texture"),
                    (F.col("v") >= MASK_LEVEL).cast("int").alias("label"))
    j = ctx.join(tex, ["image_id", "y", "x"])
    j = j.withColumn("prob", mx.blend("p_context", "p_texture"))
    return j.withColumn("pred", mx.threshold("prob"))


_BLEND_SQL = (f"{_FEATS}, j AS (SELECT f.image_id, f.y, f.x, "
              f"{fixed.BLEND_WEIGHTS[0]} * (f.blur7 / 255.0) + {fixed.BLEND_WEIGHTS[1]} * (px.v / 255.0) AS prob, "
              f"CAST(px.v >= {MASK_LEVEL} AS INTEGER) AS label FROM f JOIN px USING (image_id, y, x)), "
              f"jb AS (SELECT *, CAST(prob > {fixed.BLEND_THRESHOLD} AS INTEGER) AS pred FROM j)")


@register("blend_threshold", f"{_BLEND_SQL} SELECT image_id, y, x, round(prob, 9) AS prob, pred FROM jb")
def blend_threshold(spark, sf):
    return _blend_df(spark, sf).select("image_id", "y", "x", F.round("prob", 9).alias("prob"), "pred")


# ---- A8-A12, M5 ----------------------------------------------------------------------
_CONF_SQL = ("SELECT count(*) FILTER (WHERE {t} = 1 AND {p} = 1) AS tp, "
             "count(*) FILTER (WHERE {t} = 0 AND {p} = 1) AS fp, "
             "count(*) FILTER (WHERE {t} = 1 AND {p} = 0) AS fn, "
             "count(*) FILTER (WHERE {t} = 0 AND {p} = 0) AS tn FROM {src}")


@register("confusion_counts", _CONF_SQL.format(t="quality", p="toxic", src="labels"))
def confusion_counts(spark, sf):
    return mx.confusion_counts(read_table(spark, sf, "labels"), "quality", "toxic")


def _metrics_sql(counts_sql: str) -> str:
    b2 = fixed.F_BETA ** 2
    def ratio(n, d):
        return f"CASE WHEN ({d}) = 0 THEN 0.0 ELSE CAST({n} AS DOUBLE) / ({d}) END"
    return (f"WITH c AS ({counts_sql}), m AS (SELECT *, {ratio('tp', 'tp + fp + fn')} AS iou, "
            f"{ratio('2 * tp', '2 * tp + fp + fn')} AS dice, {ratio('tp', 'tp + fp')} AS precision, "
            f"{ratio('tp', 'tp + fn')} AS recall, {ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy, "
            f"{ratio('tp + fn', 'tp + tn + fp + fn')} AS all_positive_accuracy FROM c) "
            "SELECT tp, fp, fn, tn, round(iou, 9) AS iou, round(dice, 9) AS dice, "
            "round(precision, 9) AS precision, round(recall, 9) AS recall, round(accuracy, 9) AS accuracy, "
            "round(all_positive_accuracy, 9) AS all_positive_accuracy, "
            f"round({1 + b2} * precision * recall / ({b2} * precision + recall + {fixed.F_BETA_EPS}), 9) "
            "AS f_beta FROM m")


def _rounded_metrics(df):
    return df.select(*[F.round(c, 9).alias(c) if c not in ("tp", "fp", "fn", "tn") else c
                       for c in df.columns])


@register("segmentation_metrics",
          _BLEND_SQL + ", " + _metrics_sql(_CONF_SQL.format(t="label", p="pred", src="jb"))
          .removeprefix("WITH "))
def segmentation_metrics(spark, sf):
    counts = mx.confusion_counts(_blend_df(spark, sf), "label", "pred")
    return _rounded_metrics(mx.segmentation_metrics(counts))


@register("label_metrics", _metrics_sql(_CONF_SQL.format(t="quality", p="toxic", src="labels")))
def label_metrics(spark, sf):
    counts = mx.confusion_counts(read_table(spark, sf, "labels"), "quality", "toxic")
    return _rounded_metrics(mx.segmentation_metrics(counts))


# ---- A13-A15 ---------------------------------------------------------------------------
_LOG = "greatest(ln(CASE WHEN {x} > 0 THEN {x} END), -100.0)"


@register("soft_dice",
          f"{_BLEND_SQL} SELECT round(1 - (2 * sum(prob * label) + {fixed.DICE_SMOOTH}) / "
          f"(sum(prob) + sum(label) + {fixed.DICE_SMOOTH}), 9) AS dice_loss FROM jb")
def soft_dice(spark, sf):
    d = mx.soft_dice_loss(_blend_df(spark, sf), "prob", "label")
    return d.select(F.round("dice_loss", 9).alias("dice_loss"))


_BCE_TERM = (f"-(label * coalesce({_LOG.format(x='prob')}, -100.0) + "
             f"(1 - label) * coalesce({_LOG.format(x='1 - prob')}, -100.0))")


@register("bce_loss", f"{_BLEND_SQL} SELECT round(avg({_BCE_TERM}), 9) AS bce_loss FROM jb")
def bce_loss(spark, sf):
    b = mx.bce_loss(_blend_df(spark, sf), "prob", "label")
    return b.select(F.round("bce_loss", 9).alias("bce_loss"))


@register("combo_loss",
          f"{_BLEND_SQL}, per AS (SELECT image_id // 8 AS batch, "
          f"1 - (2 * sum(prob * label) + {fixed.DICE_SMOOTH}) / (sum(prob) + sum(label) + {fixed.DICE_SMOOTH}) AS d, "
          f"avg({_BCE_TERM}) AS b FROM jb GROUP BY 1) "
          "SELECT round(avg(0.5 * d + 0.5 * b), 9) AS mean_combo_loss, count(*) AS batches FROM per")
def combo_loss(spark, sf):
    j = _blend_df(spark, sf).withColumn("batch", (F.col("image_id") / 8).cast("long"))
    c = mx.combo_loss(j, "prob", "label", "batch")
    return c.select(F.round("mean_combo_loss", 9).alias("mean_combo_loss"), "batches")


# ---- M2 folds, A16, A7 --------------------------------------------------------------------
_FOLDS_SQL = ("SELECT doc_id, quality, toxic, CAST(ntile(5) OVER (PARTITION BY quality ORDER BY doc_id) - 1 "
              "AS INTEGER) AS fold FROM labels")


def _folds(spark, sf):
    return mx.stratified_folds(read_table(spark, sf, "labels"), "quality", "doc_id", 5)


@register("cv_folds", f"SELECT doc_id, fold FROM ({_FOLDS_SQL})")
def cv_folds(spark, sf):
    return _folds(spark, sf).select("doc_id", "fold")


_MAE_SQL = (f"SELECT fold, avg(abs(quality - (1 - toxic))) AS mae FROM ({_FOLDS_SQL}) GROUP BY fold")


@register("mae_by_fold", f"SELECT fold, round(mae, 9) AS mae FROM ({_MAE_SQL})")
def mae_by_fold(spark, sf):
    f = _folds(spark, sf).withColumn("pred", 1 - F.col("toxic"))
    return mx.mae_by_fold(f, "quality", "pred", "fold").select("fold", F.round("mae", 9).alias("mae"))


@register("cv_summary",
          f"SELECT round(avg(mae), 9) AS mean, round(stddev_pop(mae), 9) AS std, count(*) AS folds "
          f"FROM ({_MAE_SQL})")
def cv_summary(spark, sf):
    f = _folds(spark, sf).withColumn("pred", 1 - F.col("toxic"))
    s = mx.score_summary(mx.mae_by_fold(f, "quality", "pred", "fold"))
    return s.select(F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"), "folds")


# ---- J1: document x label pairing --------------------------------------------------------
@register("pair_join",
          "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)")
def pair_join(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id", "lang"])
    lab = read_table(spark, sf, "labels")
    return d.join(lab, "doc_id").select("doc_id", "lang", "quality", "toxic")
