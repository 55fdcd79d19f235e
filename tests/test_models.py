"""The model chain on real labels: both classes, better than a constant answer."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import models as md
from tessera.plans import ml
from tests.conftest import SF001, SF01


def test_hybrid_report_beats_the_constant_answers(spark):
    r = ml.hybrid_report(spark, SF001).first()
    share = (r.tp + r.fn) / (r.tp + r.fp + r.fn + r.tn)
    assert 0.2 < share < 0.8
    assert r.accuracy > max(share, 1 - share) + 0.05
    assert r.dice > 2 * share / (1 + share)          # all positive


def test_folds_have_errors_and_beat_a_guess(spark):
    """Five folds of a small forest: MAE above zero, below that of one class."""
    from tessera.operators import metrics as mx
    table = ml._pixel_table(spark, SF001).filter("split = 'train'")
    sample = md.training_sample(table, images=30, fraction=0.1).withColumn("pid", F.col("image_id") * 64 + F.col("y") * 8 + F.col("x"))
    folds = mx.stratified_folds(sample, "label", "pid", 5)
    mae = [r.mae for r in md.cross_validate_mae(folds, md.FEATURES, md.gbt(max_iter=5, max_depth=4)).collect()]
    share = sample.agg(F.avg("label")).first()[0]
    assert len(mae) == 5 and sum(mae) > 0 and sum(mae) / 5 < min(share, 1 - share)


def test_one_class_is_an_error(spark):
    df = spark.range(10).withColumn("label", F.lit(0))
    with pytest.raises(ValueError):
        md.require_classes(df, "label")
    assert md.require_classes(df.withColumn("label", F.col("id") % 2), "label").count() == 10


def test_checks_can_fail(spark):
    df = spark.createDataFrame([(float(k), float(k % 3), 2.0 * k + 5) for k in range(60)], "a double, b double, y double")
    right, wrong = ([("a", s), ("b", 0.0), ("intercept", 5.0)] for s in (2.0, 1.9))
    for rows, want in ((right, [True, True, True]), (wrong, [False, True, False])):
        fitted = spark.createDataFrame(rows, "feature string, coefficient double")
        got = [r.holds for r in md.lasso_optimality(df, ["a", "b"], "y", 0.0, fitted).collect()]
        assert got[0] == want[0] and got[2] == want[2]


def test_quality_models_rank_better_than_a_constant(spark):
    from tessera.operators import metrics as mx
    for query in (ml.logreg_quality, ml.rf_quality):
        r = mx.roc_auc(query(spark, SF01), "p", "label").first()
        assert r.auc > 0.5 + 1.64 * ((r.positives + r.negatives + 1) / (12 * r.positives * r.negatives)) ** 0.5


def test_a_fold_is_one_fit_on_few_parts(spark, monkeypatch):
    from pyspark.ml import Pipeline
    seen, fit = [], Pipeline.fit

    def counted(self, data, *a):
        seen.append((data.count(), data.rdd.getNumPartitions()))
        return fit(self, data, *a)

    monkeypatch.setattr(Pipeline, "fit", counted)
    df = spark.range(60, numPartitions=12).select(F.col("id").cast("double").alias("a"), (F.col("id") % 2).alias("label"), (F.col("id") % 5).alias("fold"))
    out = md.cross_validate_mae(df, ["a"], md.gbt(max_iter=1, max_depth=1)).collect()
    assert sorted(r.fold for r in out) == list(range(5))
    assert seen == [(48, 1)] * 5
    assert md.few_parts(spark.range(3 * md.TASK_ROWS + 1, numPartitions=9)).rdd.getNumPartitions() == 4


def test_quality_checks_read_the_texts_once(spark, monkeypatch):
    rows = spark.createDataFrame([(k, k % 2, *(float(k * j % 7) for j in range(5)), k % 5) for k in range(100)],
                                 "doc_id long, label int, " + ", ".join(f"{c} double" for c in ml.DOC_FEATURES) + ", fold int")
    calls = []
    monkeypatch.setattr(ml, "_doc_features", lambda s, sf: calls.append(sf) or rows)
    monkeypatch.setattr(ml, "read_table", lambda *a: rows.select("doc_id", F.col("label").alias("quality")))
    assert all(r.holds for r in ml.quality_checks(spark, "nowhere").collect())
    assert calls == ["nowhere"]
