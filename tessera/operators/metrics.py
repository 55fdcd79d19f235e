"""Segmentation and loss metrics (A7-A16, M4, M5) as one-pass aggregates.

Every metric is a global or grouped aggregate with map-side partial
aggregation; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import fixed


def blend(a, b, weights=fixed.BLEND_WEIGHTS) -> Column:
    """Weighted blend of two probability columns (M4)."""
    return F.lit(weights[0]) * F.col(a) + F.lit(weights[1]) * F.col(b)


def threshold(p, t: float = fixed.BLEND_THRESHOLD) -> Column:
    """Strict ``p > t`` as 0/1 (F8)."""
    return (F.col(p) > F.lit(t)).cast("int") if isinstance(p, str) else (p > F.lit(t)).cast("int")


def confusion_counts(df: DataFrame, truth: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """TP, FP, FN, TN in one pass."""
    t, p = F.col(truth) == 1, F.col(pred) == 1
    aggs = [F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
            F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn")]
    return df.groupBy(*(by or [])).agg(*aggs)


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 (zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def segmentation_metrics(counts: DataFrame, beta: float = fixed.F_BETA,
                         eps: float = fixed.F_BETA_EPS) -> DataFrame:
    """IoU, Dice/F1, precision, recall, accuracy, F-beta.

    Also the accuracy of predicting every pixel positive, the constant
    baseline the report is read against (Q23).
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    out = counts.select(
        "*",
        _ratio(tp, tp + fp + fn).alias("iou"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("dice"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp + fn, tp + tn + fp + fn).alias("all_positive_accuracy"))
    b2 = beta * beta
    return out.withColumn(
        "f_beta", F.lit(1 + b2) * F.col("precision") * F.col("recall")
        / (F.lit(b2) * F.col("precision") + F.col("recall") + F.lit(eps)))


def soft_dice_loss(df: DataFrame, p: str, y: str, by: list[str] | None = None,
                   smooth: float = fixed.DICE_SMOOTH) -> DataFrame:
    """1 - (2 sum(p y) + s) / (sum p + sum y + s), flattened per group."""
    g = df.groupBy(*(by or [])).agg(F.sum(F.col(p) * F.col(y)).alias("_i"),
                                    F.sum(p).alias("_sp"), F.sum(y).alias("_sy"))
    return g.select(*(by or []), (1 - (2 * F.col("_i") + smooth)
                                  / (F.col("_sp") + F.col("_sy") + smooth)).alias("dice_loss"))


def _clamped_log(c: Column) -> Column:
    """log with the result floored at -100 (the usual BCE convention)."""
    return F.greatest(F.log(F.when(c > 0, c)), F.lit(-100.0))


def bce_loss(df: DataFrame, p: str, y: str, by: list[str] | None = None) -> DataFrame:
    """mean of -(y ln p + (1 - y) ln(1 - p)) per group."""
    pc, yc = F.col(p), F.col(y)
    term = -(yc * F.coalesce(_clamped_log(pc), F.lit(-100.0))
             + (1 - yc) * F.coalesce(_clamped_log(1 - pc), F.lit(-100.0)))
    return df.groupBy(*(by or [])).agg(F.avg(term).alias("bce_loss"))


def combo_loss(df: DataFrame, p: str, y: str, batch: str) -> DataFrame:
    """0.5 Dice + 0.5 BCE per batch, and their mean over batches."""
    d = soft_dice_loss(df, p, y, [batch])
    b = bce_loss(df, p, y, [batch])
    per = d.join(b, batch).withColumn("combo", 0.5 * F.col("dice_loss") + 0.5 * F.col("bce_loss"))
    return per.agg(F.avg("combo").alias("mean_combo_loss"), F.count(F.lit(1)).alias("batches"))


def mae_by_fold(df: DataFrame, y: str, pred: str, fold: str) -> DataFrame:
    """MAE of hard predictions per fold, i.e. the error rate."""
    return df.groupBy(fold).agg(F.avg(F.abs(F.col(y) - F.col(pred))).alias("mae"))


def score_summary(scores: DataFrame, col: str = "mae") -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return scores.agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"),
                      F.count(F.lit(1)).alias("folds"))


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5) -> DataFrame:
    """0-based ``fold`` equal to ``ntile(k)`` within each label, ordered by id (M2).

    A label class is large by nature (a third of the rows or more), so the
    within-class position comes from the range-sliced running count rather
    than one window per class; the class size is a partial aggregate. With
    ``q, r = divmod(n, k)`` the first ``r`` folds hold ``q + 1`` rows, as
    ``ntile`` assigns them.
    """
    from tessera.operators.series import rank_within
    ranked = rank_within(df, [id_col], "_pos", partition_cols=[label])
    # class sizes from the (checkpointed) ranks: no second pass over ``df``
    n = ranked.groupBy(label).agg(F.max("_pos").alias("_n"))
    ranked = ranked.join(n, label)
    q = F.floor(F.col("_n") / k)
    r = F.col("_n") - q * k
    pos = F.col("_pos") - 1
    big = r * (q + 1)
    fold = F.when(pos < big, F.floor(pos / (q + 1))).otherwise(r + F.floor((pos - big) / q))
    return ranked.withColumn("fold", fold.cast("int")).drop("_pos", "_n")


def fold_by_hash(df: DataFrame, id_col: str, k: int = 5, seed: int = fixed.SPLIT_SEED) -> DataFrame:
    """0-based ``fold`` from a seeded hash of the id: no shuffle at all."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(k)).cast("int"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """(auc, positives, negatives, scores): the area under the ROC curve, exact
    also where scores are equal: a pair of equal scores counts one half (E12).

    Rows first become counts per distinct score; the negatives below a score are
    a running sum over those, sliced by range (no single-task sort), and the sum
    of positive x negative pairs is exact in decimals. Null without both labels.
    """
    from tessera.operators.series import running_sum
    by = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    run = running_sum(by, ["score"], "neg", "upto")
    twice = F.col("pos").cast("decimal(19,0)") * (2 * F.col("upto") - F.col("neg")).cast("decimal(19,0)")
    total = run.agg(F.sum(twice).alias("u"), F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
                    F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"), F.count(F.lit(1)).alias("scores"))
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return total.select(F.when(pairs > 0, F.col("u").cast("double") / (2 * pairs)).alias("auc"), "positives", "negatives", "scores")


def calibration(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """(bin, n, mean_score, share, gap) of scores in [0, 1] by equal bins: how
    far the mean score of a bin is from its share of positives (E12)."""
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    out = df.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
                                          F.avg((F.col(label) == 1).cast("double")).alias("share"))
    return out.withColumn("gap", F.abs(F.col("mean_score") - F.col("share")))
