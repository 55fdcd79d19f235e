"""Model-as-aggregate classifiers.

Each model is a small table derived by aggregation: class x dimension
statistics, or trigram x language log probabilities. The class models reach
the scoring rows as one array per class through a scalar subquery, so scoring
is an expression over the row's own vector: no join, no shuffle, no row per
point, dimension and class. The number of classes is checked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import fixed
from tessera.session import stored


def long_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str | None = None) -> DataFrame:
    """(id, [label,] d, x) - one row per vector component."""
    keep = [id_col] + ([label_col] if label_col else [])
    return df.select(*keep, F.posexplode(vec_col).alias("d", "x")).withColumn(
        "x", F.col("x").cast("double"))


#: Most classes (or languages) a model may have; labels are categories, so more
#: of them means that the label column is not one.
MAX_CLASSES = 1000


def _class_model(stats: DataFrame, label_col: str, *fields: str):
    """Scalar subquery: array of (label, [per dimension struct of ``fields``], n)."""
    per_class = stats.groupBy(label_col).agg(
        F.array_sort(F.collect_list(F.struct("d", *fields))).alias("dims"), F.max("n").alias("n"))
    row = per_class.agg(F.collect_list(F.struct(F.col(label_col).alias("label"), "dims", "n")).alias("m"))
    return row.select(F.when(F.size("m") <= MAX_CLASSES, F.col("m")).otherwise(
        F.raise_error(F.lit(f"more than {MAX_CLASSES} classes")))).scalar()


def _sum(arr) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)


def gaussian_nb(train: DataFrame, score: DataFrame, id_col: str, vec_col: str, label_col: str,
                var_smoothing: float = 1e-9) -> DataFrame:
    """Gaussian naive Bayes: per-class mean/variance per dimension; predicted
    class maximises log prior + sum of log densities (E9).

    Variance is the population variance plus ``var_smoothing`` times the
    largest variance; of equal scores the smallest label wins.
    """
    stats = long_vectors(train, id_col, vec_col, label_col).groupBy(label_col, "d").agg(
        F.avg("x").alias("mu"), F.var_pop("x").alias("var"), F.count(F.lit(1)).alias("n"))
    eps = stats.select(F.max("var") * var_smoothing).scalar()  # scalar subquery
    model = _class_model(stats.withColumn("var", F.col("var") + eps), label_col, "mu", "var")
    total = train.select(F.count(F.lit(1))).scalar()
    rows = score.select(id_col, vec_col, model.alias("_model"), total.alias("_total"))

    def log_density(x, m):
        gap = x.cast("double") - m["mu"]
        return -0.5 * F.log(2 * math.pi * m["var"]) - gap * gap / (2 * m["var"])

    best = F.array_max(F.transform("_model", lambda m: F.struct(
        (_sum(F.zip_with(F.col(vec_col), m["dims"], log_density)) + F.log(m["n"] / F.col("_total"))).alias("score"),
        (m["label"] * -1).alias("order"), m["label"].alias("label"))))
    return rows.select(id_col, best["label"].alias("pred"))


def min_distance(train: DataFrame, score: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Nearest class centroid by squared Euclidean distance."""
    stats = long_vectors(train, id_col, vec_col, label_col).groupBy(label_col, "d").agg(
        F.avg("x").alias("c"), F.count(F.lit(1)).alias("n"))
    model = _class_model(stats, label_col, "c")

    def square(x, m):
        return (x.cast("double") - m["c"]) * (x.cast("double") - m["c"])

    best = F.array_min(F.transform("_model", lambda m: F.struct(
        _sum(F.zip_with(F.col(vec_col), m["dims"], square)).alias("dist"), m["label"].alias("label"))))
    return score.select(id_col, vec_col, model.alias("_model")).select(id_col, best["label"].alias("pred"))


def lang_sample(text, sample_chars: int = fixed.LANG_SAMPLE_CHARS) -> Column:
    """Lower-cased leading sample the trigram profile is built from."""
    return F.lower(F.substring(F.col(text) if isinstance(text, str) else text, 1, sample_chars))


def trigrams(sample_col: str) -> Column:
    """Overlapping character trigrams of an already computed sample column.

    A zero-width lookahead capturing three characters matches at every
    position, so ``regexp_extract_all`` yields all overlapping trigrams in
    one codegen'd pass (no per-position lambda)."""
    return F.regexp_extract_all(F.col(sample_col), F.lit("(?s)(?=(.{3}))"), 1)


#: Places counted at once: bounds the arrays of a task whatever the texts' length.
GRAM_PLACES = 1 << 20


def _counted_grams(texts: list[str]):
    """(grams, counts) of texts' trigrams, as ``trigrams`` finds them: at every
    UTF-16 unit three code points, half of a pair being a question mark."""
    joined = "".join(texts)
    units = np.frombuffer(joined.encode("utf-16-le"), np.uint16)
    lens = [len(t) for t in texts] if len(units) == len(joined) else [len(t.encode("utf-16-le")) // 2 for t in texts]
    ends = np.cumsum(lens)
    for at in range(0, len(units), GRAM_PLACES):
        u = units[at:at + GRAM_PLACES + 6].astype(np.int64)           # three pairs at most from the last place on
        n = min(GRAM_PLACES, len(units) - at)
        third = np.arange(2, n + 2)
        cps = np.concatenate([u, np.full(6, 0x3F)])
        halves = (cps >= 0xD800) & (cps < 0xE000)
        if halves.any():
            pair = np.flatnonzero(halves & (cps < 0xDC00))
            step = np.ones(len(cps), np.int64)
            step[pair] = 2
            cps[pair] = 0x10000 + ((cps[pair] - 0xD800) << 10) + (cps[pair + 1] - 0xDC00)
            cps[halves & (step == 1)] = 0x3F
            second = np.arange(n) + step[:n]
            third = second + step[second]
            after = third + step[third]
        else:
            second, after = np.arange(1, n + 1), third + 1
        first = np.searchsorted(ends, at, "right")
        stop = np.searchsorted(ends, at + n - 1, "right") + 1
        until = np.repeat(ends[first:stop], np.diff(np.concatenate([[at], np.minimum(ends[first:stop], at + n)])))
        whole = at + after <= until
        keys = ((cps[:n] << 42) | (cps[second] << 21) | cps[third])[whole]
        keys, counts = np.unique(keys, return_counts=True)
        back = np.stack([keys >> 42, (keys >> 21) & 0x1FFFFF, keys & 0x1FFFFF], 1).astype("<u4").tobytes().decode("utf-32-le")
        yield [back[k:k + 3] for k in range(0, len(back), 3)], counts


def _count_trigrams(batches):
    """Batches (lang, text) to (lang, gram, c), summed over some texts of a language."""
    for batch in batches:
        by: dict = {}
        size: dict = {}

        def counted(lang):
            size[lang] = 0
            for grams, counts in _counted_grams(by.pop(lang)):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), batch.schema.field(0).type), pa.array(grams, pa.string()),
                                                  pa.array(counts, pa.int64())], ["lang", "gram", "c"])

        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if text := text.as_py():
                by.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                if size[lang] >= GRAM_PLACES:
                    yield from counted(lang)
        for lang in list(by):
            yield from counted(lang)


@dataclass
class LanguageProfiles:
    """``table`` (gram, logp): one log probability per language, in the order
    of ``langs``; ``unseen`` is each language's floor for grams it never had."""
    langs: list[str]
    unseen: list[float]
    table: DataFrame


def language_profiles(docs: DataFrame, text_col: str, lang_col: str) -> LanguageProfiles:
    """Trigram profiles with add-one smoothing over the joint vocabulary, from
    the whole texts in one pass.

    Tasks count the grams of their texts in arrays, so what reaches the aggregate
    is a row for each gram of some texts and not one for each character. The
    counts are pre-aggregated per (language, gram), gathered to one row per
    gram - at most one entry per language - and written once; totals and
    vocabulary are read from that table.
    """
    low = docs.select(F.col(lang_col).alias("lang"), F.lower(text_col).alias("_s"))
    made = T.StructType([T.StructField("lang", low.schema["lang"].dataType), T.StructField("gram", T.StringType()), T.StructField("c", T.LongType())])
    counts = (low.mapInArrow(_count_trigrams, made)
              .groupBy("lang", "gram").agg(F.sum("c").alias("c")))
    table = stored(counts.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "c"))).alias("c")), "grams")
    total = table.select(F.explode("c").alias("lang", "c")).groupBy("lang").agg(F.sum("c").alias("t"))
    rows = sorted(total.limit(MAX_CLASSES + 1).collect())
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} languages")
    size = [r["t"] + table.count() for r in rows] if rows else []
    logp = F.array(*(F.log((F.coalesce(F.try_element_at("c", F.lit(r["lang"])), F.lit(0)) + 1) / F.lit(float(n)))
                     for r, n in zip(rows, size)))
    return LanguageProfiles([r["lang"] for r in rows], [math.log(1 / n) for n in size],
                            table.select("gram", logp.alias("logp")))


def language_scores(docs: DataFrame, id_col: str, text_col: str, profiles: LanguageProfiles) -> DataFrame:
    """Best-scoring language per document (F3, re-aimed language detection).

    Sums log p over the trigrams of the document's leading sample, for all
    languages at once: one join on the gram (AQE broadcasts the profile when
    its measured size allows and splits a hot gram's partition otherwise) and
    one aggregate per document. Of equal scores the last language name wins.
    """
    smp = docs.select(id_col, lang_sample(text_col).alias("_s"))
    grams = smp.select(id_col, F.explode(trigrams("_s")).alias("gram"))
    if not profiles.langs:  # nothing to tell apart
        return grams.where("false").select(id_col, F.lit("").alias("pred_lang"))
    floor = F.array(*map(F.lit, profiles.unseen))
    p = grams.join(profiles.table, "gram", "left").withColumn("logp", F.coalesce("logp", floor))
    sums = [F.sum(F.col("logp")[k]).alias(f"s{k}") for k in range(len(profiles.langs))]
    best = F.array_max(F.array(*(F.struct(F.col(f"s{k}").alias("s"), F.lit(lang).alias("lang"))
                                 for k, lang in enumerate(profiles.langs))))
    # a document none of whose grams any language had cannot be told
    known = F.max(F.col("gram_known").cast("int"))
    p = p.withColumn("gram_known", F.col("logp") != floor)
    return p.groupBy(id_col).agg(*sums, known.alias("k")).where("k = 1").select(id_col, best["lang"].alias("pred_lang"))
