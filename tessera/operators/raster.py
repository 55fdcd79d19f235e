"""Raster operators over a pixel table ``(image_id, y, x, v, height, width)``.

Pixels are rows, so an image of any size spreads over many tasks. Stencils
are separable: one window pass along x (partitioned by image row) and one
along y (partitioned by image column), i.e. two shuffles for every feature
together; a window partition is one image row or column, bounded by the
image's width or height. Borders are reflect-101 (``dcba|abcd|dcba`` without
repeating the edge): in one pass each pixel near an edge also emits its
mirrored position, after which plain ``lag``/``lead`` see reflected
neighbours.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import fixed
from tessera.operators.series import rank_within
from tessera.session import default_parallelism

# FIXED VALUES: separable Gaussian taps for 3x3 and 7x7 kernels with sigma
# derived from the size (the standard small-kernel tables), and the 3-tap
# Sobel smoothing / difference kernels.
GAUSS3 = [0.25, 0.5, 0.25]
GAUSS7 = [1 / 32, 7 / 64, 7 / 32, 9 / 32, 7 / 32, 7 / 64, 1 / 32]
SMOOTH3 = [1.0, 2.0, 1.0]
DIFF3 = [-1.0, 0.0, 1.0]

#: Leading hex digits of a pixel's hash that the sampling counts by.
SAMPLE_DIGITS = 3

PIXEL_COLS = ["image_id", "y", "x", "v", "height", "width"]


def explode_raster(images: DataFrame, id_col: str, values_col: str,
                   height: int | Column, width: int | Column) -> DataFrame:
    """Row-major flat array -> one row per pixel."""
    h = height if isinstance(height, Column) else F.lit(height)
    w = width if isinstance(width, Column) else F.lit(width)
    px = images.select(F.col(id_col).alias("image_id"), h.alias("height"), w.alias("width"),
                       F.posexplode(values_col).alias("pos", "v"))
    return px.select("image_id", (F.col("pos") / F.col("width")).cast("int").alias("y"),
                     (F.col("pos") % F.col("width")).cast("int").alias("x"),
                     "v", "height", "width")


def quantise(c) -> Column:
    """Embedding float in about (-1, 1) -> grey value 0..255."""
    return F.floor((F.col(c).cast("double") + 1) * 127.5).cast("int")


def _pad(px: DataFrame, axis: str, r: int) -> DataFrame:
    """Add reflect-101 mirror rows within ``r`` of both edges along ``axis``.

    One pass: every pixel emits itself and, when it lies within ``r`` of an
    edge, its mirror position(s) (``inline`` of candidate structs, empty
    candidates dropped) - the input is read and computed once.
    """
    size = "width" if axis == "x" else "height"
    a, n = F.col(axis), F.col(size)
    cands = F.array(
        F.struct(a.alias("_a"), F.lit(False).alias("_pad")),
        F.struct(F.when((a >= 1) & (a <= r), -a).alias("_a"), F.lit(True).alias("_pad")),
        F.struct(F.when((a >= n - 1 - r) & (a <= n - 2), 2 * (n - 1) - a).alias("_a"),
                 F.lit(True).alias("_pad")))
    out = px.select(*[c for c in px.columns if c != axis], F.inline(cands))
    return out.filter(F.col("_a").isNotNull()).withColumnRenamed("_a", axis)


def convolve_pass(px: DataFrame, axis: str, kernels: dict[str, tuple[str, list[float]]]) -> DataFrame:
    """Apply 1-D kernels along ``axis``; ``kernels`` maps output -> (input, taps).

    Taps are centred (odd length). Columns not named as inputs are carried.
    """
    r = max(len(t) // 2 for _, t in kernels.values())
    other = "y" if axis == "x" else "x"
    w = Window.partitionBy("image_id", other).orderBy(axis)
    padded = _pad(px, axis, r)
    outs = []
    for name, (src, taps) in kernels.items():
        k = len(taps) // 2
        terms = []
        for i, wt in enumerate(taps):
            d = i - k
            if wt == 0:
                continue
            val = F.col(src) if d == 0 else (F.lead(src, d).over(w) if d > 0 else F.lag(src, -d).over(w))
            terms.append(F.lit(float(wt)) * val)
        outs.append(reduce(lambda a, b: a + b, terms).alias(name))
    carried = [c for c in px.columns if c not in kernels]
    return padded.select(*carried, "_pad", *outs).filter(~F.col("_pad")).drop("_pad")


def pixel_features(px: DataFrame, wrap: bool = False) -> DataFrame:
    """Per-pixel ``pixel, dog, sobel, var`` features.

    ``wrap=True`` reproduces 8-bit wrap-around of the original's
    ``blur3 - blur7`` and variance (blurs rounded to integers, then mod 256).
    """
    base = px.withColumn("v", F.col("v").cast("double")).withColumn("vsq", F.col("v") * F.col("v"))
    rows = convolve_pass(base, "x", {
        "h3": ("v", GAUSS3), "h7": ("v", GAUSS7), "h3sq": ("vsq", GAUSS3),
        "hd": ("v", DIFF3), "hs": ("v", SMOOTH3)})
    cols = convolve_pass(rows, "y", {
        "blur3": ("h3", GAUSS3), "blur7": ("h7", GAUSS7), "mean_sq": ("h3sq", GAUSS3),
        "gx": ("hd", SMOOTH3), "gy": ("hs", DIFF3)})
    if wrap:
        b3, b7 = F.round("blur3"), F.round("blur7")
        dog = F.pmod(b3 - b7, F.lit(256.0)) / 255.0
        var = F.pmod(F.round("mean_sq") - F.round(F.col("blur3") * F.col("blur3")), F.lit(256.0))
    else:
        dog = (F.col("blur3") - F.col("blur7")) / 255.0
        var = F.col("mean_sq") - F.col("blur3") * F.col("blur3")
    return cols.select(
        "image_id", "y", "x",
        (F.col("v") / 255.0).alias("pixel"),
        dog.alias("dog"),
        (F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")) / 255.0).alias("sobel"),
        var.alias("var"),
        "blur3", "blur7")


def mask_sum_filter(images: DataFrame, masks: DataFrame,
                    min_sum: int = fixed.INK_MIN_SUM) -> DataFrame:
    """Images whose mask grey-value sum exceeds ``min_sum``.

    Sum per image is a partial (map-side) aggregate; the survivors semi-join
    the image table, so image pixels are never shuffled for the test.
    """
    inked = (masks.groupBy("image_id").agg(F.sum("v").alias("mask_sum"))
             .filter(F.col("mask_sum") > min_sum).select("image_id"))
    return images.join(inked, "image_id", "left_semi")


#: Weighted source pixels that one task of a resampling sums.
RESAMPLE_ROWS = 4_000_000


def _reached(axis: str, size: str, out_n: int) -> Column:
    """Targets (t, w) along one axis that take source position ``axis``, with its
    weight: a range of positions around it, of which those whose two taps are
    elsewhere drop out. A tap of weight 0 is still a tap."""
    a, n = F.col(axis), F.col(size)
    step = n / F.lit(out_n)
    low = F.when(a < 1, F.lit(0)).otherwise(F.greatest(F.floor((a - 0.5) / step - 0.5) - 1, F.lit(0)))
    high = F.when(a >= n - 1, F.lit(out_n - 1)).otherwise(F.least(F.ceil((a + 1.5) / step - 0.5) + 1, F.lit(out_n - 1)))

    def weighed(t):
        at = F.greatest((t + 0.5) * n / F.lit(out_n) - 0.5, F.lit(0.0))
        first = F.least(F.floor(at).cast("int"), n - 1)
        part, second = at - first, F.least(first + 1, n - 1)
        own = F.when(first == a, 1 - part).otherwise(F.lit(0.0)) + F.when(second == a, part).otherwise(F.lit(0.0))
        return F.struct(t.alias("t"), F.when((first == a) | (second == a), own).alias("w"))
    return F.when((a >= 0) & (a < n), F.filter(F.transform(F.sequence(low.cast("int"), high.cast("int")), weighed), lambda r: r["w"].isNotNull()))


def resample_bilinear(px: DataFrame, out_h: int, out_w: int) -> DataFrame:
    """Bilinear resize with half-pixel centres and edge clamping.

    Every pixel goes to the target rows that take it, with its weight, and there
    to the targets of that row; ``sum(weight * v)`` reduces per target. No join
    is needed, so nothing depends on how large Spark thinks the pixels are, and
    the one shuffle has as many parts as the weighted pixels need at
    RESAMPLE_ROWS each: a task's memory does not grow with the table. The smallest
    part is a target row of an image.
    """
    px = px.where(F.col("image_id").isNotNull())
    many = px.agg(F.sum(F.try_divide(F.lit(4.0 * out_h * out_w), F.col("height") * F.col("width")))).first()[0] or 0
    n = max(default_parallelism(px.sparkSession), int(many // RESAMPLE_ROWS) + 1)
    rows = px.select("image_id", "x", "v", "width", F.inline(_reached("y", "height", out_h))).withColumnsRenamed({"t": "ty", "w": "wy"})
    taps = rows.repartition(n, "image_id", "ty").select("image_id", "ty", "wy", "v", F.inline(_reached("x", "width", out_w)))
    return (taps.groupBy("image_id", F.col("ty").alias("y"), F.col("t").alias("x"))
            .agg(F.sum(F.col("wy") * F.col("w") * F.col("v")).alias("v")))


def hash_key(seed: int, *cols: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def pixel_sample(px: DataFrame, fraction: float = fixed.SAMPLE_FRACTION,
                 seed: int = fixed.SPLIT_SEED) -> DataFrame:
    """floor(fraction * n) pixels per image, lowest seeded hash first.

    Deterministic (the original draws unseeded, with replacement). A count per
    image and leading hash digits (a partial aggregate, at most 16**SAMPLE_DIGITS
    rows an image) tells at which digits an image's share ends. Pixels before
    them stay and pixels behind them go where they are read; only those on the
    digits themselves, about one in 16**SAMPLE_DIGITS, are ranked, in range
    slices, so neither a hot image nor the whole table is ever sorted.
    """
    keyed = px.withColumn("_h", hash_key(seed, "image_id", "y", "x")).withColumn("_d", F.substring("_h", 1, SAMPLE_DIGITS))
    counts = keyed.groupBy("image_id", "_d").agg(F.count("*").alias("_n"))
    image = Window.partitionBy("image_id")
    upto = F.sum("_n").over(image.orderBy("_d"))
    cuts = (counts.select("image_id", F.col("_d").alias("_cut"), "_n", upto.alias("_upto"),
                          F.floor(F.sum("_n").over(image) * fraction).alias("_want"))
            .filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
            .select("image_id", "_cut", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_left")))
    near = keyed.join(cuts, "image_id").filter(F.col("_d") <= F.col("_cut"))
    inside = near.filter(F.col("_d") < F.col("_cut"))
    edge = rank_within(near.filter(F.col("_d") == F.col("_cut")), ["_h", "y", "x"], "_rank", partition_cols=["image_id"])
    return inside.select(*px.columns).unionByName(edge.filter(F.col("_rank") <= F.col("_left")).select(*px.columns))


def three_way_split(ids: DataFrame, id_col: str, sizes: tuple[int, int, int] | None = None,
                    fractions=fixed.SPLIT_FALLBACK, seed: int = fixed.SPLIT_SEED) -> DataFrame:
    """``split`` in train/val/test by seeded hash rank.

    Proportional over all ids: int(0.7n) / int(0.15n) / the rest. With
    ``sizes`` (the original's 564/121/121), that many ids go to train, val and
    test and any others to ``unused``; fewer ids than their sum are an error.
    The total is a scalar subquery, not a join.
    """
    n = ids.select(F.count(F.lit(1))).scalar()
    ranked = rank_within(ids.withColumn("_h", hash_key(seed, id_col)), ["_h", id_col], "_rank")
    r = F.col("_rank")
    if sizes is not None:
        tr, va, te = sizes
        split = (F.when(n < tr + va + te, F.raise_error(F.lit(f"fewer than {tr + va + te} ids")))
                 .when(r <= tr, "train").when(r <= tr + va, "val").when(r <= tr + va + te, "test").otherwise("unused"))
    else:
        tl, vl = F.floor(n * fractions[0]), F.floor(n * fractions[1])
        split = F.when(r <= tl, "train").when(r <= tl + vl, "val").otherwise("test")
    return ranked.withColumn("split", split).drop("_h", "_rank")
