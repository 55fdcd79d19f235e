"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of ``block_words`` words. Slot i gets the golden
ratio point u(i); the cumulative target shares cut [0, 1) into one interval per
source, and the interval that holds u(i) names the slot's source. The r-th
slot of a source takes words [r * block, (r + 1) * block) of that source's
stream: its documents in shuffled (hashed) order, read round and round. Any
stretch of the sequence is therefore mixed like the whole, and the last slot of
a source is cut where its target is met.

A source may hold any share of the rows: stream positions come from sums per
(source, hash range) and running sums inside a range; slot ranks from counts
per (stretch of slots, source) and ranks inside a stretch.

Defined results: a null text has size 0 and takes nothing; a null source is a
source of its own, last in order; repeated rows are placed one by one and
share a result; with no words at all every target is 0; an empty table gives
no rows; extra columns of any name are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD_SQL
from tessera.session import stored

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE, MAX_REPEATS = 1.5, 2
BLOCK_WORDS = 512
#: Golden ratio step for slot points: odd, so i * STEP mod 2**31 visits every
#: point once in 2**31 slots; the product stays inside a signed long.
STEP, PERIOD = 1327217885, 1 << 31
#: Slots ranked together, and equal cells of [0, 1) that match slots to sources.
STRETCH, CELLS = 1 << 16, 1024
#: Hash ranges in which a source's documents are put in order.
RANGE_BITS = 12


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, shuffle key, row number) of every row, stored;
    the number tells repeated rows apart and decides nothing else."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.expr(f"regexp_count(cast(text as string), '{WORD_SQL}')"), F.lit(0)).cast("long").alias("size"))
    return stored(rows.withColumn("key", F.xxhash64(F.lit(7), "doc_id", "source", "size"))
                  .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def targets(sizes: DataFrame, weights=WEIGHTS, total_share=TOTAL_SHARE, max_repeats=MAX_REPEATS) -> DataFrame:
    """One row per source: number, size, target words, interval of the schedule.

    The shares by weight stop at ``max_repeats`` times the source's size and
    what is over goes to the others by weight, again and again. That ends at
    min(cap, weight * level); sorted by cap / weight, the level is found in one
    pass over running sums. Rows here are sources, not documents.
    """
    one = F.lit(0)
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.partitionBy(one).orderBy(F.col("source").isNull(), "source")
    s = s.withColumn("source_no", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1))
    s = s.withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    whole = Window.partitionBy(one)
    order = Window.partitionBy(one).orderBy("ratio", "source_no")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("all_words", F.sum("source_size").over(whole))
    s = s.withColumn("level", (F.col("all_words") * F.lit(total_share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(onward))
    s = s.withColumn("level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "source_no", "level")))
                     .over(whole)["level"])
    s = s.withColumn("target", F.coalesce(F.least("cap", F.col("weight") * F.col("level")), "cap"))
    s = s.withColumn("words", F.round("target").cast("long"))
    run = F.sum("words").over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    whole_mix = F.sum("words").over(whole)
    return s.select("source", "source_no", "source_size", "target", "words",
                    F.when(whole_mix > 0, (run - F.col("words")) / whole_mix).otherwise(0.0).alias("from"),
                    F.when(whole_mix > 0, run / whole_mix).otherwise(0.0).alias("to"))


def placed(sizes: DataFrame, source: DataFrame) -> DataFrame:
    """Every row with its source's figures and its place in the source's stream."""
    rows = (sizes.join(source.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
            .drop("name").withColumn("range", F.shiftrightunsigned("key", 64 - RANGE_BITS)))
    sums = rows.groupBy("source_no", "range").agg(F.sum("size").alias("n"))
    base = sums.select("source_no", "range", F.coalesce(F.sum("n").over(
        Window.partitionBy("source_no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "range").orderBy("key", "doc_id", "size", "row")
    return (rows.join(base, ["source_no", "range"])
            .withColumn("start", F.col("base") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
                        - F.col("size"))
            .drop("range", "base", "key"))


def schedule(source: DataFrame, block_words: int = BLOCK_WORDS, step: int = STEP) -> DataFrame:
    """(source_no, rank, slot): one row per slot that the mix needs. ``step`` (odd)
    over ``PERIOD`` is how far the point moves from slot to slot.

    A source whose turns come more often than its target needs passes them; one
    that is short by a turn or two gets the missing ones after the others.
    """
    spark = source.sparkSession
    need = source.select("source_no", F.ceil(F.col("words") / block_words).alias("need"), "from", "to")
    n = need.agg(F.sum("need")).first()[0] or 0
    cells = need.where("to > from").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("from") * CELLS), F.least(F.floor(F.col("to") * CELLS), F.lit(CELLS - 1)))))
    slots = spark.range(n).select(F.col("id").alias("slot"),
                                  ((F.col("id") % PERIOD * step) % PERIOD / PERIOD).alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") * CELLS)).join(cells, "cell")
    slots = slots.where("point >= from and point < to").withColumn("stretch", F.floor(F.col("slot") / STRETCH))
    counts = slots.groupBy("source_no", "stretch").agg(F.count("*").alias("n"))
    base = counts.select("source_no", "stretch", F.coalesce(F.sum("n").over(
        Window.partitionBy("source_no").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("stretch", "source_no").orderBy("slot")
    ranked = (slots.join(base, ["source_no", "stretch"])
              .withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)
              .where("rank < need").select("source_no", "rank", "slot"))
    got = counts.groupBy("source_no").agg(F.sum("n").alias("got"))
    late = (need.join(got, "source_no", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < need")
            .select("source_no", F.explode(F.sequence(F.col("got"), F.col("need") - 1)).alias("rank"))
            .withColumn("slot", F.lit(n) + F.col("rank")))
    return ranked.unionByName(late)


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, step: int = STEP) -> DataFrame:
    """The mix: one row per document stretch in a slot (slot, rank, words from
    and to inside the document's words, ``words`` taken), and one with null slot
    for a row that the mix takes nothing from."""
    sizes = sized(docs)
    source = stored(targets(sizes), "mix-sources")
    rows = placed(sizes, source)
    turns = F.transform(F.array(*map(F.lit, range(MAX_REPEATS))), lambda k: F.col("start") + k * F.col("source_size"))
    parts = rows.withColumn("at", F.explode(turns))
    end = F.least(F.col("at") + F.col("size"), F.col("words"))
    parts = parts.withColumn("rank", F.explode_outer(F.when(end > F.col("at"), F.sequence(
        F.floor(F.col("at") / block_words), F.floor((end - 1) / block_words)))))
    slots = schedule(source, block_words, step)
    parts = parts.join(slots, ["source_no", "rank"], "left")
    lo = F.greatest(F.col("rank") * block_words, "at")
    hi = F.least((F.col("rank") + 1) * block_words, end)
    return parts.select("doc_id", "source", "size", "source_size", "target", "start", "row", "slot", "rank",
                        (lo - F.col("at")).alias("word_from"), (hi - F.col("at")).alias("word_to"),
                        F.when(F.col("slot").isNotNull(), hi - lo).otherwise(0).cast("long").alias("taken"))


def taken(docs: DataFrame, block_words: int = BLOCK_WORDS, step: int = STEP) -> DataFrame:
    """One row per document: its source's figures, the words the mix takes, and
    where in the mix they stand: how many slots hold some, the first of them and
    a digest of all. ``step`` turns the schedule (see ``schedule``)."""
    return (mix(docs, block_words, step).groupBy("doc_id", "source", "size", "source_size", "target", "row")
            .agg(F.sum("taken").alias("taken"), F.count("slot").alias("n_slots"), F.min("slot").alias("first_slot"),
                 F.coalesce(F.sum(F.xxhash64("slot", "word_from", "word_to").bitwiseAND((1 << 40) - 1)), F.lit(0)).alias("slot_digest"))
            .drop("row"))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` as the mix takes them, for the stages after it: each row once
    for every time that half its words or more are taken. Only the document in
    which a source's target falls is taken in part, so a source's words differ
    from its target by half a document at most. Rows without words are not
    taken. Rows that share doc_id and source share the larger number."""
    times = taken(docs, block_words).groupBy(F.col("doc_id").alias("_doc"), F.col("source").alias("_source")).agg(
        F.max(F.round(F.col("taken") / F.greatest("size", F.lit(1)))).cast("int").alias("_times")).where("_times > 0")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"].cast("long").alias("doc"),
                       docs["source"].cast("string").alias("source"))
    out = rows.join(times, F.col("doc").eqNullSafe(F.col("_doc")) & F.col("source").eqNullSafe(F.col("_source")))
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("row.*")
