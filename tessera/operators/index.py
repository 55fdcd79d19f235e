"""A positional inverted index and phrase search over it.

The MapReduce shape with a secondary sort: words are mapped to (word, document,
position) and grouped by word, and each group is sorted by document and position
and cut into one posting per document. The list of a common word would be one
group that grows with the corpus; lists are split by ranges of document ids, so
a group holds at most the postings of ``SPAN`` ids, and the parts of a list are
in order by their range. Positions move once, each as one number that also tells
the document's place in its range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tessera.operators.frames import computed_once

#: Document ids of one part of a posting list.
SPAN = 4096


def word_positions(docs: DataFrame, id_col: str, words) -> DataFrame:
    """(id, word, pos) of every word; ``words`` is an array column without empty words."""
    return docs.select(id_col, F.posexplode(words).alias("pos", "word"))


def inverted_index(positions: DataFrame, id_col: str, span: int = SPAN) -> DataFrame:
    """(word, part, docs, occurrences, postings): ``postings`` is an array of
    (id, positions), by id; ``part`` is the range of ids it covers."""
    part = F.floor(F.col(id_col) / span)
    kind = positions.schema[id_col].dataType
    if not isinstance(kind, IntegralType):
        one = positions.groupBy("word", id_col).agg(F.sort_array(F.collect_list("pos")).alias("positions"))
        lists = one.groupBy("word", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct(id_col, "positions"))).alias("postings"))
        held = F.aggregate("postings", F.lit(0).cast("long"), lambda n, p: n + F.size(p["positions"]))
        return lists.select("word", "part", F.size("postings").cast("long").alias("docs"), held.alias("occurrences"), "postings")
    place = F.coalesce(F.col(id_col) - part * span, F.lit(0)).cast("long")      # ids without a range are null
    at = positions.select("word", part.alias("part"), (F.shiftleft(place, 31) + F.col("pos")).alias("at"))
    lists = computed_once(at.groupBy("word", "part").agg(F.sort_array(F.collect_list("at")).alias("at")))

    def doc(x):
        return F.shiftright(x, 31)

    first = F.filter(F.sequence(F.lit(0), F.size("at") - 1), lambda k: (k == 0) | (doc(F.get("at", k)) != doc(F.get("at", k - 1))))
    lists = computed_once(lists.select("word", "part", "at", first.alias("first")))

    def posting(low, k):
        own = F.slice("at", low + 1, F.coalesce(F.get("first", k + 1), F.size("at")) - low)
        return F.struct((F.col("part") * span + doc(F.get("at", low))).cast(kind).alias(id_col),
                        F.transform(own, lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")).alias("positions"))

    return lists.select("word", "part", F.size("first").cast("long").alias("docs"), F.size("at").cast("long").alias("occurrences"),
                        F.transform("first", posting).alias("postings"))


def phrase_search(index: DataFrame, id_col: str, phrase: list[str]) -> DataFrame:
    """(id, pos) of every place of the words one after the other.

    Only the phrase's lists are read. A list's positions are moved back by the
    word's place in the phrase, so places of the phrase are those that all words
    agree on: one aggregate on (id, place), split like the lists.
    """
    spark = index.sparkSession
    wanted = F.broadcast(spark.createDataFrame(list(enumerate(phrase)), "off int, word string"))   # as long as the phrase
    lists = index.where(F.col("word").isin(sorted(set(phrase)))).join(wanted, "word")
    posts = lists.select("off", F.explode("postings").alias("p"))
    at = posts.select(F.col(f"p.{id_col}").alias(id_col), "off", F.explode("p.positions").alias("pos"))
    at = at.withColumn("pos", F.col("pos") - F.col("off"))
    return at.groupBy(id_col, "pos").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(phrase)).select(id_col, "pos")
