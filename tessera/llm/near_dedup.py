"""MinHash near-duplicates with odd sketches.

A document's set is its distinct word shingles. Documents with equal sets form
one class, whatever their number, and only one row per class goes on. MinHash
samples in bands give candidates: classes that share a band's samples. The
samples are also folded into a parity bitmap; the population count of the XOR
of two bitmaps estimates how many samples differ, sharply where similarity is
high, and throws out candidates that are far from the threshold. What is left
is confirmed on the full shingle sets.

A band's bucket may hold any number of classes, so its pairs are never listed.
First every member is held against the bucket's smallest, and the links found
are contracted to components. Only buckets that still span several components
go on, and there only members outside the bucket's largest component are held
against members of other components. These comparisons stay inside the join:
a pair leaves it if the sketches allow it and so does an exact bound. Call a
shingle rare if at most RARE members of open buckets have it. Members that share
a rare shingle are listed from it, few for each. Two others share only shingles
that are not rare; with k and l of those they share min(k, l) at most. Copies
with many edits of their own fail that bound against their whole family.

Classes are numbered by themselves and known by one text each, found by doc_id
and text hash, so a doc_id with several texts is as many members as it has sets.

Defined results: a null or empty text has no shingles and is linked with
nothing; rows that share a doc_id are judged each by its own text, and a
component bears the smallest doc_id of its rows; a row with a null doc_id is
linked with nothing and kept; an empty table gives no rows;
extra columns of any name are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, mix64, packed_texts, slices, texts, unpacked
from tessera.llm.graph import components
from tessera.session import stored

SHINGLE, PERCENT = 4, 80
#: 32 bands of 4 samples miss a pair at similarity 0.8 once in 2e7.
BANDS, ROWS = 32, 4
SKETCH_WORDS = 4
#: Pairs go on if their sketches look at least this similar. At similarity 0.8
#: the estimate falls so low, nearly six standard deviations, about 3 times in 1e9.
SKETCH_SIMILARITY = 0.45
#: Most members that have a rare shingle; every pair of them is a candidate.
RARE = 8
#: Members held against one pivot in one stretch of a task.
PIVOT_STRETCH = 256

_rng = np.random.default_rng(20)
_MUL = _rng.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64)


def sketch_limit(similarity: float = SKETCH_SIMILARITY) -> int:
    """Expected XOR population count of two sketches at that similarity."""
    bits, samples = SKETCH_WORDS * 64, BANDS * ROWS
    return math.ceil(bits / 2 * (1 - (1 - 2 / bits) ** (2 * samples * (1 - similarity))))


def shingle_hashes(text: bytes | str, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles. Bytes are
    lower-cased and split, which touch ASCII letters and white space only."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < n:
        whole = np.array([len(h)], np.uint64)
        for k in range(len(h)):
            whole = mix64(whole * np.uint64(31) + h[k:k + 1])
        return whole
    key = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        key = mix64(key + h[k:len(h) - n + 1 + k] + np.uint64(k + 1))
    return np.unique(key)


def _signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketch of a non-empty set."""
    low = np.full(len(_MUL), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[at:at + 4096, None] * _MUL + _ADD).min(axis=0))
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + low[k::ROWS])
    bit = mix64(low + np.arange(len(low), dtype=np.uint64)) % np.uint64(SKETCH_WORDS * 64)
    odd = np.bincount(bit.astype(np.int64), minlength=SKETCH_WORDS * 64) & 1
    return key.view(np.int64), np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _signatures(rows: dict) -> dict:
    out = {k: [] for k in ("n_shingles", "set_a", "set_b", "bands", "sketch")}
    for text in rows["text"]:
        s = shingle_hashes(text)
        out["n_shingles"].append(len(s))
        out["set_a"].append(int(mix64(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
        out["set_b"].append(int(mix64(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
        bands, sketch = _signature(s) if len(s) else (None, None)
        out["bands"].append(bands)
        out["sketch"].append(sketch)
    return {"doc_id": rows["doc_id"], "text_hash": rows["text_hash"], **out}


SIGNATURE = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"


def _confirm(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links (u, v) among ``pairs`` (u the pivot): similarity on the full sets.

    Members come to their pivot in stretches, so a pivot with any number of
    members is many small pieces of work; within one, rows stream past the
    pivot's set.
    """
    sized = pairs.join(pairs.groupBy("u").agg(F.count("*").alias("n")), "u") \
        .withColumn("part", F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / PIVOT_STRETCH)))
    wanted = sized.select("u", "part", F.col("v").alias("node"), F.lit(1).alias("member")) \
        .unionByName(sized.select("u", "part").distinct().select("u", "part", F.col("u").alias("node"), F.lit(0).alias("member")))
    rows = wanted.join(held, "node").repartition("u", "part").sortWithinPartitions("u", "part", "member", "node")

    def run(batches):
        pivot, own = None, []
        for part in slices(batches, "packed", 1 << 20):
            u_, v_ = [], []
            for u, p, node, member, packed in zip(*(part.column(k).to_pylist() for k in ("u", "part", "node", "member", "packed"))):
                if (u, p) != pivot:
                    pivot, own = (u, p), []
                s = shingle_hashes(unpacked(packed))
                if not member:
                    own.append(s)
                    continue
                for x in own:
                    both = len(np.intersect1d(x, s, assume_unique=True))
                    if both and 100 * both >= PERCENT * (len(x) + len(s) - both):
                        u_.append(u)
                        v_.append(node)
                        break
            yield pa.RecordBatch.from_pydict({"u": pa.array(u_, pa.int64()), "v": pa.array(v_, pa.int64())})

    return rows.select("u", "part", "node", "member", "packed").mapInArrow(run, "u long, v long")


def _differ(a: str, b: str):
    """Population count of the XOR of two sketch columns."""
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SKETCH_WORDS)), F.lit(0))


def _possible(shared, n, m):
    """Whether sets of n and m shingles that share at most ``shared`` can be linked."""
    return 100 * shared >= PERCENT * (n + m - shared)


def _rare_shingles(held: DataFrame, nodes: DataFrame) -> DataFrame:
    """(shingle, node, n): the rare shingles among the nodes, each with the n
    nodes that have it."""
    def run(rows: dict) -> dict:
        sets = [shingle_hashes(unpacked(t)) for t in rows["packed"]]
        n = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.concatenate([np.zeros(0, np.uint64), *sets])
        return {"node": np.repeat(np.array(rows["node"], np.int64), n), "shingle": flat.view(np.int64)}

    every = map_texts(held.join(nodes, "node").select("node", "packed"), run, "node long, shingle long",
                      column="packed", limit=1 << 20)
    rare = every.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") <= RARE)
    return every.join(rare, "shingle")


def _hashed(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept of every row of ``docs``."""
    rows = stored(map_texts(_hashed(docs), _signatures, SIGNATURE), "signatures")
    # one row per set: bands and sketch are functions of the set
    classes = stored(rows.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")).withColumn("node", F.monotonically_increasing_id()), "classes")
    # the pivot is the member of the smallest doc_id: the same one in all buckets of a
    # family, and the text that the others were made from where copies come later
    member = classes.select("node", "rep.doc_id", F.explode("bands").alias("key"))
    shared = member.groupBy("key").agg(F.min(F.struct("doc_id", "node")).alias("first"), F.min("node").alias("low"), F.max("node").alias("high"))
    shared = shared.where("low < high").select("key", F.col("first.node").alias("pivot"))
    bucket = stored(member.drop("doc_id").join(shared, "key").distinct(), "buckets")
    nodes = bucket.select("node").distinct().join(classes.select("node", "rep.doc_id", "rep.text_hash"), "node")
    held = packed_texts(_hashed(docs)).join(nodes, ["doc_id", "text_hash"]).select("node", "packed").distinct()
    held = stored(held, "candidate-texts")
    info = classes.select("node", "n", "sketch")

    a, b = (info.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"s{k}")) for k in "uv")
    star = bucket.where("node <> pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    near = (_differ("su", "sv") <= sketch_limit()) & _possible(F.least("nu", "nv"), F.col("nu"), F.col("nv"))
    tried = stored(star.join(b, "v").join(a, "u").where(near).select("u", "v").distinct(), "pairs")
    links = stored(_confirm(held, tried), "confirmed")
    group = stored(components(links), "groups")

    left = bucket.select("key", "node").join(group, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    size = left.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = size.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
    left = stored(left.join(main.where("parts > 1").select("key", "main"), "key"), "open")
    rare = stored(_rare_shingles(held, left.select("node").distinct()), "rare")
    own = rare.groupBy("node").agg(F.count("*").alias("own"))
    # a pair leaves the join in the first bucket that it shares only; a node is in BANDS buckets at most
    keys = left.groupBy("node").agg(F.collect_set("key").alias("keys"))
    full = left.join(info, "node").join(keys, "node").join(own, "node", "left").withColumn("k", F.col("n") - F.coalesce("own", F.lit(0)))
    a, b = (full.select("key", "main", *(F.col(c).alias(f"{c}{k}") for c in ("node", "component", "n", "k", "sketch", "keys"))) for k in "uv")
    outside = a.where("componentu != main").drop("main")
    both = F.least("ku", "kv")
    pairs = outside.join(b, (outside["key"] == b["key"]) & (F.col("componentu") != F.col("componentv"))
                         & ((F.col("componentv") == F.col("main")) | (F.col("nodeu") < F.col("nodev")))
                         & _possible(both, F.col("nu"), F.col("nv")) & (_differ("sketchu", "sketchv") <= sketch_limit())
                         & (F.array_min(F.array_intersect("keysu", "keysv")) == outside["key"]))
    pairs = pairs.select(F.col("nodev").alias("u"), F.col("nodeu").alias("v")).distinct()
    who = rare.where("n > 1").groupBy("shingle").agg(F.array_sort(F.collect_set("node")).alias("who"))
    by_rare = F.flatten(F.transform("who", lambda x: F.transform(F.filter("who", lambda y: y > x), lambda y: F.struct(x.alias("u"), y.alias("v")))))
    part = left.groupBy("node").agg(F.min("component").alias("component"))
    by_rare = who.select(F.explode(by_rare).alias("p")).select("p.u", "p.v").distinct()
    c, d = (info.join(part, "node").select(*(F.col(x).alias(x + k) for x in ("node", "n", "sketch", "component"))) for k in "uv")
    by_rare = by_rare.join(d, F.col("v") == F.col("nodev")).join(c, F.col("u") == F.col("nodeu")).where(
        (F.col("componentu") != F.col("componentv")) & _possible(F.least("nu", "nv"), F.col("nu"), F.col("nv"))
        & (_differ("sketchu", "sketchv") <= sketch_limit())).select("u", "v")
    pairs = pairs.unionByName(by_rare).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    known = tried.unionByName(tried.select(F.col("v").alias("u"), F.col("u").alias("v")))
    fresh = stored(pairs.join(known, ["u", "v"], "left_anti"), "pairs")
    found = stored(_confirm(held, fresh), "confirmed")
    if not found.isEmpty():
        group = stored(components(links.unionByName(found)), "groups")

    label = classes.select("set_a", "set_b", "node", "rep.doc_id").join(group, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = label.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    label = label.join(least, "component").select("set_a", "set_b", "component_id")
    out = rows.select("doc_id", "text_hash", "n_shingles", "set_a", "set_b").join(label, ["set_a", "set_b"], "left").select(
        "doc_id", "text_hash", "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    return labelled(docs).drop("text_hash")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one of the
    smallest doc_id, with all its rows in the group. Rows that share a doc_id
    stay or go each by its own text; rows without an id stay."""
    gone = labelled(docs).where("not kept").select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_hash")).distinct()
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["_gone"]) & (F.xxhash64(text) == gone["_hash"]), "left_anti")
