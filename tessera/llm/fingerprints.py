"""Document fingerprints by randomised edit embedding.

All texts share one random walk: step t has a random bit for every class of
characters, and a text stays at its character or goes to the next as the bit of
its class says. Output symbol t is the character that step t reads. After an
insertion or deletion two walks fall back into step after a few characters, so
edit distance becomes Hamming distance between the outputs. A fingerprint
samples the output at positions that depend on the walk's length alone and
change little with it, and keeps a 4-bit hash of the symbols there; equal texts
have equal fingerprints. Likeness is the share of equal samples, corrected for
chance. Bands of samples find candidate pairs, full fingerprints verify them.

The step bits repeat with a period; inside it the walk is a linked table whose
row for step t leads, for each class, to the row after the step that leaves the
character, so walking costs one lookup per character.

Defined results: a null or empty text has the fingerprint of an empty walk,
alike to other empty texts only; rows are followed by the next in ascending
doc_id (null ids last, equal ids in text order, the last row by the first), a
lone row by itself; an empty table gives no rows; extra columns of any name are
not read.
"""

from __future__ import annotations

import hashlib
import math
from functools import cache
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, mix64, slices, texts
from tessera.llm.graph import components
from tessera.session import stored

#: Steps before the bits repeat; classes of characters; samples.
PERIOD, CLASSES, SAMPLES = 1 << 12, 64, 256
#: Bits kept of a sampled symbol, and the characters of a symbol.
SYMBOL_BITS, SYMBOL_CHARS = 4, 2
#: Samples in a band of the candidate search: 32 bands of 8 samples.
BAND = 8
#: Likeness from which pairs are reported.
ALIKE = 0.8
#: Characters walked in one go; memory follows it, not the text's length.
STRIDE = 1 << 20


@cache
def _table() -> list[list]:
    """Row t: for each class the row after the step that leaves it; the last
    entry is t itself."""
    rng = np.random.default_rng(77)
    bits = rng.integers(0, 2, (PERIOD, CLASSES), dtype=np.int8).astype(bool)
    bits[0] = True  # every class moves somewhere in a period
    rows: list[list] = [[None] * CLASSES + [t] for t in range(PERIOD)]
    for c in range(CLASSES):
        leaves = np.flatnonzero(bits[:, c])
        nxt = leaves[np.searchsorted(leaves, np.arange(PERIOD), "left") % len(leaves)]
        for t in range(PERIOD):
            rows[t][c] = rows[(int(nxt[t]) + 1) % PERIOD]
    return rows


@cache
def _records() -> np.ndarray:
    """Sampled positions: column k holds the record times of a random sequence,
    and sample k of a walk of T steps reads the last record before T. Such a
    position is uniform over the walk, and walks of nearly equal length agree
    on it for nearly all samples."""
    rng = np.random.default_rng(78)
    rows = [np.zeros(SAMPLES, np.int64)]
    while rows[-1].min() < 1 << 50:
        at = np.minimum((rows[-1] + 1) / np.maximum(rng.random(SAMPLES), 1e-12), 2.0 ** 52)
        rows.append(at.astype(np.int64))
    return np.array(rows)


_SALT = mix64(np.arange(SYMBOL_CHARS, dtype=np.uint64) + np.uint64(99))


class Walk:
    """Arrival steps of a text's characters, walked stretch by stretch."""

    def __init__(self):
        self.row, self.step, self.arrive, self.points = _table()[0], 0, [], []

    def copy(self) -> "Walk":
        other = Walk()
        other.row, other.step, other.arrive, other.points = self.row, self.step, list(self.arrive), list(self.points)
        return other

    def feed(self, points: np.ndarray) -> "Walk":
        """Walk over more characters (code points)."""
        for at in range(0, len(points), STRIDE):
            some = points[at:at + STRIDE]
            cls = (mix64(some.astype(np.uint64)) % np.uint64(CLASSES)).astype(np.int64).tolist()
            rows = list(accumulate(cls, getitem, initial=self.row))
            t = np.fromiter(map(itemgetter(CLASSES), rows), np.int64, len(rows))
            # a row behind its predecessor has passed the end of the period
            t += np.cumsum(np.concatenate([[0], t[1:] <= t[:-1]])) * PERIOD
            t += self.step - t[0]
            self.arrive.append(t[:-1])
            self.points.append(some)
            self.row, self.step = rows[-1], int(t[-1])
        return self

    def upto(self, n: int) -> "Walk":
        """The walk over the first ``n`` characters."""
        out = Walk()
        if n <= 0 or not self.arrive:
            return out
        arrive, points = np.concatenate(self.arrive), np.concatenate(self.points)
        out.arrive, out.points = [arrive[:n]], [points[:n]]
        if n < len(arrive):
            out.step = int(arrive[n])
            out.row = _table()[out.step % PERIOD]
        else:
            out.row, out.step = self.row, self.step
        return out

    def fingerprint(self) -> str:
        """Length of the walk and the sampled symbols, in hex digits."""
        if not self.arrive or not self.step:
            return f"{0:012x}"
        arrive, points = np.concatenate(self.arrive), np.concatenate(self.points)
        records = _records()
        k = (records < self.step).sum(axis=0) - 1
        at = records[k, np.arange(SAMPLES)]
        i = np.searchsorted(arrive, at, "right") - 1
        code = np.zeros(SAMPLES, np.uint64)
        for j in range(SYMBOL_CHARS):  # the character read and the ones after it
            inside = i + j < len(points)
            code += np.where(inside, points[np.minimum(i + j, len(points) - 1)], 0).astype(np.uint64) * _SALT[j]
        code = (mix64(code) >> np.uint64(64 - SYMBOL_BITS)).astype(np.int64)
        return f"{self.step:012x}" + "".join(map("0123456789abcdef".__getitem__, code))


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def fingerprint(text: str) -> str:
    return Walk().feed(points_of(text)).fingerprint()


def likeness(a: str, b: str) -> float:
    """Share of samples of the longer walk that both fingerprints read at the
    same step and with the same symbol, less what chance gives; 0 to 1."""
    if len(a) <= 12 or len(b) <= 12:
        return float(a == b)
    records, (ta, tb) = _records(), (int(a[:12], 16), int(b[:12], 16))
    same_step = (records < ta).sum(axis=0) == (records < tb).sum(axis=0)
    x, y = np.frombuffer(a[12:].encode(), np.uint8), np.frombuffer(b[12:].encode(), np.uint8)
    chance = 2.0 ** -SYMBOL_BITS
    share = float((same_step & (x == y)).mean())
    return float(a == b) or max(0.0, (share - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the next one."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


PAIRED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, edge string, text string")


def _compare(rows):
    """One result per row that has the next one at hand."""
    for doc, text, own, walk, after, next_print in rows:
        keep = len(text) - len(text) // 4
        changed = walk.upto(keep).feed(points_of(after[:len(text) - keep])).fingerprint()
        yield (doc, len(text), hashlib.sha256(edited(text, after).encode("utf-8", "surrogatepass")).hexdigest(),
               own, changed, likeness(own, changed), likeness(own, next_print))


def _record(rows: list[tuple], edge: str | None, texts_: list[str] | None = None) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
    arrays += [pa.array([edge] * len(rows), pa.string()), pa.array(texts_ or [None] * len(rows), pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in PAIRED.split(", ")])


def _in_order(batches):
    """Over one range of documents in order: results of all rows but the last,
    and the first and last row themselves, to be joined to their neighbours."""
    held = first = None
    for part in slices(batches, "text", 4 << 20):
        out = []
        for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
            walk = Walk().feed(points_of(text))
            own = walk.fingerprint()
            if held is None:
                first = (doc, text, own)
            else:
                out += _compare([(*held, text, own)])
            held = (doc, text, own, walk)
        if out:
            yield _record(out, None)
    if held is not None:
        for edge, (doc, text, own) in (("first", first), ("last", held[:3])):
            yield _record([(doc, len(text), None, own, None, None, None)], edge, [text])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, and the likeness of
    the document to that and to the next document.

    One range shuffle puts the documents in order; a task walks its range row
    by row and holds two documents. Ranges meet in a small table of their first
    and last rows, two per task.
    """
    # bounds are sampled from the key, so the key is the id alone; equal ids share a range
    ordered = texts(docs).repartitionByRange(F.col("doc_id").asc_nulls_last()) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    rows = stored(ordered.mapInArrow(_in_order, PAIRED), "ranges")
    edges = rows.where("edge is not null").select("doc_id", "edge", "fingerprint", "text")
    # a row per range, so one task orders them
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("doc_id").asc_nulls_last(), "text")
    firsts = edges.where("edge = 'first'").withColumn("range", F.row_number().over(order))
    lasts = edges.where("edge = 'last'").withColumn("range", F.row_number().over(order))
    n = F.count("*").over(Window.partitionBy(F.lit(0)))
    heads = firsts.select(F.when(F.col("range") == 1, n).otherwise(F.col("range") - 1).alias("range"),
                          F.col("text").alias("after"), F.col("fingerprint").alias("next_print"))

    def close(rows: dict) -> dict:
        out = list(_compare((d, t, f, Walk().feed(points_of(t)), a, nf) for d, t, f, a, nf in
                            zip(rows["doc_id"], rows["text"], rows["fingerprint"], rows["after"], rows["next_print"])))
        return dict(zip(("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"),
                        zip(*out)))

    inner = rows.where("edge is null").drop("edge", "text")
    ends = map_texts(lasts.join(heads, "range"), close, PAIRED.split(", edge")[0])
    return inner.unionByName(ends)


def _differing(a: str, b: str):
    """Samples whose symbols differ, of two columns of packed symbols."""
    def nibbles(x):
        both = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(both.bitwiseOR(F.shiftrightunsigned(both, 2)).bitwiseAND(0x1111111111111111))
    return sum((nibbles(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SAMPLES * SYMBOL_BITS // 64)), F.lit(0))


def near_pairs(docs: DataFrame, alike: float = ALIKE) -> DataFrame:
    """(doc_id, other_id, likeness) of documents whose fingerprints are alike,
    so that any two alike documents that share a band are linked, by a pair or
    by a chain of pairs; all are verified on the whole fingerprints.

    Each document is held against the smallest of every band it shares, and the
    pairs found are contracted to components. In bands that still span several
    components, members outside the largest are held against members of the
    others; a pair leaves that join only if enough symbols agree, but the
    evaluations grow with the product of the two counts. Documents with equal
    fingerprints are one class, and every member is paired with the smallest.
    Rows without an id are left out."""
    def prints(rows: dict) -> dict:
        return {"doc_id": rows["doc_id"], "fingerprint": [fingerprint(t) for t in rows["text"]]}

    rows = stored(map_texts(texts(docs).where("doc_id is not null"), prints, "doc_id long, fingerprint string"), "prints")
    classes = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")).where(F.length("fingerprint") > 12)
    starts = F.array(*(F.lit(13 + k) for k in range(0, SAMPLES, BAND)))
    band = classes.select("doc_id", F.posexplode(F.transform(starts, lambda s: F.col("fingerprint").substr(s, F.lit(BAND)))).alias("band", "key"))
    low = band.groupBy("band", "key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    bucket = stored(band.join(low.drop("high"), ["band", "key"]).distinct(), "buckets")
    pairs = bucket.where("doc_id > low").select("low", "doc_id").distinct()
    a = classes.select(F.col("doc_id").alias("low"), F.col("fingerprint").alias("x"))
    b = classes.select("doc_id", F.col("fingerprint").alias("y"))

    def verified(rows: dict) -> dict:
        near = [likeness(x, y) for x, y in zip(rows["x"], rows["y"])]
        keep = [k for k, v in enumerate(near) if v >= alike]
        return {"doc_id": [rows["low"][k] for k in keep], "other_id": [rows["doc_id"][k] for k in keep], "likeness": [near[k] for k in keep]}

    def confirmed(pairs: DataFrame) -> DataFrame:
        return map_texts(pairs.join(a, "low").join(b, "doc_id"), verified, "doc_id long, other_id long, likeness double", column="x")

    found = stored(confirmed(pairs), "confirmed")
    group = stored(components(found.select(F.col("doc_id").alias("u"), F.col("other_id").alias("v"))), "groups")

    left = bucket.select("band", "key", F.col("doc_id").alias("node")).join(group, "node", "left").select(
        "band", "key", "node", F.coalesce("component", "node").alias("component"))
    size = left.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    main = size.groupBy("band", "key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
    left = left.join(main.where("parts > 1").drop("parts"), ["band", "key"])

    def packed(rows: dict) -> dict:
        return {"node": rows["node"], "symbols": [np.frombuffer(bytes.fromhex(x[12:]), ">i8").tolist() for x in rows["fingerprint"]]}

    symbols = map_texts(classes.select(F.col("doc_id").alias("node"), "fingerprint").join(left.select("node").distinct(), "node"),
                        packed, "node long, symbols array<long>", column="fingerprint")
    full = stored(left.join(symbols, "node"), "open")
    u, v = (full.select("band", "key", "main", *(F.col(c).alias(c + k) for c in ("node", "component", "symbols"))) for k in "uv")
    chance = 2.0 ** -SYMBOL_BITS
    most = SAMPLES - math.ceil(SAMPLES * (alike * (1 - chance) + chance) - 1e-6)
    fresh = u.where("componentu != main").drop("main").join(v, ["band", "key"]).where(
        (F.col("componentu") != F.col("componentv")) & ((F.col("componentv") == F.col("main")) | (F.col("nodeu") < F.col("nodev")))
        & (_differing("symbolsu", "symbolsv") <= most))
    fresh = fresh.select(F.least("nodeu", "nodev").alias("low"), F.greatest("nodeu", "nodev").alias("doc_id")).distinct()
    again = confirmed(fresh.join(pairs, ["low", "doc_id"], "left_anti"))
    equal = rows.join(classes.withColumnRenamed("doc_id", "low"), "fingerprint").where("doc_id > low").select(
        F.col("low").alias("doc_id"), F.col("doc_id").alias("other_id"), F.lit(1.0).alias("likeness")).distinct()
    return found.unionByName(again).unionByName(equal)
