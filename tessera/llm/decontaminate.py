"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (all of a shorter
item), seen as the set of its shingles of ``shingle`` words. A document holds a
window only if it holds all of its shingles, so one of them, the necessary
prefix, is enough to look for; the rarest over the corpus is taken, and windows
with a shingle that no document has are out at once. Joining a shingle at word
p with a window that has it as its o-th gives one place, p - o; the window must
lie inside the document there (position and length), and its words must equal
the document's. Every word inside such a place is hit.

Over the corpus this is two passes that move almost nothing: a bitmap of the
wanted shingle hashes, sized by their number and never above 2**28 bits, is all
that tasks hold of the benchmark, whatever its size. The first pass counts the
shingles of all windows, each task on its own before the shuffle. The second
returns every place of a prefix shingle with the words around it; these few
rows meet the windows in joins on equal keys, which Spark can split where a
passage is common. Hashes only propose; words are compared as text.

Defined results: a null or empty text has no words and is not hit; null and
empty items have no window; items of equal text count each, rows that share an
item_id count once, and a null item_id is the empty string; rows that share a
doc_id are judged each by its own text; without a benchmark nothing is hit; an
empty table gives no rows; texts and words of any length are read whole, in
stretches; columns other than doc_id, item_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import mix64, slices, texts
from tessera.session import stored

WINDOW, SHINGLE = 10, 3
#: Bytes of text hashed at a time, and words whose shingles are looked up at a time.
STRETCH, WORDS = 1 << 22, 1 << 19
#: Counts a task keeps before it gives them away.
COUNTS = 1 << 20
#: Bits of the shingle bitmap for each wanted shingle, and the least and most in all.
BITS_EACH, BITS_LEAST, BITS_MOST = 32, 20, 28

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words are runs of 0-9, a-z and of all beyond ASCII, so bytes decide.
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE and of its inverse modulo 2**64, up to ``n``."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))

    def table(x):
        out = np.full(n + 1, x, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return table(_BASE), table(inverse)


def words_of(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, and start, stop, text number and hash of
    every word. ``ends`` holds the n+1 boundaries of the texts in ``raw``."""
    low = LOWER[raw]
    inside = IN_WORD[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[ends - ends[0]] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    start = np.flatnonzero(inside & ~before)
    stop = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(ends - ends[0], start, "right") - 1
    hashes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(stop, start[at] + STRETCH, "right")))
        lo, hi = start[at], stop[to - 1]
        power, inverse = _powers(1 << max(STRETCH, int(hi - lo)).bit_length())
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((low[lo:hi].astype(np.uint64) + np.uint64(1)) * power[:hi - lo], out=sums[1:])
        a, b = start[at:to] - lo, stop[at:to] - lo
        hashes[at:to] = mix64((sums[b] - sums[a]) * inverse[a])
        at = to
    return low, start, stop, doc, hashes


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; the caller leaves out runs across texts."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(hashes) - n + 1, n, np.uint64)
    for k in range(n):
        out = out * _STEP + hashes[k:len(hashes) - n + 1 + k]
    return mix64(out)


def _texts_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the slice's texts end to end, and their n+1 boundaries."""
    col = part.column("text")
    ends = np.frombuffer(col.buffers()[1], np.int32 if col.type == pa.string() else np.int64)
    ends = ends[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends


def _joined(low: np.ndarray, start: np.ndarray, stop: np.ndarray, longest: int | None = None) -> str:
    """Words as text; one that is longer than any benchmark word can't be equal to one."""
    return b" ".join(low[a:b].tobytes() if longest is None or b - a <= longest else b"\x00"
                     for a, b in zip(start, stop)).decode("utf-8", "replace")


def windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, words, size, width, longest, tokens) of every window of every item: its
    text, number of words, words of its shingles, bytes of its longest word, and
    the hashes of its shingles in order."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                            F.col("text").cast("string").alias("text")).where("text is not null")
    schema = "item_id string, words string, size int, width int, longest long, tokens array<long>"

    def run(batches):
        for part in slices(batches, "text", 1 << 20):
            low, start, stop, doc, hashes = words_of(*_texts_of(part))
            bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
            items, sizes, out = part.column("item_id").to_pylist(), stop - start, []
            for item, a, b in zip(items, bounds[:-1], bounds[1:]):
                n = min(window, int(b - a))
                if not n:
                    continue
                width = min(shingle, n)
                tokens = shingle_hashes(hashes[a:b], width).view(np.int64)
                for at in range(a, b - n + 1):
                    out.append((item, _joined(low, start[at:at + n], stop[at:at + n]), n, width,
                                int(sizes[at:at + n].max()), tokens[at - a:at - a + n - width + 1].tolist()))
                    if len(out) == 4096:
                        yield _batch(out, schema)
                        out = []
            if out:
                yield _batch(out, schema)

    return rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    kinds = [types[f.strip().split(" ")[1]] for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


class Wanted:
    """Bitmap of shingle hashes, looked up at two places each; false hits only
    cost a row in a join."""

    def __init__(self, tokens: DataFrame):
        """``tokens``: (token, width), one row for each wanted shingle."""
        spark = tokens.sparkSession
        widths = tokens.groupBy("width").agg(F.count("*").alias("n")).collect()
        n = sum(r.n for r in widths)
        self.widths = sorted(r.width for r in widths)
        self.bits = min(BITS_MOST, max(BITS_LEAST, (n * BITS_EACH).bit_length()))
        mask = (1 << self.bits) - 1
        bit = F.explode(F.array(F.col("token").bitwiseAND(mask), F.shiftrightunsigned("token", 32).bitwiseAND(mask)))
        cells = (tokens.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("cell"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("set")).toPandas())
        words = np.zeros(1 << (self.bits - 5), np.uint32)
        words[cells["cell"].to_numpy(np.int64)] = cells["set"].to_numpy(np.int64).astype(np.uint32)
        self._set = spark.sparkContext.broadcast(words)

    def places(self, hashes: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(width, word numbers, tokens) of the wanted shingles, in stretches of words."""
        words, mask = self._set.value, np.uint64((1 << self.bits) - 1)
        for width in self.widths:
            for at in range(0, len(hashes), WORDS):
                token = shingle_hashes(hashes[at:at + WORDS + width - 1], width)
                hit = np.arange(len(token))
                for shift in (0, 32):
                    bit = (token[hit] >> np.uint64(shift)) & mask
                    hit = hit[(words[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32)) & 1 == 1]
                hit = hit[doc[at + hit] == doc[at + hit + width - 1]]
                if len(hit):
                    yield width, at + hit, token[hit]


def shingle_counts(rows: DataFrame, wanted: Wanted) -> DataFrame:
    """(token, n): how often the rows' texts hold each wanted shingle."""
    def run(batches):
        tokens, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for part in slices(batches, "text", STRETCH):
            _, _, _, doc, hashes = words_of(*_texts_of(part))
            for _, _, found in wanted.places(hashes, doc):
                tokens, back = np.unique(np.concatenate([tokens, found]), return_inverse=True)
                more = np.concatenate([counts, np.ones(len(found), np.int64)])
                counts = np.zeros(len(tokens), np.int64)
                np.add.at(counts, back, more)
                if len(tokens) > COUNTS:
                    yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts)], names=["token", "n"])
                    tokens, counts = tokens[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts)], names=["token", "n"])

    return rows.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def places(rows: DataFrame, wanted: Wanted, window: int, shingle: int, longest: int) -> DataFrame:
    """One row per document (``token`` null), and one per place of a wanted
    shingle: its word number, and the words that a window around it can have."""
    schema = "row long, doc_id long, n_words long, token long, at long, first long, around string"

    def run(batches):
        for part in slices(batches, "text", STRETCH):
            low, start, stop, doc, hashes = words_of(*_texts_of(part))
            bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
            n_words = np.diff(bounds)
            row, doc_id = part.column("row"), part.column("doc_id")
            none = pa.nulls(part.num_rows, pa.int64())
            names = [f.split(" ")[0] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([row, doc_id, pa.array(n_words, pa.int64()), none, none, none,
                                              pa.nulls(part.num_rows, pa.string())], names=names)
            for width, found, token in wanted.places(hashes, doc):
                for lo in range(0, len(found), 4096):
                    at, own = found[lo:lo + 4096], doc[found[lo:lo + 4096]]
                    reach = window if width == shingle else width
                    first = np.maximum(at + width - reach, bounds[own])
                    last = np.minimum(at + reach, bounds[own + 1])
                    around = [_joined(low, start[a:b], stop[a:b], longest) for a, b in zip(first, last)]
                    pick = pa.array(own)
                    yield pa.RecordBatch.from_arrays(
                        [row.take(pick), doc_id.take(pick), pa.array(n_words[own], pa.int64()), pa.array(token.view(np.int64)[lo:lo + 4096]),
                         pa.array(at - bounds[own], pa.int64()), pa.array(first - bounds[own], pa.int64()), pa.array(around, pa.string())], names=names)

    return rows.mapInArrow(run, schema)


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (row, doc_id, n_words), occurrences of windows (row, start, size, win) and
    the windows' items (win, item_id)."""
    all_windows = stored(windows(benchmark, window, shingle), "leak-windows")
    unique = stored(all_windows.drop("item_id").dropDuplicates(["words"])
                    .withColumn("win", F.monotonically_increasing_id()), "leak-unique")
    items = stored(all_windows.select("item_id", "words").distinct().join(unique.select("words", "win"), "words")
                   .select("win", "item_id"), "leak-items")
    tokens = unique.select("win", "size", "width", F.posexplode("tokens").alias("off", "token"))
    longest = unique.agg(F.max("longest")).first()[0] or 0

    rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
    wanted = Wanted(tokens.select("token", "width").distinct())
    counts = stored(shingle_counts(rows, wanted), "leak-counts")
    # rarest first, with the shingles that no text has before all others: their windows are out
    prefix = (tokens.join(counts, "token", "left").groupBy("win", "size", "width")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "off")).alias("rarest"))
              .where("rarest.n > 0").select("win", "size", "width", "rarest.token", "rarest.off"))
    prefix = stored(prefix, "leak-prefix")
    found = stored(places(rows, Wanted(prefix.select("token", "width").distinct()), window, shingle, longest), "leak-places")

    shapes = stored(prefix.select("token", "off", "size").distinct(), "leak-shapes")
    cands = found.where("token is not null").join(shapes, "token")
    cands = cands.withColumn("start", F.col("at") - F.col("off")).where("start >= 0 and start + size <= n_words")
    # not below 1: the optimizer may evaluate this before the filter above
    lead = F.greatest(F.lit(1), (F.col("start") - F.col("first") + 1).cast("int"))
    cands = cands.select("row", "start", "size", F.array_join(F.slice(F.split("around", " "), lead, F.col("size")), " ").alias("words"))
    occ = cands.join(unique.select("words", "win"), "words").select("row", "start", "size", "win")
    return found.where("token is null").select("row", "doc_id", "n_words"), stored(occ, "leak-occurrences"), items


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Words, hit words and items found of every document (see the module)."""
    rows, occ, items = occurrences(docs, benchmark, window, shingle)
    stop = F.col("start") + F.col("size")
    past = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = occ.groupBy("row", "start").agg(F.max("size").cast("long").alias("size"))
    spans = spans.withColumn("seen", F.coalesce(F.max(stop).over(past), F.lit(0)))
    hits = spans.groupBy("row").agg(F.sum(F.greatest(F.lit(0), stop - F.greatest("start", "seen"))).alias("n_hit"))
    leaks = (occ.select("row", "win").distinct().join(items, "win").groupBy("row")
             .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    found = hits.join(leaks, "row")
    ids = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return rows.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
