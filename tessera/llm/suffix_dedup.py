"""Repeated-substring removal by a hash-compared suffix sort.

Every 100-byte string belongs to one anchor: the 32-byte gram with the smallest
hash inside it (the leftmost of equals). Which gram that is depends on the
string alone, so equal strings have equal anchors at equal offsets, and only
about one gram in 32 is an anchor. The strings of one anchor occurrence lie
next to each other; their bytes together are its span.

1. Spans of equal bytes (anchor hash and span hash) are one class. Only the
   first occurrence of a class can hold a first occurrence of a string; all
   strings of the others are repeats. Each task does this for its own rows
   before the shuffle, so a class sends one row per task, however common.
2. Classes that are alone with their anchor hold nothing else that repeats. The
   others, a small share, are compared in bytes: the suffixes that start at the
   anchor are sorted, and so are the reversed bytes before it. Two suffixes are
   compared by the longest common extension, found by binary search over prefix
   polynomial hashes, inside a mergesort; common extensions of neighbours are
   then checked byte by byte. For each offset the sorted order splits into runs
   that agree on the right part and runs that agree on the left part; a string
   repeats an earlier one if both its runs hold an earlier occurrence together.
3. An anchor with very many classes is dealt over tasks. Strings that are first
   in their part meet again by string hash: an aggregate to the first position
   and a join.

Then each document gets its repeated ranges and loses their union.

Defined results: a null or empty text, or one under 100 bytes, loses nothing;
rows with a null doc_id come after all others; rows that share a doc_id but not
the text come in the order of a 64-bit text hash; wholly equal rows stand at one
place, so neither is earlier than the other; an empty table gives no rows;
extra columns of any name are not read.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mix64, packed_texts, release_memory, slices, unpacked
from tessera.session import stored

WINDOW, GRAM = 100, 32
#: Grams in a string, and so the most strings an anchor occurrence can own.
GRAMS = WINDOW - GRAM + 1
#: Window starts handled in one go; longer texts are cut, overlapping. A block
#: takes about 100 bytes of working memory a byte, in every Python worker.
SEGMENT, BLOCK = 1 << 19, 1 << 20
#: Rows a task holds back to merge equal classes before the shuffle, at about
#: 200 bytes a row while they are merged.
COMBINE_ROWS = 400_000
#: Anchors with about this many rows, at most HOT_KEYS of them, are dealt over
#: tasks by class; one document in SAMPLE is read to find them.
HOT_ROWS, HOT_KEYS, SAMPLE = 1_000_000, 4096, 64
#: Spans of one anchor that are compared in one task; their bytes, dealt by
#: hash, also stay below BLOCK: three quarters of it on average.
GROUP_ROWS = 100_000
LAST = (1 << 63) - 1

REMOVED, CANDIDATE, OPEN, FIRST = 1, 0, 2, 3
ANCHORS = "kind tinyint, a long, h long, doc long, digest long, pos long, n int, off int"

_rng = np.random.default_rng(41)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


@cache
def _powers(which: int, inverse: bool, size: int) -> np.ndarray:
    out = np.full(size + 1, pow(_BASE[which], -1 if inverse else 1, 1 << 64), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


class PrefixHash:
    """Polynomial hash of any stretch of a byte array from two prefix values."""

    def __init__(self, data: np.ndarray, which: int = 0):
        size = BLOCK
        while size < len(data):  # the table follows the data, whatever a caller joins
            size *= 2
        self.inverse = _powers(which, True, size)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(which, False, size)[:len(data)], out=self.prefix[1:])

    def __call__(self, start, end):
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]


def spans_of(data: np.ndarray, ends: np.ndarray):
    """Anchor occurrences of the texts end to end in ``data``: anchor hash,
    span hash, text number, first owned start, number of starts, anchor offset."""
    h = PrefixHash(data)
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < WINDOW:
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty, empty
    start = np.arange(n - GRAM + 1)
    gram = mix64(h(start, start + GRAM))
    low = np.uint64(BLOCK - 1)
    best, size = (gram & ~low) | start.astype(np.uint64), 1
    while 2 * size <= GRAMS:
        best, size = np.minimum(best[:-size], best[size:]), 2 * size
    if size < GRAMS:
        best = np.minimum(best[:len(best) - (GRAMS - size)], best[GRAMS - size:])
    owner = (best & low).astype(np.int64)
    count = np.maximum(np.diff(ends) - WINDOW + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + ends[text]
    if not len(at):
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty, empty
    owner = owner[at]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])]))
    lo, text, owner = at[new], text[new], owner[new]
    hi = at[np.concatenate([new[1:] - 1, [len(at) - 1]])]
    off = owner - lo
    span = mix64(h(lo, hi + WINDOW) + off.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return gram[owner], span, text, lo - ends[text], hi - lo + 1, off


def _units(doc, digest, text):
    """(doc, digest, position of the first byte, bytes) in overlapping segments."""
    raw = text.encode("utf-8", "surrogatepass")
    for at in range(0, max(1, len(raw) - WINDOW + 1), SEGMENT):
        yield doc, digest, at, raw[at:at + SEGMENT + WINDOW - 1]


def _blocks(batches):
    """Segments in runs of at most BLOCK bytes."""
    held, size = [], 0
    for part in slices(batches, "text", SEGMENT):
        for row in zip(*(part.column(k).to_pylist() for k in ("doc", "digest", "text"))):
            for unit in _units(*row):
                if size + len(unit[-1]) > BLOCK - 1:
                    yield held
                    held, size = [], 0
                held.append(unit)
                size += len(unit[-1])
    if held:
        yield held


def _occurrences(block):
    ends = np.zeros(len(block) + 1, np.int64)
    np.cumsum([len(raw) for *_, raw in block], out=ends[1:])
    data = np.frombuffer(b"".join(raw for *_, raw in block), np.uint8)
    a, h, text, start, n, off = spans_of(data, ends)
    doc, digest, pos = (np.array(c, np.int64)[text] for c in list(zip(*block))[:3])
    return [a.view(np.int64), h.view(np.int64), doc, digest, pos + start, n.astype(np.int32), off.astype(np.int32)]


def _batch(kind, a, h, doc, digest, pos, n, off):
    size = len(doc)
    col = [np.full(size, kind, np.int8), a, h, doc, digest, pos, n, off]
    names = ["kind", "a", "h", "doc", "digest", "pos", "n", "off"]
    kinds = [pa.int8(), *[pa.int64()] * 5, pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(col, kinds)], names=names)


def _removed(doc, digest, pos, size):
    """Rows of repeated ranges; the hash columns only deal them out evenly."""
    spread = mix64((doc ^ digest).view(np.uint64) ^ mix64(pos.view(np.uint64))).view(np.int64)
    return _batch(REMOVED, spread, spread, doc, digest, pos, size.astype(np.int32), np.zeros(len(doc), np.int32))


def _merge_classes(rows):
    """First occurrence of each class among ``rows``, and the repeats."""
    a, h, doc, digest, pos, n, off = rows
    order = np.lexsort((pos, digest, doc, h, a))
    a, h, doc, digest, pos, n, off = (c[order] for c in rows)
    same = np.zeros(len(a), bool)
    same[1:] = (a[1:] == a[:-1]) & (h[1:] == h[:-1])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(a))))
    again = same & ((doc != doc[first]) | (digest != digest[first]) | (pos != pos[first]))
    return [c[~same] for c in (a, h, doc, digest, pos, n, off)], (doc[again], digest[again], pos[again], n[again] + WINDOW - 1)


def _pass_a(batches):
    held, size = [], 0

    def flush():
        rows = [np.concatenate(c) for c in zip(*held)]
        keep, gone = _merge_classes(rows)
        for at in range(0, len(gone[0]), 50_000):
            yield _removed(*(c[at:at + 50_000] for c in gone))
        for at in range(0, len(keep[0]), 50_000):
            yield _batch(CANDIDATE, *(c[at:at + 50_000] for c in keep))

    for block in _blocks(batches):
        held.append(_occurrences(block))
        size += len(held[-1][0])
        if size >= COMBINE_ROWS:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()
    held = []
    release_memory()


def _pass_b(hot: np.ndarray):
    """Over rows sorted by anchor, class and position: repeats out, and the
    first of each class if its anchor has other classes."""

    def run(batches):
        names = ("a", "h", "doc", "digest", "pos", "n", "off")
        last = head = None          # first row of the running class; a class not yet decided
        for batch in batches:
            if batch.num_rows == 0:
                continue
            kind = batch.column(0).to_numpy()
            done = kind == REMOVED
            if done.any():
                yield batch.filter(pa.array(done))
            rows = [batch.column(batch.schema.get_field_index(k)).to_numpy()[~done] for k in names]
            if not len(rows[0]):
                continue
            if last is not None:
                rows = [np.concatenate([[x], c]).astype(c.dtype) for x, c in zip(last, rows)]
            a, h, doc, digest, pos, n, off = rows
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (h[1:] != h[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
            again = ~new & ((doc != doc[first]) | (digest != digest[first]) | (pos != pos[first]))
            if again.any():
                yield _removed(doc[again], digest[again], pos[again], n[again] + WINDOW - 1)
            # heads of the classes that begin here; the first row repeats the running class
            begin = np.flatnonzero(new)
            if last is not None:
                begin = begin[1:]
            heads = [c[begin] for c in rows]
            if head is not None:
                heads = [np.concatenate([[x], c]).astype(c.dtype) for x, c in zip(head[:-1], heads)]
            joined = head[-1] if head is not None else False
            if len(heads[0]):
                near = np.zeros(len(heads[0]), bool)
                near[1:] = heads[0][1:] == heads[0][:-1]
                near[:-1] |= near[1:]
                near[0] |= joined
                out = near | np.isin(heads[0], hot)
                tail_joined = bool(near[-1])
                if out[:-1].any():
                    keep = np.flatnonzero(out[:-1])
                    yield _batch(OPEN, *(c[keep] for c in heads))
                head = [c[-1] for c in heads] + [tail_joined]
            last = [c[first[-1]] for c in rows]
        if head is not None and (head[-1] or np.isin(head[0], hot)):
            yield _batch(OPEN, *(np.array([x]) for x in head[:-1]))
        release_memory()

    return run


# ---- the suffix sort -------------------------------------------------------

def common_extension(h: PrefixHash, x, y, limit) -> np.ndarray:
    """Longest common extension of the suffixes at x and y, up to ``limit``, by
    binary search over prefix hashes."""
    lo, hi = np.zeros(len(x), np.int64), limit.copy()
    while True:
        todo = np.flatnonzero(lo < hi)
        if not len(todo):
            return lo
        mid = (lo[todo] + hi[todo] + 1) // 2
        equal = h(x[todo], x[todo] + mid) == h(y[todo], y[todo] + mid)
        lo[todo] = np.where(equal, mid, lo[todo])
        hi[todo] = np.where(equal, hi[todo], mid - 1)


def suffix_sort(data: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes data[start:start + size] inside each group (numbers
    that ascend), and the common extension of each with the one before it.

    Bottom-up mergesort: in each round all pairs of neighbouring runs of all
    groups merge at once, every element finding its place in the other run by
    binary search. Only groups with more elements than a run take part.
    """
    h = PrefixHash(data)
    padded = np.concatenate([data, [0]]).astype(np.int64)
    order = np.arange(len(start))
    first = np.searchsorted(group, group, "left")
    count = np.searchsorted(group, group, "right") - first

    def less(i, j, ties):
        """suffix i before suffix j; equal ones by ``ties``."""
        both = np.minimum(size[i], size[j])
        n = common_extension(h, start[i], start[j], both)
        ended = n == both
        x, y = padded[np.minimum(start[i] + n, len(data))], padded[np.minimum(start[j] + n, len(data))]
        return np.where(ended, np.where(size[i] == size[j], ties, size[i] < size[j]), x < y)

    width = 1
    while len(count) and width < count.max():
        at = np.flatnonzero(count > width)
        inside = at - first[at]
        run = inside // width
        other_lo = first[at] + (run ^ 1) * width
        other_hi = np.minimum(other_lo + width, first[at] + count[at])
        lo = np.minimum(other_lo, other_hi).copy()
        hi = other_hi.copy()
        while True:
            todo = np.flatnonzero(lo < hi)
            if not len(todo):
                break
            mid = (lo[todo] + hi[todo]) // 2
            # an element of the right run goes behind equal ones of the left
            right = run[todo] % 2 == 1
            before = less(order[mid], order[at[todo]], right)
            lo[todo] = np.where(before, mid + 1, lo[todo])
            hi[todo] = np.where(before, hi[todo], mid)
        pair = first[at] + (run & ~1) * width
        place = pair + inside % width + (lo - np.minimum(other_lo, other_hi))
        merged = order.copy()
        merged[place] = order[at]
        order = merged
        width *= 2

    i, j = order[:-1], order[1:]
    both = np.minimum(size[i], size[j])
    n = common_extension(h, start[i], start[j], both)
    step = 4096
    for k in range(0, len(i), step):  # verification: these n bytes agree and the next do not
        col = np.arange(int(both[k:k + step].max(initial=0)))
        x = padded[np.minimum(start[i[k:k + step], None] + col, len(data))]
        y = padded[np.minimum(start[j[k:k + step], None] + col, len(data))]
        equal = (x == y) & (col < both[k:k + step, None])
        exact = np.where(equal.all(axis=1), len(col), np.argmin(equal, axis=1)) if len(col) else np.zeros(len(x), np.int64)
        if (np.minimum(exact, both[k:k + step]) != n[k:k + step]).any():
            return _plain_sort(data, start, size, group)
    n = np.concatenate([[0], n])[:len(order)]
    n[1:][group[order[1:]] != group[order[:-1]]] = -1
    return order, n


def _plain_sort(data, start, size, group):
    """The same by comparing bytes, for the case that two hashes collide."""
    raw = data.tobytes()
    own = [raw[s:s + k] for s, k in zip(start, size)]
    order = np.array(sorted(range(len(own)), key=lambda i: (group[i], own[i], i)), np.int64)
    n = np.full(len(order), -1, np.int64)
    for k in range(1, len(order)):
        if group[order[k]] == group[order[k - 1]]:
            x, y = own[order[k - 1]], own[order[k]]
            n[k] = next((m for m in range(min(len(x), len(y))) if x[m] != y[m]), min(len(x), len(y)))
    return order, n


def _runs(order, common, least):
    """Number of the run that each element is in, when neighbours that share
    ``least`` bytes or more stay together."""
    cut = np.cumsum(common < least)
    out = np.empty(len(order), np.int64)
    out[order] = cut
    return out


def repeats(group, doc, place, n, off, raw):
    """For spans of complete groups, sorted by group, document and position:
    a matrix [span, offset] of 1 where the string repeats an earlier one and 2
    where it is the first of its kind; 0 where the span owns no such string."""
    data = np.frombuffer(b"".join(raw), np.uint8)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    base = np.cumsum(size) - size
    right, common_right = suffix_sort(data, base + off, size - off, group)
    mirror = np.ascontiguousarray(data[::-1])
    left, common_left = suffix_sort(mirror, len(data) - (base + off), off.astype(np.int64), group)
    what = np.zeros((len(raw), GRAMS), np.int8)
    for o in range(GRAMS):
        own = np.flatnonzero((o <= off) & (o > off - n))
        if not len(own):
            continue
        key = _runs(right, common_right, WINDOW - o)[own] * (len(raw) + 1) + _runs(left, common_left, o)[own]
        _, at = np.unique(key, return_index=True)
        what[own, o] = 1
        what[own[at], o] = 2
    return what


def _resolve(batches):
    """Over spans sorted by group: ranges that repeat, and for anchors dealt
    over several tasks the strings that are first here."""
    names = ("a", "part", "parts", "doc", "digest", "pos", "n", "off", "span")
    held: list[list] = [[] for _ in names]

    def work(rows):
        a, part, parts, doc, digest, pos, n, off = cols = [np.array(c, np.int64) for c in rows[:-1]]
        order = np.lexsort((pos + off, digest, doc, part, a))
        # wholly equal rows send the same spans: one of each place stays
        place = np.array([c[order] for c in (a, part, doc, digest, pos)])
        order = order[np.concatenate([[True], (place[:, 1:] != place[:, :-1]).any(axis=0)])]
        a, part, parts, doc, digest, pos, n, off = (c[order] for c in cols)
        raw = [rows[-1][i] for i in order]
        group = np.cumsum(np.concatenate([[0], (a[1:] != a[:-1]) | (part[1:] != part[:-1])]))
        what = repeats(group, doc, pos + off, n, off, raw)
        # columns by start: offset falls as the start rises
        hit = np.zeros((len(raw), GRAMS + 2), bool)
        hit[:, 1:-1] = what[:, ::-1] == 1
        edge = np.diff(hit.astype(np.int8), axis=1)
        row, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        if len(row):
            # a start index k stands for offset GRAMS - 1 - k
            start = pos[row] + off[row] - (GRAMS - 1 - begin)
            yield _found(REMOVED, doc[row], digest[row], start, end - begin + WINDOW - 1)
        row, o = np.nonzero((what == 2) & (parts > 1)[:, None])
        if len(row):
            data = np.frombuffer(b"".join(raw), np.uint8)
            size = np.fromiter(map(len, raw), np.int64, len(raw))
            at = (np.cumsum(size) - size)[row] + off[row] - o
            x, y = (mix64(PrefixHash(data, k)(at, at + WINDOW)).view(np.int64) for k in (0, 1))
            yield _found(FIRST, doc[row], digest[row], pos[row] + off[row] - o, np.full(len(row), WINDOW), x, y)

    def whole(last):
        """Rows of complete groups; the last group may go on."""
        cut = len(held[0])
        if not last:
            while cut and held[0][cut - 1] == held[0][-1] and held[1][cut - 1] == held[1][-1]:
                cut -= 1
        out = [c[:cut] for c in held]
        for c in held:
            del c[:cut]
        return out

    def runs(rows):
        """Complete groups in runs of at most BLOCK bytes, one group at least."""
        ends = np.cumsum(np.fromiter(map(len, rows[-1]), np.int64, len(rows[-1])))
        a, part = (np.array(c, np.int64) for c in rows[:2])
        stops = np.append(np.flatnonzero((a[1:] != a[:-1]) | (part[1:] != part[:-1])) + 1, len(a))
        at = 0
        while at < len(a):
            base = ends[at - 1] if at else 0
            fits = stops[(stops > at) & (ends[stops - 1] - base <= BLOCK)]
            to = int(fits[-1] if len(fits) else stops[stops > at][0])
            yield [c[at:to] for c in rows]
            at = to

    for batch in batches:
        for c, k in zip(held, names):
            c.extend(batch.column(batch.schema.get_field_index(k)).to_pylist())
        if len(held[0]) >= 20_000:
            for rows in runs(whole(False)):
                yield from work(rows)
    for rows in runs(whole(True)):
        yield from work(rows)
    release_memory()


def _found(kind, doc, digest, pos, n, x=None, y=None):
    zero = np.zeros(len(doc), np.int64)
    cols = [np.full(len(doc), kind, np.int8), doc, digest, pos, n.astype(np.int64), zero if x is None else x, zero if y is None else y]
    types = [pa.int8(), *[pa.int64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["kind", "doc", "digest", "pos", "n", "x", "y"])


# ---- the job ---------------------------------------------------------------

def _keyed(docs: DataFrame) -> DataFrame:
    """doc (sorts a null id last), text digest, id and text of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"),
                       F.xxhash64("text").alias("digest"), "text")


def _cut_spans(batches):
    last = None
    for part in slices(batches, "packed", 2 << 20):
        out = [[] for _ in range(7)]
        for doc, digest, packed, wanted in zip(*(part.column(k).to_pylist() for k in ("doc", "digest", "packed", "wanted"))):
            if (doc, digest) == last:
                continue  # a repeated row; those that do not follow each other are found in _resolve
            last = (doc, digest)
            raw = unpacked(packed)
            for w in wanted:
                start = w["pos"]
                for c, x in zip(out, (w["a"], doc, digest, start, w["n"], w["off"], raw[start:start + w["n"] + WINDOW - 1])):
                    c.append(x)
        kinds = [*[pa.int64()] * 4, pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["a", "doc", "digest", "pos", "n", "off", "span"])


def _union(ranges) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for s, e in sorted((r["s"], r["s"] + r["n"]) for r in ranges or ()):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return [(s, e) for s, e in merged]


def _kept(batches):
    for part in slices(batches, "packed", 2 << 20):
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for packed, ranges in zip(part.column("packed").to_pylist(), part.column("ranges").to_pylist()):
            raw = unpacked(packed)
            gone = _union(ranges)
            rest, at = [], 0
            for s, e in gone:
                rest.append(raw[at:s])
                at = e
            kept = b"".join([*rest, raw[at:]])
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(len(raw) - len(kept))
            out["n_spans"].append(len(gone))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
        yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **{k: pa.array(v, pa.binary() if k == "kept" else pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items()}})


def _hot_anchors(rows: DataFrame) -> list[int]:
    """Anchors that so many rows share that one task should not read them all.
    Found on a sample; they steer the dealing of rows, never the result."""
    part = rows.where(F.pmod(F.xxhash64("doc", "digest"), F.lit(SAMPLE)) == 0).select("doc", "digest", "text")
    counts = part.mapInArrow(_pass_a, ANCHORS).where(F.col("kind") == CANDIDATE).groupBy("a").agg(F.count("*").alias("n"))
    top = counts.where(F.col("n") >= HOT_ROWS // SAMPLE).orderBy(F.col("n").desc(), "a").limit(HOT_KEYS).collect()
    return [r["a"] for r in top]


def removed_ranges(docs: DataFrame) -> DataFrame:
    """(doc, digest, ranges) of every document that loses bytes; ranges are
    (s, n): start and length, in bytes, and may overlap."""
    rows = _keyed(docs)
    hot = _hot_anchors(rows)
    found = rows.select("doc", "digest", "text").mapInArrow(_pass_a, ANCHORS)
    deal = F.col("a")
    if hot:
        deal = F.when(F.col("a").isin(hot), F.xxhash64("a", "h")).otherwise(F.col("a"))
    marks = stored(found.repartition(deal).sortWithinPartitions("a", "h", "doc", "digest", "pos")
                   .mapInArrow(_pass_b(np.array(hot, np.int64)), ANCHORS), "anchors")
    opened = marks.where(F.col("kind") == OPEN)
    per_doc = opened.groupBy("doc", "digest").agg(
        F.collect_list(F.struct("a", "pos", "n", "off")).alias("wanted"))
    many = opened.groupBy("a").agg(F.greatest(F.ceil(F.count("*") / GROUP_ROWS), F.ceil(
        F.sum(F.col("n") + WINDOW - 1) / (BLOCK * 3 // 4))).alias("parts"))
    texts_ = packed_texts(rows).select("doc", "digest", "packed")
    spans = (texts_.join(per_doc, ["doc", "digest"]).select("doc", "digest", "packed", "wanted")
             .mapInArrow(_cut_spans, "a long, doc long, digest long, pos long, n int, off int, span binary"))
    spans = spans.join(many, "a").withColumn("part", F.pmod(F.xxhash64("doc", "digest", "pos"), F.col("parts")))
    seen = stored(spans.repartition("a", "part").sortWithinPartitions("a", "part")
                  .select("a", "part", "parts", "doc", "digest", "pos", "n", "off", "span")
                  .mapInArrow(_resolve, "kind tinyint, doc long, digest long, pos long, n long, x long, y long"), "strings")
    first = seen.where(F.col("kind") == FIRST)
    low = first.groupBy("x", "y").agg(F.min(F.struct("doc", "digest", "pos")).alias("low"))
    later = first.join(low, ["x", "y"]).where(F.struct("doc", "digest", "pos") > F.col("low"))
    every = (marks.where(F.col("kind") == REMOVED).select("doc", "digest", "pos", F.col("n").cast("long").alias("n"))
             .unionByName(seen.where(F.col("kind") == REMOVED).select("doc", "digest", "pos", "n"))
             .unionByName(later.select("doc", "digest", "pos", "n")))
    return every.groupBy("doc", "digest").agg(F.collect_list(F.struct(F.col("pos").alias("s"), "n")).alias("ranges"))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining
    bytes) of every row of ``docs``."""
    rows = packed_texts(_keyed(docs)).join(removed_ranges(docs), ["doc", "digest"], "left")
    return rows.select("doc_id", "packed", "ranges").mapInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
