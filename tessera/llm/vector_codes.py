"""Product codes of vectors by exact integer arithmetic on float64 BLAS.

A component x becomes the integer floor(4096 x); a vector is cut into 8 equal
consecutive parts, and each part position has a codebook of 16 entries, first
the parts of the 16 rows of smallest ``vec_id``. Six rounds assign every part to
its nearest entry and replace each entry by the floored mean of its parts; then
parts are assigned once more.

Dot products run as matrix products in float64, which are exact only below
2**53. So both sides are split into limbs of as many bits as keep a sum of
products of two limbs below that bound; the products of all limb pairs are
shifted into place and added in int64, where the true value fits. The distance
|x|**2 - 2 x.c + |c|**2 is then exact, and the first smallest one wins. Sums of
parts are products of the limbs with the 0/1 matrix of assignments.

The integers are written once; a round is one pass over them that returns the
sums of each task (entries x components, whatever the rows), added by Spark.
Only the codebooks, 128 entries, ever reach the driver.

Defined results: rows with a null vector, a null or a non-finite component are
dropped, and so are vectors that cannot be coded: of a length that 8 does not
divide, of another length than the first kept row's, or with a component whose
integer is above 2**30 / sqrt(length), as its distances would not fit a long.
Rows with a null vec_id come last, rows that share one are ordered by vector;
equal rows are coded each. With fewer than 16 kept rows there are as many
entries. Null labels are one label. An empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import release_memory
from tessera.session import stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Bytes of integers that a task works on at a time.
STRETCH = 4 << 20


def integers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, ints) of the rows that can be coded, whatever their length."""
    v = F.col("embedding")
    most = F.lit(float(1 << 30)) / F.sqrt(F.size(v))
    fits = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) * SCALE <= most), F.lit(False)))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
            .where(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % PARTS == 0) & fits)
            .select("vec_id", "label", F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("int")).alias("ints")))


def _limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 limbs of ``x``, lowest first; all but the last are not negative."""
    n, most = 1, int(np.abs(x).max(initial=0))
    while most > 1 << bits * n:
        n += 1
    low = [(x >> bits * k) & ((1 << bits) - 1) for k in range(n - 1)]
    return [p.astype(np.float64) for p in (*low, x >> bits * (n - 1))]


def limb_bits(terms: int) -> int:
    """Most bits of a limb for which ``terms`` products of two limbs stay below 2**53."""
    return (52 - (terms - 1).bit_length()) // 2


def exact_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix products of int64 (..., n, d) and (..., d, m), exact in int64."""
    bits = limb_bits(a.shape[-1])
    out = np.zeros((*a.shape[:-1], b.shape[-1]), np.int64)
    right = _limbs(b, bits)
    for i, x in enumerate(_limbs(a, bits)):
        for j, y in enumerate(right):
            out += np.matmul(x, y).astype(np.int64) << bits * (i + j)
    return out


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part: x (part, row, place) against
    books (part, entry, place), ties to the lower entry."""
    far = (books * books).sum(2)[:, None, :] - 2 * exact_dots(x, books.transpose(0, 2, 1))
    code = far.argmin(2)
    return code, np.take_along_axis(far, code[..., None], 2)[..., 0] + (x * x).sum(2)


def totals(x: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """Sums of the parts of each entry, and last their number: (part, entry, place + 1)."""
    x = np.concatenate([x, np.ones((*x.shape[:2], 1), np.int64)], axis=2)
    own = (code[:, None, :] == np.arange(entries)[None, :, None]).astype(np.int64)
    return exact_dots(own, x)


def _stretches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Record batches cut to STRETCH bytes, each with its parts (part, row, place)."""
    rows = max(1, STRETCH // (8 * width))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            ints = part.column("ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield part, np.ascontiguousarray(ints.reshape(part.num_rows, PARTS, -1).transpose(1, 0, 2))
    release_memory()


def _round_totals(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Sums and counts of all parts by entry: every task adds its own first."""
    shape = (PARTS, books.shape[1], books.shape[2] + 1)

    def run(batches):
        out = np.zeros(shape, np.int64)
        for _, x in _stretches(batches, PARTS * books.shape[2]):
            out += totals(x, nearest(x, books)[0], books.shape[1])
        cells = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(out.ravel()[cells], pa.int64())], names=["cell", "total"])

    sums = rows.select("ints").mapInArrow(run, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total"))
    out = np.zeros(shape, np.int64)
    for r in sums.collect():          # codebook sized: parts x entries x places
        out.ravel()[r.cell] = r.total
    return out


def fit(rows: DataFrame, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, place) of stored ``integers``; None without rows."""
    first = rows.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(1).collect()
    if not first:
        return None
    same = rows.where(F.size("ints") == len(first[0].ints))
    start = same.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(ENTRIES).collect()
    books = np.array([r.ints for r in start], np.int64).reshape(len(start), PARTS, -1).transpose(1, 0, 2)
    for _ in range(rounds):
        sums = _round_totals(same, books)
        n = sums[..., -1:]
        books = np.where(n > 0, sums[..., :-1] // np.maximum(n, 1), books)
    return books


def compress(embeddings: DataFrame) -> DataFrame:
    """Code, error, error of the label and digest of the codebooks of every kept row."""
    rows = stored(integers(embeddings), "vector-ints")
    books = fit(rows)
    schema = f"vec_id long, label {dict(rows.dtypes)['label']}, code string, error long"
    if books is None:
        return rows.sparkSession.createDataFrame([], schema + ", label_error long, codebooks_sha256 string").drop("label")
    width = PARTS * books.shape[2]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    def run(batches):
        for part, x in _stretches(batches, width):
            code, error = nearest(x, books)
            names = code.T.astype(np.uint8).tobytes().hex()
            names = [names[at:at + 2 * PARTS] for at in range(0, len(names), 2 * PARTS)]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(names),
                                              pa.array(error.sum(0), pa.int64())], names=["vec_id", "label", "code", "error"])

    coded = stored(rows.where(F.size("ints") == width).mapInArrow(run, schema), "vector-codes")
    sums = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "vector-labels")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
