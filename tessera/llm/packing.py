"""Best-two-fit packing of tokenized documents into fixed-length sequences.

A document's tokens and the end token are cut into pieces of ``capacity``; only
longer documents are cut. Pieces are dealt over shards by a hash, so that the
work of a shard is bounded and every shard wastes at most part of one sequence.
Inside a shard a sequence is filled greedily, longest piece that fits first;
then its smallest piece is exchanged for two unpacked pieces that fill the
room better, as long as such a pair exists.

Tokens come from a word cache: the tokenizer lower-cases and cuts at white
space, so a text's ids are its words' ids in order, and each distinct word is
encoded once while it stays in the cache.

Defined results: a null or empty text is one piece holding the end token;
repeated rows are packed one by one; an empty table gives no rows; a null
doc_id is packed like any other; extra columns of any name are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import map_texts, texts
from tessera.session import stored

CAPACITY, END_TOKEN = 4096, 1
#: Pieces of a shard: the packer's memory and time follow it.
SHARD_PIECES = 32_768
#: Words, and parts of words, kept per Python worker; a full cache starts again.
CACHE_WORDS = 500_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Table:
    """Growing list of id sequences, gathered by number in numpy."""

    def __init__(self):
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.n, self.used = np.zeros(1 << 18, np.uint32), 0, 0

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        while self.n + len(size) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.start[self.n:self.n + len(size)] = self.used + np.cumsum(size) - size
        self.size[self.n:self.n + len(size)] = size
        self.pool[self.used:self.used + len(ids)] = ids
        self.n, self.used = self.n + len(size), self.used + len(ids)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the sequences end to end, and the n+1 boundaries."""
        size = self.size[numbers]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat((self.start[numbers] - ends[:-1]).astype(np.int32), size)  # pool and slice are far below 2**31
        at += np.arange(len(at), dtype=np.int32)
        return self.pool[at], ends


class Numbers:
    """Distinct strings, kept in an Arrow array, and their numbers. A tenth of
    the memory of a dict; the hash table lives for one call."""

    def __init__(self):
        self.values = pa.array([], pa.string())

    def __len__(self) -> int:
        return len(self.values)

    def find(self, some: pa.Array) -> np.ndarray:
        """Number of each string, -1 where it is new."""
        return pc.index_in(some, value_set=self.values).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, new: pa.Array) -> np.ndarray:
        at = len(self.values)
        self.values = pa.concat_arrays([self.values, new])
        return np.arange(at, at + len(new))


def _bounds(n: list) -> np.ndarray:
    return np.cumsum(np.fromiter(map(len, n), np.int64, len(n)))


class WordIds:
    """ids of texts through caches of words and of the parts words split into.

    ``path`` names a tokenizer that lower-cases, drops ASCII white space and
    never joins across it. Latin-1 words are split here by the tokenizer's own
    rule (contractions, letters, single digits, the rest), so that a part is
    encoded once for all the words it stands in; other words, and those that
    hold a special token, go to the tokenizer whole.
    """

    PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
    PLAIN = re.compile(r"[\x00-\x84\x86-\x9f\xa1-\xff]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.part, self.parts = Numbers(), Table()
        self.reset()

    def reset(self):
        """Forget the words, and the parts once there are as many of them."""
        self.word, self.words = Numbers(), Table()
        if len(self.part) > CACHE_WORDS:
            self.part, self.parts = Numbers(), Table()

    def _encode(self, texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch(texts_, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(size.sum())), size

    def _part_numbers(self, distinct: pa.Array) -> np.ndarray:
        number = self.part.find(distinct)
        new = np.flatnonzero(number < 0)
        words = distinct.take(pa.array(new))
        texts_ = words.to_pylist()
        for at in range(0, len(texts_), 4096):
            some = texts_[at:at + 4096]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            last = np.flatnonzero(self.closes[ids])
            if len(last) == len(some) and (not len(last) or last[-1] == len(ids) - 1):
                self.parts.add(ids, np.diff(last, prepend=-1))
            else:
                self.parts.add(*self._encode(some))
        number[new] = self.part.add(words)
        return number

    def _add(self, new: pa.Array) -> np.ndarray | None:
        """Numbers of new words; None if the cache is too full for them."""
        if len(self.word) + len(new) > CACHE_WORDS:
            return None
        plain, other, split, whole = [], [], [], []
        for k, w in enumerate(new.to_pylist()):
            if (w.isascii() or self.PLAIN.fullmatch(w)) and "<|" not in w:
                plain.append(k)
                split.append(self.PART.findall(w.lower()))
            else:
                other.append(k)
                whole.append(w)
        coded = pa.array([p for ps in split for p in ps], pa.string()).dictionary_encode()
        ids, ends = self.parts.gather(self._part_numbers(coded.dictionary)[coded.indices.to_numpy()])
        self.words.add(ids, np.diff(ends[np.concatenate([[0], _bounds(split)])]))
        self.words.add(*self._encode(whole))
        order = np.array(plain + other, np.int64)
        number = np.empty(len(order), np.int64)
        number[order] = self.word.add(new.take(pa.array(order)))
        return number

    def encode(self, docs: pa.Array, end_token: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, each document closed by ``end_token``, and the n+1
        boundaries. Words are cut and numbered in Arrow; Python sees each
        distinct word of the slice once, and only when it is new."""
        split = pc.ascii_split_whitespace(docs)
        coded = split.flatten().dictionary_encode()
        number = self.word.find(coded.dictionary)
        new = np.flatnonzero(number < 0)
        if len(new):
            added = self._add(coded.dictionary.take(pa.array(new)))
            if added is None:
                self.reset()
                new, added = np.arange(len(number)), self._add(coded.dictionary)
            if added is None:  # one slice alone holds more words than the cache
                ids, size = self._encode(docs.to_pylist())
                ends = np.concatenate([[0], np.cumsum(size)])
                return np.insert(ids, ends[1:], end_token), ends + np.arange(len(ends))
            number[new] = added
        ids, at = self.words.gather(number[coded.indices.to_numpy()])
        offsets = split.offsets.to_numpy()
        ends = at[offsets - offsets[0]]
        return np.insert(ids, ends[1:], end_token), ends + np.arange(len(ends))


@cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
           end_token: int = END_TOKEN, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document, with its ids when asked for."""
    path = tokenizer or default_tokenizer()

    def cut(rows: pa.RecordBatch) -> dict:
        ids, ends = _word_ids(path).encode(rows.column("text"), end_token)
        ids = ids.astype("<u4")
        size = np.diff(ends)
        n = -(-size // capacity)
        doc = np.repeat(np.arange(len(size)), n)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        start = piece * capacity
        length = np.minimum(capacity, size[doc] - start)
        at = ends[doc] + start
        raw = [ids[a:a + k].tobytes() for a, k in zip(at, length)]
        out = {"doc_id": rows.column("doc_id").take(pa.array(doc)), "piece": piece.astype(np.int32), "start": start,
               "length": length, "ids_crc32": [zlib.crc32(r) for r in raw]}
        return out | ({"ids": raw} if with_ids else {})

    return map_texts(texts(docs), cut, PIECES + (", ids binary" if with_ids else ""), limit=4 << 20, arrow=True)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece. Deterministic; pieces of one length are
    taken in the order given. Bit l of ``free`` says that length l is unpacked,
    bit capacity - l of ``mirror`` says the same, so that pairs of lengths with
    a given sum are one shift and one AND."""
    stock: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        stock[int(lengths[i])].append(i)
    free = mirror = 0
    for n, own in enumerate(stock):
        if own:
            free |= 1 << n
            mirror |= 1 << (capacity - n)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)

    def take(n: int) -> int:
        nonlocal free, mirror
        i = stock[n].pop()
        if not stock[n]:
            free ^= 1 << n
            mirror ^= 1 << (capacity - n)
        return i

    def put_back(n: int, i: int) -> None:
        nonlocal free, mirror
        if not stock[n]:
            free |= 1 << n
            mirror |= 1 << (capacity - n)
        stock[n].append(i)

    number = 0
    while free:
        held: list[tuple[int, int]] = []
        gap = capacity
        while fits := free & ((1 << (gap + 1)) - 1):
            n = fits.bit_length() - 1
            held.append((n, take(n)))
            gap -= n
        while gap and free:
            small = min(range(len(held)), key=lambda k: held[k][0])
            room, pair = gap + held[small][0], None
            for total in range(room, held[small][0], -1):
                both = free & (mirror >> (capacity - total))
                while both:
                    a = both.bit_length() - 1
                    if 2 * a != total or len(stock[a]) > 1:
                        pair = (a, total - a)
                        break
                    both ^= 1 << a
                if pair:
                    break
            if pair is None:
                break
            n, i = held.pop(small)
            held += [(m, take(m)) for m in pair]
            put_back(n, i)
            gap = room - sum(pair)
        at = 0
        for n, i in held:
            bins[i], offsets[i] = number, at
            at += n
        number += 1
    return bins, offsets


def pack(cut: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``cut`` (a written table of pieces) with sequence_id and offset."""
    shards = max(1, -(-cut.count() // shard_pieces))
    # the row's place in the table deals equal pieces over all shards
    keyed = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length", F.monotonically_increasing_id()), F.lit(shards)))
    schema = T.StructType([*cut.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    target = to_arrow_schema(schema)

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("ids_crc32", "ascending")])
        shard = table.column("shard")[0].as_py()
        bins, offsets = best_two_fit(table.column("length").to_numpy(), capacity)
        table = table.drop_columns(["shard"]).append_column("sequence_id", pa.array(bins + (shard << 32)))
        return table.append_column("offset", pa.array(offsets)).select(target.names).cast(target)

    return keyed.groupBy("shard").applyInArrow(one, schema)


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
           end_token: int = END_TOKEN, with_ids: bool = False) -> DataFrame:
    """Every piece of every document and its place in the packed sequences."""
    return pack(stored(pieces(docs, tokenizer, capacity, end_token, with_ids), "pieces"), capacity)


def sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
              end_token: int = END_TOKEN) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids (little-endian
    unsigned 32-bit), and the lengths of the pieces inside for attention masks.
    A sequence has at most ``capacity`` pieces, so its list is bounded."""
    part = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    rows = packed(docs, tokenizer, capacity, end_token, True).groupBy("sequence_id").agg(part.alias("parts"))
    return rows.select("sequence_id", F.aggregate("parts.length", F.lit(0).cast("long"), lambda a, n: a + n).alias("length"),
                       F.aggregate("parts.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
                       F.col("parts.length").alias("piece_lengths"))
