"""Secret scan: fixed patterns, then dictionary-primed zstandard novelty.

The patterns give the base spans. Beyond them, strings that stand near a
sensitive name are candidates; each is compressed together with the text
around it, by a compressor primed with that text, a dictionary of code words
and those words of a public tokenizer's vocabulary that the candidate is
spelled with (the others could not shorten it). The bytes it adds, per
character, say how much of it neither the dictionaries nor the context
explains; random keys stay near their full size.

Defined results: a null or empty text has no spans; repeated rows are scanned
one by one; an empty table gives no rows; extra columns are passed through by
``redact`` and ignored by ``scan``.
"""

from __future__ import annotations

import hashlib
import json
import keyword
import math
import random
import re
from collections import Counter
from functools import cache

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, texts

# FIXED VALUES: the base patterns and their least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "novel")

#: Names that make the strings after them candidates, and how far they reach.
SENSITIVE = re.compile(r"passw|passphrase|secret|token|api.?key|private.?key|access.?key|credential|"
                       r"bearer|authorization|client.?id|signature|\bpwd\b|\bauth\b", re.IGNORECASE | re.ASCII)
SENSITIVE_PARTS = ("passw", "passphrase", "secret", "token", "key", "credential", "bearer", "authorization",
                   "client", "signature", "pwd", "auth")
#: Letters of the vocabulary words that may explain a part of a candidate.
MIN_PART, MAX_PART = 4, 24
REACH, CONTEXT, MIN_NOVEL = 64, 512, 16  # defaults: ``reach`` and ``context`` are parameters of scan and redact
#: Least marginal bytes per character of a string with FEW_DIGITS digits or
#: more. A short random key is stored whole (1.0); identifiers built from words
#: of the dictionary or the context stay below 0.7.
NOVELTY, FEW_DIGITS = 0.75, 2
#: A long random string costs what its alphabet needs (0.5 in upper-case hex).
#: Strings below NOVELTY, with fewer digits or with words in them, are held against their own
#: characters in another order, which have the same alphabet and no words left:
#: random ones cost 0.97 of that or more. Strings of fewer bits a character
#: (rulers, runs) are no keys in any usual alphabet; random digits have 3.2.
OWN_ORDER, LEAST_BITS = 0.9, 2.75
#: A candidate ends in padding at most: an equals sign inside parts a name from its value.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_NOVEL)
#: What may glue a key to its name without an equals sign or a blank.
GLUE = "+/_-"

#: Identifiers that code around credentials uses; with Python's keywords they
#: prime the compressor, so that names made of them cost next to nothing.
IDENTIFIERS = ("access_token refresh_token client_secret client_id api_key secret_key private_key public_key "
               "password username authorization bearer credentials connection_string database host port "
               "endpoint environment config settings default example localhost https http www com org "
               "function return const export import class static public void string number boolean "
               "the and that with from this which there their would about these other into than").split()


@cache
def _dictionary() -> bytes:
    return " ".join([*keyword.kwlist, *IDENTIFIERS, "0123456789 abcdefghijklmnopqrstuvwxyz "
                     "ABCDEFGHIJKLMNOPQRSTUVWXYZ 00000000 xxxxxxxx"]).encode()


def vocabulary_path() -> str:
    """The default vocabulary: a public tokenizer's file where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@cache
def _vocabulary(path: str) -> frozenset[str]:
    with open(path, encoding="utf-8") as f:
        words = json.load(f)["model"]["vocab"]
    words = (w.removesuffix("</w>") for w in words)
    return frozenset(w for w in words if MIN_PART <= len(w) <= MAX_PART and w.isascii() and w.isalpha())


#: Runs of letters in one of the three ways in which words are written.
WRITTEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def spelled_with(candidate: str, path: str | None = None) -> list[str]:
    """Vocabulary words that the candidate's letter runs are spelled with, as
    they are written there, the longest at each place, left to right."""
    words, out = _vocabulary(path or vocabulary_path()), []
    for run in WRITTEN.finditer(candidate):
        low, at = run[0].lower(), 0
        while at < len(low):
            to = next((k for k in range(min(len(low), at + MAX_PART), at + MIN_PART - 1, -1) if low[at:k] in words), None)
            if to:
                out.append(run[0][at:to])
            at = to or at + 1
    return out


def marginal_bytes(candidate: str, around: str, words: list[str] | tuple[str, ...] = ()) -> int:
    """Compressed bytes that the candidate adds beside the text around it and these words."""
    prime = b"\n".join([_dictionary(), " ".join(words).encode(), around.encode("utf-8", "surrogatepass")])
    packer = zstandard.ZstdCompressor(level=19, write_content_size=False, write_checksum=False,
                                      dict_data=zstandard.ZstdCompressionDict(
                                          prime, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    probe = b"key = "
    return len(packer.compress(probe + candidate.encode())) - len(packer.compress(probe))


def bits_a_character(word: str) -> float:
    """Entropy of the characters by themselves."""
    counts = Counter(word).values()
    return sum(n * math.log2(len(word) / n) for n in counts) / len(word)


def is_novel(word: str, around: str, vocabulary: str | None = None) -> bool:
    """Whether neither the dictionaries nor the text around explains the string."""
    parts = spelled_with(word, vocabulary)
    cost = marginal_bytes(word, around, parts)
    if not parts and cost >= NOVELTY * len(word) and sum(map(str.isdigit, word)) >= FEW_DIGITS:
        return True
    if bits_a_character(word) < LEAST_BITS:
        return False
    shuffled = list(word)
    random.Random(len(word)).shuffle(shuffled)
    return cost >= OWN_ORDER * marginal_bytes("".join(shuffled), around)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, code points, end exclusive."""
    spans, low = [], text.lower()
    if any(name in low for name in ASSIGN_NAMES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


def novel_spans(text: str, known: list[tuple[int, int, int]], reach: int = REACH, context: int = CONTEXT,
                vocabulary: str | None = None) -> list[tuple[int, int, int]]:
    """Candidates in sensitive context that no base span touches and that the
    primed compressor cannot explain: strings that begin at most ``reach``
    characters behind a name, judged beside ``context`` characters on each side."""
    low = text.lower()
    if not any(part in low for part in SENSITIVE_PARTS):
        return []
    found, tried = [], set()
    for name in SENSITIVE.finditer(text):
        # so far that a string starting anywhere inside the reach shows its least length
        stop = min(len(text), name.end() + reach + MIN_NOVEL - 1)
        for m in CANDIDATE.finditer(text, name.end(), stop):
            start, end = m.span()
            if end == stop:  # the string goes on
                end = CANDIDATE.match(text, start).end()
            if start == name.end():
                # the rest of an identifier, as in tokenization, unless it is parted and has digits
                start = end - len(text[start:end].lstrip(GLUE))
                if start == name.end() or end - start < MIN_NOVEL or sum(map(str.isdigit, text[start:end])) < FEW_DIGITS:
                    continue
            if start in tried:
                continue
            tried.add(start)
            if any(s < end and start < e for s, _, e in known):
                continue
            if is_novel(text[start:end], text[max(0, start - context):start] + text[end:end + context], vocabulary):
                found.append((start, 3, end))
    return sorted(found)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def all_spans(text: str, reach: int = REACH, context: int = CONTEXT, vocabulary: str | None = None) -> tuple[list, list]:
    base = sorted(base_spans(text))
    return base, sorted(base + novel_spans(text, base, reach, context, vocabulary))


def _scan(rows: dict, *how) -> dict:
    out = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans")}
    for text in rows["text"]:
        base, spans = all_spans(text, *how)
        for kind, name in enumerate(("n_assign", "n_access", "n_hex", "n_novel")):
            out[name].append(sum(k == kind for _, k, _ in spans))
        out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
        out["spans"].append(_joined(spans))
    return {"doc_id": rows["doc_id"], **out}


def scan(docs: DataFrame, reach: int = REACH, context: int = CONTEXT, vocabulary: str | None = None) -> DataFrame:
    """One row per document: counts per kind, digest of the base spans, all spans.
    ``vocabulary`` is the tokenizer file whose words explain candidates, a path
    that every executor can read (by default the public one of the box)."""
    return map_texts(texts(docs), lambda rows: _scan(rows, reach, context, vocabulary), "doc_id long, n_assign long, n_access long, n_hex long, "
                                         "base_sha256 string, spans string, n_novel long")


def mask(text: str | None, mark: str, *how) -> str | None:
    """The text with every span (overlaps joined) replaced by ``mark``; ``how`` as in all_spans."""
    if not text:
        return text
    _, spans = all_spans(text, *how)
    parts, at = [], 0
    for s, _, e in spans:
        if e <= at:
            continue
        if s >= at:
            parts += [text[at:s], mark]
        at = e
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]", reach: int = REACH, context: int = CONTEXT,
           vocabulary: str | None = None) -> DataFrame:
    """``docs`` with its secrets replaced; all columns and rows stay, null
    texts stay null. ``n_chars``, where it exists, follows the new text."""

    @F.pandas_udf("string")
    def masked(col):
        return col.map(lambda t: mask(t, mark, reach, context, vocabulary))

    out = docs.withColumn("text", masked(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text"))
                             .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
