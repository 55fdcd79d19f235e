"""Column -> Column text functions (all JVM-side, inside whole-stage codegen).

Regexes are written in the subset Java and RE2 share, so the same pattern text
serves the Spark function and its SQL oracle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import fixed


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's Unicode white space: the property, and four separators it adds. The
# engine tests the property from a table, which is much faster than a class
# that lists the code points.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
CRAWL_DROP = "[^" + fixed.CRAWL_KEEP_CLASS.replace("\n", "\\n") + "]"
PUNCT_RUN = "[.,?!]{2,}"
ANALYSIS_DROP_RUN = "[^" + fixed.ANALYSIS_KEEP_CLASS + "]+"
TAG = "<[^>]+>"
ENTITY = "&[a-z]+;"


def clean_text(c) -> Column:
    """Crawl-time cleaner.

    Whitespace runs -> one space; characters outside the kept class -> space;
    runs of two or more of ``.,?!`` -> space; trim. The time/date removals of
    the original never fire (``:`` and ``/`` are already blanked) and are left
    out; spaces are not re-collapsed.
    """
    s = F.regexp_replace(_col(c), WHITESPACE_RUN, " ")
    s = F.regexp_replace(s, CRAWL_DROP, " ")
    s = F.regexp_replace(s, PUNCT_RUN, " ")
    return F.trim(s)


def remove_boilerplate(c, phrases: list[str] | None = None) -> Column:
    """Replace each phrase (in list order, literal substring) by a space."""
    phrases = fixed.BOILERPLATE_PHRASES if phrases is None else phrases
    return reduce(lambda acc, ph: F.replace(acc, F.lit(ph), F.lit(" ")),
                  phrases, _col(c))


def preprocess_text(c, phrases: list[str] | None = None) -> Column:
    """Analysis-time normaliser.

    lower -> tags to space -> entities to space -> boilerplate -> runs of
    characters outside ``[0-9a-z greek space]`` to one space -> collapse
    spaces -> trim. Afterwards only single spaces separate tokens, which is
    what lets term matching become token n-gram equality.
    """
    s = F.lower(_col(c))
    # Tags then entities, in one pass: each replacement inserts a space,
    # which can never complete a new tag or entity, so the alternation
    # equals the two sequential passes.
    s = F.regexp_replace(s, TAG + "|" + ENTITY, " ")
    s = remove_boilerplate(s, phrases)
    s = F.regexp_replace(s, "(?iu)" + ANALYSIS_DROP_RUN, " ")
    s = F.regexp_replace(s, " +", " ")
    return F.trim(s)


def word_count(c) -> Column:
    """Number of whitespace-separated tokens (X7, the 'direct_terms' metric)."""
    toks = F.split(F.regexp_replace(_col(c), WHITESPACE_RUN, " "), " ")
    return F.size(F.filter(toks, lambda t: t != ""))


def script_count(c, letter_class: str = fixed.GREEK_LETTER_CLASS,
                 sample_chars: int = fixed.SCRIPT_SAMPLE_CHARS) -> Column:
    """Letters of the class within the first ``sample_chars`` characters."""
    return F.regexp_count(F.substring(_col(c), 1, sample_chars), F.lit(letter_class))


def script_ratio_ok(c, letter_class: str = fixed.GREEK_LETTER_CLASS,
                    sample_chars: int = fixed.SCRIPT_SAMPLE_CHARS,
                    min_count: int = fixed.SCRIPT_MIN_COUNT,
                    min_ratio: float = fixed.SCRIPT_MIN_RATIO) -> Column:
    """Script-ratio predicate (F1): enough letters, or a high enough share."""
    sample = F.substring(_col(c), 1, sample_chars)
    n = F.regexp_count(sample, F.lit(letter_class))
    total = F.length(sample)
    return (n >= min_count) | ((total > 0) & ((n / total) >= min_ratio))


def is_greek(c) -> Column:
    return script_ratio_ok(c)


def content_hash(c) -> Column:
    """MD5 hex of the UTF-8 text."""
    return F.md5(_col(c))


def nonblank(c) -> Column:
    """text that is not empty after trimming."""
    return F.trim(_col(c)) != ""
