"""Word shingles as Spark expressions.

Words are runs of characters other than blank and the control characters U+0009 to U+000D, with
A-Z lower-cased.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.llm.tables import ascii_lower

#: Words of a shingle.
SHINGLE_WORDS = 5


def words(text: Column) -> Column:
    """Array of words; empty for null."""
    return F.array_remove(
        F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")


def _runs(words_: Column, n: int, combine) -> Column:
    last = F.size(words_) - n
    made = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                       lambda i: combine(*[F.get(words_, i + k) for k in range(n)]))
    return F.when(last >= 0, made).otherwise(F.slice(made, 1, 0))


def shingle_hashes(words_: Column, n: int = SHINGLE_WORDS) -> Column:
    """64-bit hash of every run of ``n`` words. Give ``words_`` as a column, not an expression:
    it is used many times."""
    return _runs(words_, n, lambda *run: F.xxhash64(F.lit(n), *run))


def shingle_texts(words_: Column, n: int = SHINGLE_WORDS) -> Column:
    """Every run of ``n`` words, joined by blanks."""
    return _runs(words_, n, lambda *run: F.concat_ws(" ", *run))
