"""Token-set similarity against a short reference list, as one native expression.

Published definition: the words of both strings are compared as sets. With ``s`` the common
words, ``a`` and ``b`` the sorted remaining words of each side, all joined by spaces, the score
is the best normalised insert/delete similarity among (s+a, s+b), (s, s+a) and (s, s+b); if
one word set contains the other it is 100.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Positions of so many characters are kept as bits of one long; longer texts take the slow way.
_BITS = 62


def words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def longest_common_subsequence(left: Column, right: Column, longest: int = _BITS) -> Column:
    """Length of the longest common subsequence; ``right`` has at most ``longest`` characters."""
    if longest <= _BITS:
        return _subsequence_by_bits(left, right)
    return F.when(F.length(right) <= _BITS, _subsequence_by_bits(left, right)).otherwise(
        _subsequence_by_rows(left, right))


def _subsequence_by_rows(left: Column, right: Column) -> Column:
    """The usual recurrence: one row of lengths per character of ``left``."""
    def next_row(row: Column, c: Column, letters: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.size(letters)), F.array(F.lit(0)), lambda new, j:
                           F.array_append(new, F.when(
                               F.get(letters, j - 1) == c, F.get(row, j - 1) + 1
                           ).otherwise(F.greatest(F.get(row, j), F.get(new, j - 1)))))

    rows = F.transform(F.array(_characters(right)), lambda letters: F.aggregate(
        _characters(left), F.array_repeat(F.lit(0), F.size(letters) + 1),
        lambda row, c: next_row(row, c, letters)))
    return F.element_at(F.get(rows, 0), -1)


def _subsequence_by_bits(left: Column, right: Column) -> Column:
    """One bit per character of ``right``: a step per character of ``left`` clears the bit of each
    newly matched position, so the answer is the number of cleared bits."""
    right_reversed = F.reverse(_characters(right))
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    full = F.call_function("shiftleft", one, F.length(right)) - 1
    masks = F.transform(
        _characters(left),
        lambda c: F.aggregate(
            right_reversed, zero, lambda m, r: m * 2 + F.when(r == c, 1).otherwise(0)
        ),
    )

    def step(bits: Column, mask: Column) -> Column:
        hit = bits.bitwiseAND(mask)
        return (bits + hit).bitwiseOR(bits - hit).bitwiseAND(full)

    return F.length(right) - F.bit_count(F.aggregate(masks, full, step))


def _ratio(distance: Column, total: Column) -> Column:
    return F.lit(100.0) - F.lit(100.0) * distance / total


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it stands in the result."""
    return F.get(F.transform(F.array(value), use), 0)


def token_set_ratio(
    left_words: Column, right_words: Column, at_least: float = 0.0, longest: int = _BITS
) -> Column:
    """Similarity 0..100 of two word sets. Scores under ``at_least`` may come out lower than
    they are, never higher and never at or above it: that spares the subsequence search.
    ``longest`` bounds the characters of the right side."""
    parts = F.struct(
        F.array_join(F.array_intersect(left_words, right_words), " ").alias("common"),
        F.array_join(F.array_sort(F.array_except(left_words, right_words)), " ").alias("a"),
        F.array_join(F.array_sort(F.array_except(right_words, left_words)), " ").alias("b"),
        ((F.size(left_words) == 0) | (F.size(right_words) == 0)).alias("empty"),
    )
    return _bound(parts, lambda p: _score(p, at_least, longest))


def _score(parts: Column, at_least: float, longest: int) -> Column:
    a, b = parts["a"], parts["b"]
    shared = F.length(parts["common"])
    gap = F.when(shared > 0, 1).otherwise(0)
    len_a, len_b = F.length(a), F.length(b)
    total = shared + gap + len_a + shared + gap + len_b

    by_length = F.when(
        shared > 0,
        F.greatest(
            _ratio(gap + len_a, shared + shared + gap + len_a),
            _ratio(gap + len_b, shared + shared + gap + len_b),
        ),
    ).otherwise(F.lit(0.0))
    # An insert/delete distance is never below the edit distance, so this bounds the first ratio.
    ceiling = _ratio(F.levenshtein(a, b), total)
    subsequence = longest_common_subsequence(a, b, longest)
    searched = _ratio(len_a + len_b - 2 * subsequence, total)

    return (
        F.when(parts["empty"], F.lit(0.0))
        .when((shared > 0) & ((len_a == 0) | (len_b == 0)), F.lit(100.0))
        .when((ceiling <= by_length) | (ceiling < at_least), by_length)
        .otherwise(F.greatest(by_length, searched))
    )


def best_choice(text: Column, choices: Sequence[str], threshold: float) -> Column:
    """Struct (score, rank, choice) of the most similar choice; the earlier one wins a tie.

    Null where no choice reaches the threshold. The list is a constant of the expression, so
    there is neither a join nor a pair of rows.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(-i).alias("rank"),
                F.lit(c).alias("choice"),
                F.array(*[F.lit(w) for w in dict.fromkeys(c.split())]).alias("words"),
            )
            for i, c in enumerate(choices)
        ]
    )
    longest = max(map(len, choices), default=0)
    scored = _bound(words(text), lambda text_words: F.transform(
        entries,
        lambda e: F.struct(
            token_set_ratio(text_words, e["words"], threshold, longest).alias("score"),
            e["rank"].alias("rank"),
            e["choice"].alias("choice"),
        ),
    ))
    return F.array_max(F.filter(scored, lambda s: s["score"] >= threshold))


def exact_choice(choices: Sequence[str]) -> dict[str, str]:
    """What each reference entry itself resolves to.

    Not always itself: an entry whose words contain, or are contained in, those of an earlier
    entry ties with it at 100 and the earlier one wins.
    """
    sets = [set(c.split()) for c in choices]
    return {
        c: next(d for d, other in zip(choices, sets) if other <= mine or mine <= other)
        for c, mine in zip(choices, sets)
    }
