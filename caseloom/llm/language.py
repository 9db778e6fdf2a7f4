"""Language identification by cross-parsing entropy.

A suffix automaton is built over training text of each language. A text is parsed against it from
left to right into phrases, each the longest match that the training text holds from there. With c
phrases over n symbols and N symbols of training text, c * log2(N) / n estimates the bits a symbol
costs in that language; the language that needs the fewest wins.

Training takes a bounded sample: of each language the ``SAMPLE_ROWS`` distinct texts that a hash puts
first, whole or, of longer ones, a stretch of a sixteenth of ``TRAIN_CHARS`` from a place that the hash
draws, until ``TRAIN_CHARS`` are full. All languages together have ``MODEL_CHARS``: with many labels each
gets its part of that, ``LEAST_CHARS`` at least, and labels beyond are not learned, those with the fewest
distinct texts first (ties: last by name). So the model is as large as these bounds make it, whatever
the corpus.

Symbols are lower-cased letters, every letter of the training texts one of its own; runs of other
characters are one separator. A symbol that the training text lacks is a phrase by itself. Long texts are parsed whole, in stretches of ``STRETCH`` symbols: no
phrase crosses the end of a stretch. The automaton becomes a table (state, symbol) -> (state, phrases
ended), so that many stretches are stepped through at once. Where states times symbols are more than
``DENSE`` cells, as with scripts of thousands of letters, only the moves that exist are kept, sorted,
and are found by binary search: slower, with the same results.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties go to the
language first by name; without training rows everything is ``und``; null labels and labelled rows
without letters are not learned from; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.llm.tables import stored

UNKNOWN = "und"
#: Distinct labelled texts per language that training takes.
SAMPLE_ROWS = 64
#: Symbols of training text per language, and of all languages together.
TRAIN_CHARS = 24_000
MODEL_CHARS = 200 * TRAIN_CHARS
#: A language gets so many even where there are too many of them.
LEAST_CHARS = 2_000
#: Cells of the largest table that has a cell for every state and symbol.
DENSE = 1 << 25
#: Symbols that are parsed in one go.
STRETCH = 2048
#: Characters of several texts that are parsed together.
_TOGETHER = 1_000_000
_SEPARATOR, _STRANGE = 0, 1
_RESULT = "lang string, score double, bits double, symbols long"


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the start."""
    following: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for symbol in symbols:
        new = len(following)
        following.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in following[at]:
            following[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = following[at][symbol]
            if longest[target] == longest[at] + 1:
                link[new] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                longest.append(longest[at] + 1)
                link.append(link[target])
                while at >= 0 and following[at].get(symbol) == target:
                    following[at][symbol] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return following


@dataclass
class LanguageModel:
    """``table[state + symbol]`` is ``4 * next state + phrases ended``; states are multiples of
    the alphabet's size, those of each language from ``roots`` on. With ``keys``, ``table`` has
    the moves at these values of ``state + symbol`` only, and ``restarts`` (language, symbol) the
    moves where there is none."""

    languages: list[str]
    alphabet: str
    table: np.ndarray
    roots: np.ndarray
    log_lengths: np.ndarray
    #: Letters in the training text of each language.
    letters: list[int]
    keys: np.ndarray | None = None
    restarts: np.ndarray | None = None

    look_up: np.ndarray | None = None

    def symbols_of(self) -> np.ndarray:
        """Symbol of every code point, made once and sent with the model."""
        if self.look_up is None:
            self.look_up = np.fromiter((_STRANGE if chr(c).isalpha() else _SEPARATOR
                                        for c in range(0x110000)), np.int32, 0x110000)
            for k, letter in enumerate(self.alphabet):
                self.look_up[ord(letter)] = 2 + k
        return self.look_up

    def moves(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Cells of ``table`` for states (language, place) and symbols (place)."""
        at = states + symbols
        if self.keys is None:
            return self.table.take(at)
        places = np.searchsorted(self.keys, at)
        return np.where(self.keys.take(places) == at, self.table.take(places),
                        self.restarts[:, symbols])


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all lower-cased texts, and the length of each."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.fromiter(map(len, lowered), np.int64, len(lowered))


def _collapse(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of separators become one, text by text."""
    if not len(symbols):
        return symbols, lengths
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != _SEPARATOR) | (symbols[:-1] != _SEPARATOR)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    keep[starts[lengths > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return symbols[keep], kept[ends] - kept[starts]


def build_model(texts: dict[str, list[str]], train_chars: int = TRAIN_CHARS,
                dense: int = DENSE) -> LanguageModel:
    """Automata over the texts of each language, in the order given, until ``train_chars`` are full."""
    joined = {lang: " ".join(parts).lower()[:train_chars] for lang, parts in sorted(texts.items())}
    joined = {lang: t for lang, t in joined.items() if any(c.isalpha() for c in t)}
    own = [{c for c in t if c.isalpha()} for t in joined.values()]
    alphabet = "".join(sorted(set().union(*own)))
    number = {c: 2 + k for k, c in enumerate(alphabet)}
    width = 2 + len(alphabet)
    automata, log_lengths = [], []
    for text in joined.values():
        symbols = [number.get(c, _SEPARATOR) for c in text]
        symbols = [s for k, s in enumerate(symbols) if s or not k or symbols[k - 1]]
        automata.append(suffix_automaton(symbols))
        log_lengths.append(math.log2(max(2, len(symbols))))
    sizes = np.array([len(a) for a in automata], np.int64)
    bases = np.cumsum(sizes) - sizes
    # A symbol that the training text lacks ends the open phrase, is one and leads back to the start,
    # where no phrase is open.
    restarts = np.repeat(4 * bases[:, None] * width + 2, width, 1)
    keys, moves = [], []
    for k, (following, base) in enumerate(zip(automata, bases.tolist())):
        for symbol in range(width):
            if symbol in following[0]:
                restarts[k, symbol] = 4 * (base + following[0][symbol]) * width + 1
            else:
                keys.append(base * width + symbol)
                moves.append(4 * base * width + 1)
        for state, row in enumerate(following):
            for symbol, target in row.items():
                keys.append((base + state) * width + symbol)
                moves.append(4 * (base + target) * width)
    keys, moves = np.array(keys, np.int64), np.array(moves, np.int64)
    cells = int(sizes.sum()) * width
    common = list(joined), alphabet
    letters = list(map(len, own))
    if cells > dense:
        order = np.argsort(keys)
        end = np.iinfo(np.int64).max  # greater than every key that is looked for
        return LanguageModel(*common, np.append(moves[order], 0), bases * width,
                             np.array(log_lengths), letters, np.append(keys[order], end), restarts)
    kind = np.int32 if 4 * cells < 1 << 31 else np.int64
    table = np.repeat(restarts.astype(kind), sizes, 0).ravel()
    table[keys] = moves
    return LanguageModel(*common, table, (bases * width).astype(kind), np.array(log_lengths), letters)


def count_phrases(model: LanguageModel, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Phrases per language and text: the stretches of all texts step through the table together."""
    texts = np.repeat(np.arange(len(lengths)), -(-lengths // STRETCH))
    first = np.cumsum(lengths) - lengths
    order_in_text = np.arange(len(texts)) - np.repeat(
        np.cumsum(-(-lengths // STRETCH)) - -(-lengths // STRETCH), -(-lengths // STRETCH))
    starts = first[texts] + order_in_text * STRETCH
    sizes = np.minimum(STRETCH, lengths[texts] - order_in_text * STRETCH)
    longest_first = np.argsort(-sizes, kind="stable")
    texts, starts, sizes = texts[longest_first], starts[longest_first], sizes[longest_first]
    counts = np.zeros((len(model.roots), len(texts)), np.int32)
    state = np.repeat(model.roots[:, None], len(texts), 1)
    active = len(texts)
    steps = int(sizes[0]) if active else 0
    active_at = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")
    for step in range(steps):
        active = active_at[step]
        moved = model.moves(state[:, :active], symbols[starts[:active] + step])
        counts[:, :active] += moved & 3
        state[:, :active] = moved >> 2
    counts += state != model.roots[:, None]
    total = np.zeros((len(model.roots), len(lengths)), np.int64)
    for k in range(len(model.roots)):
        total[k] = np.bincount(texts, counts[k], len(lengths))
    return total


def identify(model: LanguageModel, look_up: np.ndarray,
             texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
    """Language, score and bits per symbol of each text."""
    return judged(model, look_up, texts)[:3]


def judged(model: LanguageModel, look_up: np.ndarray, texts: list[str | None]
           ) -> tuple[list[str], list[float], list[float], list[int]]:
    """Language, score, bits per symbol and symbols of each text."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    bits, sizes = [math.nan] * len(texts), [0] * len(texts)
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end] or "") <= _TOGETHER):
            chars += len(texts[end] or "")
            end += 1
        codes, lengths = _codes([t or "" for t in texts[at:end]])
        symbols, lengths = _collapse(look_up[codes], lengths)
        sizes[at:end] = lengths.tolist()
        spoken = np.bincount(np.repeat(np.arange(len(lengths)), lengths),
                             symbols != _SEPARATOR, len(lengths)) > 0
        if len(model.languages) and spoken.any():
            cost = count_phrases(model, symbols, lengths) * model.log_lengths[:, None] \
                / np.maximum(lengths, 1)
            best = cost.argmin(0)
            ordered = np.sort(cost, 0)
            for k in np.flatnonzero(spoken):
                low = ordered[0, k]
                langs[at + k] = model.languages[best[k]]
                bits[at + k] = float(low)
                scores[at + k] = float(ordered[1, k] / (low + ordered[1, k])) \
                    if len(ordered) > 1 else 1.0
        at = end
    return langs, scores, bits, sizes


def _plan(found: list[tuple[str, int]], train_chars: int) -> tuple[list[str], int]:
    """Languages to learn, from (label, distinct texts), and the symbols that each gets."""
    budget = train_chars * MODEL_CHARS // TRAIN_CHARS
    least = min(LEAST_CHARS, train_chars)
    chosen = [lang for lang, _ in sorted(found, key=lambda f: (-f[1], f[0]))[:max(1, budget // least)]]
    return sorted(chosen), min(train_chars, max(least, budget // max(1, len(chosen))))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang",
          sample_rows: int = SAMPLE_ROWS, train_chars: int = TRAIN_CHARS) -> LanguageModel:
    """Model from a bounded sample of the labelled rows; the rest is only counted."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn(
        "draw", F.xxhash64(F.lit(5), "text"))
    # Texts are told apart by their draw; copies combine before the shuffle.
    draws = stored(rows.select("lang", "draw").distinct(), "language-draws")
    counts = draws.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    most = train_chars * MODEL_CHARS // TRAIN_CHARS // min(LEAST_CHARS, train_chars)
    found = counts.orderBy(F.desc("n"), "lang").limit(max(1, most)).collect()
    if not found:
        return build_model({})
    languages, chars = _plan([(r["lang"], r["n"]) for r in found], train_chars)
    spark = labelled.sparkSession
    first = draws.join(F.broadcast(spark.createDataFrame([(x,) for x in languages], "lang string")), "lang") \
        .withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("draw"))) \
        .filter(F.col("rank") <= sample_rows).drop("rank")  # Spark limits the ranks before it shuffles
    share = max(1, train_chars // 16)
    begin = F.pmod("draw", F.greatest(F.char_length("text") - share, F.lit(0)) + 1).cast("int") + 1
    taken = rows.join(F.broadcast(stored(first, "language-sample")), ["lang", "draw"]).select(
        "lang", "draw", F.substring("text", begin, F.lit(share)).alias("text")
    ).dropDuplicates(["lang", "draw"]).orderBy("draw", "text").collect()
    texts: dict[str, list[str]] = {}
    for row in taken:
        texts.setdefault(row["lang"], []).append(row["text"])
    return build_model(texts, chars)


def language_of(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """Struct (lang, score, bits, symbols) of a text column."""
    model.symbols_of()
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            columns = judged(known, known.symbols_of(), batch.tolist())
            yield pd.DataFrame(dict(zip(("lang", "score", "bits", "symbols"), columns)))

    return F.pandas_udf(predict, _RESULT)(text)
