"""Phrase mining against plain counting; filters give back what went in."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from caseloom.llm import phrases
from caseloom.llm.phrases import (half_bits, merged, mine_phrases, pack, permute, read_filter,
                                  split_words, unpack, write_filter)

DOCS = "doc_id long, text string, lang string"


def plain(rows, least, top):
    words, pairs, triples = Counter(), Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            run = [w for w in re.split("[ \t]+", piece) if w]
            words.update((lang, w) for w in run)
            pairs.update((lang, *run[i:i + 2]) for i in range(len(run) - 1))
            triples.update((lang, *run[i:i + 3]) for i in range(len(run) - 2))
    scored = []
    for (lang, x, y), a in pairs.items():
        longer = max([c for (g, *t), c in triples.items() if g == lang and c >= least
                      and (t[:2] == [x, y] or t[1:] == [x, y])], default=0)
        if a >= least and 100 * longer < 50 * a:
            l, r = words[lang, x], words[lang, y]
            scored.append((lang, f"{x} {y}", a, l, r, 1000000 * a * a // (l * r)))
    for (lang, x, y, z), a in triples.items():
        if a >= least:
            cuts = [(words[lang, x], pairs[lang, y, z]), (pairs[lang, x, y], words[lang, z])]
            score, k = min((1000000 * a * a // (l * r), k) for k, (l, r) in enumerate(cuts))
            scored.append((lang, f"{x} {y} {z}", a, *cuts[k], score))
    out = []
    for lang in {s[0] for s in scored}:
        own = sorted((s for s in scored if s[0] == lang), key=lambda s: (-s[5], -s[2], s[1].encode()))
        total = sum(c for (g, _), c in words.items() if g == lang)
        out += [(lang, k + 1, s[1], s[2], s[3], s[4], total, s[5]) for k, s in enumerate(own[:top])]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in mine_phrases(df, **options).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, count=60):
    draw = random.Random(seed)
    vocabulary = ["a", "B", "b", "né", "NÉ", "漢", "x-y", " ", "\x1c", "é", "to", "be", "\x00"]
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r", "!", " ? "]
    return [(k, "".join(draw.choice(vocabulary) + draw.choice(marks)
                        for _ in range(draw.randrange(40))), draw.choice(["en", "en", "fr", None]))
            for k in range(count)]


@pytest.mark.parametrize("block_words", [1, 50, 1 << 21])
def test_equals_plain_counting_in_blocks_of_any_size(spark, block_words):
    rows = corpus(block_words)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    assert mined(df, least=3, top=25, block_words=block_words) == plain(rows, 3, 25)


def test_a_third_of_all_rows_equal(spark):
    rows = corpus(7, 40) + [(5, "to be or not to be, to be", "en")] * 400
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert mined(df, block_words=100) == plain(rows, 10, 2000)


def test_counts_beyond_a_byte_and_many_merges(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_ENTRIES", 3)
    rows = [(k, "one two three", "en") for k in range(900)] + corpus(4)
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    assert mined(df, least=2, block_words=30) == plain(rows, 2, 2000)


def test_nulls_empty_and_long_texts_and_extra_columns(spark):
    rows = [(None, None, None, 1), (1, "", "en", 1), (1, " . ", "en", 1), (2, "word", "en", 1),
            (3, "a b " * 50_000, None, 1), (4, "A B", "und", 1)]
    df = spark.createDataFrame(rows, DOCS + ", `block.n` int")
    assert mined(df) == plain([r[:3] for r in rows], 10, 2000)
    assert mined(spark.createDataFrame([], DOCS)) == []
    assert mined(spark.createDataFrame(rows[:4], DOCS + ", w1 int")) == []


def test_words_and_pieces():
    assert split_words("A b\tÉ.c d\x0b".encode()) == [
        b"a", b"b", "É".encode(), b"\xff", "c d".encode(), b"\xff", b"\xff"]


@pytest.mark.parametrize("g", [1, 2, 7, 17, 21, 22, 30, 42])
def test_packing_and_permutation_come_back(g):
    draw = np.random.default_rng(g)
    words = [draw.integers(0, 1 << g, 500) for _ in range(3)]
    bits = half_bits(g)
    there = permute(pack(words, g), bits)
    assert all(int(h.max()) < 1 << bits for h in there)
    back = unpack(permute(there, bits, back=True), g)
    assert all((a == b).all() for a, b in zip(words, back))


@pytest.mark.parametrize("bits", [2, 9, 32, 33, 63])
@pytest.mark.parametrize("count", [0, 1, 5, 3000])
def test_filters_are_lossless(bits, count):
    draw = np.random.default_rng(count)
    halves = tuple(draw.integers(0, 1 << bits, count).astype(np.uint64) for _ in range(2))
    counts = draw.integers(1, 1 << draw.integers(1, 40), count) if count else np.zeros(0, np.int64)
    (high, low), total = merged(halves, counts, bits)
    want = Counter()
    for h, l, c in zip(*(x.tolist() for x in (*halves, counts))):
        want[h, l] += c
    assert list(zip(high.tolist(), low.tolist(), total.tolist())) == [
        (*k, v) for k, v in sorted(want.items())]
    (high2, low2), total2 = read_filter(write_filter((high, low), total, bits, bits))
    assert (high2 == high).all() and (low2 == low).all() and (total2 == total).all()
