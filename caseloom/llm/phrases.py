"""Phrase collocations from counting quotient filters of word n-grams.

Texts are lower-cased (A-Z only) and cut into pieces at ``. , ; : ! ?`` and U+000A to U+000D, pieces into
words at blanks and tabs. A block is about a million words, kept as the sequence of their numbers in the
block's own vocabulary. The vocabularies of all blocks meet sorted by language and word: words with
``least`` occurrences or more get numbers of the whole corpus, as no others can be part of a candidate.

In these numbers a block's n-grams of two and three words are packed into 3 g bits (g bits a word, the
third 0 in pairs) and permuted by a Feistel network over the two halves, which can be inverted. A
*filter* holds them sorted, with their counts: the leading bits of a permuted n-gram are its quotient, of
which a bit says that it is there, and a bit per entry says where a quotient's run ends; the other
bits, the full remainder, are stored, with a counter of one byte that an exact list extends. Nothing is
lost: an entry gives its n-gram back. Each block's filter is cut by leading bits into the slices of the
shards; a shard merges the sorted slices into one filter and gives its n-grams with ``least``
occurrences.

Candidates are scored with exact decimals: ``floor(1000000 a a / (l r))`` of the cut that scores lowest,
ties to the earlier cut. A candidate goes if its words stand in a longer candidate with at least half
its occurrences. The rows are the first ``top`` of every language.

Defined results: a null text is empty, a null language ``und``; repeated rows count as often as they
are there; ties end with the phrase in byte order; texts without words and empty tables give no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.llm.tables import settings, small_batches, stored
from caseloom.operators.joins import lookup_join

UNKNOWN = "und"
LEAST = 10
TOP = 2000
#: Words of a block; a block ends with the text that fills it.
BLOCK_WORDS = 1 << 20
#: Entries, before merging, that a shard holds on average at most.
SHARD_ENTRIES = 2_000_000
#: Entries that are packed or taken apart in one go.
_TOGETHER = 1 << 18
#: In UTF-8 no byte of a text; stands between pieces.
_CUT = b"\xff"
_CUTS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(_CUT[0] if c in _CUTS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_ROUND_KEYS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F,
                                      0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
#: Rows with ``local`` are words (language, _CUT, word), others with a key are languages.
_BLOCKS = "block long, local int, key binary, n long, numbers binary"
_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("local", pa.int32()), ("key", pa.binary()),
                           ("n", pa.int64()), ("numbers", pa.binary())])
_WORDS = "block long, local int, id long, lang string, word string, f long"
_WORD_SCHEMA = pa.schema([("block", pa.int64()), ("local", pa.int32()), ("id", pa.int64()),
                          ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])
_SLICE_SCHEMA = pa.schema([("shard", pa.int32()), ("grams", pa.binary())])
_GRAM_SCHEMA = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("w3", pa.int64()), ("a", pa.int64())])

# Packed n-grams: two halves of h bits, h = ceil(3 g / 2) -------------------------------------------

Halves = tuple[np.ndarray, np.ndarray]


def half_bits(g: int) -> int:
    return (3 * g + 1) // 2


def pack(words: list[np.ndarray], g: int) -> Halves:
    """High and low half of three word numbers of g bits, 42 at most."""
    a, b, c = (w.astype(np.uint64) for w in words)
    over = half_bits(g) - g  # bits of the middle word in the low half
    low = c | ((b & np.uint64((1 << over) - 1)) << np.uint64(g))
    return (b >> np.uint64(over)) | (a << np.uint64(g - over)), low


def unpack(halves: Halves, g: int) -> list[np.ndarray]:
    high, low = halves
    over = half_bits(g) - g
    b = (low >> np.uint64(g)) | ((high & np.uint64((1 << (g - over)) - 1)) << np.uint64(over))
    return [(high >> np.uint64(g - over)).astype(np.int64), b.astype(np.int64),
            (low & np.uint64((1 << g) - 1)).astype(np.int64)]


def _mixed(half: np.ndarray, key: np.uint64, bits: int) -> np.ndarray:
    made = (half + key) * _ROUND_KEYS[0]
    made = (made ^ (made >> np.uint64(31))) * _ROUND_KEYS[1]
    return (made >> np.uint64(64 - bits))


def permute(halves: Halves, bits: int, back: bool = False) -> Halves:
    """Feistel network over halves of ``bits`` bits, or its inverse."""
    high, low = halves
    for turn in range(len(_ROUND_KEYS))[::-1 if back else 1]:
        if turn % 2:
            low = low ^ _mixed(high, _ROUND_KEYS[turn], bits)
        else:
            high = high ^ _mixed(low, _ROUND_KEYS[turn], bits)
    return high, low


def packed_permuted(words: list[np.ndarray], g: int) -> Halves:
    """Permuted n-grams, made in parts to hold few copies."""
    high, low = (np.empty(len(words[0]), np.uint64) for _ in range(2))
    for at in range(0, len(high), _TOGETHER):
        part = slice(at, at + _TOGETHER)
        high[part], low[part] = permute(pack([w[part] for w in words], g), half_bits(g))
    return high, low


def merged(halves: Halves, counts: np.ndarray, bits: int) -> tuple[Halves, np.ndarray]:
    """Sorted, with equal entries added up. Counts may be None for 1 each."""
    high, low = halves
    if 2 * bits <= 64:
        key = high << np.uint64(bits)
        key |= low
        del high, low, halves
        if counts is None:
            key.sort()
            order = None
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        key = key[at]
        high, low = key >> np.uint64(bits), key & np.uint64((1 << bits) - 1)
    else:
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(high), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        at = np.flatnonzero(new)
        high, low = high[at], low[at]
    if counts is None:
        total = np.diff(np.append(at, len(new)))
    else:
        total = np.add.reduceat(counts[order], at) if len(at) else counts[:0]
    return (high, low), total


# Filters ---------------------------------------------------------------------------------------

def _narrow(values: np.ndarray, bits: int) -> bytes:
    """The lowest bytes that hold ``bits`` bits of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :-(-bits // 8)].tobytes()


def _widen(data: memoryview, count: int, bits: int) -> np.ndarray:
    wide = np.zeros((count, 8), np.uint8)
    size = -(-bits // 8)
    if not count * size:
        return wide.view("<u8").ravel().astype(np.uint64)
    wide[:, :size] = np.frombuffer(data, np.uint8, count * size).reshape(count, size)
    return wide.view("<u8").ravel().astype(np.uint64)


def _remainder_widths(rest: int, low_bits: int) -> list[int]:
    """Bits of the numbers that a remainder is stored as: one if it fits in 64 bits, else two."""
    return [rest + low_bits] if rest + low_bits <= 64 else [rest, low_bits]


def write_filter(halves: Halves, counts: np.ndarray, high_bits: int, low_bits: int) -> bytes:
    """A filter of sorted entries, the high half of which has ``high_bits`` bits."""
    high, low = halves
    count = len(high)
    q = min(high_bits, max(0, count.bit_length() - 1))
    rest = high_bits - q
    quotients = (high >> np.uint64(rest)).astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotients] = True
    run_end = np.ones(count, bool)
    run_end[:-1] = quotients[1:] != quotients[:-1]
    large = np.flatnonzero(counts > 254)
    small = np.where(counts > 254, 255, counts).astype(np.uint8)
    remainders = [high & np.uint64((1 << rest) - 1), low]
    widths = _remainder_widths(rest, low_bits)
    if len(widths) == 1:
        remainders = [(remainders[0] << np.uint64(low_bits)) | low]
    return b"".join([
        np.array([count, q, high_bits, low_bits, len(large)], "<u8").tobytes(),
        np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(),
        *[_narrow(r, bits) for r, bits in zip(remainders, widths)], small.tobytes(),
        counts[large].astype("<u8").tobytes(),
    ])


def read_filter(data: bytes) -> tuple[Halves, np.ndarray]:
    """The entries of a filter, in order."""
    view, at = memoryview(data), 40
    count, q, high_bits, low_bits, large = np.frombuffer(view, "<u8", 5).tolist()
    rest = high_bits - q

    def take(size: int) -> memoryview:
        nonlocal at
        at += size
        return view[at - size:at]

    occupied = np.unpackbits(np.frombuffer(take(-(-(1 << q) // 8)), np.uint8), count=1 << q)
    run_end = np.unpackbits(np.frombuffer(take(-(-count // 8)), np.uint8), count=count)
    run = np.cumsum(run_end) - run_end
    quotients = np.flatnonzero(occupied)[run].astype(np.uint64)
    widths = _remainder_widths(rest, low_bits)
    remainders = [_widen(take(count * -(-bits // 8)), count, bits) for bits in widths]
    if len(widths) == 1:
        both = remainders[0]
        remainders = [both >> np.uint64(low_bits), both & np.uint64((1 << low_bits) - 1)]
    high, low = remainders[0] | (quotients << np.uint64(rest)), remainders[1]
    counts = np.frombuffer(bytes(take(count)), np.uint8).astype(np.int64)
    if large:
        counts[counts == 255] = np.frombuffer(take(8 * large), "<u8")
    return (high, low), counts


# Blocks ----------------------------------------------------------------------------------------

class _Vocabulary:
    """Numbers of the words of a block, from 1 on; 0 stands between pieces."""

    class _Words(dict):
        def __init__(self, known: list[bytes], lang: str):
            super().__init__({_CUT: 0})
            self.known, self.prefix = known, lang.encode() + _CUT

        def __missing__(self, word: bytes) -> int:
            self.known.append(self.prefix + word)
            self[word] = number = len(self.known)
            return number

    def __init__(self):
        self.known: list[bytes] = []
        self.by_lang: dict[str, _Vocabulary._Words] = {}

    def of(self, lang: str) -> _Vocabulary._Words:
        if lang not in self.by_lang:
            self.by_lang[lang] = self._Words(self.known, lang)
        return self.by_lang[lang]


def split_words(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8, with ``_CUT`` between pieces and at the end."""
    return (text.translate(_TABLE).replace(_CUT, b" " + _CUT + b" ") + b" " + _CUT).split()


def write_numbers(numbers: np.ndarray, largest: int) -> bytes:
    """Numbers in as many bytes each as the largest needs, which the first byte tells."""
    width = max(1, -(-largest.bit_length() // 8))
    return bytes([width]) + _narrow(numbers, 8 * width)


def read_numbers(data: bytes) -> np.ndarray:
    return _widen(memoryview(data)[1:], (len(data) - 1) // data[0], 8 * data[0]).astype(np.int64)


def _block(block: int, numbers: np.ndarray, vocabulary: _Vocabulary) -> Iterator[pa.RecordBatch]:
    known = vocabulary.known
    found = np.bincount(numbers, minlength=len(known) + 1)[1:]
    size = len(known)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(size, block)), pa.array(np.arange(1, size + 1, dtype=np.int32)),
        pa.array(known, pa.binary()), pa.array(found), pa.nulls(size, pa.binary())],
        schema=_BLOCK_SCHEMA)
    langs = list(vocabulary.by_lang)
    of_lang = [int(found[np.fromiter(words.values(), np.int64, len(words))[1:] - 1].sum())
               for words in vocabulary.by_lang.values()]
    rows = len(langs) + 1
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(rows, block)), pa.nulls(rows, pa.int32()),
        pa.array([*[x.encode() for x in langs], None], pa.binary()), pa.array([*of_lang, None], pa.int64()),
        pa.array([None] * len(langs) + [write_numbers(numbers, size)], pa.binary())],
        schema=_BLOCK_SCHEMA)


def _number_blocks(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    vocabulary, held, size = _Vocabulary(), [], 0
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        for lang, text in zip(batch["lang"].to_pylist(), texts):
            words = split_words(text)
            held.append(np.fromiter(map(vocabulary.of(lang).__getitem__, words), np.int64, len(words)))
            size += len(words)
            if size >= block_words:
                yield from _block(block, np.concatenate(held), vocabulary)
                vocabulary, held, size, block = _Vocabulary(), [], 0, block + 1
    if vocabulary.known:
        yield from _block(block, np.concatenate(held), vocabulary)


def _number_words(batches: Iterator[pa.RecordBatch], least: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Numbers of the words that are there often enough, which come sorted: a row with each word, and
    one for each block that has it. Numbers of different tasks differ by their remainder."""
    part, place = TaskContext.get().partitionId(), 0
    held: pa.Table | None = None

    def numbered(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal place
        keys = rows["key"].combine_chunks().dictionary_encode()
        run = keys.indices.to_numpy()  # equal keys are neighbours
        at = np.flatnonzero(np.diff(run, prepend=-1))
        total = np.add.reduceat(rows["n"].to_numpy(), at)
        often = total >= least
        ids = np.zeros(len(at), np.int64)
        ids[often] = (place + np.arange(often.sum())) * parts + part + 1
        place += int(often.sum())
        words = [k.split(_CUT) for k in keys.dictionary.filter(pa.array(often)).to_pylist()]
        none = lambda kind: pa.nulls(len(words), kind)
        yield pa.RecordBatch.from_arrays([
            none(pa.int64()), none(pa.int32()), pa.array(ids[often]),
            pa.array([lang for lang, _ in words], pa.binary()).cast(pa.string()),
            pa.array([word for _, word in words], pa.binary()).cast(pa.string()),
            pa.array(total[often])], schema=_WORD_SCHEMA)
        of_row = ids[run]
        keep = pa.array(of_row > 0)
        count = int((of_row > 0).sum())
        yield pa.RecordBatch.from_arrays([
            rows["block"].filter(keep).combine_chunks(), rows["local"].filter(keep).combine_chunks(),
            pa.array(of_row[of_row > 0]), *[pa.nulls(count, f.type) for f in list(_WORD_SCHEMA)[3:]]],
            schema=_WORD_SCHEMA)

    for batch in batches:
        new = pa.Table.from_batches([batch])
        if not new.num_rows:
            continue
        held = new if held is None else pa.concat_tables([held, new])
        last = pc.equal(batch["key"], batch["key"][-1])
        complete = held.num_rows - int(pc.sum(last).as_py())
        if complete > 0 and held["key"][complete - 1] != held["key"][-1]:
            yield from numbered(held.slice(0, complete))
            held = held.slice(complete)
    if held is not None:
        yield from numbered(held)


# Shards ----------------------------------------------------------------------------------------

def _gram_places(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where n-grams of two and three words begin."""
    word = numbers > 0
    two = word[:-1] & word[1:]
    return np.flatnonzero(two), np.flatnonzero(two[:-1] & word[2:])


def _count_block(words: pa.Table, sequence: pa.Table, g: int, shard_bits: int) -> pa.Table:
    """Slices of the filter of one block's n-grams; what has a rare word in it goes."""
    if not words.num_rows or not sequence.num_rows:
        return _SLICE_SCHEMA.empty_table()
    numbers = read_numbers(sequence["numbers"][0].as_py())
    ids = np.zeros(int(numbers.max(initial=0)) + 1, np.int64)
    ids[words["local"].to_numpy()] = words["id"].to_numpy()
    numbers = ids[numbers]
    two, three = _gram_places(numbers)
    at = np.concatenate([two, three])
    third = np.concatenate([np.zeros(len(two), np.int64), numbers[three + 2]])
    bits = half_bits(g)
    halves, counts = merged(packed_permuted([numbers[at], numbers[at + 1], third], g), None, bits)
    del at, two, three, third
    rest = bits - shard_bits
    shards = (halves[0] >> np.uint64(rest)).astype(np.int64)
    high = halves[0] & np.uint64((1 << rest) - 1)
    at = np.flatnonzero(np.diff(shards, prepend=-1))
    ends = np.append(at[1:], len(shards))
    slices = [write_filter((high[a:b], halves[1][a:b]), counts[a:b], rest, bits)
              for a, b in zip(at.tolist(), ends.tolist())]
    return pa.table([pa.array(shards[at], pa.int32()), pa.array(slices, pa.binary())],
                    schema=_SLICE_SCHEMA)


def _merge_shard(slices: pa.Table, g: int, shard_bits: int, least: int) -> pa.Table:
    """n-grams of one shard that are there often enough."""
    bits = half_bits(g)
    held: list[tuple[Halves, np.ndarray]] = []
    size = 0

    def together() -> tuple[Halves, np.ndarray]:
        return merged(tuple(np.concatenate([h[k] for h, _ in held]) for k in (0, 1)),
                      np.concatenate([c for _, c in held]), bits)

    for data in slices["grams"]:
        held.append(read_filter(data.as_py()))
        size += len(held[-1][1])
        if size > SHARD_ENTRIES:
            held = [together()]
            size = len(held[0][1]) // 2  # wait until as much again has come
    (high, low), counts = together()
    often = counts >= least
    shard = np.uint64(slices["shard"][0].as_py())
    high = high[often] | (shard << np.uint64(bits - shard_bits))
    words = unpack(permute((high, low[often]), bits, back=True), g)
    return pa.table([*map(pa.array, words), pa.array(counts[often])], schema=_GRAM_SCHEMA)


# The operator ----------------------------------------------------------------------------------

def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact below 10^15 occurrences."""
    exact = [c.cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", exact[0] * exact[0] * F.lit(1_000_000).cast("decimal(7,0)"),
                           exact[1] * exact[2]).cast("long")


def count_ngrams(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                 block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words of ``least`` occurrences or more (lang, word, f, id), n-grams of such words with ``least``
    or more (w1, w2, w3, a; w3 is 0 in pairs), and all word occurrences per language (lang, n)."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    with settings(spark, {"spark.sql.parquet.compression.codec": "zstd"}):
        blocks = stored(texts.mapInArrow(lambda b: _number_blocks(b, block_words), _BLOCKS),
                        "phrase-blocks")
    languages = blocks.filter("local is null and key is not null")
    totals = stored(languages.groupBy(F.col("key").cast("string").alias("lang"))
                    .agg(F.sum("n").alias("n")), "phrase-totals")
    occurrences = totals.agg(F.sum("n")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "100000",
                          "spark.sql.parquet.compression.codec": "zstd"}):
        words = stored(
            blocks.filter("local is not null").select("block", "local", "key", "n")
            .repartition(parts, "key").sortWithinPartitions("key")
            .mapInArrow(lambda b: _number_words(b, least, parts), _WORDS), "phrase-words")
        dictionary = words.filter("word is not null").select("lang", "word", "f", "id")
        g = max(1, (dictionary.agg(F.max("id")).first()[0] or 0).bit_length())
        shards = max(parts, -(-2 * occurrences // SHARD_ENTRIES))
        shard_bits = min(half_bits(g), (shards - 1).bit_length())
        sequences = blocks.filter("numbers is not null").select(F.col("block").alias("of_block"), "numbers")
        slices = words.filter("word is null").select("block", "local", "id").groupBy("block").cogroup(
            sequences.groupBy("of_block")
        ).applyInArrow(lambda w, b: _count_block(w, b, g, shard_bits), "shard int, grams binary")
        ngrams = stored(slices.groupBy("shard").applyInArrow(
            lambda s: _merge_shard(s, g, shard_bits, least),
            "w1 long, w2 long, w3 long, a long"), "phrase-counts")
    return dictionary, ngrams, totals


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                 top: int = TOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of every language."""
    dictionary, ngrams, totals = count_ngrams(docs, text, lang, least, block_words)

    def known(number: str) -> DataFrame:
        return dictionary.select(F.col("id").alias(f"w{number}"), F.col("f").alias(f"f{number}"),
                                 F.col("word").alias(f"word{number}"), F.col("lang").alias(f"lang{number}"))

    pairs = ngrams.filter("w3 = 0").select("w1", "w2", "a")
    pairs = stored(lookup_join(lookup_join(pairs, known("1"), "w1"), known("2"), "w2"), "phrase-pairs")
    left = pairs.select("w1", "w2", F.col("a").alias("a12"), "f1", "word1", "word2", "lang1")
    right = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("a23"),
                         F.col("f2").alias("f3"), F.col("word2").alias("word3"))
    triples = stored(ngrams.filter("w3 > 0").join(left, ["w1", "w2"]).join(right, ["w2", "w3"]),
                     "phrase-triples")
    inside = triples.select("w1", "w2", "a").unionByName(
        triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    ).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    a = F.col("a")
    kept = pairs.join(inside, ["w1", "w2"], "left").filter(
        F.coalesce(2 * F.col("longer") < a, F.lit(True)))
    cut = lambda l, r: F.struct(_score(a, F.col(l), F.col(r)).alias("score"),
                                F.col(l).alias("l"), F.col(r).alias("r"))
    first, second = cut("f1", "a23"), cut("a12", "f3")
    scored = kept.select(
        F.col("lang1").alias("lang"), F.concat_ws(" ", "word1", "word2").alias("phrase"), "a",
        cut("f1", "f2").alias("cut")
    ).unionByName(triples.select(
        F.col("lang1").alias("lang"), F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a",
        F.when(second["score"] < first["score"], second).otherwise(first).alias("cut"),
    )).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # First within slices of a language, so that no task orders all phrases of a large one.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(256))
    best = scored.withColumn("slice", salt).withColumn("rank", F.row_number().over(
        W.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top).drop("slice")
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))) \
        .filter(F.col("rank") <= top)
    return lookup_join(stored(ranked, "phrases"), totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
