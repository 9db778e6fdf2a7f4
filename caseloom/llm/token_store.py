"""Token ids in Re-Pair compressed blocks.

Documents are sorted by identifier in ranges, encoded, and gathered into blocks of about
``BLOCK_IDS`` ids, each a row of a Parquet table. A block is compressed by Re-Pair: pairs of
neighbouring symbols that are frequent are replaced by a new symbol, again and again, until no pair is
there ``LEAST_COUNT`` times. Stored are the
rules (left and right symbol of each new one), the expansion length of each new symbol, the
remaining symbols, and the number of ids before every ``SYNC``-th symbol. ``read_ids`` finds a place
by these numbers and expands no more symbols than it needs.

Each round replaces all pairs that are within a factor of the most frequent one. Candidates are
counted in a table of hashed pairs first, then exactly; overlapping places go to the left one.

Encoding splits plain Latin text into the words that the vocabulary's own pattern finds and asks the
library's model once per word, in the characters that stand for the bytes of a word; texts with other characters, with capitals whose small letter is another
character (such as U+018F), or with the strings of special tokens, go to the library whole.

Defined results: a null text is empty and has the end id only; a null identifier sorts first; rows
of one identifier sort by text; repeated rows are documents of their own; an empty table makes no
blocks. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.llm.tables import stored

END_ID = 1
#: Ids of a block; a block ends with the document that fills it.
BLOCK_IDS = 1 << 20
SYNC = 256
#: New symbols start here; ids must be smaller.
FIRST_SYMBOL = 1 << 20
#: A pair must be there so often to be replaced.
LEAST_COUNT = 64
#: Pairs of a round are at most this factor rarer than its most frequent pair.
_SPAN = 256
_BUCKET_BITS = 17
#: Words whose ids a worker keeps.
_CACHED_WORDS = 1_000_000

_BLOCKS = ("part int, block int, doc_ids binary, no_id binary, ends binary, rules binary, "
           "lengths binary, symbols binary, syncs binary, n_ids long")
_BLOCK_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 7, pa.int64()]
_DOCS = "part int, block int, doc_id long, before long, n_tokens long, ids_crc32 long"
_DOC_TYPES = [pa.int32(), pa.int32(), *[pa.int64()] * 4]


# Re-Pair ---------------------------------------------------------------------------------------

def _frequent_pairs(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose pair is frequent, and the pair's number in order of its value."""
    hashed = symbols[:-1] * np.uint32(0x9E3779B1)
    hashed += symbols[1:]
    hashed *= np.uint32(0x85EBCA77)
    hashed >>= np.uint32(32 - _BUCKET_BITS)
    counts = np.bincount(hashed, minlength=1 << _BUCKET_BITS)
    least = max(least, int(counts.max()) // _SPAN)
    places = np.flatnonzero((counts >= least).take(hashed))
    keys = (symbols[places].astype(np.uint64) << np.uint64(32)) | symbols[places + 1]
    pairs, number, exact = np.unique(keys, return_inverse=True, return_counts=True)
    good = exact >= least
    keep = good[number]
    return places[keep], pairs[number[keep]]


def compress(ids: np.ndarray, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (n, 2), expansion lengths (n) and remaining symbols."""
    symbols = ids.astype(np.uint32)
    rules, lengths = [], np.zeros(0, np.uint32)
    while len(symbols) > 1:
        places, pairs = _frequent_pairs(symbols, least)
        if not len(places):
            break
        # In a stretch of neighbouring places every second one is taken.
        fresh = np.ones(len(places), bool)
        fresh[1:] = places[1:] != places[:-1] + 1
        order = np.arange(len(places))
        taken = (order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0
        places, pairs = places[taken], pairs[taken]
        new, number = np.unique(pairs, return_inverse=True)
        rule = np.stack([new >> np.uint64(32), new & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        base = FIRST_SYMBOL + sum(map(len, rules))
        lengths = np.concatenate([lengths, _lengths_of(rule.ravel(), lengths).reshape(-1, 2).sum(1)
                                  .astype(np.uint32)])
        rules.append(rule)
        symbols = symbols.copy()
        symbols[places] = base + number.astype(np.uint32)
        symbols = np.delete(symbols, places + 1)
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)), lengths, symbols


def _lengths_of(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ids that each symbol stands for."""
    out = np.ones(len(symbols), np.int64)
    new = symbols >= FIRST_SYMBOL
    out[new] = lengths[symbols[new] - FIRST_SYMBOL]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """The ids that the symbols stand for."""
    while (new := symbols >= FIRST_SYMBOL).any():
        ends = np.cumsum(np.where(new, 2, 1))
        out = np.empty(ends[-1], np.uint32)
        pair = rules[symbols[new] - FIRST_SYMBOL]
        out[ends[~new] - 1] = symbols[~new]
        out[ends[new] - 2] = pair[:, 0]
        out[ends[new] - 1] = pair[:, 1]
        symbols = out
    return symbols


def expand_all(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """As ``expand``, for many symbols: each new symbol is expanded once and its ids copied."""
    known = expand(np.arange(FIRST_SYMBOL, FIRST_SYMBOL + len(rules), dtype=np.uint32), rules)
    before = np.cumsum(lengths, dtype=np.int64) - lengths
    new = symbols >= FIRST_SYMBOL
    source = np.concatenate([known, symbols[~new]])
    start = np.empty(len(symbols), np.int64)
    start[new] = before[symbols[new] - FIRST_SYMBOL]
    start[~new] = len(known) + np.arange(len(symbols) - int(new.sum()))
    return _taken(source, start, _lengths_of(symbols, lengths))


def _array(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, kind)


def read_ids(block: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, without expanding the rest."""
    symbols, syncs = _array(block["symbols"], "<u4"), _array(block["syncs"], "<u8")
    first = max(0, int(np.searchsorted(syncs, start, side="right")) - 1)
    last = int(np.searchsorted(syncs, stop, side="left"))
    near = symbols[first * SYNC:last * SYNC]
    sizes = _lengths_of(near, _array(block["lengths"], "<u4"))
    ends = np.cumsum(sizes) + (int(syncs[first]) if len(syncs) else 0)
    a = int(np.searchsorted(ends, start, side="right"))
    b = int(np.searchsorted(ends, stop, side="left")) + 1
    ids = expand(near[a:b], _array(block["rules"], "<u4").reshape(-1, 2))
    skip = start - int(ends[a] - sizes[a]) if a < len(ends) else 0
    return ids[skip:skip + stop - start]


# Encoding --------------------------------------------------------------------------------------

def _latin(kind: str) -> str:
    """Characters of a class below U+0250, lower-case ASCII letters as a range."""
    found = [chr(c) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind]
    rest = "".join(re.escape(c) for c in found if not "a" <= c <= "z")
    return ("a-z" if "a" in found else "") + rest


def _plain() -> str:
    """White space, ASCII and Latin letters, without those that lower to something beyond U+024F."""
    codes = chain(range(0x9, 0xe), range(0x20, 0x7f), range(0xa1, 0x250))
    return "".join(re.escape(chr(c)) for c in codes if max(chr(c).lower()) < "\u0250")


def _byte_characters() -> dict[int, str]:
    """Translation of bytes, as Latin-1 characters, to the characters that byte-level vocabularies
    write for them: printable ones for themselves, the others from U+0100 on."""
    printable = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(0x100 + k) for k, b in enumerate(others)}


class _Words(dict):
    """Word -> its number; unknown words get the next ones and are noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


def _taken(source: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``source`` one after another."""
    ends = np.cumsum(sizes)
    return source[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Ids of whole texts by the tokenizers library, whose answers are kept.

    The fast way is for texts of plain Latin characters only, where the vocabulary's pattern for
    words means the same here as in the library.
    """

    _shared: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        letters, digits = _latin("L"), _latin("N")
        self.pattern = re.compile(
            rf"[{letters}]+|'(?:[stmd]|re|ve|ll)|[{digits}]|[^ \t-\r{letters}{digits}]+")
        self.plain = re.compile(f"[{_plain()}]*")
        self.characters = _byte_characters()
        self._reset()

    @classmethod
    def at(cls, path: str) -> Encoder:
        """One encoder per worker process."""
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def _reset(self) -> None:
        self.words = _Words()
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self) -> None:
        split, shown = self.library.model.tokenize, self.characters
        found = [[t.id for t in split(
            w if w.isascii() else w.encode().decode("latin-1").translate(shown))]
            for w in self.words.new]
        self.words.new = []
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each text's."""
        fast = [self.plain.fullmatch(t) is not None and "<|" not in t for t in texts]
        parts = [self.pattern.findall(t.lower()) for t, f in zip(texts, fast) if f]
        slow = [e.ids for e in self.library.encode_batch(
            [t for t, f in zip(texts, fast) if not f], add_special_tokens=False)]
        if len(self.words) > _CACHED_WORDS:
            self._reset()
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        index = np.fromiter(map(self.words.__getitem__, chain.from_iterable(parts)), np.int64,
                            int(counts.sum()))
        if self.words.new:
            self._learn()
        first, sizes = self.starts[index], self.starts[index + 1] - self.starts[index]
        flat, ends = _taken(self.ids, first, sizes), np.cumsum(sizes)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        if not slow:
            return flat, np.diff(bounds)
        pieces, at, late = [], 0, iter(slow)
        for f in fast:
            pieces.append(flat[bounds[at]:bounds[at + 1]] if f else np.array(next(late), np.uint32))
            at += f
        return np.concatenate(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))


# The table -------------------------------------------------------------------------------------

def _block(part: int, number: int, held: list[tuple]) -> pa.RecordBatch:
    """One row from (doc_ids, counts, ids) of several batches."""
    doc_ids = [d for ds, _, _ in held for d in ds]
    ends = np.cumsum(np.concatenate([c for _, c, _ in held]))
    ids = np.concatenate([i for _, _, i in held])
    rules, lengths, symbols = compress(ids)
    sizes = np.cumsum(_lengths_of(symbols, lengths))
    syncs = np.concatenate([[0], sizes])[:-1][::SYNC] if len(symbols) else np.zeros(0)
    row = [part, number,
           np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
           np.array([d is None for d in doc_ids], "u1").tobytes(),
           ends.astype("<u8").tobytes(), rules.astype("<u4").tobytes(),
           lengths.astype("<u4").tobytes(), symbols.astype("<u4").tobytes(),
           syncs.astype("<u8").tobytes(), len(ids)]
    return _rows([row], _BLOCKS, _BLOCK_TYPES)


def _rows(rows: list, schema: str, types: list) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def write_tokens(docs: DataFrame, vocabulary: str, identifier: str = "doc_id",
                 text: str = "text", block_ids: int = BLOCK_IDS) -> DataFrame:
    """The stored table of blocks. ``vocabulary`` is a tokenizer file that every executor has."""
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.at(vocabulary), TaskContext.get().partitionId()
        held, gathered, number = [], 0, 0
        for batch in batches:
            ids, counts = encoder.encode(batch["text"].to_pylist())
            doc_ids, at = batch["doc_id"].to_pylist(), 0
            ids = np.insert(ids, np.cumsum(counts), END_ID)
            counts = counts + 1
            ends = np.cumsum(counts)
            while at < len(doc_ids):
                begin = int(ends[at] - counts[at])
                stop = min(len(doc_ids),
                           at + 1 + int(np.searchsorted(ends[at:], begin + block_ids - gathered)))
                stop = max(stop, at + 1)
                held.append((doc_ids[at:stop], counts[at:stop], ids[begin:ends[stop - 1]]))
                gathered += int(ends[stop - 1]) - begin
                at = stop
                if gathered >= block_ids:
                    yield _block(part, number, held)
                    held, gathered, number = [], 0, number + 1
        if held:
            yield _block(part, number, held)

    ordered = docs.select(
        F.col(identifier).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(encoded, _BLOCKS), "token-blocks")


def read_documents(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the blocks alone."""
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids = expand_all(_array(block["symbols"], "<u4"),
                                 _array(block["rules"], "<u4").reshape(-1, 2),
                                 _array(block["lengths"], "<u4")).astype("<u4")
                ends = _array(block["ends"], "<u8").tolist()
                rows, begin, data = [], 0, memoryview(ids.tobytes())
                for doc_id, missing, end in zip(_array(block["doc_ids"], "<i8").tolist(),
                                                block["no_id"], ends):
                    rows.append((block["part"], block["block"], None if missing else doc_id, begin,
                                 end - begin, zlib.crc32(data[4 * begin:4 * end])))
                    begin = end
                yield _rows(rows, _DOCS, _DOC_TYPES)

    # Blocks before one: those of earlier parts, then earlier ones of its part.
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before_part = parts.select("part", F.coalesce(F.sum("n").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("of_parts"))
    before_block = sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(
        W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0)).alias("of_blocks"))
    return (
        blocks.mapInArrow(decoded, _DOCS)
        .join(before_block, ["part", "block"]).join(before_part, "part")
        .select("doc_id", (F.col("of_parts") + F.col("of_blocks") + F.col("before")).alias("start"),
                "n_tokens", "ids_crc32")
    )
