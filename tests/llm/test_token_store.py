import random
import zlib

import numpy as np
import pytest
from caseloom.llm.token_store import (
    FIRST_SYMBOL, Encoder, compress, expand, expand_all, read_documents, read_ids, write_tokens,
)

P = pytest.importorskip("public_tokenizers")
VOCABULARY = P.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, part int, block int, ids string"


@pytest.mark.parametrize("kind", range(6))
def test_compression_is_exact(kind):
    draw = np.random.default_rng(kind)
    ids = [np.zeros(5000, np.uint32), draw.integers(0, 3, 9000), draw.integers(0, 49000, 3000),
           np.zeros(0, np.uint32), np.array([7]), np.tile([1, 2, 3, 1, 2], 2000)][kind]
    rules, lengths, symbols = compress(ids.astype(np.uint32), least=2)
    assert (expand(symbols, rules) == ids).all()
    assert (expand_all(symbols, rules, lengths) == ids).all()
    assert [len(expand(np.array([FIRST_SYMBOL + k], np.uint32), rules))
            for k in range(len(rules))] == lengths.tolist()
    if kind in (0, 1, 5):
        assert len(symbols) < len(ids) / 2


def test_words_give_the_ids_of_whole_texts():
    draw = random.Random(8)
    encoder = Encoder(VOCABULARY)
    parts = ["don't", "It'S", "abc", "über", "ñ", "42", "3", " ", "\n", "\t ", "!!", "'", "''s", "_",
             "²", " ", "\x1c", "<|endoftext|>", "日本", "é", "İ", "ß", "ǅ", "x" * 300, "¿"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(0, 30))) for _ in range(1500)] + [""]
    ids, counts = encoder.encode(texts)
    want = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want))
    assert ids.tolist() == [i for w in want for i in w]


def test_every_plain_character_gives_the_ids_of_whole_texts():
    encoder = Encoder(VOCABULARY)
    every = [chr(c) for c in range(0x2000) if encoder.plain.fullmatch(chr(c))]
    every += [chr(c) for c in range(0x80, 0x250)]
    texts = [t for c in every for t in (f"{c}li", f"THE m{c}n", f"3{c}", f"OM{c}{c} '{c}s {c}")]
    texts += ["Əli", "ƏSAS QANUN", "ƆMAN", "ƐNAM", "THE ƏND"]
    ids, counts = encoder.encode(texts)
    want = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    ends = np.cumsum(counts)
    assert [t for t, w, n, e in zip(texts, want, counts.tolist(), ends.tolist())
            if ids[e - n:e].tolist() != w] == []


def stored_blocks(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    return write_tokens(df.repartition(5), VOCABULARY, **options)


def test_documents_come_back_in_order(spark):
    draw = random.Random(9)
    rows = [(i * 3 - 50, " ".join(draw.choices(["the", "of", "Ünder", "it's", "9"],
                                               k=draw.randrange(60)))) for i in range(300)]
    rows += [(None, None), (7, "repeated"), (7, "repeated"), (8, "long words " * 30_000)]
    blocks = stored_blocks(spark, rows, block_ids=500)
    got = sorted(read_documents(blocks).collect(), key=lambda r: r.start)
    encoder, start = Encoder.at(VOCABULARY), 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(ordered)
    for r, (doc_id, text) in zip(got, ordered):
        ids = encoder.library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_any_part_of_a_block_can_be_read(spark):
    rows = [(i, "the cat and the dog and the cat " * (i % 9)) for i in range(200)]
    block = stored_blocks(spark, rows).first().asDict()
    whole = expand(np.frombuffer(block["symbols"], "<u4"),
                   np.frombuffer(block["rules"], "<u4").reshape(-1, 2))
    assert len(np.frombuffer(block["symbols"], "<u4")) < len(whole) / 2
    draw = random.Random(1)
    for _ in range(300):
        a = draw.randrange(len(whole))
        b = draw.randrange(a, len(whole) + 1)
        assert (read_ids(block, a, b) == whole[a:b]).all()


def test_empty_table(spark):
    assert read_documents(stored_blocks(spark, [])).collect() == []


def test_compression_goes_on_until_no_pair_is_frequent():
    draw = np.random.default_rng(3)
    passage = draw.integers(0, 49_000, 600)
    ids = np.concatenate([x for _ in range(200) for x in (passage, draw.integers(0, 49_000, 30))])
    rules, lengths, symbols = compress(ids.astype(np.uint32))
    pairs, number = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)
    overlapping = pairs[0] == pairs[1]  # places of one symbol in a row overlap
    assert number[~overlapping].max() < 64 and lengths.max() > 300
    assert (expand_all(symbols, rules, lengths) == ids).all()
