"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm.queries import rebuilt_conversations
from caseloom.llm.trie import common_turns, prefix_trie, sorted_rows, turn_sequences

ROWS = "conv_id long, turn long, role string, text string"


def plain_trie(conversations):
    """conv_id -> list of (role, text); nodes as tuples."""
    members = defaultdict(list)
    for name, turns in conversations:
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append((name, len(turns)))
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    below = {}
    for prefix in sorted(members, key=len, reverse=True):
        leaves = 0 if children[prefix] else 1
        saved = (len(members[prefix]) - 1) * (len(prefix[-1][1].encode()) if prefix else 0)
        for child in children[prefix]:
            leaves, saved = leaves + below[child][0], saved + below[child][1]
        below[prefix] = leaves, saved
    nodes = []
    for prefix, found in members.items():
        ends = sorted(n for n, size in found if size == len(prefix))
        nodes.append((
            min(n for n, _ in found), len(prefix),
            min(n for n, _ in members[prefix[:-1]]) if prefix else None, len(found),
            len(children[prefix]), *below[prefix],
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(nodes, key=repr)


def built(spark, conversations, **options):
    rows = [(name, k, role, text) for name, turns in conversations
            for k, (role, text) in enumerate(turns)]
    sequences = turn_sequences(spark.createDataFrame(rows, ROWS))
    empty = [(name,) for name, turns in conversations if not turns]
    if empty:
        none = sequences.select(F.slice("turns", 1, 0).alias("turns")).limit(1)
        sequences = sequences.unionByName(
            spark.createDataFrame(empty, "conv_id long").crossJoin(none))
    found = prefix_trie(sequences, **options).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def talks(seed, count, most=6, words=3):
    draw = random.Random(seed)
    return [(draw.randrange(-50, 5) * 1000 + k,
             [(draw.choice(["user", "assistant"]), draw.choice("aé漢")[:1] * draw.randrange(words))
              for _ in range(draw.randrange(most))]) for k in range(count)]


@pytest.mark.parametrize("shards", [1, 2, 7, 60])
def test_equals_a_plain_trie_however_it_is_cut(spark, shards):
    conversations = talks(shards, 60)
    assert built(spark, conversations, shards=shards) == plain_trie(conversations)


def test_one_conversation_many_times_over_many_shards(spark):
    common = [("user", "hello"), ("assistant", "x" * 1000), ("user", "ok")]
    conversations = [(k, common) for k in range(40)] + [(100 + k, common + [("user", str(k))])
                                                        for k in range(5)] + [(200, common[:1])]
    assert built(spark, conversations, shards=9) == plain_trie(conversations)


def test_longer_than_a_matrix_is_wide(spark):
    draw = random.Random(3)
    trunk = [("user", str(k)) for k in range(150)]
    conversations = [(k, trunk[:draw.randrange(20, 150)] + [("assistant", str(draw.randrange(2)))] * (k % 3))
                     for k in range(25)] + [(99, trunk * 8)]
    assert built(spark, conversations, shards=4) == plain_trie(conversations)


def test_nulls_ties_and_extra_columns(spark):
    rows = spark.createDataFrame([
        (1, None, None, None, "x"), (1, 2, "user", "b", "x"), (1, 2, "user", "a", "x"),
        (2, 0, "", "", "y"), (2, 1, "user", "a", None), (2, 3, "user", "b", None),
        (None, 0, "user", "lost", None),
    ], ROWS + ", `turns.id` string")
    found = prefix_trie(turn_sequences(rows), shards=3)
    assert sorted(tuple(r) for r in found.select("conv_id", "depth", "n_convs").collect()) == [
        (1, 0, 2), (1, 1, 2), (1, 2, 2), (1, 3, 2)]


def test_empty_table(spark):
    assert prefix_trie(turn_sequences(spark.createDataFrame([], ROWS))).collect() == []


def test_rebuilt_on_another_beginning(spark):
    import zlib

    draw = random.Random(5)
    own = {c: [("user", f"{c}-{k}") for k in range(draw.randrange(1, 12))]
           for c in [*range(-7, 40), 1001] if c % 7}
    rows = [(c, k, *t) for c, turns in own.items() for k, t in enumerate(turns)]
    expected = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        expected[c] = own.get(base, [])[:h] + turns[h:]
    made = prefix_trie(rebuilt_conversations(turn_sequences(spark.createDataFrame(rows, ROWS))),
                       shards=5)
    found = sorted((tuple(r) for r in made.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=repr)
    assert found == plain_trie(list(expected.items()))


def test_order_and_common_turns():
    draw = np.random.default_rng(1)
    lengths = draw.integers(0, 120, 80)
    ids = np.append(draw.integers(1, 3, lengths.sum()), 0)
    ids[:len(ids) // 2] = 1  # long common beginnings
    starts = np.cumsum(lengths) - lengths
    order = sorted_rows(ids, starts, lengths, np.arange(80))
    rows = [tuple(ids[s:s + n].tolist()) for s, n in zip(starts, lengths)]
    assert [rows[k] for k in order] == sorted(rows)
    common = common_turns(ids, starts[order], lengths[order]).tolist()
    for k in range(1, 80):
        a, b = rows[order[k - 1]], rows[order[k]]
        assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
