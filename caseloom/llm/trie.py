"""Prefix trie of conversations from padded turn-id matrices.

A turn is known by a 128-bit digest of its role and text, a conversation by its sequence of digests.
Conversations are dealt to shards by ranges of these sequences. In a shard the digests become small
numbers, and the conversations the rows of a matrix of turn numbers, padded with 0 and made
``_WIDTH`` columns at a time: ``numpy.lexsort`` orders the rows, and the masks of the columns in which
a row differs from the row before it, accumulated by OR along the row, say where nodes start at each
depth. Members, children, leaves and bytes of all nodes of a depth come from one ``reduceat`` each.

Nodes on the path of a shard's first or last row may go on in the next shard. Such boundary nodes are
given as partial sums with a digest of their prefix and recombined by grouping. Neighbouring shards
have in common the first L nodes of two paths; what both have counted once is taken off again: a
child, bytes of the common path and, if the last row ends there, a leaf. The list of conversations
that end at a boundary node is hashed in one pass over the pieces that the shards give.

Defined results: rows without conversation id are left out; null role or text counts as empty; null
turns sort first, rows of equal turn by role, then text; repeated rows are turns of their own;
repeated conversation ids in a table of sequences are members of their own; an empty table gives no
rows. Other columns are ignored. The rows of a conversation are sorted in one value, so they must
fit Spark's limit of 2 GB a value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.llm.tables import stored
from caseloom.operators.joins import lookup_join

#: Turns that a shard holds, on average.
TURNS_PER_SHARD = 1_000_000
#: Columns of a matrix that are held at a time.
_WIDTH = 32
_ID = 16
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_FIELDS = [
    ("conv_id", "long", pa.int64()), ("depth", "long", pa.int64()), ("turn_id", "binary", pa.binary()),
    ("n_convs", "long", pa.int64()), ("n_children", "long", pa.int64()),
    ("n_leaves", "long", pa.int64()),
    # Bytes of all turns of the members from this depth on, and the same with every node once.
    ("listed", "long", pa.int64()), ("distinct_bytes", "long", pa.int64()),
    ("ends_sha256", "string", pa.string()), ("parent_conv_id", "long", pa.int64()),
    # Of boundary nodes, and of the parents of others if those are boundary nodes.
    ("key", "binary", pa.binary()), ("parent_key", "binary", pa.binary()),
    ("shard", "int", pa.int32()), ("is_first", "boolean", pa.bool_()),
    ("is_last", "boolean", pa.bool_()), ("path_bytes", "long", pa.int64()),
    ("size", "long", pa.int64()), ("row_turns", "long", pa.int64()), ("ends", "binary", pa.binary()),
]
_NODES = ", ".join(f"{name} {kind}" for name, kind, _ in _FIELDS)
_SCHEMA = pa.schema([(name, kind) for name, _, kind in _FIELDS])


# Sequences -------------------------------------------------------------------------------------

def turn_id(role: Column, text: Column) -> Column:
    """128 bits of a digest of role and text, as hexadecimal digits."""
    return F.substring(F.sha2(F.encode(F.concat(
        F.char_length(role).cast("string"), F.lit(":"), role, text), "utf-8"), 256), 1, 2 * _ID)


def turn_sequences(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and ``turns``, an array of (id, size) in order; size is the text's in UTF-8 bytes."""
    said = rows.select(
        F.col(conversation).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text")).alias("said"),
    ).filter("conv_id is not null")
    return said.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("said")).select(
        "conv_id", F.transform("said", lambda t: F.struct(
            turn_id(t["role"], t["text"]).alias("id"),
            F.octet_length(t["text"]).cast("long").alias("size"))).alias("turns"))


# One shard -------------------------------------------------------------------------------------

def _padded(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of up to ``_WIDTH`` turn numbers from ``starts`` on, 0 beyond their ``lengths``."""
    columns = np.arange(_WIDTH)
    inside = columns < lengths[:, None]
    return np.where(inside, ids[np.where(inside, starts[:, None] + columns, 0)], 0)


def _numbers(digests: np.ndarray) -> np.ndarray:
    """Turn numbers from 1 on, in the order of the digests (two words each)."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    ordered = digests[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    ids = np.empty(len(order), np.int64)
    ids[order] = np.cumsum(new)
    return ids


def sorted_rows(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                names: np.ndarray) -> np.ndarray:
    """Order of the rows by their turn numbers, then by name."""
    rank = np.zeros(len(lengths), np.int64)  # place of the first row that is equal so far
    depth, open_rows = 0, np.flatnonzero(lengths > 0)
    while len(open_rows):
        matrix = _padded(ids, starts[open_rows] + depth, lengths[open_rows] - depth)
        order = np.lexsort((*matrix.T[::-1], rank[open_rows]))
        rows, matrix = open_rows[order], matrix[order]
        old = rank[rows]
        group = np.ones(len(rows), bool)
        group[1:] = old[1:] != old[:-1]
        start = group.copy()
        start[1:] |= (matrix[1:] != matrix[:-1]).any(1)
        place = np.arange(len(rows))
        group_at = np.maximum.accumulate(np.where(group, place, 0))
        start_at = np.maximum.accumulate(np.where(start, place, 0))
        # Rows of the group that have ended come before those that go on.
        here = np.bincount(np.cumsum(group) - 1)
        ended = np.bincount(rank, minlength=len(rank))[old[group]] - here
        rank[rows] = old + np.repeat(ended, here) + start_at - group_at
        depth += _WIDTH
        alone = np.bincount(rank, minlength=len(rank))[rank] == 1
        open_rows = open_rows[(lengths[open_rows] > depth) & ~alone[open_rows]]
    return np.lexsort((names, rank))


def common_turns(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Turns that each row has in common with the row before it; -1 for the first."""
    common = np.zeros(len(lengths), np.int64)
    shorter = np.minimum(lengths[1:], lengths[:-1])
    rows, depth = np.arange(1, len(lengths)), 0
    while len(rows):
        changed = np.logical_or.accumulate(
            _padded(ids, starts[rows] + depth, lengths[rows] - depth)
            != _padded(ids, starts[rows - 1] + depth, lengths[rows - 1] - depth), axis=1)
        common[rows] += _WIDTH - changed.sum(1)
        depth += _WIDTH
        rows = rows[~changed[:, -1] & (shorter[rows - 1] > depth)]
    common[1:] = np.minimum(common[1:], shorter)
    common[:1] = -1
    return common


def _path_keys(digests: bytes) -> list[bytes]:
    """Digest of every prefix of a row, the empty one first."""
    made = hashlib.sha256()
    keys = [made.digest()]
    for at in range(0, len(digests), _ID):
        made.update(digests[at:at + _ID])
        keys.append(made.copy().digest())
    return keys


def _joined(names: np.ndarray) -> bytes:
    return b",".join(b"%d" % n for n in names.tolist())


def shard_nodes(names: np.ndarray, sequences: list[bytes], sizes: np.ndarray,
                shard: int) -> Iterator[pa.RecordBatch]:
    """Nodes of the rows of one shard, depth by depth. ``sizes`` has the bytes of all turns."""
    digests = np.frombuffer(b"".join(sequences), ">u8").reshape(-1, 2)
    lengths = np.array([len(s) // _ID for s in sequences], np.int64)
    starts = np.cumsum(lengths) - lengths
    ids = np.append(_numbers(digests), 0)
    order = sorted_rows(ids, starts, lengths, names)
    names, lengths, starts = names[order], lengths[order], starts[order]
    first_path, last_path = (_path_keys(sequences[order[k]]) for k in (0, -1))
    common = common_turns(ids, starts, lengths)
    before = np.concatenate([[0], np.cumsum(sizes)])
    whole = before[starts + lengths]
    # A row counts the nodes that begin with it, those deeper than what it shares.
    own = whole - before[starts + np.maximum(common, 0)]
    leaf = np.ones(len(names), np.int64)
    leaf[:-1] = common[1:] < lengths[:-1]
    low = np.zeros(len(names), np.int64)  # smallest member of a row's node at the depth before
    edge = np.zeros(len(names), np.int8)  # whether that is on the first (1) or last (2) path
    rows, depth = np.arange(len(names)), 0
    while len(rows):
        at = np.flatnonzero(common[rows] < depth)
        members = np.diff(np.append(at, len(rows)))
        heads = rows[at]
        least = np.minimum.reduceat(names[rows], at)
        goes_on = (lengths[rows] > depth).astype(np.int64)
        rest = whole[rows] - before[starts[rows] + max(depth - 1, 0)]
        listed = np.add.reduceat(rest, at)
        distinct = np.add.reduceat(own[rows], at) + rest[at] - own[heads]
        children = np.add.reduceat(goes_on & (common[rows] <= depth), at)
        leaves = np.add.reduceat(leaf[rows], at)
        ending = np.add.reduceat(1 - goes_on, at)
        on_first = np.zeros(len(at), bool)
        on_last = on_first.copy()
        on_first[0], on_last[-1] = rows[0] == 0, rows[-1] == len(names) - 1
        boundary = on_first | on_last
        count = len(at)
        ends, hashes, keys, parents = [None] * count, [_NO_ENDS] * count, [None] * count, [None] * count
        for k in np.flatnonzero(ending).tolist():
            ended = _joined(names[rows[at[k]:at[k] + ending[k]]])
            if boundary[k]:
                ends[k] = ended
            else:
                hashes[k] = hashlib.sha256(ended).hexdigest()
        for k in np.flatnonzero(boundary).tolist():
            hashes[k] = None
            keys[k] = (first_path if on_first[k] else last_path)[depth]
        if depth:
            for k in np.flatnonzero(edge[heads]).tolist():
                parents[k] = (first_path if edge[heads[k]] == 1 else last_path)[depth - 1]
            turn = digests[starts[heads] + depth - 1]
            turns = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(_ID), count, [None, pa.py_buffer(turn.tobytes())]).cast(pa.binary())
        else:
            turns = pa.nulls(count, pa.binary())
        through = before[starts[heads] + depth] - before[starts[heads]]
        no_parent = np.full(count, depth == 0) | (edge[heads] > 0)
        yield pa.RecordBatch.from_arrays([
            pa.array(least), pa.array(np.full(count, depth)), turns, pa.array(members),
            pa.array(children), pa.array(leaves), pa.array(listed), pa.array(distinct),
            pa.array(hashes, pa.string()), pa.array(low[heads], mask=no_parent),
            pa.array(keys, pa.binary()), pa.array(parents, pa.binary()),
            pa.array(np.full(count, shard, np.int32)), pa.array(on_first), pa.array(on_last),
            pa.array(through), pa.array(rest[at] - (whole[heads] - before[starts[heads] + depth])),
            pa.array(lengths[np.where(on_last, len(names) - 1, heads)]), pa.array(ends, pa.binary()),
        ], schema=_SCHEMA)
        low[rows] = np.repeat(least, members)
        edge[rows] = np.repeat(np.where(on_first, 1, np.where(on_last, 2, 0)), members)
        rows = rows[goes_on.astype(bool)]
        depth += 1


def _map_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, sequences, sizes = [], [], []
    for batch in batches:
        names.append(batch["conv_id"].to_numpy())
        sequences += batch["sequence"].to_pylist()
        sizes.append(pc.list_flatten(batch["sizes"]).to_numpy())
    if sequences:
        yield from _gathered(shard_nodes(np.concatenate(names), sequences, np.concatenate(sizes),
                                         TaskContext.get().partitionId()))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Fewer, larger batches: deep nodes come one by one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if len(held) >= 1000 or sum(b.num_rows for b in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


# Boundary nodes --------------------------------------------------------------------------------

def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the pieces of each key, which come in order."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    key, made = None, None
    for batch in batches:
        keys, hashes = [], []
        for k, piece in zip(batch["key"].to_pylist(), batch["ends"].to_pylist()):
            if k != key:
                if made:
                    keys.append(key)
                    hashes.append(made.hexdigest())
                key, made = k, hashlib.sha256(piece)
            else:
                made.update(b"," + piece)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes, pa.string())],
                                         schema=schema)
    if made:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([made.hexdigest()])], schema=schema)


def _recombined(nodes: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, each once."""
    edges = nodes.filter("key is not null")
    # One row per shard.
    following = edges.filter("is_first and depth = 0").select(
        "shard", F.lead("shard").over(W.orderBy("shard")).alias("next"))
    last = edges.filter("is_last").join(following, "shard").select(
        "shard", "next", "depth", "key", "path_bytes", "size", "row_turns")
    first = edges.filter("is_first").select(F.col("shard").alias("next"), "depth", "key")
    shared = last.join(first, ["next", "depth", "key"])
    deepest = shared.groupBy("shard").agg(F.max("depth").alias("deepest"),
                                          F.max("path_bytes").alias("shared_bytes"))
    twice = shared.join(deepest, "shard").select(
        "key", F.lit(None).cast("long").alias("conv_id"), "depth",
        F.lit(None).cast("binary").alias("turn_id"), F.lit(None).cast("binary").alias("parent_key"),
        F.lit(0).cast("long").alias("n_convs"),
        (-(F.col("depth") < F.col("deepest")).cast("long")).alias("n_children"),
        (-(F.col("deepest") == F.col("row_turns")).cast("long")).alias("n_leaves"),
        F.lit(0).cast("long").alias("listed"),
        (F.col("path_bytes") - F.col("size") - F.col("shared_bytes")).alias("distinct_bytes"),
    )
    ends = edges.filter("ends is not null").select("key", "shard", "ends").repartition("key") \
        .sortWithinPartitions("key", "shard").mapInArrow(_hash_pieces, "key binary, ends_sha256 string")
    summed = edges.select(*twice.columns).unionByName(twice).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("turn_id").alias("turn_id"), F.max("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "listed",
                                      "distinct_bytes")])
    return stored(summed.join(ends, "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))), "trie-boundary")


def prefix_trie(sequences: DataFrame, turns_per_shard: int = TURNS_PER_SHARD,
                shards: int | None = None) -> DataFrame:
    """Nodes of the trie of ``sequences`` (conv_id, turns as ``turn_sequences`` gives them).

    Per node: conv_id (its smallest member), depth, turn_id (of its last turn), parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = sequences.sparkSession
    rows = stored(sequences.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("sequence"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    ), "turn-sequences")
    turns = rows.agg(F.sum(F.size("sizes"))).first()[0] or 0
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                           -(-turns // turns_per_shard))
    nodes = stored(rows.repartitionByRange(shards, "sequence", "conv_id")
                   .mapInArrow(_map_shard, _NODES), "trie-shards")
    boundary = _recombined(nodes)
    parents = boundary.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of_boundary"))
    columns = ["conv_id", "depth", "turn_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
               (F.col("listed") - F.col("distinct_bytes")).alias("saved_tokens"), "ends_sha256"]
    inner = nodes.filter("key is null")
    under = lookup_join(inner.filter("parent_key is not null").drop("parent_conv_id"), parents,
                        "parent_key").withColumnRenamed("of_boundary", "parent_conv_id")
    top = boundary.join(parents, "parent_key", "left").withColumnRenamed("of_boundary", "parent_conv_id")
    return (inner.filter("parent_key is null").select(*columns)
            .unionByName(under.select(*columns)).unionByName(top.select(*columns)))
