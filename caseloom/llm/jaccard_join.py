"""Jaccard join of word shingle sets, size-aware: light sets by subsets, heavy sets by lists.

Two sets of a and b shingles are linked if they share at least c(a, b) = ceil(3 (a + b) / 7) of
them, which is a Jaccard similarity of 0.75 or more. Equal sets are one *class*; links are found
between classes.

Light sets, of at most ``boundary`` shingles: for each size b that a partner may have, all subsets of
c(a, b) shingles are enumerated. Two light sets are linked if and only if they have such a subset in
common, so a bucket of one subset needs no comparison: its members are linked in a chain.

Heavy sets: the rarest n - ceil(3 n / 4) + 1 shingles of a set of n go to inverted lists; linked
sets share at least one of them. Rarity is read from counters of hashed shingles, counted over the
whole corpus; the order decides how long the lists are, not what is found. An entry also has its place in
that order of its own set: of linked sets, the first shingle in common leaves at least c(a, b)
shingles from its place on in either set. Pairs of entries whose places rule that out are dropped.
The lists are scanned twice, in order of the places, so that a list begins with the sets that have
the fewest rare shingles, such as the source of many edited copies. The first scan lets each entry
meet the first entry and the one before it; of the sets a set has met in either way, the one met in
most lists is compared, so the cost is linear in the sets. The second takes from each list the pairs
of entries of different components, each of which has an entry outside the component of the
list's first entry, and compares their sets. Pairs inside a component need no comparison, as
components are what is asked for.

Before two sets are compared their *parity bitmaps* are: each shingle flips one of 2 to 4 bits per
shingle of the set, so where more bits differ than linked sets of these sizes can differ in shingles,
the pair is dropped. Bitmaps are a thirtieth of the sets and made with them in the first pass; only
sets of pairs that remain are made again and shuffled.

Light sets that a heavy one can be similar to take part in the lists too. The boundary is the size
at which all enumerated subsets and all list entries together cost least.

Defined results: documents without words have no shingles, link with nothing and are components of
their own; null identifiers count as smaller than none: a component has the smallest identifier
that is not null; repeated rows are in one class; an empty table gives no rows. Other columns are
ignored. Classes are told apart by a 64-bit hash of the whole set together with its size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from caseloom.llm.components import components
from caseloom.llm.shingles import SHINGLE_WORDS
from caseloom.llm.tables import fresh, quoted, row_key, stored
from caseloom.operators.joins import lookup_join

#: Counters of hashed shingles: 4 MB, whatever the corpus. More keep the lists shorter on more data.
COUNTERS = 1 << 20
#: Bits of the filter that says which sets are to be fetched: 4 MB, whatever the corpus. With too few
#: for their number more sets than needed are fetched, which changes no result.
FILTER_BITS = 1 << 25
_SLICES = 64
#: First-level merges of each slice.
_ROOT = 256
#: Light sets are never larger: the number of subsets explodes.
_LARGEST_LIGHT = 16
#: Cost of a list entry, scanned and compared, in enumerated subsets.
_ENTRY_COST = 8
#: Words that are hashed together.
_TOGETHER = 200_000
_SET = "doc_id long, key binary, n int, sid long, bitmap binary, slice int, counts binary"
_ENTRY = "key long, sid long, n int, other int, place int"
_MEMBER = "sid long, shingles array<bigint>"
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                         0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def needed(a: int, b: int) -> int:
    """Shingles that linked sets of these sizes share."""
    return -(-3 * (a + b) // 7)


def prefix_length(n: int) -> int:
    return n - -(-3 * n // 4) + 1


def partner_sizes(n: int) -> range:
    return range(-(-3 * n // 4), 4 * n // 3 + 1)


# Sets ------------------------------------------------------------------------------------------

def _sets_together(split: list[list[bytes]]) -> Iterator[np.ndarray]:
    counts = [len(w) for w in split]
    hashed = np.fromiter((xxh64_intdigest(w) for words in split for w in words), np.uint64, sum(counts))
    runs = max(0, len(hashed) - SHINGLE_WORDS + 1)
    mixed = np.zeros(runs, np.uint64)
    for k in range(SHINGLE_WORDS):
        part = hashed[k:k + runs] * _MULTIPLIERS[k]
        mixed = (mixed ^ (part >> np.uint64(29))) * _MULTIPLIERS[0] + part
    mixed ^= mixed >> np.uint64(32)
    at = 0
    for words, n in zip(split, counts):
        if n >= SHINGLE_WORDS:
            found = np.sort(mixed[at:at + n - SHINGLE_WORDS + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif n:
            yield np.array([xxh64_intdigest(b" ".join(words), seed=n)], np.uint64)
        else:
            yield np.zeros(0, np.uint64)
        at += n


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted shingle hashes of each text. Lower-casing and splitting of bytes know ASCII only,
    as the definition of words does."""
    held, words = [], 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass").lower().split())
        words += len(held[-1])
        if words >= _TOGETHER:
            yield from _sets_together(held)
            held, words = [], 0
    yield from _sets_together(held)


def _class_of(found: np.ndarray) -> int:
    return int(np.array(xxh64_intdigest(found.tobytes()), np.uint64).view(np.int64))


def parity_bitmap(found: np.ndarray) -> bytes:
    """A bit of each hash value's place is flipped; 2 to 4 bits for each shingle."""
    bits = max(8, 1 << (2 * len(found) - 1).bit_length())
    flips = np.bincount((found & np.uint64(bits - 1)).view(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(bool)).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """Shingles that are in one of the sets only, at least, by their bitmaps."""
    one, two = sorted((np.frombuffer(x, np.uint8) for x in (a, b)), key=len)
    while len(two) > len(one):  # places are low bits: halves of the larger lie over each other
        two = two[:len(two) // 2] ^ two[len(two) // 2:]
    return int(np.bitwise_count(one ^ two).sum())


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bitmaps do not rule a link out."""
    for batch in batches:
        keep = []
        for n, m, one, two in zip(*(batch[c].to_pylist() for c in ("n_a", "n_b", "of_a", "of_b"))):
            keep.append(n + m - 2 * needed(n, m) >= least_difference(one, two))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _describe(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Size, class and bitmap of each document, and at the end the counts of hashed shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int32()),
                        ("sid", pa.int64()), ("bitmap", pa.binary()), ("slice", pa.int32()),
                        ("counts", pa.binary())])
    counters = np.zeros(size, np.int64)
    for batch in batches:
        sizes, classes, bitmaps, parts = [], [], [], [np.zeros(0, np.uint64)]
        for found in shingle_sets(batch["text"].to_pylist()):
            sizes.append(len(found))
            bitmaps.append(parity_bitmap(found) if len(found) else None)
            classes.append(_class_of(found))
            parts.append(found & np.uint64(size - 1))
        counters += np.bincount(np.concatenate(parts).view(np.int64), minlength=size)
        missing = pa.nulls(len(sizes))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["key"], pa.array(sizes, pa.int32()), pa.array(classes, pa.int64()),
             pa.array(bitmaps, pa.binary()), missing.cast(pa.int32()), missing.cast(pa.binary())],
            schema=schema)
    missing = pa.nulls(_SLICES)
    yield pa.RecordBatch.from_arrays(
        [missing.cast(pa.int64()), missing.cast(pa.binary()), missing.cast(pa.int32()),
         missing.cast(pa.int64()), missing.cast(pa.binary()), *_sliced(np.minimum(counters, 2**32 - 1).astype("<u4"))], schema=schema)


def _merged(sliced: DataFrame, kind: str, size: int, merge) -> np.ndarray:
    """One array of ``size`` from the slices of every task's, by an operation on two arrays. Slices
    are merged in two levels, so that no task reads those of more than the root of all tasks."""
    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch["slice"].to_pylist(), batch["counts"]):
                part = np.frombuffer(zlib.decompress(data.as_py()), kind)
                total[k] = merge(total[k], part) if k in total else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([zlib.compress(c.tobytes(), 1) for c in total.values()], pa.binary())],
            names=["slice", "counts"])

    some = sliced.select("slice", "counts", F.pmod(F.spark_partition_id(), F.lit(_ROOT)).alias("part"))
    rows = some.repartition("slice", "part").select("slice", "counts").mapInArrow(
        together, "slice int, counts binary").repartition("slice").mapInArrow(
        together, "slice int, counts binary").collect()
    parts = {r["slice"]: np.frombuffer(zlib.decompress(r["counts"]), kind) for r in rows}
    none = np.zeros(size // _SLICES, kind)
    return np.concatenate([parts.get(k, none) for k in range(_SLICES)])


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a.astype(np.int64) + b, 2**32 - 1).astype("<u4")


def _sliced(array: np.ndarray) -> tuple[pa.Array, pa.Array]:
    packed = [zlib.compress(s.tobytes(), 1) for s in array.reshape(_SLICES, -1)]
    return pa.array(range(_SLICES), pa.int32()), pa.array(packed, pa.binary())


def _filter_places(classes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return classes & (size - 1), (classes >> 32) & (size - 1)


def _mark(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Filter of ``size`` bits of the classes in this task."""
    bits = np.zeros(size, bool)
    for batch in batches:
        for places in _filter_places(batch["sid"].to_numpy(), size):
            bits[places] = True
    yield pa.RecordBatch.from_arrays(list(_sliced(np.packbits(bits))), names=["slice", "counts"])


# Entries ---------------------------------------------------------------------------------------

def subset_count(n: int) -> int:
    """Subsets that a light set of n shingles enumerates."""
    return sum(math.comb(n, needed(n, b)) for b in partner_sizes(n) if needed(n, b) <= min(n, b))


def cheapest_boundary(sizes: dict[int, int]) -> int:
    """Largest size of light sets, from the number of sets of each small size."""
    def cost(boundary: int) -> int:
        listed = -(-3 * (boundary + 1) // 4)  # light sets from here on are in the lists as well
        return sum(count * ((subset_count(n) if n <= boundary else 0)
                            + (_ENTRY_COST * prefix_length(n) if n >= listed else 0))
                   for n, count in sizes.items())
    return min(range(_LARGEST_LIGHT + 1), key=lambda b: (cost(b), b))


def _subset_keys(found: np.ndarray) -> Iterator[tuple[int, int]]:
    """(key, partner's size) of every subset of a light set."""
    n = len(found)
    for b in partner_sizes(n):
        take = needed(n, b)
        if take <= min(n, b):
            seed = min(n, b) * 64 + max(n, b)
            for chosen in combinations(found.tolist(), take):
                yield xxh64_intdigest(np.array(chosen, np.uint64).tobytes(), seed=seed), b


def _entries(batches: Iterator[pa.RecordBatch], counters: np.ndarray,
             boundary: int) -> Iterator[pa.RecordBatch]:
    listed = -(-3 * (boundary + 1) // 4)
    seen: set[int] = set()
    for batch in batches:
        keys, places, rows = [], [], []
        for found in shingle_sets(batch["text"].to_pylist()):
            n, sid = len(found), _class_of(found)
            if not n or sid in seen:
                continue
            if len(seen) > 1_000_000:  # a class may be given again, which changes nothing
                seen.clear()
            seen.add(sid)
            if n >= listed:
                rarity = counters[(found & np.uint64(len(counters) - 1)).view(np.int64)]
                # Ties go by the hash: the set is sorted and the sort is stable.
                prefix = found[np.argsort(rarity, kind="stable")[:prefix_length(n)]]
                keys.append(prefix)
                places.append(np.arange(len(prefix), dtype=np.int32))
                rows.append((sid, n, 0, len(prefix)))
            if n <= boundary:
                subsets = list(_subset_keys(found))
                keys.append(np.array([k for k, _ in subsets], np.uint64))
                places.append(np.zeros(len(subsets), np.int32))
                rows += [(sid, n, b, 1) for _, b in subsets]
        if keys:
            repeat = [r[3] for r in rows]
            classes, sizes, others = (np.repeat(np.array([r[k] for r in rows], t), repeat)
                                      for k, t in ((0, np.int64), (1, np.int32), (2, np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(classes),
                 pa.array(sizes), pa.array(others), pa.array(np.concatenate(places))],
                names=["key", "sid", "n", "other", "place"])


def _members(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The set of each class that the filter lets through, once per task."""
    bits, seen = np.unpackbits(wanted).astype(bool), set()
    for batch in batches:
        sets = {_class_of(found): found.view(np.int64)
                for found in shingle_sets(batch["text"].to_pylist()) if len(found)}
        classes = np.fromiter(sets, np.int64, len(sets))
        first, second = _filter_places(classes, len(bits))
        new = [sid for sid in classes[bits[first] & bits[second]].tolist() if sid not in seen]
        seen.update(new)
        yield pa.RecordBatch.from_arrays(
            [pa.array(new, pa.int64()), pa.array([sets[sid] for sid in new], pa.list_(pa.int64()))],
            names=["sid", "shingles"])


# Links -----------------------------------------------------------------------------------------

def _shared_entries(entries: DataFrame) -> DataFrame:
    """Entries of keys that several classes have, each once, with the entry before it and the first."""
    whole = W.partitionBy("key")
    ordered = whole.orderBy("place", "sid")
    marked = entries.select(
        "*", *[F.lag(c).over(ordered).alias(f"last_{c}") for c in ("sid", "n", "place")],
        *[F.first(c).over(ordered).alias(f"first_{c}") for c in ("sid", "n", "place")],
        (F.min("sid").over(whole) != F.max("sid").over(whole)).alias("shared"),
        ((F.col("other") == F.col("n")) | (F.min("n").over(whole) != F.max("n").over(whole)))
        .alias("linked"),
    )
    return marked.filter(F.col("shared") & ~F.col("sid").eqNullSafe(F.col("last_sid"))
                         & ((F.col("other") == 0) | F.col("linked"))).drop("shared", "linked")


def _may_link(n: str, place: str, other_n: str, other_place: str, boundary: int) -> Column:
    """Whether sets of these sizes can be linked if what is at these places is the first shingle
    they share. Light sets have met by their subsets."""
    least = F.expr(f"(3 * ({n} + {other_n}) + 6) div 7")
    both_light = (F.col(n) <= boundary) & (F.col(other_n) <= boundary)
    return ((F.col(n) - F.col(place) >= least) & (F.col(other_n) - F.col(other_place) >= least)
            & ~both_light)


def _met(lists: DataFrame, boundary: int) -> DataFrame:
    """For each class the one, of the first entries of its lists, that it has met in most of them,
    and likewise of the entries before it: pairs (a, b)."""
    met = None
    for which in ("first", "last"):
        pairs = lists.filter((F.col("sid") != F.col(f"{which}_sid")) & _may_link(
            "n", "place", f"{which}_n", f"{which}_place", boundary)).groupBy(
            F.col("sid").alias("a"), F.col(f"{which}_sid").alias("b")).agg(
            F.count(F.lit(1)).alias("lists"))
        most = pairs.groupBy("a").agg(F.max(F.struct("lists", "b")).alias("most")).select(
            "a", F.col("most.b").alias("b"))
        met = most if met is None else met.unionByName(most)
    return met.distinct()


def _across(lists: DataFrame, roots: DataFrame, boundary: int) -> DataFrame:
    """Pairs (a, b) of different components that a list holds and their places allow."""
    member = roots.withColumnRenamed("node", "sid")
    leader = roots.select(F.col("node").alias("first_sid"), F.col("root").alias("first_root"))
    labelled = lists.join(member, "sid", "left").join(leader, "first_sid", "left").select(
        "key", "sid", "n", "place", F.coalesce("root", "sid").alias("root"),
        (F.coalesce("root", "sid") == F.coalesce("first_root", "first_sid")).alias("led"))
    mixed = stored(labelled.select("*", F.bool_and("led").over(W.partitionBy("key")).alias("whole"))
                   .filter("not whole").drop("whole"), "mixed-lists")
    a, b = (mixed.select("key", *[F.col(c).alias(f"{c}_{side}")
                                  for c in ("sid", "n", "place", "root", "led")]) for side in "ab")
    return a.filter("not led_a").join(b, "key").filter(
        "root_a <> root_b and (led_b or sid_a < sid_b)"
    ).filter(_may_link("n_a", "place_a", "n_b", "place_b", boundary)).select(
        F.col("sid_a").alias("a"), F.col("sid_b").alias("b")).distinct()


def _classes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid")))


def _possible(pairs: DataFrame, described: DataFrame) -> DataFrame:
    """Stored pairs (a, b) that their bitmaps allow."""
    pairs = stored(pairs.select("a", "b"), "met-pairs")
    bitmaps = described.select("sid", "n", "bitmap").join(
        _classes_of(pairs).distinct(), "sid", "left_semi").dropDuplicates(["sid"])
    of_a, of_b = (bitmaps.select(F.col("sid").alias(s), F.col("n").alias(f"n_{s}"),
                                 F.col("bitmap").alias(f"of_{s}")) for s in "ab")
    return stored(pairs.join(of_a, "a").join(of_b, "b").mapInArrow(_plausible, "a long, b long"),
                  "pairs")


def _verified(pairs: DataFrame, described: DataFrame, texts: DataFrame,
              filter_bits: int) -> DataFrame:
    """Pairs (a, b) whose sets share enough, as links (u, v). The sets are made again from the
    texts, of the classes in possible pairs only: neither texts nor other sets are shuffled."""
    spark = pairs.sparkSession
    pairs = _possible(pairs, described)
    classes = _classes_of(pairs)
    wanted = spark.sparkContext.broadcast(_merged(
        classes.mapInArrow(lambda b: _mark(b, filter_bits), "slice int, counts binary"), "u1",
        filter_bits // 8, np.bitwise_or))
    members = stored(texts.select("text").mapInArrow(
        lambda batches: _members(batches, wanted.value), _MEMBER
    ).join(classes.distinct(), "sid", "left_semi").dropDuplicates(["sid"]), "set-members")
    first = members.select(F.col("sid").alias("a"), F.col("shingles").alias("of_a"))
    second = members.select(F.col("sid").alias("b"), F.col("shingles").alias("of_b"))
    overlap = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(first, "a").join(second, "b").filter(
        7 * overlap >= 3 * (F.size("of_a") + F.size("of_b"))
    ).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _linked(docs: DataFrame, identifier: str, text: str, counters: int, filter_bits: int,
            key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, n, sid), and the root of each class that is linked and no root (node, root)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(identifier).cast("long").alias("doc_id"), key.alias("key"),
                        F.col(text).alias("text"))
    described = stored(texts.mapInArrow(lambda b: _describe(b, counters), _SET), "shingle-sets")
    bitmaps = described.filter("slice is null and n > 0")
    rows = described.filter("slice is null").select("doc_id", "key", "n", "sid")
    shared_counters = spark.sparkContext.broadcast(
        _merged(described.filter("slice is not null"), "<u4", counters, _add))
    sizes = {r["n"]: r["sets"] for r in rows.filter(
        (F.col("n") > 0) & (F.col("n") <= 2 * _LARGEST_LIGHT)).groupBy("n").agg(
        F.count(F.lit(1)).alias("sets")).collect()}
    boundary = cheapest_boundary(sizes)

    entries = texts.select("text").mapInArrow(
        lambda batches: _entries(batches, shared_counters.value, boundary), _ENTRY)
    shared = stored(_shared_entries(entries), "shared-entries")
    light = shared.filter("other > 0 and last_sid is not null").select(
        F.col("sid").alias("u"), F.col("last_sid").alias("v"))
    lists = shared.filter("other = 0").drop("other")

    met = _verified(_met(lists, boundary), bitmaps, texts, filter_bits)
    roots = components(stored(met.unionByName(light), "first-links"))
    more = _verified(_across(lists, roots, boundary), bitmaps, texts, filter_bits)
    closing = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more)
    return rows, components(closing)


def _named(rows: DataFrame, roots: DataFrame, least: Column) -> DataFrame:
    """Per class (class, size) the smallest ``least`` of the rows in its component, as ``first``."""
    classes = rows.filter("n > 0").groupBy("sid", "n").agg(F.min(least).alias("low"))
    of_class = stored(classes.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select(
        F.col("sid").alias("class"), F.col("n").alias("size"), "low",
        F.coalesce("root", "sid").alias("root")), "set-classes")
    first = stored(of_class.groupBy("root").agg(F.min("low").alias("first")), "set-components")
    return lookup_join(of_class, first, "root").select("class", "size", "first")


def jaccard_components(docs: DataFrame, identifier: str = "doc_id", text: str = "text",
                       counters: int = COUNTERS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row. ``counters`` and ``filter_bits`` are powers of
    two, 512 at least; they change the cost only."""
    rows, roots = _linked(docs, identifier, text, counters, filter_bits, F.lit(None).cast("binary"))
    named = _named(rows, roots, F.col("doc_id"))
    wordless = F.col("n") == 0
    return rows.filter(wordless).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")
    ).unionByName(
        rows.filter(~wordless).join(named, (F.col("sid") == F.col("class"))
                                    & (F.col("n") == F.col("size")))
        .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("first").alias("component_id"))
    )


def one_of_each(docs: DataFrame, identifier: str = "doc_id", text: str = "text",
                counters: int = COUNTERS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``docs`` without near copies, with all their columns: of each component the row with the
    smallest identifier stays, null being larger than all, ties by a digest of identifier and text.
    Rows that repeat both go or stay together; rows without words stay."""
    key = fresh(docs, "row_key")
    keyed = docs.withColumn(key, row_key(F.col(identifier), F.col(text)))
    rows, roots = _linked(keyed, identifier, text, counters, filter_bits, F.col(key))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    named = _named(rows, roots, order)
    gone = stored(rows.filter("n > 0").join(
        named, (F.col("sid") == F.col("class")) & (F.col("n") == F.col("size"))
    ).filter(F.col("key") != F.col("first.key")).select(F.col("key").alias(key)).distinct(), "near-copies")
    return keyed.join(gone, key, "left_anti").select(*[F.col(quoted(c)) for c in docs.columns])
