"""Best-fit packing under conflicts.

Documents are packed into bins of ``capacity`` tokens. A document longer than a bin fills bins of
its own with its leading pieces; only its last piece, shorter than a bin, is packed with others.
No bin holds two packed pieces of one source, nor two of one cluster of duplicates.

Documents are dealt into groups of about ``group_rows`` by a hash of identifier and cluster: a hot
source spreads over all groups, and each group is packed in one task. In a group pieces go in
falling length. Open bins stand in order of their residual and carry a bitmap of sources and one of
clusters; the search starts at the smallest residual that fits and goes on to the next larger
until a bin has no bit in common with the piece, so the tightest compatible bin is found. Among
equal residuals the oldest bin wins. If none fits, a bin is opened.

Defined results: a null or negative length counts as 0; a piece of length 0 is packed like others;
a null source or cluster is in conflict with nothing; ties go by identifier; repeated rows are
pieces of their own; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents packed together. More pack a little tighter and search longer.
GROUP_ROWS = 4096
_RESULT = ("doc_id long, piece int, start long, tokens long, bin_id long, bin_start long, "
           "source string, cluster string")


def _bits(keys: Sequence[str | None]) -> list[int]:
    """A bit per value; none for null or for a value that is there once."""
    counts = Counter(keys)
    places: dict[str, int] = {}
    return [
        0 if key is None or counts[key] < 2 else 1 << places.setdefault(key, len(places))
        for key in keys
    ]


def best_fit(lengths: Sequence[int], sources: Sequence[int], clusters: Sequence[int],
             capacity: int) -> list[tuple[int, int]]:
    """(bin, start) of each piece, taken in the given order. Bitmaps say what conflicts."""
    at_residual: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled = 0  # bit r: some bin has residual r
    bin_sources: list[int] = []
    bin_clusters: list[int] = []
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters):
        found = -1
        larger = filled >> length
        while larger:
            residual = length + (larger & -larger).bit_length() - 1
            for number in at_residual[residual]:
                if not (bin_sources[number] & source or bin_clusters[number] & cluster):
                    found = number
                    break
            if found >= 0:
                break
            larger &= larger - 1
            # The lowest bit is gone; the next one is the successor.
        if found < 0:
            found, residual = len(bin_sources), capacity
            bin_sources.append(0)
            bin_clusters.append(0)
        else:
            level = at_residual[residual]
            del level[bisect_left(level, found)]
            if not level:
                filled ^= 1 << residual
        placed.append((found, capacity - residual))
        bin_sources[found] |= source
        bin_clusters[found] |= cluster
        insort(at_residual[residual - length], found)
        filled |= 1 << (residual - length)
    return placed


def _pack_group(capacity: int, group: pa.Table) -> pa.Table:
    order = group.sort_by([("tail", "descending"), ("doc_id", "ascending"),
                           ("full", "ascending"), ("cluster", "ascending")])
    rows = order.to_pydict()
    packs = [k for k, (full, tail) in enumerate(zip(rows["full"], rows["tail"]))
             if tail or not full]
    spots = best_fit(
        [rows["tail"][k] for k in packs], _bits([rows["source"][k] for k in packs]),
        _bits([rows["cluster"][k] for k in packs]), capacity,
    )
    spot_of = dict(zip(packs, spots))
    bins = 1 + max((b for b, _ in spots), default=-1)
    base = (rows["bucket"][0] if packs or rows["bucket"] else 0) << 32
    out: list[tuple] = []
    for k, doc_id in enumerate(rows["doc_id"]):
        full, about = rows["full"][k], (rows["source"][k], rows["cluster"][k])
        for piece in range(full):
            out.append((doc_id, piece, piece * capacity, capacity, base + bins, 0, *about))
            bins += 1
        if k in spot_of:
            number, start = spot_of[k]
            out.append((doc_id, full, full * capacity, rows["tail"][k], base + number, start,
                        *about))
    names = [part.split()[0] for part in _RESULT.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.string()]
    columns: Iterable = zip(*out) if out else [[] for _ in names]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def pack(docs: DataFrame, capacity: int, identifier: str = "doc_id", length: str = "length",
         source: str = "source", cluster: str = "cluster",
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, start and tokens in the document, bin_id, bin_start (where
    it begins in the bin), source, cluster."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    tokens = F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(identifier).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.col(cluster).cast("string").alias("cluster"), tokens.alias("tokens"),
    )
    groups = max(1, -(-rows.count() // group_rows))
    dealt = rows.select(
        F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(groups)).alias("bucket"),
        "doc_id", "source", "cluster",
        F.expr(f"tokens div {capacity}").alias("full"), (F.col("tokens") % capacity).alias("tail"),
    )
    return dealt.groupBy("bucket").applyInArrow(
        lambda group: _pack_group(capacity, group), _RESULT)
