"""Test items inside training documents, with Spark expressions only.

An item is found in a document if at least ``threshold`` of the item's distinct word shingles occur
in the document. An item with fewer words than a shingle is one shingle, its whole word sequence.

Search: items are partitioned by the size of their shingle sets, in powers of two. In a partition
of sets of up to u shingles every item is represented by the k smallest values of a hash over its
shingles (a bottom-k MinHash), with k = u - ceil(threshold * u) + 1. An item with containment of
``threshold`` misses fewer than k of its shingles, so at least one of any k is in the document:
looking the sketches up among a document's shingles finds every match, however long the document
is. Documents are streamed past the sketches and are not shuffled where the sketches are small by
their measured size; else the optimiser joins by hash value.

Verification: for each candidate pair the shingles themselves are compared, as texts.

Defined results: items or documents without words match nothing; null identifiers are kept;
repeated rows give one pair; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.shingles import SHINGLE_WORDS, shingle_hashes, shingle_texts, words
from caseloom.llm.tables import fresh, quoted, row_key, stored

THRESHOLD = 0.75


def sketch_size(upper: int, threshold: float) -> int:
    """Shingles of which one must be found, for sets of up to ``upper``."""
    return upper - math.ceil(threshold * upper - 1e-9) + 1


def _needed(count: Column, threshold: float) -> Column:
    return F.ceil(count * F.lit(threshold) - F.lit(1e-9))


def _sketch_length(count: Column, threshold: float) -> Column:
    """k of the partition that ``count`` falls into: upper bounds are 1, 2, 4, 8, ..."""
    upper = F.pow(F.lit(2), F.ceil(F.log2(count))).cast("int")
    return (upper - _needed(upper, threshold) + 1).cast("int")


def find_contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                   identifier: str = "doc_id", text: str = "text", item: str = "item_id",
                   item_text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Pairs doc_id, item_id with ``shared`` and ``item_shingles``."""
    wanted = items.select(F.col(item).alias("item_id"), words(F.col(item_text)).alias("w")) \
        .filter(F.size("w") > 0).distinct()
    wanted = wanted.withColumn("run", F.least(F.size("w"), F.lit(shingle)))
    runs = sorted(r["run"] for r in wanted.select("run").distinct().collect())  # at most `shingle`

    def by_run(make) -> Column:
        """Shingles of the length that an item has."""
        out = F.lit(None)
        for n in runs:
            out = F.when(F.col("run") == n, F.array_distinct(make(F.col("w"), n))).otherwise(out)
        return out

    def of_document(make) -> Column:
        return F.array_distinct(F.concat(*[make(F.col("w"), n) for n in runs]))

    if not runs:
        runs = [shingle]
    described = stored(wanted.select(
        "item_id", by_run(shingle_hashes).alias("hashes"), by_run(shingle_texts).alias("texts"),
    ), "items")
    sketches = stored(described.select("item_id", F.explode(F.slice(
        F.array_sort("hashes"), 1, _sketch_length(F.size("hashes"), threshold))).alias("hash")),
        "sketches")

    split = docs.select(F.col(identifier).alias("doc_id"), words(F.col(text)).alias("w"))
    candidates = stored(
        split.select("doc_id", F.explode(of_document(shingle_hashes)).alias("hash"))
        .join(sketches, "hash").select("doc_id", "item_id").distinct(), "candidates")

    hit = candidates.select(F.col("doc_id").alias("hit_id")).distinct()
    pairs = candidates.select(F.col("doc_id").alias("pair_doc"), F.col("item_id").alias("pair_item"))
    known = described.select(F.col("item_id").alias("known_item"), "texts")
    shared = F.size(F.array_intersect("texts", "of_doc"))
    return (
        split.join(hit, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left_semi")
        .select("doc_id", of_document(shingle_texts).alias("of_doc"))
        .join(pairs, F.col("doc_id").eqNullSafe(F.col("pair_doc")))
        .join(known, F.col("pair_item").eqNullSafe(F.col("known_item")))
        .select("doc_id", F.col("pair_item").alias("item_id"), shared.alias("shared"),
                F.size("texts").alias("item_shingles"))
        .filter(F.col("shared") >= _needed(F.col("item_shingles"), threshold))
        .groupBy("doc_id", "item_id")
        .agg(F.max("shared").alias("shared"), F.max("item_shingles").alias("item_shingles"))
    )


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                    identifier: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` in which no item is found, with all their columns. A row goes by its own text:
    others with its identifier, or without one, stay."""
    key = fresh(docs, "row_key")
    keyed = docs.withColumn(key, row_key(F.col(identifier), F.col(text)))
    found = find_contained(keyed, items, threshold, key, text, **options)
    bad = stored(found.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(bad, key, "left_anti").select(*[F.col(quoted(c)) for c in docs.columns])
