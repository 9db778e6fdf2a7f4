"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage returns
to the shared folder and reads it back as the documents of the next.

1. language: documents without a letter in them, and those that cost more in their cheapest language
   than chance letters of its own and ten phrases (which is little for long texts, much for short ones
   that hold an address or a key), go;
2. exact_duplicates: of equal texts (A-Z lower-cased) the largest identifier stays;
3. near_duplicates: of documents connected by links of 0.75 or more, the smallest identifier stays;
4. decontamination: documents that hold a benchmark item go;
5. packing: what is left is packed into bins of 2048 words.

All stages but the last return the columns of documents, whatever names more of them have. Defined
results: every row is judged by its own text: of rows with one identifier and different texts, and of
rows without identifier, some may go and others stay; in stage 3 null is larger than all identifiers, and
documents without words stay; repeated rows are one document from stage 2 on; empty tables pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.decontaminate import clean_documents
from caseloom.llm.exact_dedup import keep_documents, streaming_dedup
from caseloom.llm.jaccard_join import one_of_each
from caseloom.llm.language import UNKNOWN, language_of, train
from caseloom.llm.packing import pack
from caseloom.llm.queries import PACK_TOKENS, with_pack_columns
from caseloom.llm.tables import fresh, quoted, small_batches, stored, table

#: Phrases that a text may cost beyond chance letters.
LOOSE_PHRASES = 10


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what is in no language."""
    small_batches(spark)
    model = train(docs)
    judged = fresh(docs, "judged")
    told = docs.withColumn(judged, language_of(spark, model, F.col("text")))
    if not model.languages:  # nothing was learned, so nothing can be told apart
        readable = F.col("text").rlike(r"\p{L}")
    else:
        bits = {lang: math.log2(letters + 2) for lang, letters in zip(model.languages, model.letters)}
        phrase = dict(zip(model.languages, model.log_lengths.tolist()))
        chance, one = (F.element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]),
                                    F.col(f"{judged}.lang")) for known in (bits, phrase))
        readable = (F.col(f"{judged}.lang") != UNKNOWN) & (
            F.col(f"{judged}.bits") <= chance + LOOSE_PHRASES * one / F.col(f"{judged}.symbols"))
    return told.filter(readable).select(*[F.col(quoted(c)) for c in docs.columns])


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each text."""
    return keep_documents(docs, streaming_dedup(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near copies."""
    small_batches(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the bins."""
    return pack(with_pack_columns(docs), PACK_TOKENS)


STAGES = [
    ("language", language),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: Cross-parsing and best-fit search cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
