"""Exact deduplication as a stateful stream.

The keys of the documents (digest, identifier, locator) are landed in the shared folder and read
as a stream. Its state is keyed by digest, kept on disk by the RocksDB state store and never
expires: per digest the largest identifier so far, the locator of that document's content, and
the number of rows. Rows of one digest combine before the shuffle, so a text with a third of all
copies sends one row per task. Given the same ``root`` again, a further run goes on from the state
of the last and sees earlier documents.

Where a digest was hit twice, the full texts are compared: rows of the hit digests are grouped by
digest and whole text. If one digest stands for different texts, its rows are classed by text.

Texts are equal when identical after lower-casing A-Z. Defined results: a null text counts as
empty; rows that repeat both identifier and text are one document, given once with its number of
``copies``; the largest identifier stays, null being smaller than all; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.tables import ascii_lower, fresh, quoted, settings, stored
from caseloom.session import scratch_path

_LANDED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("digest", T.StringType()),
    T.StructField("copies", T.LongType()), T.StructField("file", T.StringType()),
])
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Else every partition's store reserves megabytes for its log, however small it is.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return F.encode(ascii_lower(F.coalesce(text, F.lit(""))), "utf-8")


def sha256(body: Column) -> Column:
    return F.sha2(body, 256)


def _absorb(spark: SparkSession, root: str, files_per_trigger: int | None) -> DataFrame:
    """Run all landed files through the stream; the state as a stored table."""
    reader = spark.readStream.schema(_LANDED)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    keyed = reader.parquet(f"{root}/landed/*").groupBy("digest").agg(
        F.max(F.struct("doc_id", "file")).alias("newest"), F.sum("copies").alias("rows"))
    with settings(spark, _STATE_CONF):
        stream = (
            keyed.writeStream.outputMode("update").format("noop")
            .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
        )
        stream.awaitTermination()
        state = spark.read.format("statestore").load(f"{root}/state")
        newest, rows = state.schema["value"].dataType.names  # the buffers of the two aggregates
        return stored(state.select(
            F.col("key")["digest"].alias("digest"),
            F.col("value")[newest]["doc_id"].alias("keep_id"),
            F.col("value")[newest]["file"].alias("keep_file"),
            F.col("value")[rows].alias("group_size"),
        ), "dedup-state")


def streaming_dedup(docs: DataFrame, identifier: str = "doc_id", text: str = "text",
                    root: str | None = None, files_per_trigger: int | None = None,
                    digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document of ``docs``: doc_id, digest, copies, keep_id, keep_file, group_size,
    kept, text_sha256."""
    spark = docs.sparkSession
    root = root or scratch_path(spark, "dedup")
    body = normalised(F.col(text))
    whole = docs.select(
        F.col(identifier).cast("long").alias("doc_id"), body.alias("body"),
        digest(body).alias("digest"),
    )
    landing = scratch_path(spark, "batch").rpartition("/")[2]
    (docs.select(F.col(identifier).cast("long").alias("doc_id"), digest(body).alias("digest"),
                 F.input_file_name().alias("file"))
     .groupBy("doc_id", "digest", "file").agg(F.count(F.lit(1)).alias("copies"))
     .select("doc_id", "digest", "copies", "file").write.parquet(f"{root}/landed/{landing}"))
    rows = stored(
        spark.read.schema(_LANDED).parquet(f"{root}/landed/{landing}")
        .groupBy("doc_id", "digest").agg(F.sum("copies").alias("copies")), "dedup-rows")
    state = _absorb(spark, root, files_per_trigger)
    hits = state.filter("group_size > 1").select("digest")
    texts = (
        whole.join(hits, "digest", "left_semi").groupBy("digest", "body")
        .agg(F.max("doc_id").alias("text_keep"), F.count(F.lit(1)).alias("text_size"))
    )
    checked = stored(texts.select(
        "digest", F.sha2("body", 256).alias("text_sha256"), "text_keep", "text_size"), "dedup-texts")
    clashes = checked.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")

    classed = rows.join(state, "digest")
    clean = classed.withColumn(
        "text_sha256", F.col("digest") if digest is sha256 else F.lit(None).cast("string"))
    if not clashes.isEmpty():
        clashing = whole.join(clashes.select("digest"), "digest", "left_semi").select(
            "doc_id", "digest", F.sha2("body", 256).alias("text_sha256"))
        split = (
            clashing.groupBy("doc_id", "digest", "text_sha256")
            .agg(F.count(F.lit(1)).alias("copies"))
            .join(checked, ["digest", "text_sha256"])
            .select("digest", "doc_id", "copies", F.col("text_keep").alias("keep_id"),
                    F.lit(None).cast("string").alias("keep_file"),
                    F.col("text_size").alias("group_size"), "text_sha256")
        )
        clean = clean.join(clashes, "digest", "left_anti").select(*split.columns).unionByName(split)
    if digest is not sha256:
        hashes = whole.select("doc_id", "digest", F.sha2("body", 256).alias("sha")).distinct()
        clean = clean.join(
            hashes, (clean["digest"] == hashes["digest"])
            & clean["doc_id"].eqNullSafe(hashes["doc_id"])
            & F.coalesce(clean["text_sha256"] == hashes["sha"], F.lit(True)),
        ).select(clean["doc_id"], clean["digest"], "copies", "keep_id", "keep_file", "group_size",
                 hashes["sha"].alias("text_sha256"))
    return clean.select(
        "doc_id", "digest", "copies", "keep_id", "keep_file", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def keep_documents(docs: DataFrame, judged: DataFrame, identifier: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose document stays, each once, with all their columns, whatever their
    names are."""
    key = lambda i, d: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("~")), d)
    of_row, copies = fresh(docs, "document_key"), fresh(docs, "document_copies")
    stay = judged.filter("kept").select(
        key(F.col("doc_id"), F.col("digest")).alias(of_row), F.col("copies").alias(copies))
    keyed = docs.withColumn(of_row, key(F.col(identifier), sha256(normalised(F.col(text)))))
    joined = keyed.join(stay, of_row)
    kept = joined.filter(F.col(copies) == 1)
    if not stay.filter(F.col(copies) > 1).isEmpty():
        kept = kept.unionByName(joined.filter(F.col(copies) > 1).dropDuplicates([of_row]))
    return kept.select(*[F.col(quoted(c)) for c in docs.columns])
