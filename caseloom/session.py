"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_TARGET_PARTITION_BYTES = 128 << 20
#: Map and reduce tasks make one block for each pair of them: beyond this many partitions their
#: number, not their size, is the cost, so partitions and splits grow instead.
_MOST_PARTITIONS = 40_000
_RUNTIME_CONF = {
    # The JVM never compiles methods over 8000 bytes of code. Wide cleaning projections exceed
    # that when fused; beyond the limit Spark evaluates them in small functions instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Settings that a running session still takes. Results do not depend on them."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, input_bytes: int | None = None,
                  **conf: str) -> SparkSession:
    """Session for a run. With ``input_bytes``, shuffles start at one partition per 128 MB, and at
    40,000 of them at most (adaptive execution merges what turns out small); scan splits grow so
    that a scan of the input has no more tasks than that either."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if input_bytes:
        partitions = min(_MOST_PARTITIONS, max(200, -(-input_bytes // _TARGET_PARTITION_BYTES)))
        split = max(_TARGET_PARTITION_BYTES, -(-input_bytes // _MOST_PARTITIONS))
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions)).config(
            "spark.sql.files.maxPartitionBytes", str(split))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine a local one is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="caseloom-"))
    return context._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, so far unused path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: what several jobs use is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
