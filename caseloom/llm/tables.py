"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows that travel to a Python worker at a time: documents can be long.
_BATCH_ROWS = "512"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def quoted(name: str) -> str:
    """A column's name as Spark reads it whole, dots included."""
    return "`" + name.replace("`", "``") + "`"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(identifier: Column, text: Column) -> Column:
    """128 bits that tell rows apart by identifier and whole text, nulls included."""
    said = F.concat(F.coalesce(identifier.cast("string"), F.lit("~")),
                    F.when(text.isNull(), F.lit(":0")).otherwise(F.lit(":1")),
                    F.coalesce(text, F.lit("")))
    return F.unhex(F.substring(F.sha2(F.encode(said, "utf-8"), 256), 1, 32))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that ``stored`` wrote and that nothing will read any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings for the actions inside."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at a time. Results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _BATCH_ROWS)
