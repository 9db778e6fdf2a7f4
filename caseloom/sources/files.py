"""Folder listings through the session's own file system layer."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _open(spark, path)
    return fs.exists(hadoop_path)


def partition_folders(spark: SparkSession, root: str, column: str) -> dict[str, str]:
    """Value -> folder of every ``column=value`` folder directly under the root."""
    hadoop_path, fs = _open(spark, root)
    prefix = f"{column}="
    found = {}
    for status in fs.listStatus(hadoop_path):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            found[unquote(name[len(prefix):])] = status.getPath().toString()
    return found


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Files with content directly in a folder, by name, without hidden ones."""
    hadoop_path, fs = _open(spark, folder)
    return sorted(
        s.getPath().toString()
        for s in fs.listStatus(hadoop_path)
        if s.isFile() and s.getLen() > 0 and not s.getPath().getName().startswith(("_", "."))
    )
