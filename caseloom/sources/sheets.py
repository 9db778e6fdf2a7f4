"""Scanning a source folder with one sub-folder ``sheet=NAME`` per sheet.

All columns are read as text: sheets disagree about types, and cleaning decides them. Files, not
sheets, are grouped by their header or schema, so no file lends its columns to another.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators.joins import lookup_join
from caseloom.session import scratch_path
from caseloom.sources.csv_splits import (
    is_splittable, list_files, put_together, read_header, records,
)
from caseloom.sources.files import data_files, partition_folders, path_exists

POSITION = "row_idx"
# An empty cell is null, a quoted empty one is the empty string. Cells may hold line breaks.
_CSV_OPTIONS = {"nullValue": "\\N", "emptyValue": "", "escape": '"',
                "multiLine": "true"}
CSV_WRITE_OPTIONS = {
    "header": "true", "nullValue": "", "emptyValue": '""', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
_FILE, _AT, _PART, _TEXT = "__file", "__at", "__part", "__text"


@contextmanager
def _text_partitions(spark: SparkSession) -> Iterator[None]:
    """Sheet names such as ``2025`` or ``2025-01-01`` stay text."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def list_sheets(spark: SparkSession, root: str, exclude: Sequence[str] = ()) -> dict[str, str]:
    """Sheet name -> its folder, without the excluded sheets. Opens no file."""
    if not path_exists(spark, root):
        raise FileNotFoundError(f"no source folder at {root}")
    folders = partition_folders(spark, root, "sheet")
    return {s: folders[s] for s in sorted(folders) if s not in set(exclude)}


def _reader(spark: SparkSession, fmt: str, root: str):
    return spark.read.format(fmt).option("basePath", root)


def _column_names(header: str) -> list[str]:
    """Names in a header; empty and repeated ones are told apart by their place."""
    names: list[str] = []
    for place, name in enumerate(next(csv.reader(io.StringIO(header, newline="")))):
        taken = {n.lower() for n in names}
        names.append(name if name and name.lower() not in taken else f"{name or '_c'}{place}")
    return names


def _parsed_csv(spark: SparkSession, root: str, files: Sequence[str]) -> list[DataFrame]:
    """Cells of CSV files, parsed once into Parquet in the shared folder, with the number of each row's
    file and its place in the file. The files of each header are one scan.

    Of every file only the header is read first. Files that Spark may split are read twice.
    """
    listed = list_files(spark, files)
    with ThreadPoolExecutor(32) as pool:
        headers = list(pool.map(lambda f: read_header(spark, f[0]), listed))
    groups: dict[tuple[tuple[str, ...], bool], dict[int, tuple[int, str]]] = {}
    for number, ((path, key, length), header) in enumerate(zip(listed, headers)):
        if header is not None:
            kind = tuple(_column_names(header)), is_splittable(spark, length)
            groups.setdefault(kind, {})[key] = number, unquote(path)
    return [_parsed_group(spark, root, names, large, members)
            for (names, large), members in sorted(groups.items())]


def _parsed_group(spark: SparkSession, root: str, names: Sequence[str], large: bool,
                  members: dict[int, tuple[int, str]]) -> DataFrame:
    schema = ", ".join(f"{_quoted(n)} string" for n in names)
    cells = F.from_csv("record", schema, _CSV_OPTIONS)
    found = records(spark, root, [path for _, path in members.values()],
                    {key: number for key, (number, _) in members.items()}, large)
    body = found.filter("at >= 0")  # without headers
    path = scratch_path(spark, "parsed-sheets")
    body.select(
        F.when(F.col("whole"), cells).alias("cells"), F.col("file").alias(_FILE), F.col("at").alias(_AT),
        F.col("part").alias(_PART), F.when(~F.col("whole"), F.col("record")).alias(_TEXT), "sheet",
    ).write.partitionBy("sheet").parquet(path)
    kept = spark.read.schema(
        f"cells struct<{schema.replace(' string', ': string')}>, {_FILE} int, {_AT} long, {_PART} long, "
        f"{_TEXT} string, sheet string").parquet(path)
    place = [F.col(f"cells.{_quoted(n)}").alias(n) for n in names] + ["sheet", _FILE, _AT]
    whole = kept.filter(F.col(_TEXT).isNull()).select(*place)
    if not large:
        return whole
    pieces = kept.filter(F.col(_TEXT).isNotNull()).select(
        F.col(_FILE).alias("file"), F.col(_AT).alias("at"), F.col(_PART).alias("part"),
        F.col(_TEXT).alias("record"), "sheet")
    return whole.unionByName(put_together(pieces).select(
        cells.alias("cells"), F.col("file").alias(_FILE), F.col("at").alias(_AT), "sheet").select(*place))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _typed_scans(spark: SparkSession, fmt: str, root: str,
                 files: Sequence[str]) -> list[DataFrame]:
    """One scan if all schemas merge, else one for the files of each schema."""
    try:
        return [_reader(spark, fmt, root).option("mergeSchema", "true").load(list(files))]
    except (PySparkException, Py4JJavaError):  # the conflict comes out of a job in either class
        with ThreadPoolExecutor(8) as pool:
            schemas = list(pool.map(lambda f: _reader(spark, fmt, root).load(f).schema, files))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for file, schema in zip(files, schemas):
        groups.setdefault(schema.json(), (schema, []))[1].append(file)
    return [_reader(spark, fmt, root).schema(schema).load(group)
            for schema, group in groups.values()]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _with_place(scan: DataFrame) -> DataFrame:
    """Text columns with the file of each row and its place in the order of the file."""
    placed = scan.select("*", F.col("_metadata.file_path").alias(_FILE),
                         F.col("_metadata.row_index").alias(_AT))
    return stringify(placed, keep=(_AT,))


def _numbered(placed: DataFrame) -> DataFrame:
    """Number the rows of each sheet in file order: rows in the files before, plus the place.

    ``placed`` must give the same places each time it is read.
    """
    columns = [c for c in placed.columns if c not in (_FILE, _AT)]
    files = placed.groupBy("sheet", _FILE).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(_AT).alias("__first"))
    earlier = (
        Window.partitionBy("sheet").orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = files.select(_FILE, (
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first")
    ).alias("__shift"))
    path = scratch_path(placed.sparkSession, "file-offsets")
    shifts.write.parquet(path)
    shifts = placed.sparkSession.read.schema(shifts.schema).parquet(path)
    known = F.coalesce(F.col("__shift"), F.raise_error(F.concat(
        F.lit("no row offset for "), F.col(_FILE))).cast("long"))
    return lookup_join(placed, shifts, _FILE, "left").select(
        *columns, (F.col(_AT) + known).alias(POSITION))


def stringify(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column as text; null stays null."""
    return df.select(
        *[F.col(f"`{c}`") if c in keep else F.col(f"`{c}`").cast("string").alias(c)
          for c in df.columns]
    )


def scan_sheets(spark: SparkSession, root: str, fmt: str = "parquet",
                exclude: Sequence[str] = (), only: Sequence[str] | None = None,
                position: str | None = None) -> DataFrame:
    """All sheets as one text frame with ``sheet`` and the row position.

    Files of the same header share one scan; columns are aligned by name and absent ones are null.
    Excluded sheets are not even opened; with nothing left, or only empty files, the frame is empty.
    ``position`` names a source column that already holds the row position. CSV is parsed once into
    Parquet in the shared folder, large files by many tasks each.
    """
    sheets = list_sheets(spark, root, exclude)
    if only is not None:
        sheets = {s: f for s, f in sheets.items() if s in set(only)}
    with ThreadPoolExecutor(8) as pool:
        files = [f for part in pool.map(lambda d: data_files(spark, d), sheets.values())
                 for f in part]
    scans: list[DataFrame] = []
    if files:
        with _text_partitions(spark):
            scans = (_parsed_csv(spark, root, files) if fmt == "csv"
                     else _typed_scans(spark, fmt, root, files))
    if not scans:
        return spark.createDataFrame([], f"sheet string, {POSITION} long")
    if position is not None:
        named = [stringify(scan.drop(_FILE, _AT).withColumnRenamed(position, POSITION))
                 for scan in scans]
        return _union(named).withColumn(POSITION, F.col(POSITION).cast("long"))
    return _numbered(_union(scans if fmt == "csv" else [_with_place(scan) for scan in scans]))


def write_sheets(df: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Write sheets, replacing exactly the sheets present in ``df``.

    No shuffle: a scan task reads one sheet's file and writes to that sheet's folder, so a
    sheet with a large part of the rows stays spread over many tasks.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.options(**CSV_WRITE_OPTIONS)
    writer.partitionBy("sheet").format(fmt).save(root)


def read_bronze(spark: SparkSession, root: str, sheets: Sequence[str] | None = None) -> DataFrame:
    """All landed sheets, or the given ones only, columns aligned by name, absent ones null."""
    folders = [root]
    if sheets is not None:
        landed = partition_folders(spark, root, "sheet")
        folders = [landed[s] for s in sheets]
    with _text_partitions(spark):
        return spark.read.option("mergeSchema", "true").option("basePath", root).parquet(*folders)


def spread_scan(scan: DataFrame, *keys: str, tasks_per_core: int = 1) -> DataFrame:
    """A file scan with fewer splits than the session has cores, spread over all of them by
    hash of the keys. Any larger scan stays as it is. Rows that are narrow to read but costly to work on
    take several tasks for each core: with a few more tasks than cores most cores wait for the last ones."""
    tasks = tasks_per_core * scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= tasks else scan.repartition(tasks, *keys)
