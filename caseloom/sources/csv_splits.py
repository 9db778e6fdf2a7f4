"""CSV files with line breaks in cells, read by many tasks each.

Whether a line break ends a record depends on all quotes before it, so a task that starts inside a
file cannot tell. Each split is therefore followed once for both cases, starting outside and inside a
quoted cell: it gives the case it ends in and the records that begin in it. Composed along the splits of
a file these say how every split really starts, and the number of its first record. The second reading
cuts records by that; the lines of a record that goes over a split's end are put together from the
pieces. Files too small to be split are read once only.

Records end with a line feed, with or without a carriage return before it; line breaks inside quoted cells
stay as they are. Empty lines between records are skipped. A quote inside a cell that does not begin with
one is a character like others. A quote that is never closed takes the rest of its file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LINE = "file long, block long, value string"
_ENDS = "file long, block long, inside boolean, ends_inside boolean, records long"
_RECORD = "file int, at long, part long, whole boolean, sheet string, record string"
_RECORD_SCHEMA = pa.schema([("file", pa.int32()), ("at", pa.int64()), ("part", pa.int64()),
                            ("whole", pa.bool_()), ("sheet", pa.string()), ("record", pa.string())])


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of a line that starts outside or inside of one."""
    at = 0
    if '"' not in line:
        return inside
    while True:
        if inside:
            close = line.find('"', at)
            if close < 0:
                return True
            if line.startswith('"', close + 1):  # a doubled quote stands for one
                at = close + 2
                continue
            at = close + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        # Outside quotes: what is left of the cell, up to the next one.
        comma = line.find(",", at)
        if comma < 0:
            return False
        inside, at = False, comma + 1


def _is_blank(line: str) -> bool:
    return line in ("", "\r")


@dataclass(frozen=True)
class SplitStart:
    """How a split starts, and the number in its file of the first record that begins in it."""

    inside: bool = False
    record: int = 0


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both cases of each split: how it ends and how many records begin in it."""
    now, inside, records = None, [False, True], [0, 0]

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]] * 2, pa.int64()), pa.array([now[1]] * 2, pa.int64()),
             pa.array([False, True]), pa.array(inside), pa.array(records, pa.int64())],
            names=["file", "block", "inside", "ends_inside", "records"])

    for batch in batches:
        for file, block, line in zip(*(batch[c].to_pylist() for c in ("file", "block", "value"))):
            if (file, block) != now:
                if now is not None:
                    yield done()
                now, inside, records = (file, block), [False, True], [0, 0]
            blank = _is_blank(line)
            for case in (0, 1):
                records[case] += not (inside[case] or blank)
                inside[case] = ends_inside(line, inside[case])
    if now is not None:
        yield done()


def compose(ends: Sequence[tuple[int, int, bool, bool, int]]) -> dict[tuple[int, int], SplitStart]:
    """How every split (file, block) starts, from (file, block, inside, ends inside, records)."""
    cases = {(file, block, inside): (after, records) for file, block, inside, after, records in ends}
    starts: dict[tuple[int, int], SplitStart] = {}
    last, inside, record = None, False, 0
    for file, block in sorted({(file, block) for file, block, *_ in ends}):
        if file != last:
            last, inside, record = file, False, 0
        starts[file, block] = SplitStart(inside, record)
        inside, records = cases[file, block, inside]
        record += records
    return starts


def _cut(batches: Iterator[pa.RecordBatch], numbers: dict[int, int],
         starts: dict[tuple[int, int], SplitStart] | None) -> Iterator[pa.RecordBatch]:
    """Records, and the pieces of those that go over the end of a split. The first record of a file,
    its header, is number -1."""
    now, inside, at, held, sheet = None, False, -1, [], None
    cut_start = False  # whether the open record began in an earlier split
    rows: list[tuple] = []

    def flush(whole: bool) -> None:
        nonlocal held, cut_start
        text = "\n".join(held)
        if whole:
            text = text.removesuffix("\r")
        rows.append((numbers[now[0]], at, now[1], whole and not cut_start, sheet, text))
        held, cut_start = [], False

    def batch_of() -> pa.RecordBatch:
        nonlocal rows
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), _RECORD_SCHEMA.types)], schema=_RECORD_SCHEMA)
        rows = []
        return out

    for batch in batches:
        for file, block, line, of_sheet in zip(
                *(batch[c].to_pylist() for c in ("file", "block", "value", "sheet"))):
            if (file, block) != now:
                if held:
                    flush(False)
                start = SplitStart() if starts is None else starts[file, block]
                now, inside, at, sheet = (file, block), start.inside, start.record - 2, of_sheet
                cut_start = inside
            if not inside:
                if _is_blank(line):
                    continue
                at += 1
            held.append(line)
            inside = ends_inside(line, inside)
            if not inside:
                flush(True)
        if rows:
            yield batch_of()
    if held:
        flush(False)
    if rows:
        yield batch_of()


def _lines(spark: SparkSession, root: str, files: Sequence[str]) -> DataFrame:
    return spark.read.option("basePath", root).option("lineSep", "\n").text(list(files)).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value", F.col("sheet").cast("string"))


def list_files(spark: SparkSession, files: Sequence[str]) -> list[tuple[str, int, int]]:
    """(path, key, length) of files by path; the key is what ``records`` knows a file by. Opens none."""
    found = sorted(tuple(r) for r in spark.read.format("binaryFile").load(list(files)).select(
        "_metadata.file_path", F.xxhash64("_metadata.file_path"), "length").collect())
    if len({key for _, key, _ in found}) < len(found):
        raise ValueError("two files have the same hash of their paths")
    return found


def records(spark: SparkSession, root: str, files: Sequence[str], numbers: dict[int, int],
            splittable: bool) -> DataFrame:
    """Records of files under their ``numbers`` (by key): file, at (the header is -1), part, whole, sheet,
    record. To be read at once and with the settings that now hold, as these decide the splits.

    The starts of the splits go through the driver: 25 bytes for each split of a file.
    """
    lines = _lines(spark, root, files)
    starts = None
    if splittable:
        ends = lines.select("file", "block", "value").mapInArrow(_follow, _ENDS).collect()
        starts = compose([tuple(r) for r in ends])
    shared = spark.sparkContext.broadcast((numbers, starts))
    return lines.mapInArrow(lambda batches: _cut(batches, *shared.value), _RECORD)


def put_together(pieces: DataFrame) -> DataFrame:
    """Records whose pieces (file, at, part, record and whatever else) are in several splits."""
    same = [c for c in pieces.columns if c not in ("part", "record", "at", "file")]
    ordered = F.array_sort(F.collect_list(F.struct("part", "record")))
    joined = F.array_join(F.transform(ordered, lambda p: p["record"]), "\n")
    return pieces.groupBy("file", "at").agg(
        F.regexp_replace(joined, "\r$", "").alias("record"), *[F.first(c).alias(c) for c in same])


def is_splittable(spark: SparkSession, length: int) -> bool:
    """Whether Spark may cut a file of so many bytes. It never cuts below these sizes."""
    units = spark._jvm.org.apache.spark.network.util.JavaUtils
    return length > min(units.byteStringAsBytes(spark.conf.get(f"spark.sql.files.{name}"))
                        for name in ("openCostInBytes", "maxPartitionBytes"))


def read_header(spark: SparkSession, file: str, line_limit: int = 10_000) -> str | None:
    """The first record of a file, of which no more is read than that. None if it has none."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
        stream, jvm.java.nio.charset.StandardCharsets.UTF_8))
    try:
        held: list[str] = []
        for _ in range(line_limit):
            line = reader.readLine()
            if line is None:
                break
            line = line.removeprefix("﻿") if not held else line
            if not held and _is_blank(line):
                continue
            held.append(line)
            if not ends_inside("\n".join(held), False):
                break
        else:
            raise ValueError(f"the header of {file} does not end within {line_limit} lines")
        return "\n".join(held) if held else None
    finally:
        reader.close()
