"""Tables that are replaced as a whole, by parts, or appended to, on plain Parquet files.

A replaced table is written to a folder of its own; an entry in the commit log then makes it
current. One log append can hold several tables, and readers see all of them change or none.
A table in parts has an entry for each part: a commit writes and names the parts that change, and
the entries of the others carry their files over as they are. Folders that no entry names are leftovers
of failed runs and are never read. One writer at a time, as runs are scheduled one at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, DataFrameReader, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.sources.files import partition_folders, path_exists

_LOG_SCHEMA = T.StructType([
    T.StructField("commit_id", T.LongType()),
    T.StructField("table", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("part", T.StringType()),
])
#: Column whose values name the parts of a table in parts.
PART = "store_part"


def _read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


class TableStore:
    """Tables under one root folder. The log is read once; as the only writer, an instance
    knows what it has committed since."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._entries: dict[str, dict[str | None, Row]] | None = None
        self._schemas: dict[str, T.StructType] = {}

    def current(self) -> dict[str, dict[str | None, Row]]:
        """Latest entries of each table: one, or one for each part that has rows."""
        if self._entries is None:
            log = _read_if_present(self.spark, f"{self.root}/_commits", _LOG_SCHEMA)
            latest = [] if log is None else (
                log.groupBy("table", "part")
                .agg(F.max(F.struct("commit_id", "path", "rows")).alias("e")).collect()
            )
            self._entries = {}
            for row in latest:
                self._entries.setdefault(row["table"], {})[row["part"]] = row["e"]
        return self._entries

    def exists(self, table: str) -> bool:
        return table in self.current()

    def parts(self, table: str) -> dict[str, Row]:
        """Part -> its entry (commit_id, path, rows), without parts that have no rows."""
        return {p: e for p, e in self.current().get(table, {}).items() if p is not None and e["rows"]}

    def read(self, table: str, parts: Collection[str] | None = None) -> DataFrame:
        """A table, or only the given ones of its parts, with their columns aligned by name. Other
        parts are not opened."""
        entries = self.current().get(table)
        if entries is None:
            raise FileNotFoundError(f"table {table} has never been written in {self.root}")
        if None in entries:
            return self._reader(entries[None]["path"]).parquet(entries[None]["path"])
        wanted = [e for p, e in self.parts(table).items() if parts is None or p in parts]
        if not wanted:
            some = next(iter(entries.values()))["path"]
            return self.spark.createDataFrame([], self._schemas.get(some) or self.spark.read.parquet(some).schema)
        schemas = {self._schemas[e["path"]].json(): self._schemas[e["path"]] for e in wanted
                   if e["path"] in self._schemas}
        known = len(schemas) == 1 and all(e["path"] in self._schemas for e in wanted)
        reader = self.spark.read.schema(*schemas.values()) if known else \
            self.spark.read.option("mergeSchema", "true")
        return reader.parquet(*[e["path"] for e in wanted])

    def _reader(self, path: str) -> DataFrameReader:
        return self.spark.read.schema(self._schemas[path]) if path in self._schemas else self.spark.read

    def replace(self, tables: Mapping[str, DataFrame],
                parts: Mapping[str, tuple[DataFrame, Collection[str]]] | None = None) -> dict[str, int]:
        """Write all tables, then make them current together. Returns their row counts, taken while
        writing.

        ``parts`` has, by table, a frame with the column ``PART`` and the parts it replaces: those
        become what the frame holds of them, which may be nothing.
        """
        commit_id = 1 + max((e["commit_id"] for entries in self.current().values()
                             for e in entries.values()), default=0)
        made: dict[str, dict[str | None, Row]] = {}
        counts = {}
        for table, df in tables.items():
            path = f"{self.root}/{table}/{uuid.uuid4().hex}"
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
            made[table] = {None: Row(commit_id=commit_id, path=path, rows=seen.get["rows"])}
            counts[table] = seen.get["rows"]
            self._schemas[path] = df.schema
        for table, (df, replaced) in (parts or {}).items():
            made[table] = self._write_parts(table, df, set(replaced), commit_id)
            counts[table] = sum(e["rows"] for e in made[table].values())
        log = [(e["commit_id"], table, e["path"], e["rows"], part)
               for table, entries in made.items() for part, e in entries.items()]
        self.spark.createDataFrame(log, _LOG_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.root}/_commits"
        )
        for table, entries in made.items():
            self.current().setdefault(table, {}).update(entries)
        return counts

    def _write_parts(self, table: str, df: DataFrame, replaced: set[str],
                     commit_id: int) -> dict[str | None, Row]:
        """Entries of the replaced parts, each a sub-folder of one new folder."""
        path = f"{self.root}/{table}/{uuid.uuid4().hex}"
        df.write.partitionBy(PART).parquet(path)
        schema = T.StructType([f for f in df.schema.fields if f.name != PART])
        folders = partition_folders(self.spark, path, PART)
        if unexpected := set(folders) - replaced:
            raise ValueError(f"rows of parts that are not replaced: {sorted(unexpected)[:5]}")
        rows: dict[str, int] = {}
        if folders:
            stored = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.StringType())]))
            rows = {r[PART]: r["n"] for r in stored.parquet(path).groupBy(PART)
                    .agg(F.count(F.lit(1)).alias("n")).collect()}
        for folder in folders.values():
            self._schemas[folder] = schema
        some = next(iter(folders.values()), path)
        if not folders:  # nothing is left, but the columns are
            self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        self._schemas[some] = schema
        return {part: Row(commit_id=commit_id, path=folders.get(part, some), rows=rows.get(part, 0))
                for part in replaced}

    def append(self, table: str, df: DataFrame) -> int:
        """Add rows to an append-only table."""
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(
            f"{self.root}/{table}"
        )
        return seen.get["rows"]

    def read_appended(self, table: str, schema: T.StructType) -> DataFrame:
        """An append-only table, empty before its first rows."""
        found = _read_if_present(self.spark, f"{self.root}/{table}", schema)
        return self.spark.createDataFrame([], schema) if found is None else found
