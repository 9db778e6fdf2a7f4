"""WARC archives of pages, and capture histories merged from their indexes.

Writing: pages of equal payloads are found by digest; the one with the smallest identifier is a
response record, the others are revisit records that name it. Pages are dealt into volumes of about
``VOLUME_BYTES`` by a hash of identifier and digest; each volume is one gzip file of WARC/1.0
records, written by Spark's text sink, whose line separator is the blank lines that end a record.
Inside a volume the records are sorted by URL key, time and identifier: a local run of captures.

Reading: each volume is parsed from its start by the lengths its headers give, in one task; digests
of payloads are computed anew and must equal the header's.

Index merge: the index rows of all volumes are dealt into ranges of (URL key, time, identifier); in
each range a loser tree merges the sorted stretches of the volumes. The ranges in order hold the
captures of every URL in order of time.

Defined results: a null payload is empty; a null URL has an empty URL key and comes back as null;
line breaks in URLs are written percent-encoded and come back as they were; records without
identifier are responses; repeated rows are records of their own, all of the type that their
identifier gives; an empty table makes no archives. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.tables import ascii_lower, settings, stored

#: Bytes of payload in one archive, on average.
VOLUME_BYTES = 16 << 20
#: Payloads below this are always written whole.
LEAST_REVISIT = 100
_BREAK = "\r\n"
_INDEX = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string, url_key string, captured string, file string, "
          "ordinal long, offset long, length long")
_INDEX_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
                pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
_NAMES = [part.split()[0] for part in _INDEX.split(", ")]


def url_key(url: Column) -> Column:
    """Host labels in reverse, then the rest: sorts the pages of a site together."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), "^[^:/?#]*://", "")
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    after = F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1)
    return F.when(rest == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), after))


def revisits(rows: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """key, first_id of the rows that repeat the payload of a smaller identifier."""
    long = rows.filter(F.col("size") >= least)
    firsts = long.groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return long.join(firsts.drop("n"), "digest").filter("page_id > first_id") \
        .select("key", "first_id").distinct()


def write_archives(pages: DataFrame, root: str, identifier: str = "page_id", url: str = "url",
                   payload: str = "html", captured: Column | None = None,
                   volume_bytes: int = VOLUME_BYTES, least: int = LEAST_REVISIT) -> None:
    """Write volumes under ``root``. ``captured`` is the time of capture; without it, a time that
    rises by a second with the identifier."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload), F.lit(""))
    when = captured if captured is not None else F.timestamp_seconds(
        F.lit(1_704_067_200) + F.coalesce(F.col(identifier), F.lit(0)))
    digest = F.sha2(F.encode(body, "utf-8"), 256)
    key = F.concat_ws(":", F.coalesce(F.col(identifier).cast("string"), F.lit("~")), digest)
    size = F.octet_length(F.encode(body, "utf-8")).cast("long")
    thin = stored(pages.select(F.col(identifier).cast("long").alias("page_id"),
                               digest.alias("digest"), size.alias("size"), key.alias("key")),
                  "payload-keys")
    total = thin.agg(F.sum("size")).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    volumes = max(1, -(-total // (tasks * volume_bytes)))
    whole = pages.select(
        F.col(identifier).cast("long").alias("page_id"), F.col(url).alias("url"),
        body.alias("body"), digest.alias("digest"), size.alias("size"), key.alias("key"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
    ).repartition(tasks, "key")
    records = whole.join(revisits(thin, least), "key", "left")
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_BREAK)),
                                          F.lit(""))
    urn = lambda number: F.concat(F.lit("<urn:page:"), number.cast("string"), F.lit(">"))
    again = F.col("first_id").isNotNull()
    safe_url = F.replace(F.replace(F.replace(F.col("url"), F.lit("%"), F.lit("%25")),
                                   F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(f"WARC/1.0{_BREAK}"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:>"))),
        line("WARC-Date", F.col("captured")),
        line("WARC-Target-URI", safe_url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Refers-To", urn(F.col("first_id"))),
        line("X-URL-Key", F.hex(F.encode("url_key", "utf-8"))),
        line("X-Payload-Length", F.col("size").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(again, "0").otherwise(F.col("size").cast("string"))),
        F.lit(_BREAK),
        F.when(again, "").otherwise(F.col("body")),
    )
    # The first part is the task that a row is in, so no volume is written by two tasks.
    volume = F.pmod(F.hash("key"), F.lit(tasks)) * volumes + F.pmod(F.xxhash64("key"), F.lit(volumes))
    records.withColumn("volume", volume).withColumn("url_key", url_key(F.col("url"))) \
        .sortWithinPartitions("volume", "url_key", "captured", "page_id", "size") \
        .select("volume", record.alias("value")) \
        .write.partitionBy("volume").option("lineSep", _BREAK * 2) \
        .option("compression", "gzip").text(root)


def _unquoted(url: str | None) -> str | None:
    return url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Headers, payload, offset and length of each record of an archive."""
    offset = 0
    while line := stream.readline():
        if line != b"WARC/1.0\r\n":
            raise ValueError(f"no record at {offset}")
        used, headers = len(line), {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode("utf-8").partition(": ")
            headers[name] = value.removesuffix("\r\n")
            used += len(line)
        payload = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at {offset} has no end")
        used += 2 + len(payload) + 4
        yield headers, payload, offset, used
        offset += used


def _page_of(urn: str | None) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return int(number) if number else None


def _index_of(path: str, content: bytes) -> Iterator[tuple]:
    with gzip.open(io.BytesIO(content)) as stream:
        for ordinal, (headers, payload, offset, length) in enumerate(parse_records(stream)):
            digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"]
            size = int(headers["X-Payload-Length"])
            if kind == "response":
                if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                    raise ValueError(f"{path}: payload at {offset} is damaged")
            yield (_page_of(headers["WARC-Record-ID"]), size, digest, kind,
                   _page_of(headers.get("WARC-Refers-To")), _unquoted(headers.get("WARC-Target-URI")),
                   bytes.fromhex(headers["X-URL-Key"]).decode("utf-8"), headers["WARC-Date"], path,
                   ordinal, offset, length)


def _batches(rows: Iterator[tuple], size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    make = lambda: pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*held), _INDEX_TYPES)], names=_NAMES)
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield make()
            held = []
    if held:
        yield make()


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """One index row per record of the archives under ``root``."""
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from _batches(_index_of(path.as_py(), content.as_py()))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz") \
        .option("recursiveFileLookup", "true").load(root).select("path", "content")
    # A volume is several megabytes: few are handed over at a time.
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}):
        return stored(files.mapInArrow(parsed, _INDEX), "capture-index")


class LoserTree:
    """Merges sorted lists: each step replays one path from a leaf to the root."""

    def __init__(self, runs: list[list], key: Callable):
        self._runs, self._key = runs, key
        self._at = [0] * len(runs)
        self._heads = [self._head(k) for k in range(len(runs))]
        self._losers = [-1] * len(runs)
        self._winner = -1
        for k in range(len(runs)):
            self._replay(k)

    def _head(self, run: int) -> tuple:
        """Exhausted runs come last; runs with equal keys keep their order."""
        if self._at[run] == len(self._runs[run]):
            return (1,)
        return (0, self._key(self._runs[run][self._at[run]]), run)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + len(self._runs)) // 2
        while node > 0:
            other = self._losers[node]
            if other < 0:  # while the tree is built: wait here for the other side
                self._losers[node] = winner
                return
            if self._heads[other] < self._heads[winner]:
                self._losers[node], winner = winner, other
            node //= 2
        self._winner = winner

    def __iter__(self) -> Iterator:
        if not self._runs:
            return
        for _ in range(sum(map(len, self._runs))):
            run = self._winner
            yield self._runs[run][self._at[run]]
            self._at[run] += 1
            self._heads[run] = self._head(run)
            self._replay(run)


def _capture_key(row: tuple) -> tuple:
    return row[6], row[7], -1 if row[0] is None else row[0], row[1]


def merge_histories(index: DataFrame) -> DataFrame:
    """The index in global order of URL key, time and identifier: partition after partition."""
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                runs.setdefault(row[8], []).append(row)
        yield from _batches(iter(LoserTree(list(runs.values()), _capture_key)))

    ranges = index.repartitionByRange("url_key", "captured", "page_id")
    return ranges.sortWithinPartitions("file", "ordinal").mapInArrow(merged, _INDEX)
