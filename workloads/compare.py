"""Run queries and their checks side by side: ``python -m workloads.compare SF_DIR [NAME ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa

from caseloom.session import build_session
from workloads.catalogue import QUERIES
from workloads.checks import CHECKS

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def rows(table: pa.Table) -> list[str]:
    """Order-free text form, columns by name."""
    columns = sorted(table.column_names)
    values = zip(*[table[c].to_pylist() for c in columns])
    return sorted(repr(row) for row in values)


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """None if query and check agree, else what differs."""
    got = QUERIES[name](spark, sf_dir).toArrow()
    if name not in CHECKS:
        return None
    want = connection.execute(CHECKS[name]).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} / {sorted(want.column_names)}"
    a, b = rows(got), rows(want)
    if a == b:
        return None
    left, right = set(a) - set(b), set(b) - set(a)
    return f"{len(a)} / {len(b)} rows, e.g. {sorted(left)[:2]} / {sorted(right)[:2]}"


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found = difference(spark, connection, name, sf_dir)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if found is None else found}",
              flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
