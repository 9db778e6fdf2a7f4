"""Tables in parts, silver and reports kept up from changes, against recomputing everything."""

import os
import random
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from caseloom.operators.deltas import apply_changes
from caseloom.operators.merge import upsert
from caseloom.operators.parts import key_part, upsert_parts
from caseloom.plans.clean import to_silver
from caseloom.plans.kept import KeptReports
from caseloom.plans.reports import monthly_summary, monthly_trends, regional_stats, trend_counts
from caseloom.plans.silver import (
    DIGEST, _of_first_places, cleaned_copies, part_of, read_silver, refresh_silver,
)
from caseloom.sources.sheets import read_bronze, write_sheets
from caseloom.sources.store import PART, TableStore


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def files(store, table):
    found = {}
    for part, entry in store.parts(table).items():
        folder = entry["path"].removeprefix("file:")
        found[part] = sorted((f, os.stat(os.path.join(folder, f)).st_mtime_ns) for f in os.listdir(folder))
    return found


def people(spark, names, number):
    return spark.createDataFrame([(f"c{k}", number + k) for k in names], "id string, number int")


def load(store, source, parts=32):
    merged, after, touched = upsert_parts(store, "people", source, "id", parts)
    every = rows(after)
    store.replace({}, {"people": (merged, touched)})
    assert rows(store.read("people")) == every
    return touched


def test_upsert_writes_touched_parts_only(spark, root):
    store = TableStore(spark, root)
    first, second = people(spark, range(200), 0), people(spark, [5, 7, 900], 1000)
    assert len(load(store, first)) == 32
    before = files(store, "people")
    touched = load(store, second)
    assert 1 <= len(touched) <= 3
    after = files(store, "people")
    assert {p for p in after if after[p] != before.get(p)} == set(touched)
    again = TableStore(spark, root)  # what the log says, without what the first instance knows
    assert rows(again.read("people")) == rows(upsert(first, second, "id"))
    assert {r[0] for r in again.read("people", touched).select(key_part(F.col("id"), 32)).collect()} \
        == set(touched)
    opened = again.read("people", touched).inputFiles()
    assert opened and all(any(f"{PART}={p}/" in f for p in touched) for f in opened)


def test_a_part_that_becomes_empty(spark, root):
    store = TableStore(spark, root)
    df = spark.createDataFrame([(1, "a"), (2, "b")], f"x int, {PART} string")
    store.replace({}, {"t": (df, ["a", "b"])})
    store.replace({}, {"t": (df.filter("x < 0"), ["a"])})
    assert rows(store.read("t")) == [(2,)] and list(store.parts("t")) == ["b"]
    store.replace({}, {"t": (df.filter("x < 0"), ["b"])})
    for reader in (store, TableStore(spark, root)):
        assert reader.exists("t") and reader.read("t").columns == ["x"] and reader.read("t").count() == 0
    with pytest.raises(ValueError):
        store.replace({}, {"t": (df, ["a"])})


def test_logs_written_before_there_were_parts(spark, root):
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{root}/old/1")
    spark.createDataFrame([(1, "old", f"{root}/old/1", 1)], "commit_id long, `table` string, path string, rows long") \
        .write.parquet(f"{root}/_commits")
    store = TableStore(spark, root)
    assert rows(store.read("old")) == [(1,)] and store.parts("old") == {}
    store.replace({"old": spark.createDataFrame([(2,)], "x int")})
    assert rows(TableStore(spark, root).read("old")) == [(2,)]


COMPLAINTS = ("customerId string, natureOfComplaint string, region string, status string, "
              "turnaroundTime int, logDate date")


def complaints(draw, count):
    import datetime

    some = lambda values: draw.choice(values)
    return [(some(["a", "b", "c", None]), some(["x", "y", None]), some(["R", "S", "Unknown", None]),
             some(["Resolved", "Closed", None]), some([None, 0, 3, 100]),
             some([None, datetime.date(2025, draw.randrange(1, 4), draw.randrange(1, 28))]))
            for _ in range(count)]


def test_reports_kept_up_by_changes(spark, root):
    draw, now = random.Random(2), []
    kept = KeptReports(TableStore(spark, root))
    frame = lambda data: spark.createDataFrame(data, COMPLAINTS) if data else None
    for step in range(4):
        new, gone = complaints(draw, 40), draw.sample(now, len(now) // 2)
        if step == 3:
            new, gone = [], [r for r in now if r[0] == "a"]  # a customer and its months go
        for r in gone:
            now.remove(r)
        now += new
        kept.change(frame(new), frame(gone))
        all_rows = spark.createDataFrame(now, COMPLAINTS)
        for got, want in ((kept.monthly_trends(), monthly_trends(all_rows)),
                          (kept.monthly_summary(), monthly_summary(all_rows)),
                          (kept.regional_stats(), regional_stats(all_rows))):
            assert got.columns == want.columns and rows(got) == rows(want)
    kept.change(None, frame(now))
    assert kept.monthly_trends().count() == 0 and kept.regional_stats().count() == 0
    kept.change()


def test_removing_what_was_not_there(spark):
    one = spark.createDataFrame(complaints(random.Random(1), 30), COMPLAINTS)
    with pytest.raises(Exception, match="more rows removed"):
        apply_changes(trend_counts(one), trend_counts, None, one.unionByName(one),
                      ("n", "days", "timed")).collect()


BRONZE = "sheet string, row_idx long, NAME string, REGION string, STATUS string, TAT string, `LOG DATE` string, \
`RESOLUTION DATE` string"


def sheet(draw, name, count):
    return [(name, k, *draw.choice([
        (None, None, None, None, None, None), ("ama", "Volta", "closed", "3", "2025-01-02", None),
        ("Ama ", "volta region", " CLOSED", "3.0", "2025-01-02", None),
        ("esi", None, "open", "-1", "2025-02-02", "2025-02-01"),
        (f"k{draw.randrange(4)}", "Oti Region", "open", None, None, "2025-01-01")])) for k in range(count)]


def test_silver_from_changed_sheets_equals_a_rebuild(spark, root):
    draw = random.Random(9)
    store = TableStore(spark, f"{root}/store")
    held, comments = {}, {}
    for changed in (["a", "b", "c d"], ["b"], ["a", "e"], ["c d"], ["b", "e"]):
        held |= {s: sheet(draw, s, draw.randrange(1, 12)) for s in changed}
        # The sheets that did not change cannot be read.
        shutil.rmtree(f"{root}/bronze", ignore_errors=True)
        new = spark.createDataFrame([r for s in changed for r in held[s]], BRONZE)
        comments |= {s: "e" in changed for s in changed}
        if "e" in changed:
            new = new.withColumn("COMMENT", F.when(F.col("row_idx") % 2 == 0, "more"))
        write_sheets(new, f"{root}/bronze")
        written = refresh_silver(store, read_bronze(spark, f"{root}/bronze", changed), changed)
        assert {part_of(s) for s in changed} <= set(written)
        every = spark.createDataFrame([r for data in held.values() for r in data], BRONZE)
        if "e" in held:
            every = every.withColumn("COMMENT", F.when((F.col("row_idx") % 2 == 0) & F.col("sheet").isin(
                [s for s in held if comments[s]]), "more"))
        got, want = read_silver(store), to_silver(every)
        assert rows(got) == rows(want)
    again = TableStore(spark, f"{root}/store")
    assert rows(read_silver(again)) == rows(want)



def test_first_silver_moves_only_rows_with_copies_elsewhere(spark):
    """Rows of digests that one sheet has alone are not shuffled."""
    data = [(b"a", "s2", 1, "x"), (b"a", "s1", 5, "x"), (b"b", "s2", 2, "y"), (b"c", None, None, "z")]
    rows_of = spark.createDataFrame(data, f"{DIGEST} binary, sheet string, row_idx long, value string")
    found = _of_first_places(rows_of)
    assert sorted((tuple(r) for r in found.select("sheet", "row_idx", "value").collect()), key=repr) == sorted(
        [("s1", 5, "x"), ("s2", 2, "y"), (None, None, "z")], key=repr)
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_blank_rows_of_sheets_go_after_the_aggregate(spark):
    """The condition is not pushed below the cleaning, where it would repeat it."""
    bronze = spark.createDataFrame(sheet(random.Random(1), "a", 5), BRONZE)
    plan = cleaned_copies(bronze)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Aggregate")


def test_a_large_part_of_customers_is_written_by_several_tasks(spark, root):
    from caseloom.plans.gold import load_gold
    from caseloom.plans.schema import COMPLAINTS as COMPLAINT_TABLE, CUSTOMERS

    customers = spark.range(0, 4000, 1, 8).select(*[
        (F.current_date() if c.name == "dateOfBirth" else F.substring(F.sha2(F.concat(F.col("id"), F.lit(c.name)), 256), 1, 20))
        .alias(c.name) for c in CUSTOMERS.columns])
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "20k")
    try:
        store = TableStore(spark, root)
        load_gold(store, customers, spark.createDataFrame([], COMPLAINT_TABLE.schema), parts=1)
    finally:
        spark.conf.set(size, before)
    assert store.read("customers").count() == 4000
    assert len([f for f, _ in files(store, "customers")["000000"] if f.endswith(".parquet")]) > 1
