import random

import pytest
from caseloom.llm.warc import LoserTree, merge_histories, read_index, url_key, write_archives
from caseloom.session import scratch_path
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, html string, digest string, volume int, value string"


def round_trip(spark, rows, **options):
    df = spark.createDataFrame([(*r, "d", 1, "v") for r in rows], SCHEMA)
    root = scratch_path(spark, "warc-test")
    write_archives(df, root, **options)
    return merge_histories(read_index(spark, root)).collect()


@pytest.mark.parametrize("runs", [[], [[]], [[3]], [[1, 1], [], [1]], [[]] * 5])
def test_loser_tree_small(runs):
    assert list(LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_loser_tree_equals_sorting():
    draw = random.Random(4)
    for k in range(1, 40):
        runs = [sorted(draw.choices(range(50), k=draw.randrange(30))) for _ in range(k)]
        assert list(LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_records_come_back_in_global_order(spark):
    draw = random.Random(6)
    bodies = ["é" * 60, "x" * 99, "x" * 100, "WARC/1.0\r\n\r\n" * 20, "", None, "y\r\n\r\n" * 40]
    rows = [(i, f"http://{draw.choice('abc')}.com/{draw.randrange(9)}", draw.choice(bodies))
            for i in range(300)]
    got = round_trip(spark, rows, volume_bytes=2000)
    assert len({r.file for r in got}) > 8
    keys = [(r.url_key, r.captured, r.page_id) for r in got]
    assert keys == sorted(keys) and len(keys) == 300
    first = {}
    for i, _, html in rows:
        first.setdefault(html or "", i)
    by = {r.page_id: r for r in got}
    for i, url, html in rows:
        size = len((html or "").encode())
        repeats = size >= 100 and first[html] < i
        assert (by[i].url, by[i].payload_bytes) == (url, size)
        assert by[i].record_type == ("revisit" if repeats else "response")
        assert by[i].refers_to == (first[html] if repeats else None)


def test_nulls_repeats_breaks_and_empty(spark):
    rows = [(1, None, "z" * 200), (1, None, "z" * 200), (None, "a\r\nb%0Ac", "z" * 200),
            (2, "http://u.com/", "z" * 200), (3, "", None), (4, "http://u.com/", "q" * 300_000)]
    got = sorted(round_trip(spark, rows), key=lambda r: (r.page_id is None, r.page_id))
    assert [(r.page_id, r.record_type, r.refers_to) for r in got] == [
        (1, "response", None), (1, "response", None), (2, "revisit", 1), (3, "response", None),
        (4, "response", None), (None, "response", None)]
    assert got[-1].url == "a\r\nb%0Ac" and got[0].url is None and got[3].url == ""
    assert round_trip(spark, []) == []


def test_url_key(spark):
    url = F.lit("https://Www.A.com/x?q#f")
    assert spark.range(1).select(url_key(url).alias("k")).first().k == "com,a,www)/x?q#f"
