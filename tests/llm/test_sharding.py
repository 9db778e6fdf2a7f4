import zlib
from collections import Counter

from caseloom.llm.sharding import interleave

SCHEMA = "doc_id long, text string, source string, rank long, band int, shard string"


def placed(spark, rows, shards=24):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    return interleave(df, shards, seed=3).collect()


def check_law(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_shards_match_the_mixture(spark):
    sources = ["hot"] * 400 + ["a"] * 260 + ["b"] * 120 + [f"rare{i}" for i in range(160)]
    rows = placed(spark, [(i, f"text {i}", s) for i, s in enumerate(sources)])
    check_law(rows, 24)
    for s in range(24):
        mix = Counter(r.source if not r.source.startswith("rare") else "rare"
                      for r in rows if r.shard == s)
        assert abs(mix["hot"] - 400 / 24) <= 3 and abs(mix["a"] - 260 / 24) <= 3
        assert 1 <= mix["rare"] <= 16
    # The order inside a source is a shuffle, not the order of arrival.
    hot = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot)) if r.source == "hot"]
    assert hot != sorted(hot)


def test_nulls_repeats_and_sizes(spark):
    rows = placed(spark, [(1, None, None), (1, None, None), (None, "é", ""), (2, "", "a"),
                          (3, "x" * 100_000, "a")], shards=3)
    check_law(rows, 3)
    by = {(r.doc_id, r.source): r for r in rows}
    assert by[(1, None)].size == 8 and by[(1, None)].text_crc32 == 0
    assert by[(None, "")].size == 10 and by[(None, "")].text_crc32 == zlib.crc32("é".encode())
    assert by[(3, "a")].size == 100_008


def test_same_answer_for_any_partitioning_and_empty(spark):
    data = [(i, f"t{i}", "s" if i % 3 else None, 1, 2, "x") for i in range(500)]
    df = spark.createDataFrame(data, SCHEMA)
    one = sorted(map(tuple, interleave(df.coalesce(1), 7).collect()), key=str)
    many = sorted(map(tuple, interleave(df.repartition(13), 7).collect()), key=str)
    assert one == many
    assert placed(spark, []) == []
