from collections import defaultdict

from caseloom.llm.exact_dedup import keep_documents, streaming_dedup
from caseloom.session import scratch_path
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, digest string, rows int, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "x") for r in rows], SCHEMA)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def want(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[lower(text)].append(i)
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return {(i, keep[lower(t)], len(groups[lower(t)]), i == keep[lower(t)]) for i, t in rows}


def got(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())


ROWS = [(1, "Ab"), (2, "aB"), (3, "ä"), (4, "Ä"), (5, None), (6, ""), (7, "ab "), (8, "x" * 200_000),
        (9, "x" * 200_000), (10, "x" * 199_999 + "y")]


def test_groups_by_lowered_text(spark):
    assert got(streaming_dedup(frame(spark, ROWS))) == sorted(want(ROWS))


def test_clashing_digests_are_told_apart_by_bytes(spark):
    weak = lambda body: F.octet_length(body).cast("string")
    found = streaming_dedup(frame(spark, ROWS), digest=weak)
    assert got(found) == sorted(want(ROWS))
    assert {r.text_sha256 for r in found.collect()} == {
        r.text_sha256 for r in streaming_dedup(frame(spark, ROWS)).collect()}


def test_state_lasts_over_batches_and_runs(spark):
    root = scratch_path(spark, "dedup-test")
    first = [(i, f"t{i % 7}") for i in range(60)]
    second = [(i, f"t{i % 9}") for i in range(100, 130)]
    streaming_dedup(frame(spark, first).repartition(6), root=root, files_per_trigger=1).count()
    later = streaming_dedup(frame(spark, second), root=root)
    keep = {f"t{k}": max(i for i, t in first + second if t == f"t{k}") for k in range(9)}
    assert {(r.doc_id, r.keep_id) for r in later.collect()} == {(i, keep[t]) for i, t in second}


def test_repeated_rows_nulls_empty_and_kept_rows(spark):
    rows = [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "A"), (None, "a")]
    df = frame(spark, rows)
    judged = streaming_dedup(df)
    by = {(r.doc_id, r.keep_id): r for r in judged.collect()}
    assert len(by) == judged.count() == 4
    assert by[(1, 2)].copies == 2 and by[(2, 2)].group_size == 4 and by[(None, None)].kept
    kept = keep_documents(df, judged)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in kept.collect()) == [
        (False, 2, "A"), (True, None, "b")]
    assert streaming_dedup(frame(spark, [])).collect() == []
