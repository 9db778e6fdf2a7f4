import hashlib
import random

import corpus_pipeline
import pytest
from caseloom.llm.packing import pack
from caseloom.llm.queries import PACK_TOKENS, with_pack_columns
from caseloom.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(draw, n):
    return " ".join("".join(draw.choices("etaoinshr", k=draw.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark):
    """A corpus of clean documents and of cases that each stage must catch."""
    draw = random.Random(11)
    clean = {i: sentence(draw, 80) for i in range(40)}
    item = sentence(draw, 30)
    near = clean[3].split()
    near[10] = "changed"
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in clean.items()]
    rows += [(100, "12345 !!", "en", "s0", 8), (101, None, None, None, None), (102, "", "en", "s1", 0),
             (103, clean[5].upper(), "en", "s2", 1), (104, " ".join(near), "en", "s3", 1),
             (105, sentence(draw, 50) + " " + item + " " + sentence(draw, 500), "en", "s1", 1),
             (7, clean[7], "en", "s3", len(clean[7])), (106, sentence(draw, 9000), None, "s0", 1)]
    root = scratch_path(spark, "pipeline-test")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item), (2, sentence(draw, 25)), (3, None)],
                          "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, clean


def test_each_stage_catches_its_cases_and_keeps_the_rest(spark, planted):
    root, clean = planted
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns, left = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stored(stage(spark, docs, root), f"test-{name}")
        assert docs.columns == columns
        left.append(sorted(r.doc_id for r in docs.collect()))
    ids = set(clean)
    assert left[0] == sorted([*ids, 7, 103, 104, 105, 106])
    assert left[1] == sorted((ids | {103, 104, 105, 106}) - {5})
    assert left[2] == sorted((ids | {103, 105, 106}) - {5})
    assert left[3] == sorted((ids | {103, 106}) - {5})
    out = corpus_pipeline.run(spark, root).collect()
    assert {r.doc_id for r in out} == set(left[3])
    assert sum(r.tokens for r in out if r.doc_id == 106) == 9001
    want = pack(with_pack_columns(docs), PACK_TOKENS).collect()
    assert sorted(map(str, out)) == sorted(map(str, want))


def test_letters_of_another_language_do_not_raise_the_limit(spark):
    draw = random.Random(12)
    words = ["".join(draw.choices("etaoinshrdlu", k=draw.randrange(2, 8))) for _ in range(300)]
    signs = [chr(c) for c in range(0x4e00, 0x5200)]
    rows = [(i, " ".join(draw.choices(words, k=150)), "en", "s", 1) for i in range(30)]
    rows += [(100 + i, "".join(draw.choices(signs, k=600)), "zz", "s", 1) for i in range(4)]
    rows += [(200, " ".join(draw.choices(words, k=400)), None, "s", 1),
             (201, "".join(draw.choices("0123456789abcdef", k=900)), None, "s", 1)]
    kept = {r.doc_id for r in corpus_pipeline.language(
        spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert {*range(30), 200} <= kept and 201 not in kept


def stage(spark, name, rows, root, schema=SCHEMA):
    """What a stage leaves of rows (doc_id, text)."""
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows] if schema is SCHEMA else rows, schema)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, root)
    assert out.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def plain_exact(rows):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    order = lambda r: (r[0] is not None, r[0] or 0)
    best = {}
    for r in rows:
        if low(r[1]) not in best or order(r) > order(best[low(r[1])]):
            best[low(r[1])] = r
    return best


def plain_near(rows):
    """One row of each component of rows with 0.75 or more of their shingles in common."""
    from tests.llm.test_jaccard_join import shingles

    def key(row):
        said = ("~" if row[0] is None else str(row[0])) + (":0" if row[1] is None else ":1") + (row[1] or "")
        return hashlib.sha256(said.encode()).digest()[:16]

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    best = {}
    for k, row in enumerate(rows):
        rank = (row[0] is None, row[0] or 0, key(row))
        if k not in best.setdefault(group[k], []) and (not best[group[k]] or rank < best[group[k]][0]):
            best[group[k]] = [rank, row]
    return sorted((row for _, row in best.values()), key=repr)


def test_rows_that_share_an_identifier_or_have_none(spark, planted):
    root, clean = planted
    draw = random.Random(5)
    item = spark.read.parquet(f"{root}/benchmark.parquet").filter("item_id = 1").first().text

    def edited(text):
        w = text.split()
        w[len(w) // 2] = "changed"
        return " ".join(w)

    a, b, c, d = (sentence(draw, 60) for _ in range(4))
    rows = [(3, a), (7, edited(a)), (7, b), (7, edited(b)), (None, c), (None, edited(c)), (None, d),
            (8, edited(c) + " end"), (9, None), (None, ""), (5, clean[0]), (5, "few words"), (6, "few words")]
    assert stage(spark, "near_duplicates", rows, root) == plain_near(rows)
    assert (7, b) in plain_near(rows) or (7, edited(b)) in plain_near(rows)

    dirty = f"{clean[1]} {item}"
    rows = [(None, clean[2]), (None, dirty), (7, dirty), (7, clean[3]), (8, clean[4]), (9, None)]
    assert stage(spark, "decontamination", rows, root) == sorted(
        [r for r in rows if r[1] != dirty], key=repr)

    rows = [(1, "A b"), (None, "a b"), (1, "c"), (None, "c"), (None, "C"), (None, "d"), (2, "d"), (2, "d"),
            (3, None), (1, ""), (7, "x"), (7, "y"), (7, "Y")]
    kept = stage(spark, "exact_duplicates", rows, root)
    assert {(i, (t or "").lower()) for i, t in kept} == {
        (r[0], text) for text, r in plain_exact(rows).items()}

    rows = [(1, clean[1]), (1, "123"), (None, clean[2]), (None, "!"), (None, None)] + [
        (10 + k, t) for k, t in clean.items()]
    assert stage(spark, "language", rows, root) == sorted(
        [r for r in rows if r[1] in clean.values()], key=repr)


def test_columns_of_any_name(spark, planted):
    root, clean = planted
    names = ["a.b", "row_key", "judged", "document_key", "document_copies", "__key", "found", "lang_"]
    schema = SCHEMA + "".join(f", `{n}` string" for n in names)
    rows = [(k, t, "en", "s", 1, *[f"{k}{n}" for n in names]) for k, t in clean.items()]
    for name, _ in corpus_pipeline.STAGES[:4]:
        assert stage(spark, name, rows, root, schema) == sorted(clean.items(), key=repr)


def test_short_texts_are_judged_by_the_same_rule(spark, planted):
    root, clean = planted
    rows = [(k, t, "en", "s", 1, 0) for k, t in clean.items()] + [
        (k, t, None, "s", 1, 0) for k, t in [(100, "hero"), (101, "a"), (102, "one tin hat"),
                                             (200, "qzx" * 200)]]
    kept = {i for i, _ in stage(spark, "language", rows, root, SCHEMA + ", more int")}
    assert {100, 101, 102, *clean} <= kept and 200 not in kept


def test_empty_tables_pass_through(spark):
    root = scratch_path(spark, "pipeline-empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    assert corpus_pipeline.run(spark, root).count() == 0


def test_nothing_learned_keeps_texts_with_letters(spark):
    docs = spark.createDataFrame([(1, "words", None, "s", 5), (2, "1", None, "s", 1)], SCHEMA)
    assert [r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()] == [1]


def test_names_and_oracle():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "exact_duplicates", "near_duplicates", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
