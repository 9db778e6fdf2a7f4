"""Containment search and the documents that are left, against all pairs."""

import math
import random

import pytest

from caseloom.llm.decontaminate import clean_documents, find_contained, sketch_size
from caseloom.llm.tables import settings

DOCS = "doc_id long, text string, row_key string, `doc.id` int, w string, item_id long"
ITEMS = "item_id long, text string, hash long, doc_id string"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def runs(w, n):
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def shared(doc, item, threshold=0.75, shingle=5):
    """(shared, shingles of the item) if that is enough, else None."""
    w = words(item)
    own = runs(w, min(len(w), shingle)) if w else set()
    common = len(own & runs(words(doc), min(len(w), shingle))) if w else 0
    return (common, len(own)) if own and common >= math.ceil(threshold * len(own) - 1e-9) else None


def brute(docs, items, **options):
    return sorted({(d, i, *found) for d, text in docs for i, wanted in items
                   if (found := shared(text, wanted, **options))}, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, "k", 1, "w", 5) for d in docs], DOCS).repartition(3),
            spark.createDataFrame([(*i, 7, "x") for i in items], ITEMS))


def pairs(spark, docs, items, **options):
    found = find_contained(*frames(spark, docs, items), **options).select(
        "doc_id", "item_id", "shared", "item_shingles")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def left(spark, docs, items):
    df, wanted = frames(spark, docs, items)
    out = clean_documents(df, wanted)
    assert out.columns == df.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def corpus(seed, n=120):
    """Items of all sizes, and documents that hold none, parts, edited and whole ones of them."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["Ä", "The", "the", "THE"]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([0, 1, 2, 4, 5, 6, 9, 13, 30, 70]))))
             for k in range(40)]
    docs = []
    for k in range(n):
        body = draw.choices(vocabulary, k=draw.randrange(0, 60))
        inside = words(draw.choice(items)[1])
        for _ in range(draw.randrange(0, 5)):
            if inside:
                at = draw.randrange(len(inside))
                inside = draw.choice([inside[:at] + ["changed"] + inside[at + 1:], inside, inside[at // 3:]])
        docs.append((k, draw.choice([" ", "\n", "\t  "]).join(body[:20] + inside + body[20:])))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_finds_what_comparing_all_pairs_finds(spark, seed):
    docs, items = corpus(seed)
    want = brute(docs, items)
    assert len(want) > 20
    assert pairs(spark, docs, items) == want
    assert left(spark, docs, items) == sorted(
        (d for d in docs if not any(shared(d[1], t) for _, t in items)), key=repr)


def test_without_broadcasts(spark):
    docs, items = corpus(7)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert pairs(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize("threshold", [0.5, 0.9, 1.0])
def test_other_thresholds(spark, threshold):
    docs, items = corpus(4)
    assert pairs(spark, docs, items, threshold=threshold) == brute(docs, items, threshold=threshold)


def test_exactly_three_quarters_is_enough(spark):
    item = " ".join(f"t{k}" for k in range(8))  # four shingles
    docs = [(1, " ".join(f"t{k}" for k in range(7))), (2, " ".join(f"t{k}" for k in range(6)))]
    assert pairs(spark, docs, [(1, item)]) == [(1, 1, 3, 4)]


def test_short_items_nulls_repeats_and_long_texts(spark):
    long = " ".join(f"x{k}" for k in range(60_000))
    docs = [(None, "say hello world now"), (None, "clean"), (1, None), (2, ""), (3, "HELLO\tworld"),
            (3, "HELLO\tworld"), (3, "another text"), (4, long + " hello world"), (5, "hello  there world"),
            (6, " \n ")]
    items = [(None, "hello world"), (1, "hello world"), (1, "hello world"), (2, None), (3, "  "),
             (4, "x59998 x59999"), (5, "world")]
    assert pairs(spark, docs, items) == brute(docs, items)
    assert left(spark, docs, items) == sorted(
        [(None, "clean"), (1, None), (2, ""), (3, "another text"), (6, " \n ")], key=repr)


def test_a_row_goes_by_its_own_text(spark):
    clean, item = "nothing to see in this one", "one two three four five six"
    docs = [(None, clean), (None, item), (7, item), (7, clean), (8, clean)]
    assert left(spark, docs, [(1, item)]) == sorted([(None, clean), (7, clean), (8, clean)], key=repr)


def test_a_passage_in_a_third_of_the_documents(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    docs = [(k, (passage if k % 3 == 0 else "") + f" own{k} words{k}") for k in range(300)]
    assert pairs(spark, docs, [(1, passage), (2, passage + " and more words than that, many more of them")]) \
        == brute(docs, [(1, passage), (2, passage + " and more words than that, many more of them")])


def test_empty_tables(spark):
    docs, items = corpus(1, 5)
    assert pairs(spark, [], items) == [] and pairs(spark, docs, []) == []
    assert left(spark, docs, []) == sorted(docs, key=repr) and left(spark, [], items) == []


def test_sketches_cannot_be_missed():
    for upper in (1, 2, 4, 8, 16, 64):
        for size in range(upper // 2 + 1, upper + 1):
            missed = size - math.ceil(0.75 * size - 1e-9)
            assert sketch_size(upper, 0.75) > missed
