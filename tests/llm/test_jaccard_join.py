import random

import numpy as np
import pytest
from caseloom.llm import jaccard_join
from caseloom.llm.components import components
from caseloom.llm.jaccard_join import (
    cheapest_boundary, jaccard_components, least_difference, needed, parity_bitmap, partner_sizes,
    prefix_length, shingle_sets,
)

SCHEMA = "doc_id long, text string, n int, sid string, root string, key int"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def shingles(text):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows):
    """doc_id -> (size, smallest id reachable), looking at all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return sorted((i, len(sets[k]), low[find(k)]) for k, (i, _) in enumerate(rows))


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "s", "r", 2) for r in rows], SCHEMA).repartition(4)
    return sorted((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard_components(df, **options).collect())


def corpus(seed, n, longest):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    passage = draw.choices(vocabulary, k=20)
    texts = []
    for _ in range(n):
        kind = draw.random()
        if texts and kind < 0.6:
            w = draw.choice(texts).split(" ")
            for _ in range(draw.randrange(0, 4)):
                k = draw.randrange(len(w) + 1)
                w = draw.choice([w[:k] + w[k + 1:], w[:k] + [draw.choice(vocabulary)] + w[k:], w])
        else:
            w = draw.choices(vocabulary, k=draw.randrange(0, longest))
            if kind > 0.85:
                w += passage
        texts.append(" ".join(w))
    return list(enumerate(texts))


def test_sizes_agree_with_the_definition():
    for a in range(1, 60):
        linkable = [b for b in range(1, 90) if any(4 * o >= 3 * (a + b - o) for o in range(1, min(a, b) + 1))]
        assert linkable == [b for b in partner_sizes(a) if needed(a, b) <= min(a, b)]
        for b in linkable:
            least = min(o for o in range(min(a, b) + 1) if 4 * o >= 3 * (a + b - o))
            assert needed(a, b) == least
            assert a - prefix_length(a) + 1 <= least


def test_sets_are_those_of_the_definition():
    texts = ["a b c d e f a b c d e", "", None, "one", "One  TWO\tthree", "É é É é É", "a\x1cb c d e f",
             "x " * 3000, "p q r s t"]
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    a, b = shingle_sets(["A b C d e f", "f a B c D e"])
    assert len(np.intersect1d(a, b)) == 1


@pytest.mark.parametrize("seed,longest", [(1, 14), (2, 14), (3, 40), (4, 120)])
def test_equals_all_pairs(spark, seed, longest):
    rows = corpus(seed, 260, longest)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("boundary", [0, 3, 9])
def test_any_boundary_finds_the_same(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard_join, "cheapest_boundary", lambda sizes: boundary)
    rows = corpus(7, 200, 18)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("options", [{"counters": 512}, {"filter_bits": 512}])
def test_saturated_counters_or_filter_find_the_same(spark, options):
    rows = corpus(9, 300, 60)  # thousands of shingles for 512 counters
    assert found(spark, rows, **options) == brute(rows)


def test_a_passage_in_a_third_of_the_texts(spark):
    draw = random.Random(13)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for k in range(300):
        own = [f"{draw.randrange(500)}" for _ in range(draw.randrange(5, 60))]
        rows.append((k, " ".join(own + passage if k % 3 == 0 else own)))
    rows += [(1000 + k, rows[k][1] + " more") for k in range(0, 300, 7)]
    want = brute(rows)
    assert len({low for _, _, low in want}) > 200
    assert found(spark, rows, counters=512) == want


def test_bitmaps_never_rule_out_a_link():
    draw = np.random.default_rng(4)
    for _ in range(400):
        n = int(draw.integers(1, 400))
        a = np.unique(draw.integers(0, 1 << 63, n).astype(np.uint64))
        keep = a[draw.random(len(a)) < draw.choice([0.5, 0.8, 0.95, 1])]
        b = np.unique(np.concatenate([keep, draw.integers(0, 1 << 63, int(draw.integers(1, 100))).astype(np.uint64)]))
        apart = len(a) + len(b) - 2 * len(np.intersect1d(a, b))
        assert least_difference(parity_bitmap(a), parity_bitmap(b)) <= apart
    far = [np.unique(draw.integers(0, 1 << 63, 300).astype(np.uint64)) for _ in range(2)]
    assert least_difference(*map(parity_bitmap, far)) > 600 - 2 * needed(300, 300)


def test_nulls_repeats_long_and_empty(spark):
    long = " ".join(f"t{k}" for k in range(30_000))
    rows = [(4, None), (5, ""), (6, "a b"), (7, "A  B"), (8, long), (9, long + " end"), (3, "a b"),
            (3, "a b"), (11, " \n"), (12, "b a")]
    assert found(spark, rows) == [
        (3, 1, 3), (3, 1, 3), (4, 0, 4), (5, 0, 5), (6, 1, 3), (7, 1, 3), (8, 29_996, 8),
        (9, 29_997, 8), (11, 0, 11), (12, 1, 12)]
    nameless = [(None, "q r s t u"), (2, "q r s t u"), (None, None)]
    got = jaccard_components(spark.createDataFrame(
        [(*r, 1, "s", "r", 2) for r in nameless], SCHEMA)).collect()
    assert sorted(str(tuple(r)) for r in got) == ["(2, 1, 2)", "(None, 0, None)", "(None, 1, 2)"]
    assert found(spark, []) == []


def test_boundary_weighs_subsets_against_lists():
    assert cheapest_boundary({}) == 0
    assert 2 <= cheapest_boundary({n: 100 for n in range(1, 30)}) <= 12


def test_components_of_long_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 300)]
    star = [(1000 + k, 2000) for k in range(100)]
    random.Random(1).shuffle(chain)
    df = spark.createDataFrame(chain + star + [(5, 5)], "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    assert all(got[k] == 0 for k in range(1, 301))
    assert all(got[1000 + k] == 1000 for k in range(1, 100)) and got[2000] == 1000
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_edited_copies_of_one_text(spark):
    draw = random.Random(21)
    source = [f"s{k}" for k in range(150)]
    rows = []
    for k in range(150):
        w = list(source)
        for at in draw.sample(range(len(w)), draw.randrange(0, 7)):
            w[at] = f"e{k}-{at}"
        rows.append((k, " ".join(w)))
    want = brute(rows)
    assert 1 < len({low for _, _, low in want}) < 100  # a large component and copies too far from it
    assert found(spark, rows) == want
