"""Certain spans against the patterns as stated; estimation against known reliabilities."""

import random
import re
import time

import numpy as np
import pytest

from caseloom.llm import pii
from caseloom.llm.pii import KINDS, base_spans, candidates, estimate, find_personal, fit

DOCS = "doc_id long, text string"
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_luhn(digits):
    doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(digits[::-1])]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def plain_spans(text):
    def good(kind, match):
        digits = re.sub("[^0-9]", "", match)
        return (kind == 0 or kind == 1 and all(int(p) <= 255 for p in match.split("."))
                or kind == 2 and 13 <= len(digits) <= 19 and plain_luhn(digits)
                or kind == 3 and 9 <= len(digits) <= 15)
    return [[m.span() for m in re.finditer(p, text) if good(k, m.group())]
            for k, p in enumerate(PATTERNS)]


FIXED = [
    "", "a@b.c@d.e", "a@b.c_x@d.e.", "x@y x@y.z", "@a.b", "a@@b.c", "é@b.cé", "a..b@c.d-e.f..g",
    "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1 01.002.0003.4", "1.2.3 4.5.6.7", "12.12.12.1212",
    "4111 1111-1111 1111", "4111  1111 1111 1111", "4111111111111111", "0000000000000", "5-5",
    "4111111111111112", "4111111111111111 2 3", "+1 (743) 555-3824", "+1", "+12345678", "+123456789 ",
    "+1 2 3 4 5 6 7 8 9 +44 20 7946 0958)", "+1234567890123456", "++49 30 1234567", "+4.9-3(0)12345678(",
    "x+y@z.w +1 4111 1111 1111 1111", "٣٤٥@b.c ٣٤٥.1.1.1",
]


@pytest.mark.parametrize("text", FIXED)
def test_certain_spans_of(text):
    assert base_spans(text) == plain_spans(text)


def test_certain_spans_of_random_texts():
    draw = random.Random(11)
    parts = ["@", ".", "-", " ", "+", "1", "25", "256", "4111", "0", "a", "b_c", "é", "(", ")", "\n",
             "a@b.co", "1.2.3.4", "4111111111111111", "+1 743 555 3824", "..", "--", "😀", "%"]
    for _ in range(20_000):
        text = "".join(draw.choices(parts, k=draw.randrange(14)))
        assert base_spans(text) == plain_spans(text), text


def test_candidates_beside_certain_spans():
    text = "write jo [at] mail [dot] org, call (030) 1234-567; v 300.1.2.3 card 4111111111111112"
    found = {KINDS[k]: text[a:b] for k, a, b, _ in candidates(text)}
    assert found == {"email": "jo [at] mail [dot] org", "phone": "(030) 1234-567", "ip": "300.1.2.3",
                     "card": "4111111111111112"}
    assert candidates("+49 (030) 1234-567 and 1.2.3.4")[0][:3] == (1, 23, 30)
    assert len(candidates("+49 (030) 1234-567 and 1.2.3.4")) == 2


@pytest.mark.parametrize("run", ["a", "1", "1.", "+", "+1", "@", "a@", "a@b.", "1 ", "(1) ", "1:", "[at]",
                                 "a[at]b[dot]", "0-"])
def test_long_runs_take_linear_time(run):
    start = time.time()
    candidates(run * (400_000 // len(run)))
    assert time.time() - start < 20


def test_estimation_finds_the_labelers_that_are_right():
    draw = np.random.default_rng(2)
    truth = draw.random(40_000) < 0.3
    right = [0.95, 0.8, 0.6, 0.5, 0.9]
    given = np.stack([np.where(draw.random(len(truth)) < 0.2, 0,
                               np.where((draw.random(len(truth)) < r) == truth, 1, -1)) for r in right], 1)
    patterns, number = np.unique(given, axis=0, return_counts=True)
    believed, rates, share = estimate(patterns, number.astype(float), np.zeros(len(patterns), bool))
    assert np.allclose(rates[0], right, atol=0.03) and np.allclose(1 - rates[1], right, atol=0.03)
    assert abs(share - 0.3) < 0.02
    place = {tuple(p): k for k, p in enumerate(patterns)}
    chosen = np.array([believed[place[tuple(v)]] for v in given]) > 0.5
    # With the rates known, no choice is better than this one.
    odds = np.log(0.3 / 0.7) + given @ (np.log(right) - np.log1p(-np.array(right)))
    assert (chosen == (odds > 0)).mean() > 0.99


def test_classifier_follows_the_estimates():
    def code(base, *rest):
        return int(np.ravel_multi_index((3, base, *[v + 1 for v in rest], 3, 2), pii._SHAPE))
    model = fit({code(1, 1, 1, 1, 1, 1): 500, code(1, 1, 1, 1, 0, 1): 300, code(0, 0, 1, 0, 1, 1): 50,
                 code(0, -1, -1, 0, -1, -1): 400, code(0, 0, -1, -1, 0, -1): 300})
    assert model.probability[code(0, 0, 1, 0, 1, 1)] > 0.9
    assert model.probability[code(0, -1, -1, 0, -1, -1)] < 0.1
    assert list(model.reliability) == ["phone"] and fit({}).share == {}


def test_rows_nulls_copies_and_extra_columns(spark):
    texts = ["mail me: a@b.com", None, "", "call (030) 1234-567 or +49 30 1234567", "no 2020-01-02"]
    rows = [(k if k else None, t, "x") for k, t in enumerate(texts)] + [(7, texts[0], "y")] * 200 \
        + [(8 + k, f"tel +49 30 {1000000 + k}", "z") for k in range(50)] + [(9, "é" * 100_000 + texts[3], "")]
    found, model = find_personal(spark.createDataFrame(rows, DOCS + ", `found.code` string").repartition(3))
    got = [(r.doc_id, [(s.kind, s.start, s.end, s.base) for s in r.spans]) for r in found.collect()]
    assert len(got) == len(rows)
    assert got.count((7, [("email", 9, 16, True)])) == 200 and (None, [("email", 9, 16, True)]) in got
    assert (1, []) in got and (2, []) in got and (4, []) in got
    assert ("phone", 23, 37, True) in dict(got)[3]
    for name, spans in got:
        text = {(r[0]): r[1] for r in rows[::-1]}[name] or ""
        assert [(k, a, b) for k, a, b, base in spans if base] == [
            (KINDS[k], *s) for k, own in enumerate(plain_spans(text)) for s in own] or name == 9
    assert model.reliability["phone"]["form"][0] > 0.9


def test_accepted_candidates_do_not_overlap():
    code = int(np.ravel_multi_index((3, 0, 2, 2, 2, 2, 2, 0, 0), pii._SHAPE))
    other = code + 1
    probability = np.zeros(int(np.prod(pii._SHAPE)))
    probability[[code, other]] = 0.95, 0.99
    found = [dict(kind=3, start=a, end=b, code=c) for a, b, c in
             [(0, 10, code), (5, 12, other), (12, 15, code), (14, 20, code), (30, 31, code)]]
    assert [(s["start"], s["end"]) for s in pii._chosen(found, probability, 0.9)] == [
        (5, 12), (12, 15), (30, 31)]


def test_empty_table(spark):
    found, model = find_personal(spark.createDataFrame([], DOCS))
    assert found.collect() == [] and model.share == {}
