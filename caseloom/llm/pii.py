"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans are certain: e-mail addresses, IP addresses with parts up to 255, card numbers of 13 to
19 digits that pass Luhn's check, and international phone numbers of 9 to 15 digits; of each kind the
leftmost matches that do not overlap. Candidates are base spans and looser finds beside them: written-out
addresses (``name [at] host [dot] org``), IP version 6 and dotted numbers beyond 255, card numbers that
fail the check, national phone numbers.

Five labelers vote for or against each candidate or abstain: its *form*, a *check* of its digits, a
*gazetteer* (top-level domains, issuer prefixes, calling codes, address blocks), the *words* in front of
it, and the characters at its *edges*. Per kind, expectation maximisation estimates how often each
labeler votes for true and for false spans where it does not abstain; base spans are held to be true. The
probabilities train a logistic span classifier on votes, length and groups of the span. Votes, length and
groups are few discrete values, so all candidates of the corpus are counted by them before the
driver sees them: nothing is sampled. Candidates that the classifier gives ``ACCEPTED`` or more are
added, unless they overlap a base span or a likelier one.

Defined results: a null text is empty; null and repeated identifiers have a row for each row; documents
without spans have an empty list; a kind without any candidate learns nothing; places are code points;
an empty table gives no rows. Other columns are ignored. Scanning takes time in proportion to the text,
also where it is one long run of digits or letters.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.tables import small_batches, stored

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("form", "check", "gazetteer", "words", "edges")
#: Probability from which a candidate is added.
ACCEPTED = 0.9
#: Characters in front of a candidate in which words are looked for.
_BEFORE = 40
#: Upper bounds of the bins of length and of groups of digits or letters.
_LENGTHS = (9, 12, 14, 16, 18, 22, 30)
_GROUPS = (1, 3, 4)
_SHAPE = (len(KINDS), 2, *[3] * len(LABELERS), len(_LENGTHS) + 1, len(_GROUPS) + 1)
_FOUND = "doc_id long, found array<struct<kind:int,start:int,end:int,code:int>>"
_SPAN_TYPE = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                        ("code", pa.int32())])
_SPANS = ("doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean,"
          "probability:double>>")
_OUT_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                       ("base", pa.bool_()), ("probability", pa.float64())])

# Base patterns ---------------------------------------------------------------------------------

_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser candidates -----------------------------------------------------------------------------

_AT = re.compile(r"\s?[\[({]\s?at\s?[\])}]\s?", re.I)
_SPELT = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?)[A-Za-z0-9-]+)+", re.I)
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_NATIONAL = re.compile(
    r"(?<![0-9A-Za-z+.(-])\(?[0-9]{2,5}\)?(?:[ .-][0-9]{2,5}){1,4}(?![0-9A-Za-z]|[.-][0-9])")

# Labelers --------------------------------------------------------------------------------------

_NOT_IT = {
    "phone": re.compile(r"(?:19|20)\d\d[.-]\d\d[.-]\d\d|\d\d[.-]\d\d[.-](?:19|20)\d\d"
                        r"|\d+\.\d+|(?:\d{1,3} ){2,}\d{3}"),
    "card": re.compile(r"(\d)\1+|0+[\d -]*"),
}
_DOMAINS = frozenset(
    "com org net edu gov mil int info biz name io co me tv ai app dev xyz online site shop cloud "
    "de fr es it uk us ca au nz ie nl be lu ch at pt pl cz sk hu ro bg gr se no dk fi is ee lv lt "
    "ru ua by tr il sa ae eg za ng ke gh ma in pk bd lk cn jp kr tw hk sg my th vn id ph br ar mx "
    "cl pe ve uy ec bo".split())
_CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 "
    "64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 218 220 221 225 233 234 237 254 255 256 "
    "260 263 351 352 353 354 355 356 357 358 359 370 371 372 373 374 375 376 377 380 381 382 385 "
    "386 387 389 420 421 423 852 853 855 856 880 886 960 961 962 963 964 965 966 967 968 971 972 "
    "973 974 975 976 977 992 993 994 995 996 998".split())
_ISSUERS = re.compile(r"4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-5]|[689])|35|6(?:011|5|4[4-9])|62")
_WORDS = {
    "email": ("mail", "contact", "write to", "reach", "correo", "kontakt", "courriel", "address"),
    "ip": ("ip", "address", "host", "server", "login from", "client", "adresse"),
    "card": ("card", "visa", "mastercard", "amex", "payment", "carte", "tarjeta", "karte", "credit"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "whatsapp", "anruf", "appel"),
}
_OTHER_WORDS = ("version", "isbn", "order", "invoice", "serial", "section", "chapter", "build", "page",
                "sha", "commit", "checksum", "licen", "release")


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _parts_fit(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in text.split("."))


def _local_start(text: str, at: int, least: int) -> int:
    """Where the run of address characters that ends at ``at`` begins, not before ``least``."""
    width = 64
    while True:
        low = max(least, at - width)
        start = low + len(text[low:at].rstrip(_LOCAL))
        if start > low or low == least:
            return start
        width *= 4


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    at, end = text.find("@"), 0
    while at >= 0:
        start = _local_start(text, at, end)
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Certain spans of each kind, by start."""
    ips = [m.span() for m in _IP.finditer(text) if _parts_fit(m.group())]
    cards = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            cards.append(m.span())
    phones = [m.span() for m in _PHONE.finditer(text)
              if 9 <= sum(c.isdigit() for c in m.group()) <= 15] if "+" in text else []
    return [list(_addresses(text)), ips, cards, phones]


def _loose(text: str) -> Iterator[tuple[int, int, int]]:
    """Candidates that are not base spans, as (kind, start, end)."""
    for m in _AT.finditer(text):
        start = _local_start(text, m.start(), 0)
        if start < m.start() and (host := _SPELT.match(text, m.end())):
            yield 0, start, host.end()
    for m in _IP.finditer(text):
        if not _parts_fit(m.group()):
            yield 1, *m.span()
    if text.count(":") >= 7:
        for m in _IP6.finditer(text):
            yield 1, *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and not luhn(d):
            yield 2, *m.span()
    for m in _NATIONAL.finditer(text):
        if 7 <= len(_digits(m.group())) <= 15:
            yield 3, *m.span()


def _check(kind: str, span: str, digits: str) -> int:
    if kind == "email":
        return 1 if len(span) <= 254 and ".." not in span else -1
    if kind == "ip":
        return 1 if ":" in span or _parts_fit(span) else -1
    if kind == "card":
        return 1 if luhn(digits) else -1
    return 1 if 9 <= len(digits) <= 15 else -1


def _gazetteer(kind: str, span: str, digits: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[^A-Za-z0-9-]+", span)[-1].lower() in _DOMAINS else -1
    if kind == "ip":
        try:
            address = ipaddress.ip_address(span)
        except ValueError:
            return -1
        return -1 if address.is_reserved or address.is_unspecified or address.is_multicast else 1
    if kind == "card":
        return 1 if _ISSUERS.match(digits) else -1
    abroad = digits if span.startswith("+") else digits[2:] if span.startswith("00") else ""
    return 0 if not abroad else 1 if any(abroad[:k] in _CALLING_CODES for k in (1, 2, 3)) else -1


def votes(text: str, kind: int, start: int, end: int, base: bool) -> list[int]:
    """1 for, -1 against, 0 abstains, in the order of ``LABELERS``."""
    name, span = KINDS[kind], text[start:end]
    digits = _digits(span)
    bad = name in _NOT_IT and _NOT_IT[name].fullmatch(span)
    before = text[max(0, start - _BEFORE):start].lower()
    near = 1 if any(w in before for w in _WORDS[name]) else \
        -1 if any(w in before for w in _OTHER_WORDS) else 0
    around = text[max(0, start - 1):start] + text[end:end + 1]
    edges = -1 if any(c.isalnum() or c in "_/=\\#$&" for c in around) else 1
    return [-1 if bad else int(base), _check(name, span, digits), _gazetteer(name, span, digits),
            near, edges]


def _code(text: str, kind: int, start: int, end: int, base: bool) -> int:
    """All that the classifier sees of a span, as one number."""
    groups = len(re.findall("[0-9A-Za-z]+", text[start:end]))
    return int(np.ravel_multi_index((
        kind, int(base), *[v + 1 for v in votes(text, kind, start, end, base)],
        sum(end - start > n for n in _LENGTHS), sum(groups > n for n in _GROUPS)), _SHAPE))


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, code) of base spans and of candidates that overlap none of them."""
    certain = base_spans(text)
    found = [(kind, a, b, _code(text, kind, a, b, True)) for kind in range(4) for a, b in certain[kind]]
    taken = sorted((a, b) for spans in certain for a, b in spans)
    starts = np.array([a for a, _ in taken])
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else starts
    for kind, a, b in _loose(text):
        before = int(np.searchsorted(starts, b)) if taken else 0  # base spans that begin before b
        if not before or reach[before - 1] <= a:
            found.append((kind, a, b, _code(text, kind, a, b, False)))
    return found


# Estimation ------------------------------------------------------------------------------------

@dataclass
class SpanModel:
    """``reliability`` has per kind and labeler the share of votes for, of those given to true and to
    false spans; ``share`` of true spans per kind; ``probability`` of every code."""

    reliability: dict[str, dict[str, tuple[float, float]]]
    share: dict[str, float]
    probability: np.ndarray


def estimate(given: np.ndarray, counts: np.ndarray, certain: np.ndarray,
             rounds: int = 500) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation maximisation over vote patterns (pattern, labeler) with counts: probability of each
    pattern, rates of votes for in (true, false) spans, and the share of true spans."""
    cast, favour = given != 0, given > 0
    rates, share = np.array([[0.8], [0.2]]).repeat(given.shape[1], 1), 0.5
    start = rates.copy()
    probability = np.where(certain, 1.0, 0.5)
    for _ in range(rounds):
        logs = [np.where(favour, np.log(r), np.log1p(-r)) * cast for r in rates]
        odds = np.log(share) - np.log1p(-share) + (logs[0] - logs[1]).sum(1)
        new = np.where(certain, 1.0, 1 / (1 + np.exp(-np.clip(odds, -700, 700))))
        moved = np.abs(new - probability).max(initial=0)
        probability = new
        for k, weight in enumerate((counts * probability, counts * (1 - probability))):
            # As if four more votes of the rate to start with had been seen.
            rates[k] = (weight @ favour + 4 * start[k]) / (weight @ cast + 4)
        share = (counts @ probability + 1) / (counts.sum() + 2)
        if moved < 1e-9:
            break
    return probability, rates, float(share)


def fit_logistic(features: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients of a ridge-regularised logistic regression on probabilities, by Newton steps."""
    beta = np.zeros(features.shape[1])

    def loss(b: np.ndarray) -> float:
        z = features @ b
        return float(weight @ (np.logaddexp(0, z) - target * z) + b @ b / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -700, 700)))
        slope = features.T @ (weight * (p - target)) + beta
        bend = (features.T * (weight * p * (1 - p))) @ features + np.eye(len(beta))
        step, size, here = np.linalg.solve(bend, slope), 1.0, loss(beta)
        while size > 1e-6 and loss(beta - size * step) > here:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return beta


def _features(codes: np.ndarray) -> np.ndarray:
    parts = np.unravel_index(codes, _SHAPE)
    columns = [np.ones(len(codes))]
    for k in range(len(LABELERS)):
        columns += [parts[2 + k] == 2, parts[2 + k] == 0]
    columns += [parts[-2] == n for n in range(_SHAPE[-2])] + [parts[-1] == n for n in range(_SHAPE[-1])]
    return np.stack(columns, 1).astype(float)


def fit(counts: dict[int, int]) -> SpanModel:
    """Model from the number of candidates with each code."""
    probability = np.zeros(int(np.prod(_SHAPE)))
    reliability, shares = {}, {}
    codes = np.array(sorted(counts), np.int64)
    number = np.array([counts[c] for c in codes.tolist()], float)
    parts = np.unravel_index(codes, _SHAPE)
    for kind, name in enumerate(KINDS):
        own = parts[0] == kind
        if not own.any():
            continue
        given = np.stack([p[own] for p in parts[2:2 + len(LABELERS)]], 1) - 1
        believed, rates, share = estimate(given, number[own], parts[1][own] == 1)
        features = _features(codes[own])
        beta = fit_logistic(features, believed, number[own])
        probability[codes[own]] = 1 / (1 + np.exp(-np.clip(features @ beta, -700, 700)))
        reliability[name] = {l: (float(a), float(b)) for l, a, b in zip(LABELERS, *rates)}
        shares[name] = share
    return SpanModel(reliability, shares, probability)


# The operator ----------------------------------------------------------------------------------

def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[dict(zip(("kind", "start", "end", "code"), c)) for c in candidates(text or "")]
                 for text in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(found, pa.list_(_SPAN_TYPE))], names=["doc_id", "found"])


def _chosen(found: list[dict], probability: np.ndarray, accepted: float) -> list[dict]:
    """Base spans and accepted candidates, by kind and start."""
    spans, more = [], []
    for s in found:
        p = float(probability[s["code"]])
        if np.unravel_index(s["code"], _SHAPE)[1]:  # certain
            spans.append((s["kind"], s["start"], s["end"], True, p))
        elif p >= accepted:
            more.append((-p, s["kind"], s["start"], s["end"]))
    taken: list[tuple[int, int]] = []  # kept sorted; spans in it do not overlap
    for p, kind, a, b in sorted(more):
        at = bisect_left(taken, (a, a))
        if (at and taken[at - 1][1] > a) or (at < len(taken) and taken[at][0] < b):
            continue
        taken.insert(at, (a, b))
        spans.append((kind, a, b, False, -p))
    return [{"kind": KINDS[k], "start": a, "end": b, "base": base, "probability": p}
            for k, a, b, base, p in sorted(spans)]


def find_personal(docs: DataFrame, identifier: str = "doc_id", text: str = "text",
                  accepted: float = ACCEPTED) -> tuple[DataFrame, SpanModel]:
    """doc_id and ``spans`` (kind, start, end, base, probability) of every row, and the model."""
    spark = docs.sparkSession
    small_batches(spark)
    found = stored(docs.select(F.col(identifier).cast("long").alias("doc_id"), F.col(text).alias("text"))
                   .mapInArrow(_label, _FOUND), "pii-candidates")
    # At most as many rows as there are codes.
    counts = found.select(F.explode("found.code").alias("code")).groupBy("code").count().collect()
    model = fit({r["code"]: r["count"] for r in counts})
    shared = spark.sparkContext.broadcast(model.probability.astype(np.float32))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_chosen(f, shared.value, accepted) for f in batch["found"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(spans, pa.list_(_OUT_TYPE))], names=["doc_id", "spans"])

    return found.mapInArrow(decide, _SPANS), model
