"""Scalar cleaning against examples and against plain Python."""

import re
from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseloom.functions.coerce import (
    DATE_FORMATS, format_shape, rounded_percentage, to_calendar_date, to_int,
)
from caseloom.functions.phone import e164
from caseloom.functions.similarity import best_choice, exact_choice
from caseloom.functions import text as text_functions
from caseloom.functions.text import WHITESPACE, default_name, lower_camel, strip, title_case
from caseloom.operators.canonical import canonicalise, score_variants
from caseloom.operators.dedupe import distinct_rows, drop_blank_rows
from caseloom.operators.turnaround import validate_turnaround
from caseloom.plans.clean import clean, to_silver
from caseloom.plans.schema import REGIONS


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def regions(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, region string")
    return [r["region"] for r in canonicalise(df, "region", REGIONS).orderBy("i").collect()]


def indel(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return len(a) + len(b) - 2 * row[-1]


def token_set(x, y):
    """The published formula in plain Python."""
    a, b = set(x.split()), set(y.split())
    if not a or not b:
        return 0.0
    both, da, db = a & b, a - b, b - a
    if both and (not da or not db):
        return 100.0
    ja, jb, s = " ".join(sorted(da)), " ".join(sorted(db)), len(" ".join(both))
    gap = 1 if s else 0
    la, lb = s + gap + len(ja), s + gap + len(jb)
    scores = [100 - 100 * indel(ja, jb) / (la + lb)]
    if s:
        scores += [100 - 100 * (gap + len(ja)) / (s + la), 100 - 100 * (gap + len(jb)) / (s + lb)]
    return max(scores)


def best(value):
    if value is None or not value.strip():
        return "Unknown"
    scores = [token_set(value, r) for r in REGIONS]
    top = max(scores)
    return REGIONS[scores.index(top)] if top >= 80 else "Unknown"


def test_region_examples(spark):
    assert regions(spark, ["Greater Accra Region", "Greater Accra", "Not A Real Place", None]) == [
        "Greater Accra Region", "Greater Accra Region", "Unknown", "Unknown"
    ]


def test_long_reference_entries(spark):
    """Beyond the characters that fit the bits of one number."""
    names = ("Ministry of Works " * 6 + "and Housing", "Short Entry", "Quay " + "abcdefghij" * 10)
    values = ["Ministry of Works and Housin", "Shrt Entry", "Quay " + "abcdefghij" * 9 + "abcdxfghij", "zz"]
    scored = spark.createDataFrame([(v,) for v in values], "v string").select(
        best_choice(F.col("v"), names, 60.0)["choice"].alias("c"))
    want = [max(names, key=lambda n: (token_set(v, n), -names.index(n))) for v in values]
    assert [r.c for r in scored.collect()] == [*want[:3], None]


def test_region_quirks(spark):
    # A two-letter word plus "Region" scores exactly 80 everywhere; the first entry wins.
    # Entries that contain an earlier entry's words, or are contained in it, tie with it.
    assert regions(spark, ["Ga Region", "Region", "Western North Region", "Ahafo Region", " "]) == [
        "Ashanti Region", "Ashanti Region", "Western Region", "Brong Ahafo Region", "Unknown"
    ]
    assert exact_choice(REGIONS) == {r: best(r) for r in REGIONS}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_region_property(spark, data):
    words = sorted({w for r in REGIONS for w in r.split()})
    typo = st.sampled_from(words).flatmap(
        lambda w: st.builds(
            lambda i, c, keep: w[:i] + c + w[i + keep:],
            st.integers(0, len(w)), st.sampled_from(["", "a", "e", "n", "xy"]), st.integers(0, 1),
        )
    )
    values = data.draw(st.lists(st.lists(typo, max_size=4).map(" ".join), min_size=60, max_size=60))
    assert regions(spark, values) == [best(v) for v in values]


def test_region_join_beyond_broadcast(spark):
    values = ["Ashanti"] * 500 + ["Voltaa Region"] * 3 + ["Oti Region", None, "zzz"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, region string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = canonicalise(df, "region", REGIONS, slice_rows=50).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [r["region"] for r in result] == [best(v) for v in values]


def test_headers():
    assert lower_camel("NATURE OF COMPLAINT") == "natureOfComplaint"
    assert lower_camel("NAME") == "name"
    assert lower_camel("  LOG  DATE ") == "logDate"


def test_phone_examples(spark):
    given_numbers = ["0244987654", "233244987654", "244987654", "99", "024 498 7654", None]
    expected = ["+233244987654"] * 3 + [None, "+233244987654", None]
    assert column(spark, given_numbers, e164) == expected


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=30), min_size=40, max_size=40))
def test_strip_and_title_equal_python(spark, values):
    # Surrogates cannot be stored; one reserved code point is the marker title_case uses.
    values = [v.encode("utf-8", "ignore").decode().replace("\x00", "") for v in values]
    assert column(spark, values, strip) == [v.strip() for v in values]
    ascii_values = [v.encode("ascii", "ignore").decode() for v in values]
    assert column(spark, ascii_values, title_case) == [v.title() for v in ascii_values]


def test_title_examples(spark):
    values = ["walk-in", "3rd o'brien USSD", "straße ßeta", "a中b", "\tfoo bar", "", None, "a\nb"]
    expected = [None if v is None else v.title() for v in values]
    assert column(spark, values, title_case) == expected
    assert all(c.isspace() for c in WHITESPACE)


def test_name_default(spark):
    assert column(spark, [" NaN ", None, "", "null", "None", "  Ama "], default_name) == [
        "Unknown", "Unknown", "Unknown", "Unknown", "Unknown", "Ama"
    ]


def test_coercion(spark):
    assert column(spark, ["3", " 4 ", "3.0", "1.5", "n/a", "3d", "1e2", "9e99", None], to_int) == [
        3, 4, 3, None, None, None, 100, None, None
    ]
    dates = column(spark, ["2024-06-21", "2024-06-21 00:00:00", "6/6/2024", "16-Jun-2024", "N/A",
                           "unknown", "-", None, "2025-13-40", "2024-06-21 junk", "2024-06-21Tzzz",
                           "2024-06-21T10:11:12.5Z", "21 June 2024", "June 21, 2024"],
                   to_calendar_date)
    assert [None if d is None else d.isoformat() for d in dates] == [
        "2024-06-21", "2024-06-21", "2024-06-06", "2024-06-16", None, None, None, None, None, None,
        None, "2024-06-21", "2024-06-21", "2024-06-21",
    ]


def test_percentage_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 800), (0, 5), (1, 0)], "a long, b long")
    rounded = df.select(rounded_percentage(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r["p"] for r in rounded] == [33.33, 66.67, 0.13, 0.0, None]


def tat(spark, *rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, logDate string, resolutionDate string, turnaroundTime int",
    ).withColumns({c: F.col(c).cast("date") for c in ("logDate", "resolutionDate")})
    return validate_turnaround(df).orderBy("i").collect()


def test_turnaround(spark):
    swapped, filled, negative, kept, reversed_kept, one_date, reversed_null = tat(
        spark,
        ("2024-06-21", "2024-06-16", -5), ("2024-06-03", "2024-06-06", None),
        ("2024-06-03", "2024-06-06", -1), ("2024-06-03", "2024-06-06", 9),
        ("2024-06-21", "2024-06-16", 2), (None, "2024-06-16", -2),
        ("2024-06-21", "2024-06-16", None),
    )
    assert swapped["logDate"] < swapped["resolutionDate"] and swapped["turnaroundTime"] == 5
    assert filled["turnaroundTime"] == 3
    assert negative["turnaroundTime"] == 3
    assert kept["turnaroundTime"] == 9
    assert reversed_kept["logDate"] > reversed_kept["resolutionDate"]
    assert reversed_kept["turnaroundTime"] == 2
    assert one_date["turnaroundTime"] == -2
    assert reversed_null["turnaroundTime"] is None


def test_distinct_keeps_first_lineage_and_nulls_are_equal(spark):
    df = spark.createDataFrame(
        [("b", 1, "x", None), ("a", 2, "x", None), ("a", 1, "y", 1)],
        "sheet string, row_idx long, v string, n int",
    )
    rows = {tuple(r) for r in distinct_rows(df, ["sheet", "row_idx"]).collect()}
    assert rows == {("x", None, "a", 2), ("y", 1, "a", 1)}
    blank = spark.createDataFrame([("n", None), ("n", 1)], "name string, x int")
    assert drop_blank_rows(blank, ["name"]).count() == 1


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("s", 0, " ama ", None)], "sheet string, row_idx long, NAME string, STATUS string")
    assert clean(df).select("name", "status").first() == ("Ama", None)
    full = df.selectExpr("*", "'2025-01-01' as `LOG DATE`", "'2025-01-03' as `RESOLUTION DATE`",
                         "'x' as TAT")
    assert to_silver(full).first()["turnaroundTime"] == 2


def test_only_texts_of_a_shape_are_read_by_its_date_format(spark):
    """A failed reading is an exception, so texts that no format can read must fit no shape."""
    written = ["3/7/1988", "5-Jan-1990", "8 Feb 1991", "7 January 1992", "January 9, 1993", "+3/+7/1988"]
    fits = [[f for f in DATE_FORMATS if re.match(format_shape(f), text)] for text in written]
    assert fits == [["M/d/yyyy"], ["d-MMM-yyyy"], ["d MMM yyyy", "d MMMM yyyy"],
                    ["d MMM yyyy", "d MMMM yyyy"], ["MMMM d, yyyy"], ["M/d/yyyy"]]
    odd = ["1985-03-10 junk", "1985-03-10Tzzz", "3/7", "5-Jan", "1 2 1990", "3/7/1988 x"]
    assert not [(f, x) for f in DATE_FORMATS for x in odd if re.match(format_shape(f), x)]
    assert format_shape("E d M yyyy") == ""  # a weekday: anything may fit
    assert column(spark, [*written[:5], *odd], to_calendar_date) == [
        date(1988, 3, 7), date(1990, 1, 5), date(1991, 2, 8), date(1992, 1, 7), date(1993, 1, 9),
        *[None] * len(odd)]


def test_title_case_of_ascii_and_other_texts(spark):
    """The patterns that every text meets have no class of ranges, which is slow for each character."""
    assert not re.search(r"[A-Za-z]-[A-Za-z]", text_functions._MAYBE_WORD_START + text_functions._ASCII_WORD_START)
    values = ["walk-in", "3rd x_y", "customer#000a", "a.b,c d", "é-é x", "x-é", "ß-a", "\U0001d4aa-b a-\U00010428",
              "o'neil", "UPPER-lower", "#1 2", "-", "", None]
    assert column(spark, values, title_case) == [None if v is None else v.title() for v in values]


def test_cleaning_is_evaluated_once_for_each_value_of_a_scored_column(spark):
    """The condition on variants stays above the aggregate that makes them distinct."""
    raw = spark.createDataFrame([("volta",), ("volta",), (" ",), (None,), ("Volta Region",)], "region string")
    cleaned = raw.select(title_case(F.upper("region")).alias("region"))
    scored = score_variants(cleaned, "region", REGIONS, 80.0)
    assert [tuple(r) for r in scored.collect()] == [("Volta", "Volta Region")]
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate"):]
    assert "Filter" not in below


def test_sheets_are_listed_from_the_frame_that_is_cheaper_to_read(spark):
    """Listing the sheets does not evaluate what the rows were cleaned with."""
    raw = spark.createDataFrame([("b", 1, "x"), ("a", 7, "x"), (None, 2, "y")], "sheet string, row_idx long, v string")
    costly = raw.join(raw.select(F.raise_error("listed from the cleaned rows").cast("string").alias("w"),
                                 F.col("v").alias("u")), F.col("v") == F.col("w"), "left").drop("w", "u")
    groups = distinct_rows(costly, ["sheet", "row_idx"], listed=raw)  # lists, but does not read the rows
    assert groups.columns == ["v", "sheet", "row_idx"]
    got = distinct_rows(raw, ["sheet", "row_idx"], listed=raw)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [("x", "a", 7), ("y", None, 2)]))


def test_only_texts_with_other_ends_are_stripped_by_the_list(spark, monkeypatch):
    """The list of white space is looked through for a text that starts or ends with anything but visible
    ASCII once its spaces are off, and for no other."""
    unlisted = lambda text, _: F.raise_error("looked through the list").cast("string")
    plain = ["a", " ab ", "  a b", "!", "~ ~   ", "a\u2003b", "a\tb"]
    other = [None, "", "   ", "\ta", "a \n ", "\u3000 x", "x\u2029", "\x7f", "é", " aé ", "\x85", " \x1f z \xa0"]
    with monkeypatch.context() as patched:
        patched.setattr(F, "btrim", unlisted)
        assert column(spark, plain, strip) == [v.strip() for v in plain]
    assert column(spark, other, strip) == [v and v.strip() for v in other]
