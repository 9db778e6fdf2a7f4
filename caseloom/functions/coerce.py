"""Type coercion that turns what it cannot read into null, under ANSI mode or not."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.functions.text import strip

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# A whole ISO date, or timestamp with optional fraction and zone: the cast alone would also take
# a date that is followed by anything.
_ISO = (r"^[+-]?[0-9]{1,6}(-[0-9]{1,2}(-[0-9]{1,2}([T ]([0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}"
        r"(\.[0-9]*)?)?)?( ?(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2})?))?)?)?)?$")

#: Tried in this order for each value, after the ISO forms.
DATE_FORMATS = ("M/d/yyyy", "d-MMM-yyyy", "d MMM yyyy", "d MMMM yyyy", "MMMM d, yyyy")


def format_shape(pattern: str) -> str:
    """Regular expression that every text fits which a date pattern can read, and few others do.

    Numbers of day, month and year are digits with or without a sign, names of months have no digit,
    and separators stand as they are. A pattern with anything else fits every text.
    """
    shape = []
    for run, other in re.findall(r"(M+|d+|y+|[-/., ])|(.)", pattern, re.DOTALL):
        if other:
            return ""
        if run[0] in "Mdy":
            shape.append("[^0-9]+" if run.startswith("MMM") else "[+-]?[0-9]+")
        else:
            shape.append(re.escape(run))
    return f"^{''.join(shape)}$"


def to_int(text: Column) -> Column:
    """Whole number written as an integer, a decimal or in E notation; all else is null."""
    trimmed = strip(text)
    number = F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))
    return F.when(number == F.floor(number), number.try_cast("int"))


def to_calendar_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Calendar date of an ISO date or timestamp text, or of any of the listed formats."""
    trimmed = strip(text)
    # Every failed reading is an exception inside Spark: only texts of a format's shape are read by it.
    readings = [F.when(trimmed.rlike(format_shape(f)), F.try_to_timestamp(trimmed, F.lit(f)).cast("date"))
                for f in formats]
    # A text without a digit, such as "N/A", is of no shape.
    other = F.when(trimmed.rlike("[0-9]"), F.coalesce(*readings)) if readings else F.lit(None)
    iso = F.when(trimmed.rlike(_ISO), trimmed.try_cast("date"))
    return F.coalesce(iso, other)


def rounded_percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to two decimals, half up, in exact integer arithmetic."""
    hundredths = F.call_function("div", part * 20000 + whole, whole * 2)
    return F.when(whole != 0, hundredths.cast("double") / F.lit(100.0))
