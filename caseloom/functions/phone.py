"""Phone number standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def e164(number: Column, country_code: str = "233", subscriber_digits: int = 9) -> Column:
    """International form of a phone number, or null where no known national form fits.

    Accepted after removing every non-digit: trunk ``0`` + subscriber number, country code +
    subscriber number, or the bare subscriber number.
    """
    digits = F.regexp_replace(number, "[^0-9]", "")
    length = F.length(digits)
    return (
        F.when(
            digits.startswith("0") & (length == subscriber_digits + 1),
            F.concat(F.lit(f"+{country_code}"), F.substring(digits, 2, subscriber_digits)),
        )
        .when(
            digits.startswith(country_code)
            & (length == len(country_code) + subscriber_digits),
            F.concat(F.lit("+"), digits),
        )
        .when(length == subscriber_digits, F.concat(F.lit(f"+{country_code}"), digits))
    )
