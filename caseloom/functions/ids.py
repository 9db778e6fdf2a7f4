"""Identifiers derived from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Base-32 digits as ``conv`` writes them, and the identifier alphabet.
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUV"
_ALPHABET = "ABCDEFGHJKMNPQRSTVWXYZ"


def _base32(hexadecimal: Column, width: int) -> Column:
    digits = F.lpad(F.conv(hexadecimal, 16, 32), width, "0")
    return F.translate(digits, _DIGITS, _ALPHABET)


def time_sortable_id(key: Column, run_millis: int) -> Column:
    """26-character identifier: 10 for the run time, 16 from the key's SHA-256.

    A function of key and run time only, so a retried task cannot mint a second identifier.
    """
    digest = F.sha2(key, 256)
    return F.concat(
        _base32(F.lit(f"{run_millis:x}"), 10),
        _base32(F.substring(digest, 1, 10), 8),
        _base32(F.substring(digest, 11, 10), 8),
    )
