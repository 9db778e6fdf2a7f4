"""Text standardisation expressions."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Unicode text stripping treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The first visible ASCII character, and the first one after them. Texts compare by their bytes.
_VISIBLE = ("!", "\x7f")

# Spellings of a missing name, compared after trimming and lower-casing.
MISSING_NAMES = ("nan", "none", "null", "")

# Letters that have a case. A word starts at each of these that follows anything else.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_WORD_START_AFTER_NON_SPACE = f"([^ {_CASED}])(?=[{_CASED}])"
# Java tests a class of single characters by a table, but one of several ranges by calls that cost over ten
# times as much for each character of a text. So the patterns that every text meets list theirs.
_LETTERS = string.ascii_letters
_ASCII_OTHERS = "".join(rf"\x{c:02x}" for c in range(128) if chr(c) not in _LETTERS)
_ASCII_WORD_START = f"([^ {_LETTERS}])(?=[{_LETTERS}])"
# Cheap to test, and true wherever a word starts after a non-space.
_MAYBE_WORD_START = f"[^ {_LETTERS}][^{_ASCII_OTHERS}]"
# A code point that Unicode reserves for internal use, and the space that starts a word. Where
# a text holds the code point itself, another one follows it meanwhile.
_MARK, _OWN = "\ufdd0", "\ufdd0\ufdd1"
_BREAK = _MARK + " "


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` removes spaces only).

    Looking for each character of a text in a list costs many times what a search for spaces does. So
    spaces go first, and only a text that then starts or ends with anything but visible ASCII is looked at.
    """
    bare = F.trim(text)
    last = F.substring(bare, -1, 1)
    done = (bare >= _VISIBLE[0]) & (bare < _VISIBLE[1]) & (last >= _VISIBLE[0]) & (last < _VISIBLE[1])
    return F.when(done, bare).otherwise(F.btrim(bare, F.lit(WHITESPACE)))


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    ``initcap`` starts words after spaces only, which is enough for most values. In the others,
    such as ``walk-in`` or ``3rd``, a break is put before the other word starts first, and
    taken out afterwards. Everything is code-generated. ``text`` is used twice, so project a
    costly expression to a column of its own before.
    """
    own = F.replace(text, F.lit(_MARK), F.lit(_OWN))
    broken = F.regexp_replace(own, _WORD_START_AFTER_NON_SPACE, f"$1{_BREAK}")
    plain = F.regexp_replace(text, _ASCII_WORD_START, f"$1{_BREAK}")
    return F.when(~text.rlike(_MAYBE_WORD_START), F.initcap(text)).when(
        F.octet_length(text) == F.length(text), F.replace(F.initcap(plain), F.lit(_BREAK), F.lit("")),
    ).otherwise(
        F.replace(F.replace(F.initcap(broken), F.lit(_BREAK), F.lit("")), F.lit(_OWN), F.lit(_MARK)))


def default_name(name: Column, default: str = "Unknown") -> Column:
    """Trim a name; null and spellings of "missing" become the default."""
    trimmed = strip(name)
    missing = name.isNull() | F.lower(trimmed).isin(*MISSING_NAMES)
    return F.when(missing, F.lit(default)).otherwise(trimmed)


def lower_camel(header: str) -> str:
    """``NATURE OF COMPLAINT`` -> ``natureOfComplaint``. Column names only, never data.

    Runs of blanks count as one; the first word is lower case throughout, in every other each
    letter that follows a non-letter is a capital.
    """
    words = re.findall(r"[^ ]+", header.strip())
    tail = [word.title() for word in words[1:]]
    return "".join([*(word.lower() for word in words[:1]), *tail])
