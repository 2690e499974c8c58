"""Text helpers with Unicode-aware whitespace and digits."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# All white space, listed one by one: single Latin-1 characters become a bit set
# in the matcher, which is much faster than (?U)\s or ranges.
_OTHER_SPACE = "\\t\\n\\x0b\\f\\r\\x1c\\x1d\\x1e\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACE_CHARS = "\\x20" + _OTHER_SPACE
_SPACE = f"[{_SPACE_CHARS}]"


def quoted(name: str) -> Column:
    """Column by exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(c, f"^{_SPACE}+|{_SPACE}+$", "")


def squeeze(c: Column) -> Column:
    """Collapse runs of white space to one blank and strip the ends."""
    # runs of plain blanks are found fast, runs of the whole set are not: other white space becomes blanks first
    return F.trim(F.regexp_replace(F.regexp_replace(c, f"[{_OTHER_SPACE}]", " "), " {2,}", " "))


def capitalise(c: Column) -> Column:
    """First character upper case, all others lower case (not word-wise)."""
    return F.concat(F.upper(F.substr(c, F.lit(1), F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def before_first_blank(c: Column) -> Column:
    return F.substring_index(c, " ", 1)


def after_first_blank(c: Column) -> Column:
    """Text after the first blank; empty when there is none."""
    return F.coalesce(F.get(F.split(c, " ", 2), F.lit(1)), F.lit(""))


@lru_cache(maxsize=1)
def _digit_pairs() -> tuple[str, str]:
    # Every decimal digit of every script, from the Unicode database.
    foreign = [(chr(p), str(unicodedata.decimal(chr(p))))
               for p in range(0x80, 0x20000) if unicodedata.decimal(chr(p), None) is not None]
    return "".join(a for a, _ in foreign), "".join(b for _, b in foreign)


def ascii_digits(c: Column) -> Column:
    """Replace decimal digits of other scripts by 0-9."""
    source, target = _digit_pairs()
    return F.translate(c, source, target)


def has_text(c: Column) -> Column:
    """Whether there is any character that is not white space; stops at the first."""
    return F.coalesce(F.rlike(c, F.lit(f"[^{_SPACE_CHARS}]")), F.lit(False))


def first_digits(c: Column, pattern: str, keyword: str) -> Column:
    """Group 1 of the first match as digits 0-9 without leading zeros, of any length; NULL without a match.

    ``keyword`` is plain text every match contains: texts without it skip the
    pattern. Digits and white space of all scripts count.
    """
    wide = pattern.replace("\\d", "\\p{Nd}").replace("\\s", _SPACE)
    digits = F.when(F.contains(c, F.lit(keyword)), F.nullif(F.regexp_extract(c, wide, 1), F.lit("")))
    return F.regexp_replace(ascii_digits(digits), "^0+(?=.)", "")


def first_number(c: Column, pattern: str, default: int, keyword: str, kind: str = "decimal(38,0)") -> Column:
    """The number of :func:`first_digits`, else ``default``.

    As ``string`` or ``double`` numbers of any length are kept; one of more than 38
    digits does not fit a DECIMAL and gives NULL there, not the default.
    """
    digits = first_digits(c, pattern, keyword)
    return F.when(digits.isNull(), F.lit(str(default)).cast(kind)).otherwise(digits if kind == "string" else digits.try_cast(kind))


def contains_any(c: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(c, F.lit(word))
    return hit
