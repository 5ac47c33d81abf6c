"""Text column builders. All stay inside Catalyst expressions; NULL stays NULL."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# White space as Unicode defines it, with the four separator
# control characters; as characters and as a Java pattern for a run of them.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def trim(column: Column | str) -> Column:
    """Strip all white space at both ends (tabs and no-break spaces too); only the ends are looked at."""
    return F.btrim(_col(column), F.lit(WHITE_SPACE))


def lower(column: Column | str) -> Column:
    return F.lower(_col(column))


def upper(column: Column | str) -> Column:
    return F.upper(_col(column))


def collapse_spaces(column: Column | str) -> Column:
    """Replace each run of white space by one space."""
    return F.regexp_replace(_col(column), SPACE_RUN, " ")


def normalize(column: Column | str) -> Column:
    """Trim, lower-case and collapse white space."""
    return collapse_spaces(lower(trim(column)))


def replace_literal(column: Column | str, old: str, new: str) -> Column:
    return F.replace(_col(column), F.lit(old), F.lit(new))


def contains(column: Column | str, pattern: str, case: bool = True, regex: bool = True) -> Column:
    """True where the pattern occurs; NULL text counts as no match."""
    body = pattern if regex else re.escape(pattern)
    flags = "" if case else "(?iu)"
    return F.coalesce(_col(column).rlike(flags + body), F.lit(False))


def extract(column: Column | str, pattern: str, group: int = 1) -> Column:
    """One capture group of the first match, NULL where nothing matches."""
    text = _col(column)
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def last_part(column: Column | str, separator: str, drop_suffix: str = "") -> Column:
    """Last piece after splitting on a literal separator, less a literal suffix."""
    piece = F.element_at(F.split(_col(column), re.escape(separator)), -1)
    return replace_literal(piece, drop_suffix, "") if drop_suffix else piece
